"""Projection, renaming and column choice."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import normalize_name

# Column names of the notification files in both eras.
CASE_NAMES = {
    "nu_notificacao": "id",
    "dt_notificacao": "data",
    "nu_notific": "id",
    "dt_notific": "data",
}
# Column names of the station files.
STATION_NAMES = {"data_yyyy_mm_dd": "data", "hora_utc": "hora"}
# Wind columns that not every station file has.
WIND_COLUMNS = (
    "vento_rajada_maxima_m_s",
    "vento_direcao_horaria_gr_gr",
    "vento_velocidade_horaria_m_s",
)
# Names of the sensors once averaged.
FEATURE_NAMES = {
    "contagem": "casos_dengue",
    "precipitacao_total_horario_mm": "precipitacao_total_media_mm",
    "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb": "pressao_atmosferica_media_mb",
    "pressao_atmosferica_max_na_hora_ant_aut_mb": "pressao_atmosferica_max_media_mb",
    "pressao_atmosferica_min_na_hora_ant_aut_mb": "pressao_atmosferica_min_media_mb",
    "temperatura_do_ar_bulbo_seco_horaria_c": "temperatura_ar_media_c",
    "temperatura_do_ponto_de_orvalho_c": "temperatura_ponto_orvalho_media_c",
    "temperatura_maxima_na_hora_ant_aut_c": "temperatura_max_media_c",
    "temperatura_minima_na_hora_ant_aut_c": "temperatura_min_media_c",
    "temperatura_orvalho_max_na_hora_ant_aut_c": "temperatura_orvalho_max_media_c",
    "temperatura_orvalho_min_na_hora_ant_aut_c": "temperatura_orvalho_min_media_c",
    "umidade_rel_max_na_hora_ant_aut": "umidade_rel_max_media",
    "umidade_rel_min_na_hora_ant_aut": "umidade_rel_min_media",
    "umidade_relativa_do_ar_horaria": "umidade_relativa_media",
}
# Columns of the concrete-strength table, by position.
CONCRETE_NAMES = (
    "cement",
    "blast_furnace_slag",
    "fly_ash",
    "water",
    "superplasticizer",
    "coarse_aggregate",
    "fine_aggregate",
    "age",
    "strength",
)


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist; columns that get one name are merged into it."""
    sources: dict[str, list[str]] = {}
    for c in df.columns:
        sources.setdefault(names.get(c, c), []).append(f"`{c}`")
    return df.select(
        *[
            (F.coalesce(*cols) if len(cols) > 1 else F.col(cols[0])).alias(new)
            for new, cols in sources.items()
        ]
    )


def require_columns(df: DataFrame, required: Iterable[str], label: str = "table") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{label} is missing required columns: {missing}")
    return df


def drop_matching(
    df: DataFrame,
    patterns: Iterable[str] = (r"^Unnamed",),
    contains: Iterable[str] = ("RADIACAO GLOBAL",),
    normalized: bool = False,
) -> DataFrame:
    """Drop columns whose name matches a pattern or contains a text."""
    if normalized:
        contains = [normalize_name(c) for c in contains]
    gone = [
        c
        for c in df.columns
        if any(re.search(p, c) for p in patterns) or any(t in c for t in contains)
    ]
    return df.drop(*gone)


def feature_columns(
    df: DataFrame, target: str, drop: Iterable[str] = ("uf", "municipio")
) -> list[str]:
    """Feature column names; features and target stay in one frame."""
    skip = {target, *drop}
    return [c for c in df.columns if c not in skip]


def split_only_dropped(df: DataFrame, date_col: str = "data") -> DataFrame:
    """Remove the column that only serves to split."""
    return df.drop(date_col)


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, non-null count. One pass over the data."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    kinds = dict(df.dtypes)
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col(c).alias("non_null")
            )
            for c in df.columns
        ]
    )
    return counts.select(F.inline(pairs))


def columns_in_rows(df: DataFrame, width: int = 7) -> list[list[str]]:
    """Column names in rows of ``width``, for display."""
    names = df.columns
    return [names[i : i + width] for i in range(0, len(names), width)]


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column absent from a frame is null there."""
    frames = list(frames)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
