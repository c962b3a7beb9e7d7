"""Municipality lookup and the multi-city case and weather tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_of, station_date
from ..functions.missing import drop_missing, numeric_columns, sentinel_to_null, text_columns
from ..functions.names import fold_accents
from ..functions.text import decimal_comma, lower_key, upper_key
from .aggregate import mean_per_key
from .schema import STATION_NAMES, drop_matching, rename_present
from .series import rolling_impute


def municipality_map(
    municipalities: DataFrame, states: DataFrame, codes: DataFrame | None = None
) -> DataFrame:
    """``nome, uf, codigo_municipio``, reduced to the codes that occur.

    The 7-digit code loses its check digit. Lookups are joined by size: Spark
    broadcasts them while their measured size allows it.
    """
    named = municipalities.select("codigo_ibge", "nome", "codigo_uf").join(
        states.select("codigo_uf", "uf"), "codigo_uf", "left"
    )
    coded = named.select("nome", "uf", F.expr("codigo_ibge div 10").alias("codigo_municipio"))
    if codes is None:
        return coded
    return coded.join(codes.select("codigo_municipio"), "codigo_municipio", "left_semi")


def panel_cases(
    cases: DataFrame,
    municipalities: DataFrame,
    date_col: str = "DT_NOTIFIC",
    code_col: str = "ID_MUNICIP",
    accents: bool = True,
) -> DataFrame:
    """Cases per ``data, uf, municipio``.

    Notifications are counted per code and day before the lookup, so a city with many
    cases is a few rows by the time it is joined.
    """
    dated = cases.select(F.col(code_col).alias("_code"), day_of(F.col(date_col)).alias("data"))
    counted = drop_missing(dated).groupBy("_code", "data").agg(F.count("*").alias("_n"))
    named = counted.join(
        municipalities, F.col("_code") == F.col("codigo_municipio"), "left"
    ).select("data", upper_key(F.col("uf")).alias("uf"), lower_key(F.col("nome")).alias("municipio"), "_n")
    if not accents:
        named = named.withColumn("municipio", fold_accents(F.col("municipio")))
    return (
        drop_missing(named)
        .groupBy("data", "uf", "municipio")
        .agg(F.sum("_n").alias("casos_dengue"))
    )


def keys_from_file_name(df: DataFrame, file_col: str = "arquivo", accents: bool = True) -> DataFrame:
    """``uf`` and ``municipio`` from parts 2 and 4 of the file name."""
    stem = F.regexp_replace(F.col(file_col), r"\.[^.]*$", "")
    parts = F.split(stem, "_")
    city = lower_key(F.get(parts, F.lit(4)))
    return df.withColumns(
        {
            "uf": upper_key(F.get(parts, F.lit(2))),
            "municipio": city if accents else fold_accents(city),
        }
    )


def panel_weather(
    df: DataFrame,
    window: int = 4,
    min_periods: int = 2,
    file_col: str = "arquivo",
    order_by: Sequence[str] = ("data", "hora"),
    accents: bool = True,
    sentinels: Sequence[float] = (),
    **how,
) -> DataFrame:
    """Daily sensor means per ``uf, municipio, data`` out of hourly text readings.

    Gaps are filled by a trailing mean within each file; rows still incomplete in a
    column their file has (``colunas``, when given) are dropped. Stations of a city are
    averaged unweighted. Values in ``sentinels`` count as missing; by default none do.
    """
    plain = drop_matching(df, contains=("RADIACAO GLOBAL", "radiacao_global"))
    plain = rename_present(plain, STATION_NAMES)
    keep = [file_col, "data", "hora", *(["colunas"] if "colunas" in df.columns else [])]
    numbers = numeric_columns(plain, exclude=keep)
    texts = text_columns(plain, exclude=keep)
    typed = plain.select(
        *keep,
        *numbers,
        *[decimal_comma(F.col(c)).alias(c) for c in texts],
    ).withColumn("data", station_date(F.col("data").cast("string")))
    sensors = numbers + texts
    if sentinels:
        typed = sentinel_to_null(typed, sentinels, sensors)
    filled = rolling_impute(
        typed, sensors, "mean", window, min_periods, order_by, (file_col,), **how
    )
    complete = F.col("data").isNotNull() & F.col("hora").isNotNull()
    for c in sensors:
        there = F.col(c).isNotNull()
        if "colunas" in keep:
            there = there | ~F.array_contains("colunas", c)
        complete = complete & there
    per_station = mean_per_key(filled.where(complete), [file_col, "data"], sensors)
    keyed = keys_from_file_name(per_station, file_col, accents)
    return mean_per_key(keyed, ["uf", "municipio", "data"], sensors)
