"""Missingness, distribution and correlation profiles."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import finite, float_columns, numeric_columns
from .quantiles import exact_quantiles


def null_shares(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Share of missing values per column; NaN and infinities of numbers are missing."""
    floats = set(float_columns(df))
    value = {c: finite(F.col(c)) if c in floats else F.col(c) for c in cols}
    return [F.avg(value[c].isNull().cast("int")).alias(c) for c in cols]


def _to_rows(wide: DataFrame, keys: Sequence[str], cols: Sequence[str], value: str) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("coluna"), F.col(c).alias(value)) for c in cols]
    )
    return wide.select(*keys, F.inline(pairs))


def missing_profile(
    df: DataFrame, by: Sequence[str] = (), cols: Sequence[str] | None = None
) -> DataFrame:
    """Percent missing per column (and group), largest first. One pass."""
    cols = [c for c in df.columns if c not in by] if cols is None else list(cols)
    wide = df.groupBy(*by).agg(*null_shares(df, cols))
    rows = _to_rows(wide, by, cols, "share")
    out = rows.select(*by, "coluna", (F.col("share") * 100.0).alias("percentual_faltantes"))
    return out.orderBy(F.desc("percentual_faltantes"), "coluna", *by)


def sparse_columns(
    df: DataFrame, max_null: float = 0.4, cols: Sequence[str] | None = None
) -> list[str]:
    """Columns whose share of nulls is not below ``max_null``."""
    cols = df.columns if cols is None else list(cols)
    row = df.agg(*null_shares(df, cols)).first()
    return [c for c in cols if not (row[c] is not None and row[c] < max_null)]


def drop_sparse_columns(
    df: DataFrame, max_null: float = 0.4, cols: Sequence[str] | None = None
) -> DataFrame:
    return df.drop(*sparse_columns(df, max_null, cols))


def per_file_missing(
    df: DataFrame,
    file: str = "arquivo",
    cols: Sequence[str] | None = None,
    present: str | None = None,
) -> DataFrame:
    """Mean over files of each file's percent missing, largest first.

    ``present`` names an array column with the columns the row's file has; a file is
    left out of the mean of the columns it lacks.
    """
    skip = {file, present}
    cols = [c for c in df.columns if c not in skip] if cols is None else list(cols)
    has = [F.max(F.array_contains(present, c)).alias(f"_has_{c}") for c in cols] if present else []
    wide = df.groupBy(file).agg(*null_shares(df, cols), *has)
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("coluna"),
                (F.when(F.col(f"_has_{c}"), F.col(c)) if present else F.col(c)).alias("share"),
            )
            for c in cols
        ]
    )
    return (
        wide.select(F.inline(pairs))
        .groupBy("coluna")
        .agg((F.avg("share") * 100.0).alias("media_percentual_faltantes"))
        .orderBy(F.desc_nulls_last("media_percentual_faltantes"), "coluna")
    )


def column_presence(headers: DataFrame, names: str = "colunas") -> DataFrame:
    """In how many files each column occurs; ``headers`` has one row per file."""
    return (
        headers.select(F.explode(F.array_distinct(names)).alias("coluna"))
        .groupBy("coluna")
        .agg(F.count("*").alias("qtd_arquivos"))
        .orderBy(F.desc("qtd_arquivos"), "coluna")
    )


def describe_exact(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max; one row per column."""
    cols = numeric_columns(df) if cols is None else list(cols)
    quartiles = exact_quantiles(df, cols, (0.25, 0.5, 0.75))
    stats = []
    for c in cols:
        x = finite(F.col(c).cast("double"))
        stats.append(
            F.struct(
                F.lit(c).alias("coluna"),
                F.count(x).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                *[
                    F.lit(v).cast("double").alias(name)
                    for name, v in zip(("p25", "p50", "p75"), quartiles[c])
                ],
                F.max(x).alias("max"),
            )
        )
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


# Up to this many columns all pairs are aggregated as expressions of one pass.
MAX_PAIR_COLUMNS = 40


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present."""
    cols = numeric_columns(df) if cols is None else list(cols)
    pairs = list(itertools.combinations_with_replacement(range(len(cols)), 2))
    width = MAX_PAIR_COLUMNS * (MAX_PAIR_COLUMNS + 1) // 2
    parts = []
    for start in range(0, len(pairs), width):
        chunk = pairs[start : start + width]
        made = []
        for i, j in chunk:
            r = F.corr(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double"))
            made.append((i, j, r))
            if i != j:
                made.append((j, i, r))
        rows = F.array(
            *[
                F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), r.alias("corr"))
                for i, j, r in made
            ]
        )
        parts.append(df.agg(rows.alias("m")).select(F.inline("m")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def scaling_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of each column."""
    stats = F.array(
        *[
            F.struct(
                F.lit(c).alias("coluna"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")
            )
            for c in cols
        ]
    )
    return df.agg(stats.alias("s")).select(F.inline("s"))
