"""Keyed aggregation. Every aggregate here combines on the map side first.

Rows with a null key belong to no group, except where null keys count as one key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import drop_missing, numeric_columns


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "contagem") -> DataFrame:
    return drop_missing(df, keys).groupBy(*keys).agg(F.count("*").alias(name))


def mean_per_key(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Null-skipping mean of each numeric column per key."""
    cols = numeric_columns(df, exclude=keys) if cols is None else list(cols)
    return drop_missing(df, keys).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def sum_per_key(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return drop_missing(df, keys).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key in the given order; null keys count as one key.

    The rank filter becomes a group limit before the shuffle, so a key that holds a
    large part of the rows sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def distinct_values(frames: Iterable[DataFrame], col: str, name: str | None = None) -> DataFrame:
    """Distinct values of one column over several frames."""
    out = None
    for frame in frames:
        part = frame.select(F.col(col).alias(name or col)).distinct()
        out = part if out is None else out.union(part)
    return out.distinct()


def keys_missing_target(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Sorted distinct keys that have a row without a target."""
    return df.where(F.col(target).isNull()).select(*keys).distinct().orderBy(*keys)


def family_summary(
    df: DataFrame,
    family: str = "algo",
    model: str = "model_id",
    score: str = "rmse",
    time_ms: str = "training_time_ms",
) -> DataFrame:
    """Per model family: number of models, best and mean score, mean training time.

    Only the columns that exist are summarised; sorted by best score, or by count.
    """
    aggs = [F.count(model).alias("qtd_modelos")]
    if score in df.columns:
        aggs += [F.min(score).alias("melhor_rmse"), F.avg(score).alias("rmse_medio")]
    if time_ms in df.columns:
        aggs += [
            F.avg(time_ms).alias("tempo_medio_treino_ms"),
            (F.avg(time_ms) / 1000.0).alias("tempo_medio_treino_s"),
        ]
    by = "melhor_rmse" if score in df.columns else "qtd_modelos"
    return drop_missing(df, [family]).groupBy(family).agg(*aggs).orderBy(F.asc_nulls_last(by))


def top_models(df: DataFrame, n: int = 10, score: str = "rmse", ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` best models by score; without a score column, any ``n`` rows."""
    if score not in df.columns:
        return df.limit(n)
    return df.orderBy(F.asc_nulls_last(score), *ties).limit(n)


def last_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The last ``n`` rows in the given order, read from the reversed order."""
    return df.orderBy(*[F.desc_nulls_first(c) for c in order]).limit(n)


def sort_nulls_last(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in cols])
