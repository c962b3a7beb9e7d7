"""Cleaning of notification and station tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import notification_time, station_date, station_hour
from ..functions.missing import (
    STATION_SENTINEL,
    drop_missing,
    numeric_columns,
    sentinel_to_null,
)
from ..session import materialize
from .aggregate import first_per_key
from .profile import null_shares
from .schema import CASE_NAMES, STATION_NAMES, WIND_COLUMNS, rename_present
from .series import rolling_impute


def clean_cases(
    df: DataFrame,
    year_col: str = "ano_arquivo",
    order: Sequence[Column | str] = ("_arquivo", "_bloco", "_linha"),
) -> DataFrame:
    """``id, data`` per notification: parsed date, first row of each id per file year.

    Rows without a date text are dropped before, rows whose date cannot be read are
    not: such a row may be the first of its id.
    """
    named = rename_present(df, CASE_NAMES)
    dated = drop_missing(named, ["data"]).withColumn(
        "data", notification_time(F.col("data"), F.col(year_col)).cast("date")
    )
    kept = dated.select("id", "data", year_col, *order)
    return first_per_key(kept, [year_col, "id"], list(order)).select("id", "data", year_col)


def mask_sparse_columns(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], max_null: float = 0.3
) -> tuple[DataFrame, list[str]]:
    """Null out the columns that are too sparse within a file.

    The share is taken per key; columns that fail everywhere are dropped. Adds
    ``_kept``, the names that survive in the row's file. The shares are one small row
    per file, joined back on the key.
    """
    shares = df.groupBy(*keys).agg(*null_shares(df, cols))
    good = [F.when(F.col(c) < max_null, F.lit(c)) for c in cols]
    kept = materialize(shares.select(*keys, F.array_compact(F.array(*good)).alias("_kept")))
    alive = {r[0] for r in kept.select(F.explode("_kept")).distinct().collect()}
    names = [c for c in cols if c in alive]
    joined = df.join(kept, list(keys), "left")
    masked = joined.withColumns(
        {c: F.when(F.array_contains("_kept", c), F.col(c)) for c in names}
    ).drop(*[c for c in cols if c not in alive])
    return masked, names


def clean_weather(
    df: DataFrame,
    keys: Sequence[str] = ("arquivo",),
    year_col: str = "ano_arquivo",
    max_col_null: float = 0.3,
    max_row_null: float = 0.6,
    window: int = 6,
    min_periods: int = 2,
    sentinels: Sequence[float] = (STATION_SENTINEL,),
    **how,
) -> DataFrame:
    """Hourly readings of many files: parsed, sparse columns out, gaps filled per file.

    ``df`` has ``data`` and ``hora`` as text and sensors as numbers. All work is per
    ``keys``, so files never mix.
    """
    named = rename_present(df.drop(*WIND_COLUMNS), STATION_NAMES)
    dated = drop_missing(named, ["data"]).withColumns(
        {
            "data": station_date(F.col("data"), F.col(year_col)),
            "hora": station_hour(F.col("hora")),
        }
    )
    sensors = numeric_columns(dated, exclude=[*keys, year_col, "hora"])
    clean = sentinel_to_null(dated, sentinels, sensors)
    clean, sensors = mask_sparse_columns(clean, keys, sensors, max_col_null)
    filled = rolling_impute(
        clean, sensors, "median", window, min_periods, ("data", "hora"), keys, **how
    )
    missing = sum((F.col(c).isNull().cast("int") for c in ("data", "hora")), F.lit(0))
    for c in sensors:
        missing = missing + (F.array_contains("_kept", c) & F.col(c).isNull()).cast("int")
    width = F.size("_kept") + F.lit(2)
    return filled.where(missing / width < max_row_null).drop("_kept")
