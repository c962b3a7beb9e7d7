"""One kind of missing value: NaN, infinities and sentinels become null."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the stations' marker for a reading that was not taken.
STATION_SENTINEL = -9999


def finite(column: Column) -> Column:
    """Null in place of NaN and plus or minus infinity."""
    bad = F.isnan(column) | (F.abs(column) == F.lit(float("inf")))
    return F.when(~bad, column)


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def nonfinite_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: finite(F.col(c)) for c in float_columns(df)})


def sentinel_to_null(
    df: DataFrame, sentinels: Iterable[float] = (STATION_SENTINEL,), cols: list[str] | None = None
) -> DataFrame:
    values = list(sentinels)
    cols = numeric_columns(df) if cols is None else cols
    return df.withColumns({c: F.when(~F.col(c).isin(values), F.col(c)) for c in cols})


def present(df: DataFrame, cols: Iterable[str] | None = None) -> Column:
    """Whether a row has a value in every given column; NaN is none.

    Plain null tests reach the scan, unlike ``na.drop``.
    """
    floats = set(float_columns(df))
    test = F.lit(True)
    for c in df.columns if cols is None else cols:
        test = test & F.col(c).isNotNull()
        if c in floats:
            test = test & ~F.isnan(c)
    return test


def drop_missing(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows with any missing value (in ``subset``)."""
    return df.where(present(df, subset))


def null_share(cols: Iterable[str]) -> Column:
    """Share of the given columns that are null in a row."""
    cols = list(cols)
    total = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    return total / F.lit(float(len(cols)))


def drop_sparse_rows(
    df: DataFrame, max_null: float = 0.6, cols: list[str] | None = None
) -> DataFrame:
    """Keep rows whose share of nulls is below ``max_null`` (strictly)."""
    return df.where(null_share(cols or df.columns) < max_null)
