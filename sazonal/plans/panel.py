"""The multi-city datasets: trailing means, or one column per day before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_parts, date_from_parts
from ..functions.missing import drop_missing, nonfinite_to_null, numeric_columns
from ..operators.aggregate import sort_nulls_last
from ..operators.coverage import coverage_filter
from ..operators.schema import require_columns
from ..operators.series import lag_matrix, prior_window_mean

KEYS = ("uf", "municipio")


def _with_cases(
    features: DataFrame, cases: DataFrame, keys: Sequence[str], frac: float
) -> DataFrame:
    """Join the cases, keep covered places and complete rows, turn the date into parts.

    A row without cases is dropped in the end and does not count as coverage, so the
    join can be inner from the start.
    """
    joined = features.join(cases, ["data", *keys])
    covered = coverage_filter(joined, keys, "casos_dengue", frac)
    return calendar_parts(drop_missing(covered)).drop("data")


def panel_dataset(
    weather: DataFrame,
    cases: DataFrame,
    window: int = 30,
    frac: float = 0.5,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Trailing-mean dataset out of one weather row and one case row per place and day."""
    sensors = numeric_columns(weather, exclude=(*keys, "data"))
    before = prior_window_mean(weather, sensors, ("data",), keys, window, bounded=True)
    return _with_cases(before, cases, keys, frac)


def lag_panel_dataset(
    weather: DataFrame,
    cases: DataFrame,
    n: int = 30,
    frac: float = 0.5,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """As ``panel_dataset`` with ``<sensor>_dia_1..n`` in place of the means."""
    sensors = numeric_columns(weather, exclude=(*keys, "data"))
    lagged = lag_matrix(weather, sensors, n, ("data",), keys, keep=[*keys, "data"], bounded=True)
    return _with_cases(lagged, cases, keys, frac)


def panel_supervised(
    df: DataFrame, target: str = "casos_dengue"
) -> tuple[DataFrame, list[str]]:
    """Clean rows of a stored panel with their date, places dropped; and the features."""
    require_columns(df, ("ano", "mes", "dia", target), "dataset")
    dated = df.withColumn("data", date_from_parts(F.col("ano"), F.col("mes"), F.col("dia")))
    clean = drop_missing(nonfinite_to_null(dated), ["data", target])
    places = [k for k in KEYS if k in df.columns]
    out = sort_nulls_last(clean, ["data", *places]).drop(*KEYS)
    return out, [c for c in out.columns if c != target]
