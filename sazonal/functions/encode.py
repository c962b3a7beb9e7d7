"""Scores, units and encodings as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Periods of the calendar parts.
PERIODS = {"mes": 12, "dia": 31, "dia_da_semana": 7}
# Order in which a score column is looked for after the metric itself.
SCORE_FALLBACKS = ("rmse", "RMSE", "mae", "MAE", "mse", "MSE", "r2")
# Score columns of an evolutionary search, best is the largest value.
NEGATED_SCORES = ("root_mean_squared_error", "neg_root_mean_squared_error")


def encode_cyclical(df: DataFrame, col: str, period: float) -> DataFrame:
    """Replace ``col`` by its sine and cosine over ``period``."""
    angle = F.lit(2.0) * F.pi() * F.col(col) / F.lit(float(period))
    return df.withColumns({f"{col}_sin": F.sin(angle), f"{col}_cos": F.cos(angle)}).drop(col)


def encode_calendar(df: DataFrame, periods: dict[str, float] = PERIODS) -> DataFrame:
    for col, period in periods.items():
        if col in df.columns:
            df = encode_cyclical(df, col, period)
    return df


def bin_label(value: Column, edges: Sequence[Column], labels: Sequence[str]) -> Column:
    """Label of the left-closed bin; outside all bins gives null."""
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value >= low) & (value < high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def score_candidates(metric: str) -> list[str]:
    return [metric, metric.lower(), metric.upper(), *SCORE_FALLBACKS]


def first_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate that is a column of ``df``."""
    return next((c for c in candidates if c in df.columns), None)


def first_value(df: DataFrame, candidates: Sequence[str]) -> Column:
    """Row-wise first non-null value among the candidates that exist."""
    found = [F.col(c).try_cast("double") for c in dict.fromkeys(candidates) if c in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("double")


def comparable_rmse(
    framework: Column, metric: Column, value: Column, best_negated: Column
) -> Column:
    """Score on the RMSE scale.

    A leaderboard run stores RMSE or MSE. An evolutionary run stores negated scores:
    the largest one counts, or the stored value when the history has none.
    """
    name = F.lower(metric)
    leaderboard = F.when(name == "rmse", value).when((name == "mse") & (value >= 0), F.sqrt(value))
    evolved = F.abs(F.coalesce(best_negated, value))
    return F.when(framework == "h2o", leaderboard).when(framework == "tpot", evolved)


def seconds_to_minutes(c: Column) -> Column:
    return c / F.lit(60.0)


def millis_to_seconds(c: Column) -> Column:
    return c / F.lit(1000.0)


def share_to_percent(c: Column) -> Column:
    return c * F.lit(100.0)
