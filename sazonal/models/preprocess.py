"""Imputation, scaling and one-hot encoding, fitted on the training part only."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import finite, numeric_columns, text_columns
from ..operators.quantiles import exact_quantiles, most_frequent


@dataclass(frozen=True)
class NumericStep:
    col: str
    median: float
    mean: float = 0.0
    scale: float = 1.0

    @property
    def name(self) -> str:
        return f"numeric__{self.col}"

    def filled(self) -> Column:
        return F.coalesce(finite(F.col(self.col).cast("double")), F.lit(self.median))

    def column(self) -> Column:
        out = self.filled()
        if (self.mean, self.scale) != (0.0, 1.0):
            out = (out - F.lit(self.mean)) / F.lit(self.scale)
        return out.alias(self.name)


@dataclass(frozen=True)
class CategoryStep:
    col: str
    mode: str
    categories: tuple[str, ...]

    def columns(self) -> list[Column]:
        value = F.coalesce(F.col(self.col), F.lit(self.mode))
        return [
            F.when(value == c, 1.0).otherwise(0.0).alias(f"categorical__{self.col}_{c}")
            for c in self.categories
        ]


@dataclass(frozen=True)
class Preprocessor:
    """Fitted preparation; ``transform`` is one projection without a shuffle."""

    numeric: tuple[NumericStep, ...]
    categorical: tuple[CategoryStep, ...]
    # Means of other columns, asked for when fitting with scaling.
    means: tuple[float, ...] = ()

    @property
    def feature_names(self) -> list[str]:
        return [s.name for s in self.numeric] + [
            f"categorical__{s.col}_{c}" for s in self.categorical for c in s.categories
        ]

    def transform(self, df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
        made = [s.column() for s in self.numeric]
        made += [c for s in self.categorical for c in s.columns()]
        return df.select(*keep, *made)


def safe_scale(mean: float, std: float | None) -> float:
    """Population deviation, or 1 for a constant column."""
    if std is None or std <= 1e-12 * max(1.0, abs(mean)):
        return 1.0
    return std


def fit_scale(
    df: DataFrame, steps: Sequence[NumericStep], also: Sequence[str] = ()
) -> tuple[list[NumericStep], list[float]]:
    """Mean and population deviation after imputation; means of other columns.

    All columns share one pass.
    """
    aggs = [F.avg(c) for c in also]
    for s in steps:
        aggs += [F.avg(s.filled()), F.stddev_pop(s.filled())]
    row = list(df.agg(*aggs).first()) if aggs else []
    means, row = row[: len(also)], row[len(also) :]
    scaled = [
        NumericStep(s.col, s.median, row[2 * i], safe_scale(row[2 * i], row[2 * i + 1]))
        for i, s in enumerate(steps)
    ]
    return scaled, means


def fit_categories(df: DataFrame, col: str) -> CategoryStep | None:
    """Mode and sorted categories. They become columns, so the driver needs the list."""
    mode = most_frequent(df, col)
    if mode is None:
        return None
    found = df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)
    return CategoryStep(col, mode, tuple(r[0] for r in found.collect()))


def fit_preprocessor(
    df: DataFrame,
    features: Sequence[str],
    scale: bool = True,
    exclude: Iterable[str] = (),
    also: Sequence[str] = (),
) -> Preprocessor:
    """Fit on ``df``: median (and scaling) of numbers, mode and categories of texts.

    A column without any value in ``df`` is left out; other types are dropped. With
    scaling, the means of the columns in ``also`` come out of the same pass.
    """
    skip = set(exclude)
    frame = df.select(*features)
    numbers = numeric_columns(frame, exclude=skip)
    medians = exact_quantiles(frame, numbers, (0.5,))
    steps = [NumericStep(c, medians[c][0]) for c in numbers if medians[c][0] is not None]
    means: list[float] = []
    if scale:
        steps, means = fit_scale(df, steps, also)
    texts = [fit_categories(frame, c) for c in text_columns(frame, exclude=skip)]
    return Preprocessor(
        tuple(steps),
        tuple(t for t in texts if t is not None),
        tuple(means),
    )
