"""Cross-validation from sums per segment.

The borders of all folds cut the rows into segments. One pass sums the products of the
columns per segment (``products``); missing values and unknown categories enter as columns of
their own, so the sums serve every fold whatever median, mode, mean and deviation its own
training rows have. Fits need no further pass, and all folds are scored in one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import finite, numeric_columns, text_columns
from ..operators.quantiles import grouped_quantiles
from .linear import LinearModel, solve
from .preprocess import CategoryStep, NumericStep, Preprocessor, safe_scale
from .products import Products, no_products, segment_products


@dataclass(frozen=True)
class _Texts:
    """Counts of a text column's values by segment; None counts missing ones."""

    col: str
    counts: dict[int, dict[str | None, int]]

    @property
    def values(self) -> list[str]:
        return sorted({v for c in self.counts.values() for v in c if v is not None})

    def step(self, segments: Sequence[int]) -> CategoryStep | None:
        total: dict[str, int] = {}
        for s in segments:
            for value, n in self.counts.get(s, {}).items():
                if value is not None:
                    total[value] = total.get(value, 0) + n
        if not total:
            return None
        mode = min(total, key=lambda v: (-total[v], v))
        return CategoryStep(self.col, mode, tuple(sorted(total)))


@dataclass
class SegmentFit:
    """What the sums per segment say about a table; ``fit`` gives a model of any segments."""

    features: Sequence[str]
    target: str
    numbers: list[str]
    centre: dict[str, float]
    gaps: list[str]
    texts: list[_Texts]
    products: dict[int, Products]
    medians: dict[tuple[int, ...], dict[str, float | None]] = field(default_factory=dict)

    @property
    def width(self) -> int:
        return len(self.numbers) + len(self.gaps) + sum(len(t.values) + 1 for t in self.texts) + 1

    def fit(
        self, segments: Sequence[int], intercept: bool = True, positive: bool = False, scale: bool = True
    ) -> tuple[LinearModel, Preprocessor]:
        """Preparation and least squares fitted on the rows of ``segments`` only."""
        sums = reduce(add, [self.products.get(s, no_products(self.width)) for s in segments])
        n = sums.rows
        if not n:
            raise ValueError("Cannot fit a model on no rows.")
        steps, rows = self._numeric(segments, sums)
        categories, more = self._categories(segments)
        rows = np.array([*rows, *more]).reshape(len(rows) + len(more), sums.gram.shape[0])
        y = np.zeros(sums.gram.shape[0])
        y[-2] = 1.0
        means = rows @ sums.gram[:, -1] / n
        squares = np.einsum("ij,jk,ik->i", rows, sums.gram, rows) / n
        # Numbers stand beside their centre, categories as they are.
        shift = np.array([self.centre[s.col] for s in steps] + [0.0] * len(more))
        if scale:
            steps = [
                self._scaled(step, means[i], squares[i], shift[i], sums) for i, step in enumerate(steps)
            ]
        names = [s.name for s in steps] + [
            f"categorical__{s.col}_{c}" for s in categories for c in s.categories
        ]
        # Columns as the preparation makes them: (value - mean) / scale of the numbers.
        factor = np.array([1.0 / s.scale for s in steps] + [1.0] * len(more))
        offset = np.array([(c - s.mean) / s.scale for s, c in zip(steps, shift)] + [0.0] * len(more))
        made = rows * factor[:, None]
        made[:, -1] += offset
        y[-1] = self.centre[self.target]
        g, b = made @ sums.gram @ made.T, made @ sums.gram @ y
        x_mean, y_mean = made @ sums.gram[:, -1] / n, float(y @ sums.gram[:, -1]) / n
        if intercept:
            g, b = g - n * np.outer(x_mean, x_mean), b - n * x_mean * y_mean
        w = solve(g, b, positive)
        at = y_mean - float(x_mean @ w) if intercept else 0.0
        model = LinearModel(tuple(names), tuple(float(v) for v in w), at)
        return model, Preprocessor(tuple(steps), tuple(categories), (y_mean,))

    def _numeric(self, segments: Sequence[int], sums: Products) -> tuple[list[NumericStep], list[np.ndarray]]:
        medians = self.medians.get(tuple(segments), {})
        steps, rows = [], []
        for i, c in enumerate(self.numbers):
            row = np.zeros(sums.gram.shape[0])
            row[i] = 1.0
            # Without a gap anywhere in the table no row asks for the median.
            median = medians.get(c, None if c in self.gaps else self.centre[c])
            if median is None:
                continue
            if c in self.gaps:
                row[len(self.numbers) + self.gaps.index(c)] = median - self.centre[c]
            steps.append(NumericStep(c, median))
            rows.append(row)
        return steps, rows

    def _categories(self, segments: Sequence[int]) -> tuple[list[CategoryStep], list[np.ndarray]]:
        steps, rows = [], []
        at = len(self.numbers) + len(self.gaps)
        for text in self.texts:
            values, step = text.values, text.step(segments)
            if step is not None:
                steps.append(step)
                for value in step.categories:
                    row = np.zeros(self.width + 1)
                    row[at + values.index(value)] = 1.0
                    row[at + len(values)] = float(value == step.mode)
                    rows.append(row)
            at += len(values) + 1
        return steps, rows

    def _scaled(
        self, step: NumericStep, mean: float, square: float, centre: float, sums: Products
    ) -> NumericStep:
        at = self.numbers.index(step.col)
        low, high, mean, centre = sums.low[at], sums.high[at], float(mean), float(centre)
        if step.col in self.gaps:
            gap = len(self.numbers) + self.gaps.index(step.col)
            if sums.high[gap] > 0:
                # A missing value stands as 0 among the others; its median may as well.
                low, high = min(low, step.median - centre), max(high, step.median - centre)
        if low == high:
            return NumericStep(step.col, step.median, centre + mean, 1.0)
        spread = square - mean * mean
        if step.col in self.gaps and spread <= 1e-12 * square:
            spread = 0.0
        deviation = float(np.sqrt(max(spread, 0.0)))
        return NumericStep(step.col, step.median, centre + mean, safe_scale(centre + mean, deviation))


def sum_segments(
    df: DataFrame, features: Sequence[str], target: str, segment: Column
) -> SegmentFit:
    """Two passes: means and gaps, then all products; one more for each text column."""
    frame = df.select(*features)
    numbers, texts = numeric_columns(frame), text_columns(frame)
    tagged = df.select(*features, F.col(target).cast("double").alias("_y"), segment.alias("_segment")).where(
        "_segment is not null and _y is not null and not isnan(_y)"
    )
    value = {c: finite(F.col(c).cast("double")) for c in numbers}
    row = tagged.agg(
        F.avg("_y"), *[F.avg(value[c]) for c in numbers], *[F.count_if(value[c].isNull()) for c in numbers]
    ).first()
    centre = {target: row[0] or 0.0, **{c: row[1 + i] or 0.0 for i, c in enumerate(numbers)}}
    gaps = [c for i, c in enumerate(numbers) if row[1 + len(numbers) + i]]
    found = []
    for c in texts:
        counts: dict[int, dict[str | None, int]] = {}
        for r in tagged.groupBy("_segment", c).count().collect():
            counts.setdefault(r[0], {})[r[1]] = r[2]
        found.append(_Texts(c, counts))
    cols = [F.coalesce(value[c] - F.lit(centre[c]), F.lit(0.0)) for c in numbers]
    cols += [value[c].isNull().cast("double") for c in gaps]
    for t in found:
        cols += [F.coalesce((F.col(t.col) == v).cast("double"), F.lit(0.0)) for v in t.values]
        cols.append(F.col(t.col).isNull().cast("double"))
    cols.append(F.col("_y") - F.lit(centre[target]))
    products = segment_products(tagged, cols, F.col("_segment"))
    return SegmentFit(features, target, numbers, centre, gaps, found, products)


def add_medians(
    fits: SegmentFit, df: DataFrame, segment: Column, bounds: Sequence[int], cols: Sequence[str] | None = None
) -> None:
    """Medians of the rows below each bound, in four passes for all; by default of the columns
    with gaps only, as no fold uses another's."""
    cols = list(fits.gaps if cols is None else cols)
    if not cols:
        return
    # Rows that the sums pass over take no part here either.
    y = F.col(fits.target).cast("double")
    measured = F.when(y.isNotNull() & ~F.isnan(y), segment)
    for bound, found in zip(bounds, grouped_quantiles(df, cols, (0.5,), measured, bounds)):
        fits.medians[tuple(range(bound))] = {c: v[0] for c, v in found.items()}


def raw_prediction(model: LinearModel, prep: Preprocessor) -> Column:
    """The model's value from columns as they are before the preparation."""
    made = [s.column() for s in prep.numeric] + [c for s in prep.categorical for c in s.columns()]
    return reduce(add, [c * F.lit(w) for c, w in zip(made, model.coefficients)], F.lit(model.intercept))


def scored_segments(
    df: DataFrame,
    target: str,
    segment: Column,
    models: dict[int, tuple[LinearModel, Preprocessor]],
) -> DataFrame:
    """(fold, actual, predicted) of the rows of the segments that ``models`` has one for."""
    tagged = df.withColumn("_segment", segment).where(F.col("_segment").isin(list(models)))
    predicted: Column | None = None
    for number, (model, prep) in models.items():
        here, value = F.col("_segment") == number, raw_prediction(model, prep)
        predicted = F.when(here, value) if predicted is None else predicted.when(here, value)
    return tagged.select(
        F.col("_segment").cast("int").alias("fold"), F.col(target).cast("double").alias("actual"),
        predicted.alias("predicted"),
    )


def expanding_scores(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    segment: Column,
    folds: int,
    metrics: Callable[[DataFrame], DataFrame],
    **how,
) -> tuple[DataFrame, SegmentFit]:
    """Metrics of ``folds`` expanding folds: fold j is fitted on the segments before j and
    scored on segment j."""
    fits = sum_segments(df, features, target, segment)
    add_medians(fits, df, segment, range(1, folds + 1))
    models = {j: fits.fit(range(j), **how) for j in range(1, folds + 1)}
    return metrics(scored_segments(df, target, segment, models)), fits


def ridge_block_scores(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    block: Column,
    blocks: int,
    alphas: Sequence[float] = (0.1, 1.0, 10.0),
    scoring: str = "mae",
) -> DataFrame:
    """(fold, alpha, rows, rmse): every block is scored by a ridge fitted on all other rows,
    with the penalty of least leave-one-out error (``mae`` or ``mse``) among those rows.

    Two passes: the products per block, of which those of a fit are the total less the block;
    then the leave-one-out errors of all folds and penalties, beside the errors on the blocks.
    Rows with a missing value take no part.
    """
    if scoring not in ("mse", "mae"):
        raise ValueError(f"Unknown scoring: {scoring}")
    spark, names = df.sparkSession, [*features, target]
    rows = df.select(
        *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)], block.cast("int").alias("block")
    ).na.drop("any")
    cols = [f"c{i}" for i in range(len(names))]
    centre = rows.agg(*[F.avg(c) for c in cols]).first()
    if centre[0] is None:
        return spark.createDataFrame([], "fold int, alpha double, rows long, rmse double")
    products = segment_products(rows, [F.col(c) - F.lit(m) for c, m in zip(cols, centre)], F.col("block"))
    total = reduce(add, products.values())
    # Per fold and penalty: weights, means of the fit, inverse of its products.
    fits: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray, int]] = {}
    for k in range(blocks):
        held = products.get(k)
        g = total.gram - held.gram if held is not None else total.gram
        n = int(round(g[-1, -1]))
        if not n:
            continue
        means = g[:-1, -1] / n
        g = g[:-1, :-1] - n * np.outer(means, means)
        for a, alpha in enumerate(alphas):
            inverse = np.linalg.inv(g[:-1, :-1] + alpha * np.eye(len(features)))
            fits[k, a] = inverse @ g[:-1, -1], means, inverse, n
    shared = spark.sparkContext.broadcast((fits, np.array(centre)))

    def errors(batches):
        import pandas as pd

        held, centre = shared.value
        sums: dict[tuple[int, int], np.ndarray] = {key: np.zeros(4) for key in held}
        for batch in batches:
            data, of = batch[cols].to_numpy(float) - centre, batch["block"].to_numpy()
            for (k, a), (w, means, inverse, n) in held.items():
                z = data - means
                e = z[:, -1] - z[:, :-1] @ w
                inside = of == k
                leverage = 1.0 / n + np.einsum("ij,jk,ik->i", z[~inside, :-1], inverse, z[~inside, :-1])
                left_out = np.abs(e[~inside] / (1.0 - leverage))
                sums[k, a] += (left_out.sum(), (left_out**2).sum(), inside.sum(), (e[inside] ** 2).sum())
        yield pd.DataFrame(
            [(k, float(alphas[a]), *s) for (k, a), s in sums.items()],
            columns=["fold", "alpha", "absolute", "squared", "rows", "error"],
        )

    summed = rows.mapInPandas(
        errors, "fold int, alpha double, absolute double, squared double, rows double, error double"
    ).groupBy("fold", "alpha").agg(
        *[F.sum(c).alias(c) for c in ("absolute", "squared", "rows", "error")]
    )
    by = "absolute" if scoring == "mae" else "squared"
    best = summed.groupBy("fold").agg(F.min_by(F.struct("alpha", "rows", "error"), F.struct(by, "alpha")).alias("b"))
    return best.where("b.rows > 0").select(
        (F.col("fold") + 1).cast("int").alias("fold"), "b.alpha", F.col("b.rows").cast("long").alias("rows"),
        F.sqrt(F.col("b.error") / F.col("b.rows")).alias("rmse"),
    )
