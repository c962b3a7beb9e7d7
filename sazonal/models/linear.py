"""Least squares from a Gram matrix that Spark sums up.

One pass over the centred features and target gives all their products, added up on the
executors; only a small square matrix reaches the driver, which solves it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .products import segment_products

# Relative size below which an eigenvalue of the Gram matrix counts as zero.
RANK_TOLERANCE = 1e-12


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    alpha: float | None = None

    def predict(self) -> Column:
        terms = [F.col(f) * F.lit(c) for f, c in zip(self.features, self.coefficients)]
        return sum(terms, F.lit(self.intercept))

    def table(self, df: DataFrame) -> DataFrame:
        """``feature, coefficient`` rows with the intercept, for storing."""
        rows = [("(intercept)", self.intercept), *zip(self.features, self.coefficients)]
        return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def column_means(df: DataFrame, cols: Sequence[str]) -> tuple[int, np.ndarray]:
    row = df.agg(F.count("*"), *[F.avg(c) for c in cols]).first()
    if not row[0]:
        raise ValueError("Cannot fit a model on no rows.")
    return row[0], np.array(row[1:], dtype=float)


def gram(df: DataFrame, cols: Sequence[str], centre: Sequence[float] | None = None) -> np.ndarray:
    """Sums of products of all column pairs, optionally of centred columns."""
    centre = [0.0] * len(cols) if centre is None else centre
    centred = [F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(cols, centre)]
    found = segment_products(df, centred, F.lit(0))
    return found[0].gram[:-1, :-1] if found else np.zeros((len(cols), len(cols)))


def moments(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    fit_intercept: bool = True,
    centre: Sequence[float] | None = None,
) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, float]:
    """Row count, Gram matrix, products with the target, feature means, target mean.

    ``centre`` has a value near each column's mean (within about its deviation); the
    sums are taken around it and moved to the means, which saves the pass that would
    find the means first.
    """
    cols = [*features, target]
    if not fit_intercept:
        centre = [0.0] * len(cols)
    elif centre is None:
        centre = column_means(df, cols)[1]
    centred = [F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(cols, centre)]
    found = segment_products(df, centred, F.lit(0))
    if not found:
        raise ValueError("Cannot fit a model on no rows.")
    g, n = found[0].gram, found[0].rows
    means = np.zeros(len(cols))
    products = g[:-1, :-1]
    if fit_intercept:
        off = g[:-1, -1] / n
        products = products - n * np.outer(off, off)
        means = np.asarray(centre, dtype=float) + off
    return n, products[:-1, :-1], products[:-1, -1], means[:-1], float(means[-1])


def non_negative_solve(g: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimise ``x'Gx/2 - b'x`` with ``x >= 0`` by the active-set method."""
    n = len(b)
    x = np.zeros(n)
    free = np.zeros(n, dtype=bool)
    floor = 1e-10 * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(10 * n + 10):
        gain = np.where(free, -np.inf, b - g @ x)
        if free.all() or gain.max(initial=-np.inf) <= floor:
            break
        free[int(np.argmax(gain))] = True
        while True:
            z = np.zeros(n)
            z[free] = np.linalg.pinv(g[np.ix_(free, free)], rcond=RANK_TOLERANCE) @ b[free]
            blocked = free & (z <= 0)
            if not blocked.any():
                break
            step = np.min(x[blocked] / np.maximum(x[blocked] - z[blocked], 1e-300))
            x = x + step * (z - x)
            free &= x > 1e-14
            x[~free] = 0.0
        x = z
    return x


def solve(g: np.ndarray, b: np.ndarray, positive: bool = False) -> np.ndarray:
    """Coefficients from the products of the features, of minimum norm when they depend."""
    if positive:
        return non_negative_solve(g, b)
    return np.linalg.pinv(g, rcond=RANK_TOLERANCE, hermitian=True) @ b


def fit_linear(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    fit_intercept: bool = True,
    positive: bool = False,
    centre: Sequence[float] | None = None,
) -> LinearModel:
    """Ordinary least squares, of minimum norm when columns are dependent.

    ``positive`` keeps all coefficients at or above zero.
    """
    _, g, b, x_mean, y_mean = moments(df, features, target, fit_intercept, centre)
    w = solve(g, b, positive)
    intercept = y_mean - float(x_mean @ w) if fit_intercept else 0.0
    return LinearModel(tuple(features), tuple(float(v) for v in w), intercept)


def leave_one_out(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    inverses: np.ndarray,
    weights: np.ndarray,
    x_mean: np.ndarray,
    y_mean: float,
    n: int,
) -> np.ndarray:
    """Summed absolute and squared leave-one-out errors per penalty, in one pass."""
    features, size = list(features), len(inverses)

    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, 2))
        for batch in batches:
            x = batch[features].to_numpy(dtype=float) - x_mean
            y = batch[target].to_numpy(dtype=float) - y_mean
            for i in range(size):
                leverage = 1.0 / n + np.einsum("ij,jk,ik->i", x, inverses[i], x, optimize=True)
                e = np.abs((y - x @ weights[i]) / (1.0 - leverage))
                total[i] += e.sum(), (e * e).sum()
        yield pd.DataFrame(
            {"i": np.arange(size), "absolute": total[:, 0], "squared": total[:, 1]}
        )

    sums = (
        df.select(*features, target)
        .mapInPandas(errors, "i int, absolute double, squared double")
        .groupBy("i")
        .agg(F.sum("absolute").alias("absolute"), F.sum("squared").alias("squared"))
        .orderBy("i")
        .collect()
    )
    return np.array([[r.absolute, r.squared] for r in sums])


def ridge_loo(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    alphas: Sequence[float] = (0.1, 1.0, 10.0),
    scoring: str = "mse",
) -> tuple[LinearModel, dict[float, float]]:
    """Ridge with the penalty of least leave-one-out error (``mse`` or ``mae``).

    Returns the model and the error of each penalty. Two passes: the products, then the
    leave-one-out errors of all penalties together.
    """
    if scoring not in ("mse", "mae"):
        raise ValueError(f"Unknown scoring: {scoring}")
    n, g, b, x_mean, y_mean = moments(df, features, target)
    eye = np.eye(len(b))
    inverses = np.stack([np.linalg.inv(g + a * eye) for a in alphas])
    weights = inverses @ b
    sums = leave_one_out(df, features, target, inverses, weights, x_mean, y_mean, n)
    errors = dict(zip(alphas, sums[:, 0 if scoring == "mae" else 1] / n))
    best = min(range(len(alphas)), key=lambda i: errors[alphas[i]])
    w = weights[best]
    model = LinearModel(
        tuple(features), tuple(float(v) for v in w), y_mean - float(x_mean @ w), alphas[best]
    )
    return model, errors


def coefficient_table(model: LinearModel, df: DataFrame) -> DataFrame:
    """``feature, coefficient, abs_coefficient``, largest first."""
    rows = [(f, c, abs(c)) for f, c in zip(model.features, model.coefficients)]
    schema = "feature string, coefficient double, abs_coefficient double"
    return df.sparkSession.createDataFrame(rows, schema).orderBy(
        F.desc("abs_coefficient"), "feature"
    )
