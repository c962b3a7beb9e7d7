"""Principal components that keep a share of the variance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import column_means, gram


@dataclass(frozen=True)
class Components:
    cols: tuple[str, ...]
    means: tuple[float, ...]
    vectors: tuple[tuple[float, ...], ...]
    ratios: tuple[float, ...]

    def transform(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """``PC1..PCk`` of the centred columns beside the kept ones."""
        keep = [c for c in df.columns if c not in self.cols] if keep is None else list(keep)
        made = []
        for i, vector in enumerate(self.vectors):
            terms = [
                (F.col(c) - F.lit(m)) * F.lit(v) for c, m, v in zip(self.cols, self.means, vector)
            ]
            made.append(sum(terms[1:], terms[0]).alias(f"PC{i + 1}"))
        return df.select(*made, *keep)


def pca_variance(df: DataFrame, cols: Sequence[str], keep: float = 0.95) -> Components:
    """Fewest components whose summed share of the variance exceeds ``keep``.

    Each component's largest weight is positive, so that signs do not vary.
    """
    n, means = column_means(df, cols)
    values, vectors = np.linalg.eigh(gram(df, cols, means) / max(n - 1, 1))
    order = np.argsort(values)[::-1]
    values, vectors = np.clip(values[order], 0.0, None), vectors[:, order]
    ratios = values / values.sum()
    k = min(int(np.searchsorted(np.cumsum(ratios), keep, side="right")) + 1, len(ratios))
    chosen = vectors[:, :k]
    largest = chosen[np.abs(chosen).argmax(axis=0), np.arange(k)]
    chosen = chosen * np.sign(largest)
    return Components(
        tuple(cols),
        tuple(float(m) for m in means),
        tuple(tuple(float(v) for v in chosen[:, i]) for i in range(k)),
        tuple(float(r) for r in ratios),
    )
