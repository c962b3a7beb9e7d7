"""Sums of products of columns, per segment of the rows, in one pass.

A least-squares fit needs nothing of the rows but these sums, and the sums of several
segments add up. So folds that share rows are fitted from one pass over the table: expanding
folds from prefix sums, folds that leave one block out from the total less the block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOW, _HIGH = -1, -2


@dataclass(frozen=True)
class Products:
    """Of some rows: products of all column pairs, the last column being 1, and extremes."""

    gram: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __add__(self, other: Products) -> Products:
        return Products(
            self.gram + other.gram, np.minimum(self.low, other.low), np.maximum(self.high, other.high)
        )

    @property
    def rows(self) -> int:
        return int(round(self.gram[-1, -1]))


def no_products(width: int) -> Products:
    size = width + 1
    return Products(np.zeros((size, size)), np.full(size, np.inf), np.full(size, -np.inf))


def segment_products(df: DataFrame, cols: Sequence[Column], segment: Column) -> dict[int, Products]:
    """Products of ``cols`` and 1, by segment; rows without a segment or with a missing value
    take no part. Tasks add up their rows, Spark the tasks; one matrix per segment reaches the
    driver."""
    width = len(cols) + 1
    names = [f"x{i}" for i in range(width)]
    numbered = df.select(
        segment.cast("int").alias("segment"),
        *[c.cast("double").alias(n) for c, n in zip([*cols, F.lit(1.0)], names)],
    ).na.drop("any")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Products] = {}
        for batch in batches:
            held = batch.column("segment").to_numpy(zero_copy_only=False)
            x = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            for one in np.unique(held):
                part = x[held == one]
                found[int(one)] = found.get(int(one), no_products(width - 1)) + Products(
                    part.T @ part, part.min(axis=0), part.max(axis=0)
                )
        for one, sums in found.items():
            rows = [*sums.gram, sums.low, sums.high]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([one] * len(rows), pa.int32()),
                    pa.array([*range(width), _LOW, _HIGH], pa.int32()),
                    pa.array([r.tolist() for r in rows], pa.list_(pa.float64())),
                ],
                names=["segment", "at", "numbers"],
            )

    parts = numbered.mapInArrow(run, "segment int, at int, numbers array<double>")
    summary = Summarizer.metrics("sum", "min", "max").summary(array_to_vector("numbers"))
    merged = parts.groupBy("segment", "at").agg(summary.alias("s")).select(
        "segment", "at",
        F.when(F.col("at") == _LOW, vector_to_array("s.min"))
        .when(F.col("at") == _HIGH, vector_to_array("s.max"))
        .otherwise(vector_to_array("s.sum")).alias("numbers"),
    )
    out: dict[int, Products] = {}
    for row in merged.collect():
        sums = out.setdefault(row["segment"], no_products(width - 1))
        if row["at"] == _LOW:
            sums.low[:] = row["numbers"]
        elif row["at"] == _HIGH:
            sums.high[:] = row["numbers"]
        else:
            sums.gram[row["at"]] = row["numbers"]
    return out
