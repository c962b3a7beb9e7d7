"""Exact quantiles of columns of any length.

Doubles are read as 64-bit whole numbers in the same order. A pass counts 16 bits of them:
the first the upper ones of all values, the next ones the following 16 of the values that
share the upper bits of a wanted rank. After four passes every rank is known to the last bit.
All columns, ranks and groups share each pass; a pass shuffles counts, and only the digits of
the wanted ranks reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import finite

DIGIT_BITS, PASSES = 16, 4
_SIGN = np.uint64(1 << 63)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Doubles as unsigned 64-bit numbers in the same order; both zeros are one."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def from_bits(bits: int) -> float:
    raw = bits ^ (1 << 63) if bits >> 63 else ~bits & (1 << 64) - 1
    return float(np.array([raw], np.uint64).view(np.float64)[0])


def _digits(df: DataFrame, cols: int, step: int, prefixes: list[np.ndarray]) -> DataFrame:
    """(col, segment, at, digit, n): counts of the digits of one step among the values whose
    upper bits are the column's prefix number ``at``."""
    upper, shift = np.uint64(64 - DIGIT_BITS * step if step else 0), np.uint64(64 - DIGIT_BITS * (step + 1))
    mask = np.uint64((1 << DIGIT_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments = batch.column("segment").to_numpy(zero_copy_only=False)
            parts = []
            for col in range(cols):
                column = batch.column(f"x{col}")
                there = column.is_valid().to_numpy(zero_copy_only=False)
                keys = ordered_bits(column.drop_null().to_numpy(zero_copy_only=False))
                held = segments[there].astype(np.int64)
                known = prefixes[col]
                if not len(known):
                    continue
                at = np.zeros(len(keys), np.int64)
                if step:
                    top = keys >> upper
                    at = np.minimum(np.searchsorted(known, top), len(known) - 1)
                    mine = known[at] == top
                    at, keys, held = at[mine], keys[mine], held[mine]
                digit = (keys >> shift & mask).astype(np.int64)
                code, n = np.unique((held * len(known) + at) << DIGIT_BITS | digit, return_counts=True)
                where, digit = code >> DIGIT_BITS, code & int(mask)
                parts.append((np.full(len(n), col), where // len(known), where % len(known), digit, n))
            if parts:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(columns, names=["col", "segment", "at", "digit", "n"])

    return df.mapInArrow(run, "col long, segment long, at long, digit long, n long")


def grouped_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    segment: Column,
    bounds: Sequence[int],
) -> list[dict[str, list[float | None]]]:
    """Exact quantiles over the rows with ``segment`` below each of ``bounds``, in four passes
    for all of them. Rows without a segment take no part."""
    cols = list(cols)
    if not cols or not bounds:
        return [{c: [None] * len(probs) for c in cols} for _ in bounds]
    if len(bounds) == 1:
        segment, bounds = F.when(segment < bounds[0], F.lit(0)), [1]
    values = df.select(
        segment.cast("long").alias("segment"),
        *[finite(F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)],
    ).where(F.col("segment") < max(bounds))
    # Per column, group and rank: upper bits known so far, and the rank among the values with them.
    known: dict[tuple[int, int, int], tuple[int, int]] = {}
    totals: dict[tuple[int, int], int] = {}
    prefixes = [np.zeros(1, np.uint64) for _ in cols]
    groups = F.array(*[F.struct(F.lit(i).alias("group"), F.lit(b).alias("bound")) for i, b in enumerate(bounds)])
    for step in range(PASSES):
        # Groups reach back over segments, so a count belongs to several of them.
        counts = (
            _digits(values, len(cols), step, prefixes)
            .groupBy("col", "segment", "at", "digit").agg(F.sum("n").alias("n"))
            .select("*", F.inline(groups)).where(F.col("segment") < F.col("bound"))
        )
        if len(bounds) > 1:
            counts = counts.groupBy("col", "group", "at", "digit").agg(F.sum("n").alias("n"))
        same = Window.partitionBy("col", "group", "at")
        counts = counts.withColumn("below", F.sum("n").over(same.orderBy("digit")) - F.col("n"))
        if step == 0:
            counts = counts.withColumn("total", F.sum("n").over(same))
            ranks = F.flatten(F.array(*[
                F.array(end(F.lit(float(p)) * (F.col("total") - 1)).cast("long"))
                for p in probs for end in (F.floor, F.ceil)
            ]))
            placed = counts.withColumn("rank", F.explode(F.array_distinct(ranks))).withColumn(
                "left", F.col("rank")
            )
        else:
            wanted = ", ".join(
                f"({c}, {g}, {int(np.searchsorted(prefixes[c], np.uint64(bits)))}, {rank}, {left})"
                for (c, g, rank), (bits, left) in known.items()
            )
            wanted = df.sparkSession.sql(f"SELECT * FROM VALUES {wanted} AS t(col, `group`, at, rank, left)")
            placed = counts.withColumn("total", F.lit(0)).join(wanted, ["col", "group", "at"])
        inside = (F.col("below") <= F.col("left")) & (F.col("left") < F.col("below") + F.col("n"))
        for row in placed.where(inside).collect():
            key = row["col"], row["group"], row["rank"]
            bits = known[key][0] if step else 0
            known[key] = bits << DIGIT_BITS | row["digit"], row["left"] - row["below"]
            if step == 0:
                totals[row["col"], row["group"]] = row["total"]
        prefixes = [
            np.array(sorted({bits for (c, *_), (bits, _) in known.items() if c == col}), np.uint64)
            for col in range(len(cols))
        ]
        if not known:
            break

    def quantile(col: int, group: int, p: float) -> float | None:
        if (col, group) not in totals:
            return None
        at = p * (totals[col, group] - 1)
        low, high = (from_bits(known[col, group, end(at)][0]) for end in (math.floor, math.ceil))
        return low + (high - low) * (at - math.floor(at))

    return [
        {c: [quantile(i, group, float(p)) for p in probs] for i, c in enumerate(cols)}
        for group in range(len(bounds))
    ]


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column's values; null, NaN and infinite ones
    are missing."""
    return grouped_quantiles(df, cols, probs, F.lit(0), [1])[0]


def most_frequent(df: DataFrame, col: str):
    """Most frequent value, the smallest among ties; counted per value, then a top-1."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    row = counts.orderBy(F.desc("n"), F.asc(col)).limit(1).first()
    return None if row is None else row[0]
