"""Leakage-free splits: by date, by row position, by hash."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.series import positions


def cut_by(value: Column, starts: Sequence[Column]) -> Column:
    """How many of the ascending ``starts`` a value has reached; null for null."""
    return reduce(add, [(value >= s).cast("int") for s in starts], F.lit(0))


@dataclass(frozen=True)
class Fold:
    """One fold as two row predicates."""

    number: int
    train: Column
    valid: Column


def unique_dates(df: DataFrame, date_col: str = "data") -> list[date]:
    """Sorted distinct days. The calendar bounds their number, whatever the row count."""
    day = F.col(date_col).cast("date").alias("d")
    return sorted(r.d for r in df.select(day).where("d is not null").distinct().collect())


def split_index(n: int, test_size: float) -> int:
    """First test position out of ``n``, kept away from both ends."""
    return min(max(int(n * (1 - test_size)), 1), n - 1)


def _check(test_size: float) -> None:
    if not 0 < test_size < 1:
        raise ValueError(f"A test_size between 0 and 1 is needed, not {test_size}.")


def chronological_split(
    df: DataFrame, date_col: str = "data", test_size: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """Train before and test from the date that leaves ``test_size`` of the dates.

    No date is in both parts; rows without a date are dropped.
    """
    _check(test_size)
    day = F.col(date_col).cast("date")
    rows = {r.d: r["count"] for r in df.groupBy(day.alias("d")).count().collect()}
    if sum(rows.values()) < 3:
        raise ValueError("Too few to split: it takes 3 rows.")
    dates = sorted(d for d in rows if d is not None)
    if len(dates) < 3:
        raise ValueError("Too few to split: it takes 3 unique dates.")
    cutoff = F.lit(dates[split_index(len(dates), test_size)])
    return df.where(day < cutoff), df.where(day >= cutoff)


def row_split(
    df: DataFrame, order_by: Sequence[str], test_size: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """Split by position in the given order."""
    _check(test_size)
    n = df.count()
    if n < 3:
        raise ValueError("Too few to split: it takes 3 rows.")
    at = split_index(n, test_size)
    placed = positions(df, order_by)
    return (
        placed.where(F.col("_pos") < at).drop("_pos"),
        placed.where(F.col("_pos") >= at).drop("_pos"),
    )


def expanding_bounds(n: int, n_splits: int) -> list[tuple[int, int, int]]:
    """``(fold, first valid, first after)`` of expanding folds over ``n`` positions."""
    size = n // (n_splits + 1)
    starts = [n - (n_splits - j) * size for j in range(n_splits)]
    return [(j + 1, s, s + size) for j, s in enumerate(starts)]


def time_folds(df: DataFrame, date_col: str = "data", n_splits: int = 5) -> list[Fold]:
    """Expanding folds over the distinct dates, as date ranges."""
    dates = unique_dates(df, date_col)
    k = min(n_splits, len(dates) - 1)
    if len(dates) < 3 or k < 2:
        return []
    day = F.col(date_col).cast("date")
    folds = []
    for number, first, after in expanding_bounds(len(dates), k):
        valid = (day >= F.lit(dates[first])) & (day <= F.lit(dates[after - 1]))
        folds.append(Fold(number, day < F.lit(dates[first]), valid))
    return folds


def time_segments(df: DataFrame, date_col: str = "data", n_splits: int = 5) -> tuple[Column, int]:
    """The folds of ``time_folds`` as segments: fold j is fitted on the segments before j and
    scored on segment j. Returns each row's segment, and the number of folds."""
    dates = unique_dates(df, date_col)
    k = min(n_splits, len(dates) - 1)
    if len(dates) < 3 or k < 2:
        return F.lit(0), 0
    starts = [F.lit(dates[first]) for _, first, _ in expanding_bounds(len(dates), k)]
    return cut_by(F.col(date_col).cast("date"), starts), k


def row_segments(
    df: DataFrame, order_by: Sequence[str], n_splits: int = 5
) -> tuple[DataFrame, Column, int]:
    """The folds of ``row_folds`` as segments; the frame has ``_pos``."""
    placed = positions(df, order_by)
    n = df.count()
    k = min(n_splits, max(0, n - 1))
    if k < 2:
        return placed, F.lit(0), 0
    starts = [F.lit(first) for _, first, _ in expanding_bounds(n, k)]
    return placed, cut_by(F.col("_pos"), starts), k


def row_blocks(
    df: DataFrame, order_by: Sequence[str], n_splits: int = 5
) -> tuple[DataFrame, Column]:
    """The blocks of ``block_folds``, numbered from 0; the frame has ``_pos``."""
    placed = positions(df, order_by)
    base, extra = divmod(df.count(), n_splits)
    starts = [F.lit(j * base + min(j, extra)) for j in range(1, n_splits)]
    return placed, cut_by(F.col("_pos"), starts)


def row_folds(
    df: DataFrame, order_by: Sequence[str], n_splits: int = 5
) -> tuple[DataFrame, list[Fold]]:
    """Expanding folds by row position; returns the frame with ``_pos`` and the folds."""
    placed = positions(df, order_by)
    n = df.count()
    k = min(n_splits, max(0, n - 1))
    if k < 2:
        return placed, []
    pos = F.col("_pos")
    return placed, [
        Fold(j, pos < first, (pos >= first) & (pos < after))
        for j, first, after in expanding_bounds(n, k)
    ]


def block_folds(
    df: DataFrame, order_by: Sequence[str], n_splits: int = 5
) -> tuple[DataFrame, list[Fold]]:
    """Unshuffled blocks: each block is validated on a fit of all other rows."""
    placed = positions(df, order_by)
    base, extra = divmod(df.count(), n_splits)
    pos, first, folds = F.col("_pos"), 0, []
    for j in range(n_splits):
        after = first + base + (1 if j < extra else 0)
        inside = (pos >= first) & (pos < after)
        folds.append(Fold(j + 1, ~inside, inside))
        first = after
    return placed, folds


def hash_split(
    df: DataFrame, key: Sequence[str], frac: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Random split that depends on the key alone, however the rows are partitioned."""
    draw = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    return df.where(draw < frac), df.where(draw >= frac)


#: Bits of a draw, and bits that each pass of the selection settles.
DRAW_BITS, DIGIT_BITS = 60, 15


def keyed_draw(key: Sequence[str], seed: int) -> Column:
    """A whole number of 60 bits that depends on the seed and the key alone; null counts as
    an empty text."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("long")


def smallest_draw(draws: DataFrame, rank: int) -> int | None:
    """The draw (a column of that name) at a rank from 1, or null beyond the last row. Each
    pass counts one digit of the draws that agree so far, so at most 2^15 counts reach the
    driver, whatever the number of rows."""
    found = 0
    for shift in range(DRAW_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        digit = F.shiftright("draw", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        counts = (
            draws.where(F.shiftright("draw", shift + DIGIT_BITS) == found)
            .groupBy(digit.alias("digit")).count().orderBy("digit").collect()
        )
        for row in counts:
            if rank <= row["count"]:
                found = found << DIGIT_BITS | row["digit"]
                break
            rank -= row["count"]
        else:
            return None
    return found


def random_split(
    df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Seeded random split of exact size: the test part has ``test_size`` of the rows, rounded
    up. Rows with the same key have the same draw and stay together; if the border falls
    among them, all are trained on. No row is shuffled or sorted.
    """
    _check(test_size)
    n = df.count()
    if n < 2:
        raise ValueError("Too few to split: it takes 2 rows.")
    draw = keyed_draw(key, seed)
    last = smallest_draw(df.select(draw.alias("draw")), n - min(math.ceil(n * test_size), n - 1))
    return df.where(draw <= last), df.where(draw > last)


def split_summary(
    df: DataFrame, target: str, split: str = "split", date_col: str | None = "data"
) -> DataFrame:
    """Rows, target mean and date range of each part."""
    dates = []
    if date_col is not None:
        day = F.col(date_col).cast("date")
        dates = [F.min(day).alias("start_date"), F.max(day).alias("end_date")]
    return df.groupBy(split).agg(
        F.count("*").alias("rows"), F.avg(target).alias("target_mean"), *dates
    )


def label_split(train: DataFrame, test: DataFrame, name: str = "split") -> DataFrame:
    return train.withColumn(name, F.lit("train")).unionByName(
        test.withColumn(name, F.lit("test"))
    )
