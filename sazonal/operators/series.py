"""Row-based windows over ordered series of any length.

A daily series has one row per key and day, so the calendar bounds it; ``bounded`` says so, and
a window by key puts a whole series into one task. Any other series is range-partitioned on key
and order, which also cuts a hot key, and stored once. A pass over the parts takes the last
rows of each, the borders. Then each task reads its part in order, begins with the last rows
of the parts before it, and hands the last rows of each batch on to the next: every frame is
complete wherever it lies, and nothing is shuffled again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.missing import drop_missing
from ..session import materialize


def _ordered(order_by: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_last(c) for c in order_by]


def _serialized(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _runs(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Numbers of the runs of equal keys that the rows of a sorted batch belong to."""
    change = np.zeros(len(batch), bool)
    for k in keys:
        column = batch.column(k)
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(change)


def _key(batch: pa.RecordBatch, keys: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(k)[row].as_py() for k in keys)


def _last_rows(stored: DataFrame, keys: list[str], cols: list[str], back: int) -> dict[int, tuple[int, bool, tuple, bytes]]:
    """Per part: length of the run of keys that it ends with, whether that is the whole part,
    its key, and up to ``back`` of its rows. The driver gets at most ``back`` rows a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, length, whole, tail = None, None, 0, True, []

        def border() -> pa.RecordBatch:
            rows = pa.concat_batches(tail)
            rows = rows.slice(max(0, len(rows) - back))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([length], pa.int64()), pa.array([whole]),
                    pa.array([_serialized(rows)], pa.binary()), pa.array([_serialized(last)], pa.binary()),
                ],
                names=["part", "length", "whole", "tail", "last"],
            )

        for batch in batches:
            if not len(batch):
                continue
            of = batch.column("_part").to_numpy()
            for start in [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1)]:
                piece = batch.slice(start)
                piece = piece.slice(0, int(np.sum(of[start:] == of[start])))
                if of[start] != part:
                    if part is not None:
                        yield border()
                    part, key, length, whole, tail = int(of[start]), _key(piece, keys, 0), 0, True, []
                runs = _runs(piece, keys)
                ends = piece.slice(int(np.searchsorted(runs, runs[-1])))
                if runs[-1] > 0 or _key(piece, keys, 0) != key:
                    whole, length, tail = whole and length == 0 and runs[-1] == 0, 0, []
                key, length = _key(ends, keys, 0), length + len(ends)
                last = ends.slice(len(ends) - 1).select(keys or ["_part"])
                tail.append(ends.slice(max(0, len(ends) - back)).select(cols))
                if len(tail) > 1:
                    rows = pa.concat_batches(tail)
                    tail = [rows.slice(max(0, len(rows) - back))]
        if part is not None:
            yield border()

    found = stored.mapInArrow(run, "part int, length long, whole boolean, tail binary, last binary")
    out = {}
    for row in found.collect():
        last = pa.ipc.open_stream(row["last"]).read_all().to_batches()[0]
        out[row["part"]] = row["length"], row["whole"], _key(last, keys, 0), bytes(row["tail"])
    return out


def _before(borders: dict, part: int, key: tuple, back: int) -> tuple[int, list[pa.RecordBatch]]:
    """Of the rows of a key that lie in earlier parts: their number, and the last of them."""
    count, halo, held = 0, [], 0
    for at in range(part - 1, -1, -1):
        if at not in borders:
            continue
        length, whole, last, tail = borders[at]
        if last != key:
            break
        count += length
        if held < back:
            rows = pa.ipc.open_stream(tail).read_all().combine_chunks().to_batches()
            halo = [*rows, *halo]
            held += sum(map(len, rows))
        if not whole:
            break
    return count, halo


def _sorted_parts(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    sorting = [*[F.asc_nulls_last(k) for k in keys], *_ordered(order_by)]
    return materialize(
        df.repartitionByRange(*sorting).sortWithinPartitions(*sorting)
        .withColumn("_part", F.spark_partition_id())
    )


#: Rows of a batch with those before it, their run numbers, and how many stand before: columns
#: for all of them.
Compute = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], list[pa.Array]]


def _in_order(
    df: DataFrame, compute: Compute, schema: str, order_by: Sequence[str],
    partition_by: Sequence[str], cols: Sequence[str], back: int,
) -> DataFrame:
    """Add the columns that ``compute`` makes of ``cols`` of the rows in order, at most ``back``
    of them before the first; it also gets the position of each row within its series."""
    keys, cols = list(partition_by), list(dict.fromkeys([*partition_by, *cols, "_part"]))
    stored = _sorted_parts(df, keys, order_by)
    borders = df.sparkSession.sparkContext.broadcast(_last_rows(stored, keys, cols, back))
    made = [field.split()[0] for field in schema.split(", ")]
    names = [c for c in stored.columns if c != "_part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carried, count, key = None, [], 0, None
        for batch in batches:
            if not len(batch):
                continue
            of = batch.column("_part").to_numpy()
            for start in [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1)]:
                piece = batch.slice(start)
                piece = piece.slice(0, int(np.sum(of[start:] == of[start])))
                first = _key(piece, keys, 0)
                if of[start] != part:
                    part = int(of[start])
                    count, carried = _before(borders.value, part, first, back)
                elif first != key:
                    count = 0
                seen = sum(map(len, carried))
                rows = pa.concat_batches([*carried, piece.select(cols)])
                runs = _runs(rows, keys)
                # Rows of the same series before the piece count on; each further series begins at 0.
                own = runs[seen:]
                starts = np.searchsorted(own, own)
                place = np.arange(len(own)) - starts + np.where(own == own[0], count, 0)
                new = compute(rows, runs, place)
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(n) for n in names], *[a.slice(len(a) - len(piece)) for a in new]],
                    names=[*names, *made],
                )
                key, count = _key(piece, keys, len(piece) - 1), int(place[-1]) + 1
                carried = [rows.slice(max(0, len(rows) - back))] if back else []

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema if f.name != "_part")
    return stored.mapInArrow(run, f"{kinds}, {schema}")


def positions(
    df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (), name: str = "_pos"
) -> DataFrame:
    """Add the dense 0-based position of each row within its series. ``order_by`` should name
    enough columns to leave no ties."""

    def place(rows: pa.RecordBatch, runs: np.ndarray, at: np.ndarray) -> list[pa.Array]:
        return [pa.array(at, pa.int64())]

    return _in_order(df, place, f"{name} long", order_by, partition_by, [], 0)


def _windowed(column: pa.Array, runs: np.ndarray, width: int, ahead: int) -> np.ndarray:
    """Per row the ``width`` values that end ``ahead`` rows before it; NaN for missing ones and
    those of another series."""
    values = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
    pad = width - 1 + ahead
    values = np.concatenate([np.full(pad, np.nan), values])
    of = np.concatenate([np.full(pad, -1), runs])
    view = np.lib.stride_tricks.sliding_window_view
    n = len(runs)
    return np.where(view(of, width)[:n] == runs[:, None], view(values, width)[:n], np.nan)


def _median_of(window: np.ndarray, count: np.ndarray) -> np.ndarray:
    ordered, at = np.sort(window, axis=1), np.arange(len(window))
    low, high = np.maximum(count - 1, 0) // 2, count // 2
    high = np.minimum(high, window.shape[1] - 1)
    return (ordered[at, low] + ordered[at, high]) / 2.0


def _nullable(values: np.ndarray, there: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=~there)


def prior_window_mean(
    df: DataFrame,
    cols: Sequence[str],
    order_by: Sequence[str] = ("data",),
    partition_by: Sequence[str] = (),
    window: int = 30,
    bounded: bool = False,
) -> DataFrame:
    """Replace each column by the mean of the ``window`` rows before the current one.

    Rows, not calendar days. Null unless all those rows are there and not null. ``bounded``:
    a series has one row per day at most.
    """
    if bounded:
        frame = _by_key(partition_by, order_by).rowsBetween(-window, -1)
        return df.withColumns({
            c: F.when(F.count(c).over(frame) == window, F.avg(c).over(frame)) for c in cols
        })

    def means(rows: pa.RecordBatch, runs: np.ndarray, at: np.ndarray) -> list[pa.Array]:
        out = []
        for c in cols:
            sums = _windowed(rows.column(c), runs, window, 1).sum(axis=1)
            out.append(_nullable(sums / window, ~np.isnan(sums)))
        return out

    schema = ", ".join(f"_mean_{i} double" for i in range(len(cols)))
    out = _in_order(df, means, schema, order_by, partition_by, cols, window)
    return out.withColumns({c: F.col(f"_mean_{i}") for i, c in enumerate(cols)}).select(*df.columns)


def _by_key(partition_by: Sequence[str], order_by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*partition_by).orderBy(*_ordered(order_by))


def _median(ordered: Column) -> Column:
    n = F.size(ordered)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2.0


def rolling_impute(
    df: DataFrame,
    cols: Sequence[str],
    stat: str = "median",
    window: int = 6,
    min_periods: int = 2,
    order_by: Sequence[str] = ("data", "hora"),
    partition_by: Sequence[str] = (),
    bounded: bool = False,
) -> DataFrame:
    """Fill nulls with the median or mean of the last ``window`` rows, current included.

    Values come from the unfilled column; fewer than ``min_periods`` of them leave a null.
    """
    if stat not in ("median", "mean"):
        raise ValueError(f"Unknown statistic: {stat}")

    if bounded:
        frame = _by_key(partition_by, order_by).rowsBetween(-(window - 1), 0)
        made, centre = {}, {}
        for i, c in enumerate(cols):
            if stat == "median":
                made[f"_near_{i}"] = F.sort_array(F.collect_list(c).over(frame))
                ordered = F.col(f"_near_{i}")
                centre[c] = F.when(F.size(ordered) >= min_periods, _median(ordered))
            else:
                made[f"_near_{i}"] = F.avg(c).over(frame)
                made[f"_count_{i}"] = F.count(c).over(frame)
                centre[c] = F.when(F.col(f"_count_{i}") >= min_periods, F.col(f"_near_{i}"))
        out = df.withColumns(made)
    else:

        def near(rows: pa.RecordBatch, runs: np.ndarray, at: np.ndarray) -> list[pa.Array]:
            out = []
            for c in cols:
                held = _windowed(rows.column(c), runs, window, 0)
                count = np.count_nonzero(~np.isnan(held), axis=1)
                if stat == "median":
                    value = _median_of(held, count)
                else:
                    value = np.nansum(held, axis=1) / np.maximum(count, 1)
                out.append(_nullable(value, (count >= min_periods) & (count > 0)))
            return out

        schema = ", ".join(f"_near_{i} double" for i in range(len(cols)))
        out = _in_order(df, near, schema, order_by, partition_by, cols, window - 1)
        centre = {c: F.col(f"_near_{i}") for i, c in enumerate(cols)}
    return out.withColumns({c: F.coalesce(F.col(c), centre[c]) for c in cols}).select(*df.columns)


def _lagged(
    df: DataFrame, made: dict[str, tuple[str, int]], order_by: Sequence[str],
    partition_by: Sequence[str], bounded: bool,
) -> DataFrame:
    """Add columns that hold another one's value so many rows before."""
    if not made:
        return df
    if bounded:
        w = _by_key(partition_by, order_by)
        return df.withColumns({name: F.lag(c, k).over(w) for name, (c, k) in made.items()})
    steps = sorted({k for _, k in made.values()})

    def lags(rows: pa.RecordBatch, runs: np.ndarray, at: np.ndarray) -> list[pa.Array]:
        where = {}
        for k in steps:
            there = np.zeros(len(runs), bool)
            there[k:] = runs[k:] == runs[: max(0, len(runs) - k)]
            where[k] = pa.array(np.arange(len(runs)) - k, pa.int64(), mask=~there)
        return [rows.column(c).take(where[k]) for c, k in made.values()]

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"_lag_{i} {kinds[c]}" for i, (c, _) in enumerate(made.values()))
    cols = list(dict.fromkeys(c for c, _ in made.values()))
    out = _in_order(df, lags, schema, order_by, partition_by, cols, max(steps))
    return out.withColumnsRenamed({f"_lag_{i}": name for i, name in enumerate(made)})


def add_lags(
    df: DataFrame,
    cols: Sequence[str] | dict[str, str],
    lags: Sequence[int] = (7, 14, 21),
    order_by: Sequence[str] = ("data",),
    partition_by: Sequence[str] = (),
    dropna: bool = True,
    bounded: bool = False,
) -> DataFrame:
    """Add ``<name>_lag_<k>`` for the columns that exist, then drop incomplete rows.

    ``cols`` may map a column to the name its lags get.
    """
    names = cols if isinstance(cols, dict) else {c: c for c in cols}
    made = {f"{n}_lag_{k}": (c, k) for c, n in names.items() if c in df.columns for k in lags}
    out = _lagged(df, made, order_by, partition_by, bounded)
    return drop_missing(out) if dropna else out


def lag_matrix(
    df: DataFrame,
    cols: Sequence[str],
    n: int = 30,
    order_by: Sequence[str] = ("data",),
    partition_by: Sequence[str] = ("uf", "municipio"),
    keep: Sequence[str] | None = None,
    bounded: bool = False,
) -> DataFrame:
    """``<col>_dia_1`` to ``<col>_dia_n`` for every column; same-day values are not kept."""

    keep = [c for c in df.columns if c not in cols] if keep is None else list(keep)
    made = {f"{c}_dia_{k}": (c, k) for c in cols for k in range(1, n + 1)}
    chosen = df.select(*dict.fromkeys([*keep, *partition_by, *order_by, *cols]))
    out = _lagged(chosen, made, order_by, partition_by, bounded)
    return out.select(*keep, *[f"{c}_dia_{k}" for c in cols for k in range(1, n + 1)])
