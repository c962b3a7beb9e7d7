"""Packing documents into full sequences that each hold the sources in target proportions.

Every source is a queue of tokens, and the queues are the leaves of a binary tree. A node of
the tree serves its two sides by deficit round-robin, a quantum of tokens at a time: the side
whose service lags behind its share has the larger deficit and is next. After n quanta the
left side has therefore got n times its share, rounded, and what it still misses is the
deficit it carries on. As that is known for every n without serving what lies before, a task
computes from the tree alone the deficits with which any window begins: nothing is handed on
from window to window or from partition to partition, and yet nothing is forgotten.

A queue that has run dry leaves its share to the other side of its node. Documents are cut
where their queue's service in a window ends.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bin_completion import encoder
from .common import stored, text_bytes

WINDOW = 4096
#: Tokens that a queue is served at a time; windows are whole numbers of it.
QUANTUM = 64
#: The id that ends every document.
END = 2


# One queue -----------------------------------------------------------------------------


class Queue:
    """A leaf of the tree: its path from the root as (is the right side, own quanta, the
    other side's quanta, own weight, the other side's weight, the other side's odd tokens)."""

    def __init__(self, path: list[tuple[bool, int, int, int, int, int]], quanta: int):
        self.quanta = quanta
        self.at, self.border = 0, (0, 0)
        self.odd_before = sum(odd for right, *_, odd in path if right)
        self.steps = []
        for right, own, other, own_weight, other_weight, _ in path:
            if own_weight + other_weight == 0:
                own_weight, other_weight = own, other
            sides = (other, own, other_weight) if right else (own, other, own_weight)
            self.steps.append((right, *sides, own_weight + other_weight))

    def served(self, n: int) -> tuple[int, int]:
        """Of the first ``n`` quanta served by the root: the queue's own, and those of the
        leaves before it."""
        before = 0
        for right, left, rest, weight, both in self.steps:
            low = min(left, max(n - rest, (2 * n * weight + both) // (2 * both) if both else 0))
            if right:
                before += low
                n -= low
            else:
                n = low
        return n, before

    def share(self, first: int, last: int) -> tuple[int, int, int]:
        """Of the quanta ``first`` to ``last`` served by the root: the queue's own first and
        last, and how many of the others stand before them when a window lists its queues in
        the order of the leaves."""
        own, before = self.border if self.at == first else self.served(first)
        # The next window begins where this one ends.
        self.at, self.border = last, self.served(last)
        return own, self.border[0], self.border[1] - before

    def turn(self, nth: int) -> int:
        """Which of the quanta served by the root is the queue's own ``nth``."""
        for right, left, rest, weight, both in reversed(self.steps):
            if right:
                dry, lag = left + nth + 1, both - weight
                due = both * (2 * nth + 1) // (2 * lag) + 1 if lag else dry
            else:
                dry, lag = rest + nth + 1, weight
                due = -(-both * (2 * nth + 1) // (2 * lag)) if lag else dry
            nth = min(dry, due) - 1
        return nth


def places(
    queue: Queue, start: int, length: int, quanta: int, window: int, quantum: int
) -> Iterator[tuple[int, int, int]]:
    """(place in the queue, place in the stream, length) of the runs that tokens ``start`` to
    ``start + length`` of a queue fall into; the stream holds the windows in a row, and the
    odd tokens of all queues after ``quanta`` quanta."""
    end, even = start + length, queue.quanta * quantum
    if start < even:
        per_window = window // quantum
        at = queue.turn(start // quantum) // per_window
        upto = queue.turn((min(end, even) - 1) // quantum) // per_window
        for nth in range(at, upto + 1):
            first, last, before = queue.share(nth * per_window, min((nth + 1) * per_window, quanta))
            low, high = max(start, first * quantum), min(end, last * quantum)
            if low < high:
                yield low, nth * window + (before - first) * quantum + low, high - low
    if end > even:
        low = max(start, even)
        yield low, (quanta - queue.quanta) * quantum + queue.odd_before + low, end - low


class Sequences:
    """Sequences of a stream of tokens: whole windows, and the rest in falling powers of two,
    which need no padding."""

    def __init__(self, tokens: int, window: int):
        self.window = window
        self.full = tokens // window
        rest = tokens % window
        self.starts = [self.full * window]
        for bit in reversed(range(window.bit_length())):
            if rest >> bit & 1:
                self.starts.append(self.starts[-1] + (1 << bit))

    def cut(self, place: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, offset, length) of a run of tokens."""
        while length > 0:
            if place < self.starts[0]:
                number, offset = divmod(place, self.window)
                room = self.window - offset
            else:
                at = bisect.bisect_right(self.starts, place) - 1
                number, offset = self.full + at, place - self.starts[at]
                room = self.starts[at + 1] - place
            yield number, offset, min(room, length)
            place, length = place + room, length - room


# The tables ----------------------------------------------------------------------------


def _tokens(docs: DataFrame, path: str, id_col: str, text_col: str, source_col: str, end: int) -> DataFrame:
    """One row per document with its ids; ``deal`` is the task, ``before`` the tokens that
    the task has read of the same queue."""
    chosen = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        F.xxhash64(F.col(f"`{source_col}`")).alias("queue"),
        text_bytes(F.col(f"`{text_col}`")).alias("raw"),
    )
    kinds = dict(chosen.dtypes)
    closing = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        deal = TaskContext.get().partitionId()
        read: dict[int, int] = {}
        for batch in batches:
            ids, sizes, before = [], [], []
            for queue, raw in zip(batch.column("queue").to_pylist(), batch.column("raw")):
                tokens = encode(raw.as_py()) + closing
                ids.append(tokens)
                sizes.append(len(tokens) // 4)
                before.append(read.get(queue, 0))
                read[queue] = before[-1] + sizes[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("source"), batch.column("queue"),
                    pa.array([deal] * len(ids), pa.int64()), pa.array(before, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "source", "queue", "deal", "before", "doc_tokens", "ids"],
            )

    return chosen.mapInArrow(
        run,
        f"doc_id {kinds['doc_id']}, source {kinds['source']}, queue long, deal long, "
        "before long, doc_tokens long, ids binary",
    )


def _paths(queues: DataFrame) -> DataFrame:
    """(queue, quanta, path) from (queue, quanta, odd, weight): the bits of a queue's hash lead
    from the root to it; nodes with one side only are passed over."""
    levels = F.explode(F.sequence(F.lit(1), F.lit(64)))
    steps = queues.select("*", levels.alias("level")).withColumn(
        "node", F.expr("shiftrightunsigned(queue, 64 - level)")
    )
    nodes = steps.groupBy("level", "node").agg(
        *[F.sum(name).alias(name) for name in ("quanta", "odd", "weight")]
    )
    beside = nodes.select(
        "level", F.col("node").bitwiseXOR(F.lit(1)).alias("node"),
        *[F.col(name).alias(f"other_{name}") for name in ("quanta", "odd", "weight")],
    )
    step = F.struct(
        "level", (F.col("node").bitwiseAND(F.lit(1)) == 1).alias("right"), "quanta", "other_quanta",
        "weight", "other_weight", "other_odd",
    )
    paths = nodes.join(beside, ["level", "node"]).select("level", "node", step.alias("step"))
    found = steps.select("queue", "level", "node").join(paths, ["level", "node"]).groupBy("queue").agg(
        F.array_sort(F.collect_list("step")).alias("path")
    )
    return queues.select("queue", F.col("quanta").alias("own")).join(found, "queue", "left")


def pack_mixture(
    docs: DataFrame,
    tokenizer_path: str,
    weights: dict[str | None, int] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    window: int = WINDOW,
    quantum: int = QUANTUM,
    end: int = END,
) -> DataFrame:
    """(doc_id, source, start, length, ids, doc_tokens, sequence_id, offset), one row per piece.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. Without
    ``weights`` a source's target is its share of all tokens, the one that every window can
    meet until all documents are packed; with them, sources that are not named weigh nothing
    and are served when the others have run dry. In every window a source has its target
    within log2(sources) quanta. All sequences are full but the last few, whose lengths are
    powers of two.

    Null and empty texts are the end id alone. A null source is a source of its own; repeated
    rows and ids are packed as often as they come; an empty table gives no rows. No row is
    shuffled with its ids unless the table of offsets, one row per task and source, is too
    large for Spark to broadcast.
    """
    if window % quantum:
        raise ValueError(f"A window of {window} tokens is not a whole number of quanta of {quantum}.")
    tokens = stored(_tokens(docs, tokenizer_path, id_col, text_col, source_col, end), "mixture-tokens")
    per_deal = tokens.groupBy("deal", "queue").agg(
        F.sum("doc_tokens").alias("tokens"), F.min("source").alias("source")
    )
    earlier = Window.partitionBy("queue").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_deal.select("deal", "queue", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    size = F.sum("tokens")
    weight = size
    if weights is not None:
        named = F.lit(0)
        for source, amount in weights.items():
            named = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(int(amount))).otherwise(named)
        weight = F.max(named)
    queues = stored(
        per_deal.groupBy("queue").agg(size.alias("tokens"), weight.cast("long").alias("weight")).select(
            "queue", "tokens", "weight", F.expr(f"tokens div {quantum}").alias("quanta"),
            (F.col("tokens") % quantum).alias("odd"),
        ),
        "mixture-queues",
    )
    total, quanta = queues.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("quanta"), F.lit(0))
    ).first()
    offsets = stored(bases.join(_paths(queues), "queue"), "mixture-offsets")
    placed = tokens.join(offsets, ["deal", "queue"]).select(
        "doc_id", "source", "queue", "own", "path", (F.col("base") + F.col("before")).alias("start"),
        "doc_tokens", "ids",
    )
    kinds = dict(tokens.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = Sequences(total, window)
        known: dict[int, Queue] = {}
        for batch in batches:
            names, paths, own = (batch.column(name) for name in ("queue", "path", "own"))
            starts, sizes = batch.column("start").to_pylist(), batch.column("doc_tokens").to_pylist()
            rows, parts = [], []
            for at, name in enumerate(names.to_pylist()):
                queue = known.get(name)
                if queue is None:
                    steps = [tuple(step.values())[1:] for step in paths[at].as_py() or []]
                    queue = known[name] = Queue(steps, own[at].as_py())
                ids = batch.column("ids")[at].as_py()
                start = starts[at]
                for low, place, length in places(queue, start, sizes[at], quanta, window, quantum):
                    low -= start
                    for number, offset, n in sequences.cut(place, length):
                        rows.append((at, low, n, number, offset))
                        parts.append(ids[4 * low : 4 * (low + n)])
                        low += n
            if not rows:
                continue
            at, low, n, number, offset = np.array(rows, np.int64).T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at)), batch.column("source").take(pa.array(at)),
                    pa.array(low), pa.array(n), pa.array(parts, pa.binary()),
                    batch.column("doc_tokens").take(pa.array(at)), pa.array(number), pa.array(offset),
                ],
                names=["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return placed.mapInArrow(
        run,
        f"doc_id {kinds['doc_id']}, source {kinds['source']}, start long, length long, ids binary, "
        "doc_tokens long, sequence_id long, offset long",
    )
