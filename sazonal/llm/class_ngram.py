"""Scores of texts under a class-based bigram model whose classes come from exchange clustering.

A text's probability is the product, over its words and its end, of the probability of the
word's class after the class before it and of the word within its class.

* Counts of all words come from the whole training text.
* Words with at least ``ITEM_SHARE`` of all tokens are clustering items of their own; there
  are at most 1 / ITEM_SHARE of them, however large the corpus. All other words start in the
  item of their ending.
* Counts of neighbouring items are gathered by Spark into one row per item. In a sweep the
  items go through several lanes side by side. Within a lane one item after the other moves
  to the class in which the likelihood of the class bigrams is largest, and the next sees the
  move; lanes see each other's moves from the next sweep on. The classes with the best
  likelihood stay.
* Every other word that occurs ``LEAST`` times or more, however many there are, is then placed
  by its own neighbours: all executors move words, each to the class in which its occurrences
  are likeliest under the class counts of that time. Only rarer and unseen words keep the class of their ending.
* Class after class is counted anew over the whole training text with all words in their classes.
* Words with at least ``HEAD_SHARE`` of all tokens are looked up in a broadcast table, bounded
  by 1 / HEAD_SHARE entries; the others meet their counts and classes in one join.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, coded_words, distinct, fold_of, lean, stored, text_bytes
from .prefix_refinement import CUT, ROWS, Alive, Tally, alive_filter

ITEM_SHARE, HEAD_SHARE = 1e-4, 2e-6
#: Occurrences from which on a word's own neighbours say its class.
LEAST = 5
#: Items of rare words, classes, sweeps of the exchange, and lanes that a sweep has side by side.
ENDINGS, CLASSES, SWEEPS, LANES = 512, 96, 5, 4
#: Added to every word count, and per class to every transition.
WORD_MASS, STEP_MASS = 0.1, 0.5
#: Distinct words or item pairs that a task holds before it passes them on.
HELD = 400_000
PAIR = 1 << 20
#: Added to the class of a word whose own class is not known yet.
OPEN = 128


def _ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def _places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Where each word stands in a list of distinct words; -1 where it does not."""
    return pc.index_in(words, value_set=known).fill_null(-1).to_numpy().astype(np.int64)


def _items(words: pa.Array, items: dict[bytes, int]) -> np.ndarray:
    """The item of each word: its own or, from 1 to ``ENDINGS``, that of its ending."""
    endings = pc.binary_slice(words, -3).dictionary_encode()
    each = np.array([1 + _ending(ending) for ending in endings.dictionary.to_pylist()], np.int64)
    out = each[endings.indices.to_numpy()]
    if not items:
        return out
    # -1 is the last entry.
    own = np.array([*items.values(), 0])[_places(words, pa.array(list(items), pa.binary()))]
    return np.where(own > 0, own, out)


def _numbered(known: pa.Array, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The known words and behind them those of ``words`` that are new, and the place there of
    each of ``words``."""
    coded = pa.concat_arrays([known, words]).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()[len(known) :].astype(np.int64)


def _held(alive: Alive, words: pa.Array, n: np.ndarray) -> np.ndarray:
    """Which of the words the filter of those with ``LEAST`` occurrences lets through. Where
    ``n`` training occurrences say it already, it need not be asked."""
    out = n >= LEAST
    asked = words.filter(pa.array(~out))
    keys = pc.binary_join_element_wise(pa.scalar(b"", pa.binary()), asked, pa.scalar(CUT, pa.binary()))
    out[~out] = alive.holds_keys(keys.to_numpy(zero_copy_only=False))
    return out


def _with_ends(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The words' numbers in one line, with a 0 before the first text and behind every text."""
    line = np.zeros(len(codes) + len(starts), codes.dtype)
    line[1 + np.arange(len(codes)) + np.repeat(np.arange(len(starts) - 1), np.diff(starts))] = codes
    return line


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in batches of bounded size; the executor holds one of them at a time."""
    return (batch.slice(at, ROWS) for at in range(0, batch.num_rows, ROWS))


def _added(keys: np.ndarray, n: np.ndarray, more: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of distinct sorted keys, added up from two such."""
    if not len(keys):
        return more, m
    every, n = np.concatenate([keys, more]), np.concatenate([n, m])
    # Two sorted runs: a stable sort only merges them.
    order = np.argsort(every, kind="stable")
    every = every[order]
    at = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    return every[at], np.add.reduceat(n[order], at)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (fold_of(F.col(f"`{id_col}`"), 10) == 0).alias("held_out"),
        text_bytes(F.col(f"`{text_col}`")).alias("raw"),
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of the training texts, summed within tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally("word", "n")
        for batch in batches:
            words, codes, _ = coded_words(batch.column("raw"), WORD_BYTES)
            tally.add(np.zeros(len(words), np.int64), words, np.bincount(codes, minlength=len(words)))
            yield from tally.rows(HELD)
        yield from tally.rows(0)

    return (
        texts.where("not held_out").select("raw").mapInArrow(lean(run), "word binary, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )


def item_pairs(texts: DataFrame, items: dict[bytes, int]) -> DataFrame:
    """(pair, n): how often an item follows an item in the training texts; the end of a text
    is item 0 and stands before its first word, too."""
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            words, codes, starts = coded_words(batch.column("raw"), WORD_BYTES)
            # Texts stand between ends, so no pair crosses from one into the next.
            line = _with_ends(_items(words, shared.value)[codes], starts)
            keys, times = _added(keys, times, *distinct(line[:-1] * PAIR + line[1:]))
            if len(keys) > 4 * HELD:
                yield from _parts(pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], names=["pair", "n"]))
                keys, times = keys[:0], times[:0]
        if len(keys):
            yield from _parts(pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], names=["pair", "n"]))

    return (
        texts.where("not held_out").select("raw").mapInArrow(lean(run), "pair long, n long")
        .groupBy("pair").agg(F.sum("n").alias("n"))
    )


# Exchange clustering -------------------------------------------------------------------


def _contexts(pairs: DataFrame) -> DataFrame:
    """(item, after, after_n, before, before_n): one row per item, no longer than the number
    of items."""
    split = pairs.select(
        F.floor(F.col("pair") / PAIR).cast("int").alias("a"),
        (F.col("pair") % PAIR).cast("int").alias("b"), "n",
    )

    def lists(key: str, other: str, name: str) -> DataFrame:
        return split.groupBy(F.col(key).alias("item")).agg(
            F.collect_list(F.struct(F.col(other).alias("item"), "n")).alias(name)
        )

    joined = lists("a", "b", "after").join(lists("b", "a", "before"), "item", "full")
    return joined.select(
        "item", "after.item", F.col("after.n").alias("after_n"),
        F.col("before.item").alias("before"), F.col("before.n").alias("before_n"),
    ).toDF("item", "after", "after_n", "before", "before_n")


def _context_rows(batch: pa.RecordBatch):
    for row in batch.to_pylist():
        yield (
            row["item"],
            np.array(row["after"] or [], np.int64), np.array(row["after_n"] or [], np.float64),
            np.array(row["before"] or [], np.int64), np.array(row["before_n"] or [], np.float64),
        )


def class_counts(contexts: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Counts of class after class, summed on the executors."""
    shared = contexts.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_classes, n_classes))
        for batch in batches:
            for item, after, after_n, _, _ in _context_rows(batch):
                total[shared.value[item]] += np.bincount(shared.value[after], after_n, n_classes)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total.ravel()[at])], names=["cell", "n"]
        )

    out = np.zeros(n_classes * n_classes)
    for row in contexts.mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row["cell"]] = row["n"]
    return out.reshape(n_classes, n_classes)


def _spread(values: np.ndarray) -> np.ndarray:
    """n log n, 0 at 0."""
    return values * np.log(np.maximum(values, 1e-300))


def likelihood(counts: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, but for a part that no assignment changes."""
    return float(
        _spread(counts).sum() - _spread(counts.sum(axis=1)).sum() - _spread(counts.sum(axis=0)).sum()
    )


def best_class(
    item: int, after, after_n, before, before_n, classes: np.ndarray, counts: np.ndarray
) -> tuple[int, np.ndarray]:
    """Class in which the likelihood is largest if this item alone may move, and the class
    counts after the move."""
    n_classes = len(counts)
    own = classes[item]
    loops = float(after_n[after == item].sum())
    follow = np.bincount(classes[after], after_n, n_classes)
    lead = np.bincount(classes[before], before_n, n_classes)
    follow[own] -= loops
    lead[own] -= loops
    rest = counts.copy()
    rest[own] -= follow
    rest[:, own] -= lead
    rest[own, own] -= loops
    # Wherever the item goes, what leads to it counts in the leading rows, and so on.
    rows, columns = rest.sum(axis=1) + lead, rest.sum(axis=0) + follow
    # Row k and column k grow; the cell where they meet grows by both and by the loops.
    gain = (_spread(rest + follow[None, :]) - _spread(rest)).sum(axis=1)
    gain += (_spread(rest + lead[:, None]) - _spread(rest)).sum(axis=0)
    cell = np.diag(rest)
    gain -= _spread(cell + follow) + _spread(cell + lead) - 2 * _spread(cell)
    gain += _spread(cell + follow + lead + loops) - _spread(cell)
    all_after, all_before = follow.sum() + loops, lead.sum() + loops
    gain -= _spread(rows + all_after) - _spread(rows)
    gain -= _spread(columns + all_before) - _spread(columns)
    gain[0] = -np.inf
    best = int(np.argmax(gain))
    if not gain[best] > gain[own] + 1e-6:
        return int(own), counts
    rest[best] += follow
    rest[:, best] += lead
    rest[best, best] += loops
    return best, rest


def exchange(contexts: DataFrame, n_items: int, n_classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the items and the counts of class after class. Class 0 is the end's alone;
    the others start with every so-manieth item."""
    classes = np.zeros(n_items, np.int64)
    if n_items > 1:
        classes[1:] = 1 + np.arange(n_items - 1) % (n_classes - 1)
    context = contexts.sparkSession.sparkContext
    laned = contexts.withColumn("lane", F.col("item") % LANES).repartition(
        LANES, "lane"
    ).sortWithinPartitions("lane", "item")
    counts = class_counts(contexts, classes, n_classes)
    best = (likelihood(counts), classes, counts)
    for _ in range(SWEEPS):
        shared = context.broadcast((classes, counts))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lane, now, table = None, None, None
            for batch in batches:
                items, moves = [], []
                for at, (item, *lists) in zip(batch.column("lane").to_pylist(), _context_rows(batch)):
                    if at != lane:
                        lane, now, table = at, shared.value[0].copy(), shared.value[1]
                    if item == 0:
                        continue
                    to, table = best_class(item, *lists, now, table)
                    if to != now[item]:
                        now[item] = to
                        items.append(item)
                        moves.append(to)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int64()), pa.array(moves, pa.int64())], names=["item", "to"]
                )

        moved = laned.mapInArrow(run, "item long, to long").collect()
        if not moved:
            break
        classes = classes.copy()
        for row in moved:
            classes[row["item"]] = row["to"]
        counts = class_counts(contexts, classes, n_classes)
        reached = likelihood(counts)
        if reached > best[0]:
            best = (reached, classes, counts)
    return best[1], best[2]


# Words beyond the items -----------------------------------------------------------------


def word_neighbours(texts: DataFrame, items: dict[bytes, int], classes: np.ndarray, n_classes: int, left) -> DataFrame:
    """(word, codes, times), added up within a task: neighbours of the training words that the
    filter lets through and that are no items. A code is the class of what follows, or
    ``n_classes`` more than the class of what leads, or 2 ``n_classes`` where a word follows
    itself."""
    shared = texts.sparkSession.sparkContext.broadcast((items, classes, left))
    width = 2 * n_classes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, of, bits = shared.value
        alive = Alive(bits)
        # Words that are looked at, numbered, and what is counted of them.
        known = none = pa.array([], pa.binary())
        keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def batch_of(keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
            word, code = np.divmod(keys, width)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            ends = pa.array(np.r_[starts, len(word)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    known.take(pa.array(word[starts])),
                    pa.ListArray.from_arrays(ends, pa.array(code, pa.int16())),
                    pa.ListArray.from_arrays(ends, pa.array(times, pa.int32())),
                ],
                names=["word", "codes", "times"],
            )

        for batch in batches:
            words, codes, starts = coded_words(batch.column("raw"), WORD_BYTES)
            item = _items(words, items)
            others = np.flatnonzero(item <= ENDINGS)
            n = np.bincount(codes, minlength=len(words))
            others = others[_held(alive, words.take(pa.array(others)), n[others])]
            # By word, the end first: its class, and its number if it is looked at.
            kind, number = np.append(0, of[item]), np.full(len(words) + 1, -1)
            known, number[1 + others] = _numbered(known, words.take(pa.array(others)))
            line = _with_ends(codes + 1, starts)
            line, kind = number[line], kind[line]
            own = line >= 0
            loop = own[1:] & (line[1:] == line[:-1])
            after = np.where(loop, 2 * n_classes, kind[1:])
            fresh = np.concatenate([
                (line[:-1] * width + after)[own[:-1]],
                (line[1:] * width + n_classes + kind[:-1])[own[1:] & ~loop],
            ])
            keys, times = _added(keys, times, *distinct(fresh))
            if len(keys) > 4 * HELD or len(known) > HELD:
                if len(keys):
                    yield from _parts(batch_of(keys, times))
                keys, times, known = keys[:0], times[:0], none
        if len(keys):
            yield from _parts(batch_of(keys, times))

    return texts.where("not held_out").select("raw").mapInArrow(
        lean(run), "word binary, codes array<smallint>, times array<int>"
    )


def log_steps(counts: np.ndarray) -> np.ndarray:
    """log10 of the probability of a class after a class."""
    smooth = (counts.sum(axis=0) + 1.0) / (counts.sum() + len(counts))
    steps = counts + STEP_MASS * len(counts) * smooth[None, :]
    return np.log10(steps / steps.sum(axis=1, keepdims=True))


def best_places(own: np.ndarray, codes: np.ndarray, steps: np.ndarray, in_class: np.ndarray) -> np.ndarray:
    """Class of each word, now ``own``, in which its occurrences are likeliest beside the classes
    around them. A row of ``codes`` counts them as ``word_neighbours`` has them."""
    k = len(steps)
    after, before, loops = codes[:, :k], codes[:, k : 2 * k], codes[:, 2 * k :]
    gain = after @ steps.T + before @ steps + loops * np.diag(steps)
    gain -= (after.sum(axis=1, keepdims=True) + loops) * in_class
    gain[:, 0] = -np.inf
    best, each = gain.argmax(axis=1), np.arange(len(own))
    return np.where(gain[each, best] > gain[each, own] + 1e-6, best, own)


def placed_words(neighbours: DataFrame, classes: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(word, class) of the words with ``LEAST`` occurrences or more, from ``word_neighbours``.
    A word's row is no longer than there are codes."""
    width = 2 * len(counts) + 1
    in_class = np.log10(np.maximum(counts.sum(axis=0), WORD_MASS))
    shared = neighbours.sparkSession.sparkContext.broadcast(
        (classes[1 : 1 + ENDINGS], log_steps(counts), in_class)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings, steps, mass = shared.value

        def placed(words: list[bytes], codes: np.ndarray) -> pa.RecordBatch:
            # Every occurrence is followed by one token.
            often = codes[:, : width // 2].sum(axis=1) + codes[:, -1] >= LEAST
            words = pa.array(words, pa.binary()).filter(pa.array(often))
            own = endings[_items(words, {}) - 1]
            return pa.RecordBatch.from_arrays(
                [words, pa.array(best_places(own, codes[often], steps, mass), pa.int16())],
                names=["word", "class"],
            )

        # The last word's rows may go on in the next batch.
        words, codes = [], np.zeros((0, width))
        for batch in batches:
            found = batch.column("word").dictionary_encode()
            names = found.dictionary.to_pylist()
            rows = np.repeat(found.indices.to_numpy(), batch.column("codes").value_lengths().to_numpy())
            code, n = (batch.column(name).flatten().to_numpy() for name in ("codes", "times"))
            more = np.bincount(rows * np.int64(width) + code, n, len(names) * width).reshape(-1, width)
            if words and names and words[-1] == names[0]:
                more[0] += codes[-1]
                words, codes = words[:-1], codes[:-1]
            words, codes = words + names, np.concatenate([codes, more])
            if len(words) > 1:
                yield placed(words[:-1], codes[:-1])
                words, codes = words[-1:], codes[-1:].copy()
        if words:
            yield placed(words, codes)

    return neighbours.repartition("word").sortWithinPartitions("word").mapInArrow(
        lean(run), "word binary, class smallint"
    )


def vocabulary(texts: DataFrame, n_classes: int = CLASSES) -> tuple[DataFrame, np.ndarray, int]:
    """Stored (word, n, class) of all training words, the classes of the endings, and the
    number of training texts."""
    context = texts.sparkSession.sparkContext
    counts = stored(word_counts(texts), "ngram-words")
    ends = texts.where("not held_out").count()
    n_tokens = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + ends
    frequent = counts.where(F.col("n") >= max(2, math.ceil(ITEM_SHARE * n_tokens))).collect()
    frequent.sort(key=lambda row: (-row["n"], row["word"]))
    items = {bytes(row["word"]): 1 + ENDINGS + at for at, row in enumerate(frequent)}
    contexts = stored(_contexts(item_pairs(texts, items)), "ngram-contexts")
    classes, class_table = exchange(contexts, 1 + ENDINGS + len(items), n_classes)
    left = alive_filter(
        counts.where(F.col("n") >= LEAST).select(F.lit(b"").alias("lang"), F.col("word").alias("prefix"))
    )
    placed = placed_words(word_neighbours(texts, items, classes, n_classes, left), classes, class_table)
    shared = context.broadcast((items, classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, of = shared.value
        for batch in batches:
            own = pa.array(of[_items(batch.column("word"), table)], pa.int16())
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pc.coalesce(batch.column("class"), own)],
                names=["word", "n", "class"],
            )

    words = counts.join(placed, "word", "left").mapInArrow(run, "word binary, n long, class smallint")
    return stored(words, "ngram-classes"), classes[1 : 1 + ENDINGS], ends


# The model -----------------------------------------------------------------------------


@dataclass
class ClassModel:
    """Tables of bounded size: log10 of a class after a class, and of a class's mass."""

    steps: np.ndarray
    in_class: np.ndarray
    n_tokens: int
    n_words: int


def _log_base(n_tokens: int, n_words: int) -> float:
    return math.log10(n_tokens + WORD_MASS * (n_words + 1))


def class_paths(texts: DataFrame, words: DataFrame, endings: np.ndarray, n_tokens: int, ends: int) -> DataFrame:
    """Stored (doc_id, held_out, n_tokens, n_known, mass, path) of all texts: the path holds a
    byte per token, its class, and the end's 0; the mass is the sum of log10(count + WORD_MASS)
    over the words."""
    kind = dict(texts.dtypes)["doc_id"]
    head = words.where(F.col("n") >= max(2, math.ceil(HEAD_SHARE * n_tokens))).collect()
    shared = texts.sparkSession.sparkContext.broadcast((
        pa.array([bytes(row["word"]) for row in head], pa.binary()),
        np.array([row["class"] for row in head] + [0], np.uint8),
        np.log10(np.array([row["n"] for row in head] + [1 - WORD_MASS]) + WORD_MASS),
        endings,
    ))
    del head

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, kinds, logs, of = shared.value
        row_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            words, codes, starts = coded_words(batch.column("raw"), WORD_BYTES)
            size, texts = len(words), batch.num_rows
            text = np.repeat(np.arange(texts), np.diff(starts))
            # -1 is the last entry of the tables: class 0, log 0.
            at = _places(words, table)
            way = np.where(at < 0, OPEN + of[_items(words, {}) - 1], kinds[at]).astype(np.uint8)
            known, mass = np.bincount(text, at[codes] >= 0, texts), np.bincount(text, logs[at[codes]], texts)
            # A text's other words: each once, how often it occurs, and the occurrences in order.
            others = np.flatnonzero(at[codes] < 0)
            rare, order, rare_n = np.unique(
                text[others] * size + codes[others], return_inverse=True, return_counts=True
            )
            firsts = np.searchsorted(rare, np.arange(texts + 1) * size)
            slots = order - firsts[text[others]]
            path = _with_ends(way[codes], starts)[1:]
            firsts, bounds = pa.array(firsts, pa.int32()), (starts + np.arange(texts + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row_id + np.arange(texts)), batch.column("doc_id"), batch.column("held_out"),
                    pa.array(np.diff(starts) + 1, pa.int64()),
                    pa.array(known.astype(np.int64) + (ends > 0)), pa.array(mass, pa.float64()),
                    pa.BinaryArray.from_buffers(
                        pa.binary(), texts, [None, pa.py_buffer(bounds), pa.py_buffer(path)]
                    ),
                    pa.ListArray.from_arrays(firsts, words.take(pa.array(rare % max(size, 1)))),
                    pa.ListArray.from_arrays(firsts, pa.array(rare_n, pa.int32())),
                    pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(others, starts), pa.int32()), pa.array(slots, pa.int32())
                    ),
                ],
                names=[
                    "row_id", "doc_id", "held_out", "n_tokens", "n_known", "known_mass", "path",
                    "rare", "rare_n", "slots",
                ],
            )
            row_id += texts

    def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for path, slots, found in zip(
                batch.column("path").to_pylist(), batch.column("slots"), batch.column("found")
            ):
                way = np.frombuffer(path, np.uint8).copy()
                others = np.flatnonzero(way >= OPEN)
                if len(others):
                    way[others] -= OPEN
                    order = slots.values.to_numpy()
                    own = np.zeros(order.max() + 1, np.uint8)
                    own[order] = way[others]
                    if found.is_valid and len(found):
                        own[found.values.field("slot").to_numpy()] = found.values.field("class").to_numpy()
                    way[others] = own[order]
                paths.append(way.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in ("doc_id", "held_out", "n_tokens", "n_known", "mass")],
                    pa.array(paths, pa.binary()),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "mass", "path"],
            )

    rows = stored(
        texts.mapInArrow(
            lean(run),
            f"row_id long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, known_mass double, "
            "path binary, rare array<binary>, rare_n array<int>, slots array<int>",
        ),
        "ngram-rows",
    )
    rare = rows.select("row_id", F.posexplode(F.arrays_zip("rare", "rare_n")).alias("slot", "entry")).select(
        "row_id", "slot", F.col("entry.rare").alias("word"), F.col("entry.rare_n").alias("times")
    )
    log = F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(WORD_MASS))
    added = (
        rare.join(words, "word", "left").groupBy("row_id")
        .agg(
            F.sum(F.col("times") * log).alias("rare_mass"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"),
            F.collect_list(F.when(F.col("n") > 0, F.struct("slot", "class"))).alias("found"),
        )
    )
    return stored(
        rows.drop("rare", "rare_n").join(added, "row_id", "left").select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_known") + F.coalesce(F.col("known"), F.lit(0))).alias("n_known"),
            (F.col("known_mass") + F.coalesce(F.col("rare_mass"), F.lit(0.0))).alias("mass"),
            "path", "slots", "found",
        ).mapInArrow(
            lean(resolved),
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, mass double, path binary",
        ),
        "ngram-paths",
    )


def _line(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The paths of a batch in one line, behind an end, and where each begins."""
    path = batch.column("path").to_pylist()
    starts = np.cumsum([0, *map(len, path[:-1])])
    return np.frombuffer(b"\0" + b"".join(path), np.uint8).astype(np.int64), starts


def path_counts(paths: DataFrame, n_classes: int) -> np.ndarray:
    """Counts of class after class over the training texts, summed on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_classes * n_classes, np.int64)
        for batch in batches:
            line, _ = _line(batch)
            total += np.bincount(line[:-1] * n_classes + line[1:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    out = np.zeros(n_classes * n_classes)
    for row in (
        paths.where("not held_out").select("path").mapInArrow(run, "cell long, n long")
        .groupBy("cell").agg(F.sum("n").alias("n")).collect()
    ):
        out[row["cell"]] = row["n"]
    return out.reshape(n_classes, n_classes)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[ClassModel, DataFrame, DataFrame]:
    """The model, the stored (word, n, class) of all training words, and the stored class paths
    of all texts."""
    texts = _texts(docs, id_col, text_col)
    words, endings, ends = vocabulary(texts)
    per_class = words.groupBy("class").agg(
        F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")
    ).collect()
    n_tokens = sum(row["tokens"] for row in per_class) + ends
    n_words = sum(row["words"] for row in per_class) + (ends > 0)
    in_class = np.zeros(CLASSES)
    # A class that takes rare words keeps the mass of one unseen word.
    in_class[np.unique(endings)] += WORD_MASS
    for row in per_class:
        in_class[row["class"]] += row["tokens"] + WORD_MASS * row["words"]
    in_class = np.log10(np.maximum(in_class, WORD_MASS))
    # The end is the only token of its class.
    in_class[0] = 0.0
    paths = class_paths(texts, words, endings, n_tokens, ends)
    steps = log_steps(path_counts(paths, CLASSES))
    log_end = math.log10(ends + WORD_MASS)
    paths = paths.withColumn(
        "base_score",
        F.col("mass") + F.lit(log_end) - F.col("n_tokens") * F.lit(_log_base(n_tokens, n_words)),
    )
    return ClassModel(steps, in_class, n_tokens, n_words), words, paths


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity).

    Learns from the rows whose fold is not 0 and scores all rows, whole texts. Null and
    empty texts are an end alone. A null id is folded as the empty text, which holds it out.
    Rows are scored one by one, so ids may repeat. Without training rows every token is
    unseen, and both scores follow from the added masses; an empty table gives no rows.
    """
    model, _, paths = fit(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(paths.dtypes)["doc_id"]
    kept = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: ClassModel = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            line, starts = _line(batch)
            inner = np.add.reduceat(m.steps[line[:-1], line[1:]] - m.in_class[line[1:]], starts)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in kept],
                    pa.array(batch.column("mass").to_numpy() + inner, pa.float64()),
                ],
                names=[*kept, "score"],
            )

    return paths.mapInArrow(
        lean(run),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    ).select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
