"""Near-duplicates by an LSH forest over MinHash signatures.

A document is the set of its 5-word shingles; documents with equal sets are one class from
the start. The signature of a class is read in several orders, the trees. A tree sorts all
classes by their values in its order, so that the classes sharing the longest prefixes stand
side by side; neighbours that share at least ``depth`` values are candidates. How deep the
shared prefix is follows from how crowded a region is: in a crowd the neighbours are those
that agree much further.

A first round links next neighbours in a few trees. The others go through the regions of all
trees, but only through those of several components, so large groups of copies add next to
nothing. In a region of few rows all are compared: in the second round each component tries
the most alike row of another, which joins nearly all that belong together, and in the third
every pair that is left. The classes of larger regions, the crowds, meet in the third by an
exact join on their rarest shingles, so a crowd costs no link. Every candidate is
confirmed on whole shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, filter_bits, lean, maybe_in, stored, text_bytes, words_of
from .components import components

SHINGLE = 5
#: Sets are linked if they share so many hundredths of their union.
PERCENT = 75
#: Trees, values that each starts with, values of a label, and the shortest shared prefix. At
#: the threshold a pair shares 3 values of a tree with odds 0.42, and misses that in all 24
#: with odds 2e-6.
TREES, STEP, LABEL, DEPTH = 24, 4, 6, 3
#: Trees of the first round; rows of a region that are all compared later.
FIRST_TREES, CALM = 8, 128
#: Classes whose shingles are counted for the order of the exact join, and log2 of the counts.
#: Any order finds the same pairs; a good one has the common shingles last.
COUNTED, COUNT_BITS = 8192, 22
#: Rows carry 2 bits of 256 least values. Of sets at the threshold 208 agree on average, with
#: a deviation of 6.2; fewer than SAME, five deviations below, agree with odds 3e-7.
SKETCH, SAME = 256, 176
_ONES = int("01" * SKETCH, 2)

_DRAWS = np.random.default_rng(20240229)
_FACTORS = _DRAWS.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TURNS = _DRAWS.integers(0, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _DRAWS.integers(0, 2**63, SKETCH, dtype=np.uint64)

_WORDS: dict[bytes, int] = {}
_KNOWN = 200_000


def _word_hashes(words: list[bytes]) -> np.ndarray:
    known = _WORDS
    try:
        return np.array([known[word] for word in words], np.uint64)
    except KeyError:
        pass
    if len(known) > _KNOWN:
        known.clear()
    for word in words:
        if word not in known:
            known[word] = xxhash.xxh3_64_intdigest(word)
    return np.array([known[word] for word in words], np.uint64)


def _forget_words() -> None:
    _WORDS.clear()


def _scrambled(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(raw: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct 5-word shingles of a text; of fewer words, one
    hash of them all; of none, nothing."""
    words = words_of(raw)
    if not words:
        return np.empty(0, np.uint64)
    hashes = _word_hashes(words)
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
    for at in range(width):
        total += hashes[at : len(words) - width + 1 + at] * _FACTORS[at]
    return np.unique(_scrambled(total))


def signature(values: np.ndarray) -> np.ndarray:
    """The upper halves of the least values of a set under each of the hash functions."""
    least = None
    for start in range(0, len(values), 512):
        part = values[start : start + 512, None] * _TURNS[None, :] + _SHIFTS[None, :]
        part = part.min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketch(least: np.ndarray) -> bytes:
    """The last 2 bits of each value of a signature."""
    low = (least & np.uint32(3)).astype(np.uint8)
    return (low[0::4] * 64 + low[1::4] * 16 + low[2::4] * 4 + low[3::4]).tobytes()


def agreeing(a: int, b: int) -> int:
    """In how many places two sketches, read as whole numbers, agree."""
    x = a ^ b
    return SKETCH - ((x | x >> 1) & _ONES).bit_count()


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _described(docs: DataFrame) -> DataFrame:
    """(id, n_shingles, node, signature, sketch): node is a digest of the set, null for none."""
    kind = dict(docs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("word hashes", _forget_words)
        for batch in batches:
            counts, nodes, signatures, sketches = [], [], [], []
            for raw in batch.column("raw").to_pylist():
                values = shingle_set(raw)
                counts.append(len(values))
                nodes.append(_digest(values) if len(values) else None)
                found = signature(values) if len(values) else None
                signatures.append(None if found is None else found[: TREES * STEP].astype(">u4").tobytes())
                sketches.append(None if found is None else sketch(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(signatures, pa.binary()), pa.array(sketches, pa.binary())],
                names=["id", "n_shingles", "node", "signature", "sketch"],
            )

    return docs.mapInArrow(lean(run, _forget_words), f"id {kind}, n_shingles long, node binary, signature binary, sketch binary")


def _batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    low, high = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(low, pa.binary()), pa.array(high, pa.binary())], names=["a", "b"])


def _labels(classes: DataFrame, trees: int) -> DataFrame:
    """(tree, label, node, n_shingles, sketch): the first values of each class in each order."""
    around = F.concat("signature", "signature")
    return classes.select(
        F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
        around.alias("around"), "node", "n_shingles", "sketch",
    ).select(
        "tree",
        F.substring("around", F.col("tree") * (4 * STEP) + 1, F.lit(4 * LABEL)).alias("label"),
        "node", "n_shingles", "sketch",
    )


def _neighbours(labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of next neighbours in the sorted orders. Rows are sorted by range
    partitions, so a crowded region is spread by its deeper values. Sizes and sketches that
    rule a link out spare a candidate. What this misses is left to the later rounds.
    """
    ordered = labels.repartitionByRange("tree", "label", "node").sortWithinPartitions(
        "tree", "label", "node"
    )
    prefix = 4 * DEPTH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            low, high = [], []
            columns = [batch.column(name).to_pylist() for name in ("tree", "label", "node", "n_shingles", "sketch")]
            for tree, label, node, n, marks in zip(*columns):
                row = ((tree, label[:prefix]), node, n, int.from_bytes(marks))
                if last and last[0] == row[0] and last[1] != node and _may_link(last[2:], row[2:]):
                    low.append(min(node, last[1]))
                    high.append(max(node, last[1]))
                last = row
            if low:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low, pa.binary()), pa.array(high, pa.binary())], names=["a", "b"]
                )

    return ordered.mapInArrow(lean(run), "a binary, b binary").distinct()


def _may_link(one: tuple[int, int], other: tuple[int, int]) -> bool:
    """Whether the (size, sketch) of two sets leave a link possible."""
    (n, marks), (size, others) = one, other
    return 100 * min(n, size) >= PERCENT * max(n, size) and agreeing(marks, others) >= SAME


def _regions(classes: DataFrame) -> DataFrame:
    """(region, node, root, n_shingles, sketch): the place of each class in each tree."""
    around = F.concat("signature", "signature")
    return classes.select(
        F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"),
        around.alias("around"), "node", "root", "n_shingles", "sketch",
    ).select(
        F.xxhash64("tree", F.substring("around", F.col("tree") * (4 * STEP) + 1, F.lit(4 * DEPTH))).alias("region"),
        "node", "root", "n_shingles", "sketch",
    )


def _rarest(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(token, node, root, n, at): the shingles of each class (node, id, root) that come first
    in one order of all shingles. A set of n has to share one of its first n/4 + 1 with every
    set that it is linked to."""
    share = max(1, -(-classes.count() // COUNTED))
    sample = classes.where(F.pmod(F.xxhash64("node"), F.lit(share)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for values in batch.column("values").to_pylist():
                places = np.frombuffer(values, np.uint64) >> np.uint64(64 - COUNT_BITS)
                np.add.at(total, places.astype(np.int64), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "n"])

    counted = _sets(sample, docs).mapInArrow(lean(count), "place long, n long")
    common = counted.groupBy("place").agg(F.sum("n").alias("n")).where("n > 2").toArrow()
    order = np.zeros(1 << COUNT_BITS, np.uint16)
    order[common["place"].to_numpy()] = np.minimum(common["n"].to_numpy(), 65_535)
    order = docs.sparkSession.sparkContext.broadcast(order)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, tokens, at = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for raw in batch.column("values").to_pylist():
                values = np.frombuffer(raw, np.uint64)
                places = (values >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
                taken = len(values) - -(-PERCENT * len(values) // 100) + 1
                values = values[np.lexsort((values, order.value[places]))[:taken]]
                tokens.append(values.view(np.int64))
                at.append(np.arange(taken))
                sizes.append((len(raw) // 8, taken))
            n, taken = np.array(sizes, np.int64).reshape(-1, 2).T
            row = pa.array(np.repeat(np.arange(len(n)), taken))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens)), batch.column("node").take(row), batch.column("root").take(row),
                 pa.array(np.repeat(n, taken)), pa.array(np.concatenate(at))],
                names=["token", "node", "root", "n", "at"],
            )

    held = _sets(classes, docs).join(classes.select("node", "root"), "node")
    return held.mapInArrow(lean(first), "token long, node binary, root binary, n long, at long")


def _crowd_pairs(crowd: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes (node, id, root) that may be linked and are in different
    components; none is missing.

    The first shingle, in one order, that two sets of m <= n share is at place j and i: they
    share min(m - j, n - i) at most and need 3/7 of m + n. So j is within m/7, and what a
    whole crowd shares brings together only sets of which the rest is small enough. Shingles
    of one component are out before the join.
    """
    rows = stored(_rarest(crowd, docs), "forest-rarest")
    shared = rows.groupBy("token").agg(
        F.min(F.xxhash64("root")).alias("low"), F.max(F.xxhash64("root")).alias("high")
    ).where("low < high").select("token")
    rows = stored(rows.join(shared, "token"), "forest-shared")
    least, most = PERCENT, 100 + PERCENT
    x = rows.where(F.expr(f"{most} * (n - at) >= {2 * least} * n")).select(
        "token", *[F.col(c).alias(f"x_{c}") for c in ("node", "root", "n", "at")]
    )
    y = rows.select("token", *[F.col(c).alias(f"y_{c}") for c in ("node", "root", "n", "at")])
    met = x.join(y, "token").where(F.expr(
        "x_root <> y_root and (x_n < y_n or (x_n = y_n and x_node < y_node))"
        f" and {most} * (x_n - x_at) >= {least} * (x_n + y_n)"
        f" and {most} * (y_n - y_at) >= {least} * (x_n + y_n)"
    ))
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def _met(rows: list[tuple], nearest: bool) -> list[tuple[bytes, bytes]]:
    """Pairs of one region's rows (node, root, n, marks) that sizes and sketches leave possible
    and that are in different components; with ``nearest`` only the most alike pairs by which
    each component meets another, no more than there are components."""
    found = []
    for j, (_, root, n, marks) in enumerate(rows):
        for i, (_, other_root, size, others) in enumerate(rows[:j]):
            if root != other_root and 100 * min(n, size) >= PERCENT * max(n, size):
                same = agreeing(marks, others)
                if same >= SAME:
                    found.append((same, i, j))
    if nearest:
        every, found, met = sorted(found, reverse=True), [], set()
        for same, i, j in every:
            ends = {rows[i][1], rows[j][1]}
            if not ends <= met:
                met |= ends
                found.append((same, i, j))
    return [(min(a, b), max(a, b)) for a, b in ((rows[i][0], rows[j][0]) for _, i, j in found)]


def _candidates(classes: DataFrame, docs: DataFrame, nearest: bool) -> DataFrame:
    """Pairs (a, b) of classes in different components that share the start of a tree, without
    those that sizes, sketches or rarest shingles rule out. With ``nearest`` each component of
    a calm region brings its most alike pair only, and crowds wait."""
    places = _regions(classes)
    kinds = stored(
        places.groupBy("region").agg(
            F.count(F.lit(1)).alias("rows"), F.min(F.xxhash64("root")).alias("low"),
            F.max(F.xxhash64("root")).alias("high"),
        ).where("low < high").select("region", "rows"),
        "forest-regions",
    )

    def within(regions: DataFrame, rows: DataFrame) -> DataFrame:
        tested = maybe_in(rows, F.col("region"), filter_bits(regions, F.col("region")))
        return tested.where("hit").drop("hit").join(regions.select("region"), "region")

    calm = within(kinds.where(F.col("rows") <= CALM), places)
    ordered = calm.repartition("region").sortWithinPartitions("region")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[
                batch.column(name).to_pylist() for name in ("region", "node", "root", "n_shingles", "sketch")
            ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = []
        for _, rows in groupby(each(batches), itemgetter(0)):
            pairs += _met([(node, root, n, int.from_bytes(marks)) for _, node, root, n, marks in rows], nearest)
            if len(pairs) > 8192:
                yield _batch(pairs)
                pairs = []
        if pairs:
            yield _batch(pairs)

    pairs = ordered.mapInArrow(lean(run), "a binary, b binary")
    if nearest:
        return pairs.distinct()
    crowded = kinds.where(F.col("rows") > CALM)
    if crowded.isEmpty():
        return pairs.distinct()
    nodes = within(crowded, places.select("region", "node")).select("node").distinct()
    crowd = stored(classes.select("node", "id", "root").join(nodes, "node"), "forest-crowd")
    return pairs.unionAll(_crowd_pairs(crowd, docs)).distinct()


def _sets(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, values) of the texts that the classes (node, id) of ``wanted`` come from, each
    node once; some others may be among them."""
    # A null id has no place in the filter: such texts are all made again.
    some = maybe_in(docs, F.col("id"), filter_bits(wanted.where("id is not null"), F.col("id")))
    texts = some.where("hit or id is null").select("raw")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, values = [], []
            for raw in batch.column("raw").to_pylist():
                found = shingle_set(raw)
                if len(found):
                    nodes.append(_digest(found))
                    values.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(values, pa.binary())], names=["node", "values"]
            )

    return texts.mapInArrow(lean(sets, _forget_words), "node binary, values binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose whole shingle sets are alike enough. Sets are made again from the
    texts of the classes that occur in pairs; a set carries its node, so texts are shuffled
    once, by node, and that exchange serves both sides of the pairs."""
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b"))
    wanted = stored(nodes.distinct().join(classes.select("node", "id"), "node"), "forest-wanted")
    held = _sets(wanted, docs)
    both = (
        pairs.join(held.select(F.col("node").alias("a"), F.col("values").alias("left")), "a")
        .join(held.select(F.col("node").alias("b"), F.col("values").alias("right")), "b")
    )

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(lean(alike), "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per document.

    Documents whose sets share at least 75 of 100 parts of their union are linked;
    ``component_id`` is the smallest id that links reach, and that document is kept. Texts
    without words (null, empty, white space) are linked with nothing. Null ids are never the
    smallest; a group of null ids alone has a null component and is kept. Rows with equal
    sets are one class, repeated rows included; rows that share an id but not a text are
    treated as the texts they are. An empty table gives no rows.
    """
    texts = docs.select(
        F.col(f"`{id_col}`").alias("id"), text_bytes(F.col(f"`{text_col}`")).alias("raw")
    )
    rows = stored(_described(texts), "forest-rows")
    classes = stored(
        rows.where("node is not null").groupBy("node").agg(
            F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"), F.first("sketch").alias("sketch"),
        ),
        "forest-classes",
    )
    tried = stored(_neighbours(_labels(classes, FIRST_TREES)), "forest-pairs")
    roots = components(stored(_confirmed(tried, classes, texts), "forest-links"))
    for nearest in (True, False):
        # Only classes that may have links are shuffled to meet their roots.
        tested = maybe_in(classes, F.col("node"), filter_bits(roots, F.col("node")))
        grouped = stored(
            tested.where("hit").drop("hit").join(roots, "node", "left")
            .withColumn("root", F.coalesce("root", "node"))
            .unionByName(tested.where("not hit").drop("hit").withColumn("root", F.col("node"))),
            "forest-grouped",
        )
        pairs = stored(
            _candidates(grouped, texts, nearest).join(tried, ["a", "b"], "left_anti"), "forest-pairs"
        )
        links = stored(_confirmed(pairs, classes, texts), "forest-links")
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(links))
        tried = tried.unionAll(pairs)
    member = classes.select("node", "id").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    least = member.groupBy("root").agg(F.min("id").alias("component_id"))
    member = member.join(least, "root").select("node", "component_id")
    return rows.join(member, "node", "left").select(
        "id", "n_shingles",
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is kept. An id that occurs on several rows stays if any
    of them is kept."""
    found = stored(near_duplicates(docs, id_col, text_col).select("id", "kept"), "forest-kept")
    gone = found.groupBy("id").agg(F.max("kept").alias("any")).where("not any").select("id")
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
    )
    tested = maybe_in(row, F.col("id"), filter_bits(gone, F.col("id")))
    clear = tested.where("not hit").select("row.*")
    doubtful = tested.where("hit").join(gone, "id", "left_anti").select("row.*")
    return clear.unionAll(doubtful)
