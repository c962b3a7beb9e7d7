"""Source divergence audit on terms found by iceberg prefix refinement.

Which terms occur in enough documents is found level by level on byte prefixes. The first
level counts the documents of each short prefix; prefixes in too few documents are discarded
with every term below them, and only terms below the others are extended to the next, longer
level. A prefix shorter than its level is a complete term: it is kept or discarded for good.
The levels end when no incomplete prefix is left. Long tails of rare terms are dropped as a
few short prefixes and never become rows of their own.

A last pass counts the kept terms by source. Tasks split whole batches of texts into numbered
terms and count the numbers. They know which prefixes are left from a Bloom filter of bounded
size. What it lets through wrongly lies below a discarded prefix, is in too few documents as
well, and is discarded by the count of the next level: results are exact whatever the filter
does.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import coded_words, distinct, stored, text_bytes

#: Documents of its language that a kept term occurs in, at least.
LEAST = 10
#: Bytes of the first level's prefixes, and how many times longer each next level's are.
FIRST, LONGER = 6, 4
#: Parts that shares are counted in.
PARTS = 1_000_000_000
#: log2 of the bits of a filter: at least, and at most (32 MB; at 30 million prefixes one in
#: fifty others passes).
FEWEST_BITS, MOST_BITS = 18, 28
#: Counts that a task holds before it hands them on; counts by source; rows it hands on at once.
HELD, HELD_COUNTS, ROWS = 400_000, 1_000_000, 100_000
#: Byte between a language and a prefix; no term holds it.
CUT = b"\x00"

_LETTERS = string.ascii_lowercase.encode()
#: Letters to lower case, all other ASCII to blanks; bytes of further characters stay.
TERM_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or byte in _LETTERS else 32
    for byte in range(256)
)


def terms_of(raw: bytes) -> list[bytes]:
    """Runs of letters and non-ASCII characters of a text in UTF-8, A-Z lower-cased."""
    # Blanks are the only ASCII white space left, and bytes.split knows no other.
    return raw.translate(TERM_BYTES).split()


def terms_from(least: int) -> Callable[[bytes], list[bytes]]:
    """As ``terms_of``, but only terms of ``least`` bytes or more."""
    if least < 2:
        return terms_of
    found = re.compile(rb"[^ ]{%d,}" % least).findall
    return lambda raw: found(raw.translate(TERM_BYTES))


# Prefixes that are left ----------------------------------------------------------------


class Alive:
    """A Bloom filter of (lang, prefix) keys; four places of each key's 64-bit hash."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.mask = np.uint64(8 * len(bits) - 1)

    def holds(self, lang: bytes, prefixes: list[bytes]) -> np.ndarray:
        """Which of the prefixes may be left."""
        head = lang + CUT
        return self.holds_keys([head + prefix for prefix in prefixes])

    def holds_keys(self, keys: list[bytes]) -> np.ndarray:
        """As ``holds``, for languages and prefixes with the byte between them."""
        # Spark's xxhash64 of a binary value.
        value = np.fromiter(map(xxhash.xxh64_intdigest, keys, repeat(42)), np.uint64, len(keys))
        place, step = value & np.uint64(0xFFFFFFFF), value >> np.uint64(32) | np.uint64(1)
        out = np.ones(len(keys), bool)
        for _ in range(4):
            at = place & self.mask
            out &= self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0
            place = place + step
        return out


def alive_filter(left: DataFrame) -> np.ndarray:
    """The filter's bytes, from rows (lang, prefix); its size follows from their number, and
    only its 4 KB parts reach the driver."""
    number = left.count()
    power = min(MOST_BITS, max(FEWEST_BITS, (16 * number).bit_length()))
    value = F.xxhash64(F.concat("lang", F.lit(CUT), "prefix"))
    low, step = value.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(value, 32).bitwiseOR(F.lit(1))
    places = F.array(*[(low + nth * step).bitwiseAND((1 << power) - 1) for nth in range(4)])
    parts = left.select(F.explode(places).alias("at")).groupBy(
        F.shiftright("at", 15).alias("part")
    ).agg(F.expr("bitmap_construct_agg(at & 32767)").alias("bits"))
    out = np.zeros(1 << (power - 3), np.uint8)
    for row in parts.collect():
        out[row["part"] << 12 : (row["part"] + 1) << 12] = np.frombuffer(row["bits"], np.uint8)
    return out


def _left(alive: Alive, lang: pa.Array, prefixes: pa.Array) -> np.ndarray:
    """Which of the rows (lang, prefix) may be left; equal ones are looked up once."""
    keys = pc.binary_join_element_wise(lang, prefixes, pa.scalar(CUT, pa.binary())).dictionary_encode()
    return alive.holds_keys(keys.dictionary.to_pylist())[keys.indices.to_numpy()]


class Tally:
    """Counts of keys by group, added up and handed on as rows (*group, key, n) when they are
    many."""

    def __init__(self, *names: str):
        self.names = names
        self.numbers: dict[tuple, int] = {}
        self.held: list[pa.Table] = []
        self.size = 0

    def groups(self, batch: pa.RecordBatch) -> np.ndarray:
        """The number of each row's group."""
        rows = zip(*(batch.column(name).to_pylist() for name in self.names[:-2]))
        return np.array([self.numbers.setdefault(row, len(self.numbers)) for row in rows], np.int64)

    def parts(self, group: np.ndarray, part: int) -> pa.Array:
        """A column of the groups by their numbers."""
        return pa.array([row[part] for row in self.numbers], pa.binary()).take(pa.array(group))

    def add(self, group: np.ndarray, keys: pa.Array, n: np.ndarray) -> None:
        """Add counts of distinct (group, key)."""
        self.held.append(pa.table([pa.array(group), keys, pa.array(n, pa.int64())], names=["group", "key", "n"]))
        self.size += len(keys)

    def rows(self, most: int) -> Iterator[pa.RecordBatch]:
        if self.size <= most:
            return
        table = pa.concat_tables(self.held)
        if len(self.held) > 1:
            table = table.group_by(["group", "key"], use_threads=False).aggregate([("n", "sum")])
            # What shrinks well is worth holding on to.
            if 2 * len(table) <= most:
                self.held, self.size = [table.rename_columns(["group", "key", "n"])], len(table)
                return
        for batch in table.to_batches(ROWS):
            group = batch.column(0).to_numpy()
            columns = [self.parts(group, part) for part in range(len(self.names) - 2)]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[1:]], names=list(self.names))
        self.numbers, self.held, self.size = {}, [], 0


def _prefix_counts(rows: DataFrame, level: int, before: int, alive) -> DataFrame:
    """(lang, prefix, docs) of one level, added up within a task: documents with the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = Alive(alive.value) if alive else None
        tally = Tally("lang", "prefix", "docs")
        for batch in batches:
            # Shorter terms were complete at the level before.
            terms, codes, starts = coded_words(batch.column("raw"), TERM_BYTES, before)
            if not len(terms):
                continue
            coded = pc.binary_slice(terms, 0, level).dictionary_encode()
            prefixes, width = coded.dictionary, len(coded.dictionary)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            once, _ = distinct(doc * width + coded.indices.to_numpy()[codes])
            doc, prefix = np.divmod(once, width)
            keys, docs = distinct(tally.groups(batch)[doc] * width + prefix)
            group, prefix = np.divmod(keys, width)
            prefixes = prefixes.take(pa.array(prefix))
            if left is not None:
                held = _left(left, tally.parts(group, 0), pc.binary_slice(prefixes, 0, before))
                group, prefixes, docs = group[held], prefixes.filter(pa.array(held)), docs[held]
            tally.add(group, prefixes, docs)
            yield from tally.rows(HELD)
        yield from tally.rows(0)

    return rows.select("lang", "raw").mapInArrow(run, "lang binary, prefix binary, docs long")


def _term_counts(rows: DataFrame, alive) -> DataFrame:
    """(lang, source, term, n), added up within a task: occurrences of terms of the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = Alive(alive.value)
        tally = Tally("lang", "source", "term", "n")
        for batch in batches:
            terms, codes, starts = coded_words(batch.column("raw"), TERM_BYTES)
            if not len(terms):
                continue
            keys, n = distinct(np.repeat(tally.groups(batch), np.diff(starts)) * len(terms) + codes)
            group, term = np.divmod(keys, len(terms))
            found = terms.take(pa.array(term))
            held = _left(left, tally.parts(group, 0), found)
            tally.add(group[held], found.filter(pa.array(held)), n[held])
            yield from tally.rows(HELD_COUNTS)
        yield from tally.rows(0)

    return rows.mapInArrow(run, "lang binary, source binary, term binary, n long")


def kept_terms(rows: DataFrame, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """(lang, term) of the terms in at least ``least`` documents of their language, from rows
    (lang, raw) of bytes."""
    spark = rows.sparkSession
    found: DataFrame | None = None
    level, before, alive = first, 0, None
    while True:
        counted = stored(
            _prefix_counts(rows, level, before, alive).groupBy("lang", "prefix").agg(
                F.sum("docs").alias("docs")
            ).where(F.col("docs") >= least),
            f"refinement-{level}",
        )
        if alive:
            alive.destroy()
        complete = F.octet_length("prefix") < level
        terms = counted.where(complete).select("lang", F.col("prefix").alias("term"))
        found = terms if found is None else found.unionByName(terms)
        left = counted.where(~complete).select("lang", "prefix")
        if left.isEmpty():
            return found
        alive = spark.sparkContext.broadcast(alive_filter(left))
        level, before = LONGER * level, level


def occurrences(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, n) of the kept terms in rows (lang, source, raw) of bytes."""
    alive = rows.sparkSession.sparkContext.broadcast(
        alive_filter(kept.select("lang", F.col("term").alias("prefix")))
    )
    # Tasks have added up what they could; rows go to where their term is.
    counts = _term_counts(rows, alive).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n")
    )
    out = stored(counts.join(kept, ["lang", "term"], "left_semi"), "term-counts")
    alive.destroy()
    return out


# The audit -----------------------------------------------------------------------------


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(PARTS (count + 2) / (total + 2 kept)), by long division in steps of 1000; exact
    while the total is below 9e15."""
    left, size = count + 2, total + 2 * kept
    out = F.call_function("div", left, size)
    for _ in range(3):
        left = (left % size) * 1000
        out = out * 1000 + F.call_function("div", left, size)
    return out + 1


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most PARTS + 1, so 64 bits hold it all."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _apart_numbers(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _met(both: DataFrame) -> DataFrame:
    """(lang, source, item, value) added up by batch, from (lang, held): for each two sources
    that hold a term, the first smaller, what the term changes beyond what each side does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held")
            n = held.value_lengths().to_numpy()
            rows = held.flatten()
            if not len(rows):
                continue
            sources, langs = rows.field("source").dictionary_encode(), batch.column("lang").dictionary_encode()
            code = sources.indices.to_numpy()
            p, none = (rows.field(name).to_numpy() for name in ("p", "none"))
            # Every entry beside all later ones of its term; entries are sorted by source.
            ends = np.repeat(np.cumsum(n), n)
            later = ends - np.arange(len(code)) - 1
            a = np.repeat(np.arange(len(code)), later)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)
            value = (
                _apart_numbers(p[a], p[b]) - _apart_numbers(p[a], none[b])
                - _apart_numbers(none[a], p[b]) + _apart_numbers(none[a], none[b])
            )
            width = len(sources.dictionary)
            lang = np.repeat(langs.indices.to_numpy(), n)[a].astype(np.int64)
            keys, at = np.unique((lang * width + code[a]) * width + code[b], return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, at, value)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(keys // (width * width))),
                    sources.dictionary.take(pa.array(keys // width % width)),
                    sources.dictionary.take(pa.array(keys % width)), pa.array(sums),
                ],
                names=["lang", "source", "item", "value"],
            )

    return both.mapInArrow(run, "lang binary, source binary, item binary, value long")


def divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = LEAST,
    top: int = 10,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) group of the table.

    Part ``pair`` compares the group's shares of its language's kept terms with those of each
    other source of the language, part ``term`` with the language's own and names the ``top``
    terms it overuses most. Values are whole numbers, exactly rounded down.

    Null texts, languages and sources are empty ones. Every row is a document, repeated ones
    too; texts without terms count for nothing, but their group appears, with pairs of value 0
    where its language keeps no term. Equal values rank by item in UTF-8. An empty table gives
    no rows. Tables that are joined hold one row per kept term and source at most; none is
    forced to be broadcast.
    """

    def given(name: str) -> Column:
        return text_bytes(F.col(f"`{name}`"))

    rows = docs.select(
        given(lang_col).alias("lang"), given(source_col).alias("source"), given(text_col).alias("raw")
    )
    kept = stored(kept_terms(rows, least), "kept-terms")
    counts = occurrences(rows, kept)
    every = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
    kept_per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = stored(
        every.join(totals, ["lang", "source"], "left").join(kept_per_lang, "lang", "left").select(
            "lang", "source", *[F.coalesce(name, F.lit(0)).alias(name) for name in ("total", "own", "kept")]
        ).withColumn(
            # Share of a term that the group does not hold; none where nothing is kept.
            "none", F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept")))
        ),
        "groups",
    )
    shares = counts.join(groups, ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("total"), F.col("kept"))
    )
    p, q, none, other_none = (F.col(name) for name in ("p", "q", "none", "other_none"))

    # A pair's sum over all kept terms: as if no term were in either; what the terms of each
    # side change; and what the terms of both change on top.
    others = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("other_none"), F.col("own").alias("other_own"))
    sides = shares.groupBy("lang", "source", "none", "p").agg(F.count(F.lit(1)).alias("times")).join(
        others, "lang"
    ).where(F.col("source") != F.col("item"))
    change = (F.col("times") * (_apart(p, other_none) - _apart(none, other_none))).alias("value")
    one_side = sides.select("lang", "source", "item", change)
    both = shares.groupBy("lang", "term").agg(
        F.array_sort(F.collect_list(F.struct("source", "p", "none"))).alias("held")
    )
    two_sides = _met(both.select("lang", "held"))
    base = groups.join(others, "lang").where(F.col("source") != F.col("item")).select(
        "lang", "source", "item",
        F.coalesce(F.col("kept") * _apart(none, other_none), F.lit(0)).alias("value"),
    )
    # Both directions of a pair are worth the same.
    changes = one_side.unionByName(two_sides).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    swapped = changes.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = base.unionByName(changes).unionByName(swapped).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))

    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    lang_totals = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("kept").alias("kept"))
    overall = whole.join(lang_totals, "lang").select(
        "lang", "term", _share(F.col("n"), F.col("total"), F.col("kept")).alias("q")
    )
    terms = shares.join(overall, ["lang", "term"]).where(p > q).select(
        "lang", "source", F.col("term").alias("item"), _apart(p, q).alias("value"), F.lit("term").alias("part")
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).unionByName(
        terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    )
    return ranked.select(
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "part",
        F.col("item").cast("string").alias("item"), "value", "rank",
    )
