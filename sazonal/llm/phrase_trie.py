"""Phrase collocation mining: frequent phrases by double-array tries, scored by their cuts.

Frequent words are numbered and the corpus is stored once as their numbers, 0 for a cut or a
rarer word. Phrases grow by a word a pass over it. A pass has double-array tries of the
frequent phrases of the length before; numpy takes all positions of a run through them at the
same time, one level after another. Two neighbouring positions that both end in an accepting
state are the start of a candidate: a phrase one word longer whose two shorter parts are both
frequent. No other phrase can be frequent, so none is counted. Tasks count the pairs of
accepting states they see, and Spark sums the tasks' counts, by the numbers of the words.

A trie holds about ``MOST`` phrases. More are dealt into blocks by their first two words, so
one block's trie is enough for a position. The driver builds and broadcasts one after the
other; a task takes each position through its block's trie, with one trie open at a time. So
memory stays bounded and a length is one pass, however many blocks there are. Words are
broadcast in blocks, too, and phrases become text again on the executors.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lean, stored, text_bytes

#: Words of the longest phrase, and occurrences of a phrase at least.
LONGEST, LEAST = 5, 100
#: Phrases of a block, and words of a block.
MOST = 500_000
#: Bytes of text that are taken apart at a time, and counts that a task holds.
CHUNK, HELD = 1 << 20, 500_000
#: Numbers of a stored run at least; words that are numbered at a time, or whose pairs are
#: sorted at a time; words that go through the tries of several blocks at a time.
RUN, SOME, RUNS = 1 << 11, 1 << 18, 1 << 21
#: Counts that leave a task in one batch.
ROWS = 1 << 16
#: Blocks are dealt by the rest of the first two words' numbers by this prime.
DEALT = 1_000_003

#: A byte that UTF-8 never holds stands for the end of a piece.
CUT = b"\xff"
PIECE_BYTES = bytes(
    255 if byte in b".,;:!?\n\x0b\x0c\r" else byte + 32 if 65 <= byte <= 90 else byte
    for byte in range(256)
)
_BETWEEN = re.compile(rb"[ \t\xff]")


def token_runs(raws: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Words of texts in UTF-8, A-Z lower-cased, with ``CUT`` at the end of every piece; lists
    of bounded length unless a single word is longer."""
    parts, size = [], 0
    for raw in raws:
        text = raw.translate(PIECE_BYTES) + CUT
        start = 0
        while len(text) - start > CHUNK:
            at = _BETWEEN.search(text, start + CHUNK).start()
            parts.append(text[start:at])
            yield _tokens(parts)
            parts, size, start = [], 0, at
        parts.append(text[start:])
        size += len(text) - start
        if size > CHUNK:
            yield _tokens(parts)
            parts, size = [], 0
    if parts:
        yield _tokens(parts)


def _tokens(parts: list[bytes]) -> list[bytes]:
    # Other white space than blanks and tabs has become CUT.
    return b"".join(parts).replace(CUT, b" \xff ").split()


# The trie ------------------------------------------------------------------------------


def _window(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions from each start on, as many as its size."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class DoubleArray:
    """A trie of phrases of one length, given by their words or by a row of numbers each.

    Words are numbered from 1 to ``words``, and a word's number is the state after it alone.
    A number is taken as two digits, so what follows a state lies close together however many
    words there are. From state s digit d leads to ``base[s] + d`` if ``check`` says s there.
    State 0 is none.
    """

    #: States with this many digits after them, at least and at most, are placed together, in
    #: so many rounds between what is there; all others get a window of their own.
    SIZES, ROUNDS = ((17, 32), (9, 16), (5, 8), (2, 4)), 12

    def __init__(self, phrases: list[tuple[bytes, ...]] | np.ndarray, words: int = 0):
        if not isinstance(phrases, np.ndarray):
            self.codes = {word: at for at, word in enumerate(sorted({w for p in phrases for w in p}), 1)}
            words = len(self.codes)
            phrases = np.array([[self.codes[word] for word in phrase] for phrase in phrases])
        self.depth = phrases.shape[1]
        self.shift = (words.bit_length() + 1) // 2
        self.base = np.zeros(words + 1, np.int32)
        self.check = np.full(words + 1, -1, np.int32)
        draw = np.random.default_rng(words)
        order = np.lexsort(phrases.T[::-1])
        states = phrases[order, 0]
        for depth in range(1, self.depth if len(phrases) else 1):
            for digits in self._digits(phrases[order, depth]):
                new = np.r_[True, (states[1:] != states[:-1]) | (digits[1:] != digits[:-1])]
                places = self._place(states[new], digits[new], words + 1, draw)
                states = places[np.cumsum(new) - 1]
        #: The accepting state of each phrase.
        self.states = np.empty_like(states)
        self.states[order] = states
        # The largest digit beyond the last state keeps every look-up inside.
        self._grow(1 << self.shift)

    def _digits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return codes >> self.shift, codes & ((1 << self.shift) - 1)

    def _grow(self, by: int) -> None:
        self.base = np.r_[self.base, np.zeros(by, np.int32)]
        self.check = np.r_[self.check, np.full(by, -1, np.int32)]

    def _place(
        self, parents: np.ndarray, digits: np.ndarray, least: int, draw: np.random.Generator
    ) -> np.ndarray:
        """Places, from ``least`` on, of the edges of a level, which come in order."""
        starts = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        sizes = np.diff(np.r_[starts, len(parents)])
        bases = np.zeros(len(starts), np.int64)

        def free() -> np.ndarray:
            return least + np.flatnonzero(self.check[least:] < 0)

        def settle(groups: np.ndarray) -> None:
            edges = _window(starts[groups], sizes[groups])
            self.check[np.repeat(bases[groups], sizes[groups]) + digits[edges]] = parents[edges]

        def windows(groups: np.ndarray) -> None:
            firsts = digits[starts[groups]]
            spans = digits[starts[groups] + sizes[groups] - 1] - firsts + 1
            bases[groups] = len(self.check) + np.cumsum(spans) - spans - firsts
            self._grow(int(spans.sum()))
            settle(groups)

        windows(np.flatnonzero(sizes > self.SIZES[0][1]))
        for fewest, most in self.SIZES:
            left = np.flatnonzero((sizes >= fewest) & (sizes <= most))
            self._grow(max(0, 2 * int(sizes[left].sum()) - len(free())))
            for _ in range(self.ROUNDS if len(left) else 0):
                holes, count = free(), sizes[left]
                bases[left] = holes[draw.integers(0, len(holes), len(left))] - digits[starts[left]]
                edges, owner = _window(starts[left], count), np.repeat(np.arange(len(left)), count)
                places = np.repeat(bases[left], count) + digits[edges]
                fits = places < len(self.check)
                places[~fits] = 0
                # A place that two want goes to one of them.
                wanted = np.empty(len(self.check), np.int32)
                wanted[places] = owner
                fits &= (self.check[places] < 0) & (wanted[places] == owner)
                fits = np.logical_and.reduceat(fits, np.cumsum(count) - count)
                settle(left[fits])
                left = left[~fits]
                if not len(left):
                    break
            windows(left)
        single = np.flatnonzero(sizes == 1)
        self._grow(max(0, len(single) - len(free())))
        bases[single] = free()[: len(single)] - digits[starts[single]]
        settle(single)
        self.base[parents[starts]] = bases
        return np.repeat(bases, sizes) + digits

    def walk(self, codes: np.ndarray) -> np.ndarray:
        """States of all positions after as many words as the phrases have; 0 where the words
        that begin there are no phrase."""
        out = np.zeros(len(codes), np.int64)
        at, states = self.ends(codes, np.flatnonzero(codes))
        out[at] = states
        return out

    def ends(self, codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of some positions where a phrase begins, and their states."""
        at = at[at <= len(codes) - self.depth]
        states = codes[at]
        for depth in range(1, self.depth):
            for digit in range(2):
                places = self.base[states] + self._digits(codes[at + depth])[digit]
                live = np.flatnonzero(self.check[places] == states)
                states, at = places[live], at[live]
        return at, states


class Blocks:
    """Tries that tasks open one at a time, with the sum of the sizes of those before each."""

    def __init__(self, tries: list[tuple[Broadcast, int]]):
        self.tries = [trie for trie, _ in tries]
        self.offsets = np.cumsum([0, *(size for _, size in tries)])

    def walk(self, codes: np.ndarray) -> np.ndarray:
        """States of all positions that begin a phrase, different between blocks; otherwise 0."""
        if len(self.tries) == 1:
            return self.tries[0].value.walk(codes)
        out = np.zeros(len(codes), np.int64)
        at = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0)).astype(np.int32)
        block = np.empty(len(at), np.min_scalar_type(len(self.tries)))
        for begin in range(0, len(at), SOME):
            here = at[begin : begin + SOME]
            pair = (codes[here].astype(np.int64) << 32) | codes[here + 1]
            block[begin : begin + SOME] = pair % DEALT % len(self.tries)
        ends = np.cumsum(np.bincount(block, minlength=len(self.tries)))
        at = at[np.argsort(block, kind="stable")]
        for trie, offset, begin, end in zip(self.tries, self.offsets, np.r_[0, ends], ends):
            if begin < end:
                here, states = _opened(trie).ends(codes, at[begin:end])
                out[here] = states + offset
        return out


def _opened(broadcast: Broadcast):
    """A broadcast's value, which the worker does not keep if it can be read again."""
    value = broadcast.value
    if getattr(broadcast, "_path", None):
        vars(broadcast).pop("_value", None)
    return value


def _by_lang(batch: pa.RecordBatch) -> dict[bytes, list[bytes]]:
    out = defaultdict(list)
    for lang, raw in zip(batch.column("lang"), batch.column("raw")):
        out[lang.as_py()].append(raw.as_py())
    return out


COUNTS = "lang binary, phrase binary, n long"


def _batch(rows: list[tuple[bytes, bytes | None, int]]) -> pa.RecordBatch:
    lang, phrase, n = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.binary()), pa.array(phrase, pa.binary()), pa.array(n, pa.int64())],
        names=["lang", "phrase", "n"],
    )


def _word_counts(rows: DataFrame) -> DataFrame:
    """Occurrences of each word within a task; of all words together under null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Counter] = defaultdict(Counter)
        total: Counter = Counter()

        def counted() -> pa.RecordBatch:
            out = _batch([(lang, word, n) for lang, words in held.items() for word, n in words.items()])
            held.clear()
            return out

        for batch in batches:
            for lang, raws in _by_lang(batch).items():
                for tokens in token_runs(raws):
                    counts = Counter(tokens)
                    counts.pop(CUT, None)
                    total[lang] += sum(counts.values())
                    held[lang].update(counts)
                    if sum(map(len, held.values())) > HELD:
                        yield counted()
        if any(held.values()):
            yield counted()
        if total:
            yield _batch([(lang, None, n) for lang, n in total.items()])

    return rows.mapInArrow(lean(run), COUNTS)


# Numbers of words ----------------------------------------------------------------------


class Words:
    """Frequent words of all languages, numbered from 1 and broadcast in blocks; a word's key
    is its language, ``CUT`` and itself."""

    def __init__(self, words: DataFrame, most: int):
        context = words.sparkSession.sparkContext
        blocks = max(1, -(-words.count() // most))
        block = F.pmod(F.xxhash64("lang", "phrase"), F.lit(blocks))
        key = F.concat("lang", F.lit(CUT), "phrase").alias("key")
        self.blocks, self.size = [], 0
        for number in range(blocks):
            # About ``most`` rows.
            keys = words.where(block == number).select(key).toArrow().column(0).combine_chunks()
            self.blocks.append((context.broadcast(keys), self.size))
            self.size += len(keys)

    def destroy(self) -> None:
        for keys, _ in self.blocks:
            keys.destroy()


def _numbers(blocks: list[tuple[Broadcast, int]], keys: pa.Array) -> np.ndarray:
    """The words' numbers, 0 for others."""
    out = np.zeros(len(keys), np.int32)
    for block, before in blocks:
        at = pc.fill_null(pc.index_in(keys, value_set=block.value if len(blocks) == 1 else _opened(block)), -1)
        at = at.to_numpy(zero_copy_only=False)
        out = np.where(at >= 0, at + before + 1, out).astype(np.int32)
    return out


def _numbered(rows: DataFrame, words: Words) -> DataFrame:
    """The corpus as runs of numbers of words, 0 where a word is rarer or a piece ends; a run
    ends at a 0, so no phrase reaches over its end."""
    blocks = words.blocks

    def numbers(parts: list[tuple[bytes, pa.DictionaryArray]]) -> np.ndarray:
        found = _numbers(blocks, pa.concat_arrays([
            pc.binary_join_element_wise(pa.scalar(lang, pa.binary()), part.dictionary, CUT)
            for lang, part in parts
        ]))
        ends = np.cumsum([len(part.dictionary) for _, part in parts])
        return np.concatenate([
            found[end - len(part.dictionary) : end][part.indices.to_numpy()]
            for end, (_, part) in zip(ends, parts)
        ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_end = np.zeros(0, np.int32)

        def cut(parts: list) -> Iterator[pa.RecordBatch]:
            nonlocal open_end
            codes = np.r_[open_end, numbers(parts)]
            # One 0 stands for any number of them.
            codes = codes[np.r_[True, (codes[1:] > 0) | (codes[:-1] > 0)]]
            ends = np.flatnonzero(codes == 0) + 1
            open_end = codes[ends[-1] if len(ends) else 0 :]
            if len(ends):
                # The last end of every so many numbers, and the very last.
                ends = ends[np.r_[ends[:-1] // RUN != ends[1:] // RUN, True]]
                data = codes[: ends[-1]].astype("<i4").tobytes()
                runs = pa.BinaryArray.from_buffers(
                    pa.binary(), len(ends),
                    [None, pa.py_buffer((4 * np.r_[0, ends]).astype(np.int32)), pa.py_buffer(data)],
                )
                yield pa.RecordBatch.from_arrays([runs], names=["codes"])

        for batch in batches:
            parts, size = [], 0
            for lang, raws in _by_lang(batch).items():
                for tokens in token_runs(raws):
                    parts.append((lang, pa.array(tokens, pa.binary()).dictionary_encode()))
                    size += len(tokens)
                    if size > SOME:
                        yield from cut(parts)
                        parts, size = [], 0
            if parts:
                yield from cut(parts)

    return rows.mapInArrow(lean(run), "codes binary")


# Phrases as numbers --------------------------------------------------------------------


def _columns(words: int) -> list[str]:
    """Columns of the numbers of a phrase's words, two in each; a missing one is 0."""
    return [f"k{at}" for at in range((words + 1) // 2)]


def _paired(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """The columns of phrases of up to ``longest`` words, from a row of numbers for each phrase."""
    codes = codes.astype(np.int64)
    out = [codes[:, at] << 32 for at in range(0, codes.shape[1], 2)]
    out += [np.zeros(len(codes), np.int64)] * ((longest + 1) // 2 - len(out))
    for at in range(1, codes.shape[1], 2):
        out[at // 2] |= codes[:, at]
    return out


def _unpaired(columns: list[np.ndarray], words: int) -> np.ndarray:
    """A row of numbers for each phrase, of its first ``words`` words."""
    return np.stack([(columns[at // 2] >> (0 if at % 2 else 32)) & 0x7FFFFFFF for at in range(words)], axis=1)


def _first(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and where in it each distinct key begins."""
    order = np.argsort(keys)
    ordered = keys[order]
    return order, np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])


Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def _added(found: list[Found]) -> Found:
    keys = np.concatenate([keys for keys, _, _ in found])
    order, begins = _first(keys)
    at = order[begins]
    counts = np.add.reduceat(np.concatenate([counts for _, counts, _ in found])[order], begins)
    return keys[at], counts, np.concatenate([codes for _, _, codes in found])[at]


def _longer(runs: DataFrame, words: int, longest: int, tries: Blocks | None) -> DataFrame:
    """Occurrences within a task of the phrases of ``words`` words whose parts of one word less
    are in the tries; without tries every pair of frequent words."""
    names = [*_columns(longest), "n"]

    def pairs(codes: np.ndarray) -> Iterator[Found]:
        states = tries.walk(codes) if tries else codes.astype(np.int64)
        starts = np.flatnonzero((states[:-1] > 0) & (states[1:] > 0))
        for begin in range(0, len(starts), SOME):
            at = starts[begin : begin + SOME]
            keys = states[at] * (int(tries.offsets[-1]) if tries else 1 << 31) + states[at + 1]
            order, begins = _first(keys)
            once = at[order[begins]]
            counts = np.diff(np.r_[begins, len(at)])
            yield keys[order[begins]], counts, codes[once[:, None] + np.arange(words)]

    def counted(found: Found) -> Iterator[pa.RecordBatch]:
        _, counts, codes = found
        for begin in range(0, len(counts), ROWS):
            rows = slice(begin, begin + ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (*_paired(codes[rows], longest), counts[rows])], names=names
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[Found] = []
        size = 0
        for codes in _held(batches, RUNS if tries and len(tries.tries) > 1 else SOME):
            for part in pairs(codes):
                found.append(part)
                size += len(part[0])
                if size > HELD:
                    found = [_added(found)]
                    size = len(found[0][0])
                    if 2 * size > HELD:
                        yield from counted(found.pop())
                        size = 0
        if found:
            yield from counted(_added(found))

    return runs.mapInArrow(lean(run), ", ".join(f"{name} long" for name in names))


def _held(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[np.ndarray]:
    """Runs, put together until they have ``least`` numbers."""
    held, size = [], 0
    for batch in batches:
        for raw in batch.column("codes"):
            held.append(np.frombuffer(raw.as_buffer(), "<i4"))
            size += len(held[-1])
            if size >= least:
                whole = np.concatenate(held)
                held, size = [], 0
                yield whole
    if held:
        yield np.concatenate(held)


def _spelled(phrases: DataFrame, longest: int, blocks: list[tuple[Broadcast, int]]) -> DataFrame:
    """(lang, phrase, n, words) of phrases given by the numbers of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _unpaired([batch.column(name).to_numpy() for name in _columns(longest)], longest)
            known, at = np.unique(codes, return_inverse=True)
            lang, text = np.empty((2, len(known)), object)
            for block, before in blocks:
                keys = _opened(block)
                here = np.flatnonzero((known > before) & (known <= before + len(keys)))
                for to, key in zip(here.tolist(), keys.take(pa.array(known[here] - before - 1)).to_pylist()):
                    lang[to], _, text[to] = key.rpartition(CUT)
            lang, text = pa.array(lang, pa.binary()), pa.array(text, pa.binary())
            at, sizes, n = at.reshape(codes.shape), (codes > 0).sum(axis=1), batch.column("n").to_numpy()
            for size in np.unique(sizes).tolist():
                rows = sizes == size
                parts = [text.take(pa.array(at[rows, word])) for word in range(size)]
                yield pa.RecordBatch.from_arrays(
                    [lang.take(pa.array(at[rows, 0])), pc.binary_join_element_wise(*parts, b" "),
                     pa.array(n[rows]), pa.array(np.full(len(parts[0]), size, np.int32))],
                    names=["lang", "phrase", "n", "words"],
                )

    return phrases.mapInArrow(lean(run), COUNTS + ", words int")


def _tries(known: DataFrame, words: int, codes: int, most: int) -> Blocks:
    """Broadcast tries of phrases of ``words`` words, numbered up to ``codes``, in blocks of about
    ``most``; the driver holds one at a time."""
    context = known.sparkSession.sparkContext
    blocks = max(1, -(-known.count() // most))
    names, tries = _columns(words), []
    for number in range(blocks):
        rows = known.where(F.col("k0") % DEALT % blocks == number).select(*names).toArrow()
        trie = DoubleArray(_unpaired([rows.column(name).to_numpy() for name in names], words), codes)
        del rows, trie.states
        tries.append((context.broadcast(trie), len(trie.base)))
    return Blocks(tries)


def frequent_phrases(
    rows: DataFrame, longest: int = LONGEST, least: int = LEAST, most: int = MOST
) -> DataFrame:
    """(lang, phrase, words, n) of the phrases of 1 to ``longest`` words that occur ``least``
    times within pieces, from rows (lang, raw) of bytes; the row of a language with a null
    phrase counts all its words."""
    first = stored(
        _word_counts(rows).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(
            F.col("phrase").isNull() | (F.col("n") >= least)
        ),
        "phrases-1",
    )
    words = Words(first.where(F.col("phrase").isNotNull()), most)
    runs = stored(_numbered(rows, words), "phrases-runs") if words.size else None
    columns = _columns(longest)
    numbers: DataFrame | None = None
    tries: Blocks | None = None
    for length in range(2, longest + 1 if words.size else 2):
        counts = _longer(runs, length, longest, tries).groupBy(*columns).agg(F.sum("n").alias("n"))
        latest = stored(counts.where(F.col("n") >= least), f"phrases-{length}")
        for trie in tries.tries if tries else []:
            trie.destroy()
        numbers = latest if numbers is None else numbers.unionByName(latest)
        if length == longest or latest.isEmpty():
            break
        tries = _tries(latest, length, words.size, most)
    found = first.withColumn("words", F.lit(1))
    if numbers is not None:
        found = found.unionByName(stored(_spelled(numbers, longest, words.blocks), "phrases"))
    words.destroy()
    return found


# Scores --------------------------------------------------------------------------------


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = 2000,
    most: int = MOST,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases.

    A phrase of 2 to ``longest`` words that occurs a times, cut into parts that occur l and r
    times, scores floor(1000 a n / (l r)), n being all words of the language; its lowest cut
    counts. Phrases inside a longer one that occurs as often are dropped.

    Null texts are empty, a null language is ``und``. Texts are cut at punctuation and line
    ends, and no phrase reaches over a cut. Repeated rows count as often as they come; equal
    scores rank by a, then by phrase in UTF-8. Empty tables and texts without a frequent
    phrase give no rows.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).cast("binary").alias("lang"),
        text_bytes(F.col(f"`{text_col}`")).alias("raw"),
    )
    found = frequent_phrases(rows, longest, least, most).select(
        F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"),
        "words", "n",
    )
    counts = found.where(F.col("phrase").isNotNull())
    totals = found.where(F.col("phrase").isNull()).select("lang", F.col("n").alias("all"))
    phrases = counts.where(F.col("words") > 1).withColumn("parts", F.split("phrase", " "))

    def part(start, length) -> Column:
        return F.array_join(F.slice("parts", start, length), " ")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "n", "k", part(F.lit(1), F.col("k")).alias("first"),
        part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
    )
    firsts = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    whole = "decimal(19,0)"
    above = (1000 * F.col("n")).cast(whole) * F.col("all").cast(whole)
    below = F.col("l").cast(whole) * F.col("r").cast(whole)
    lowest = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(totals, "lang").groupBy(
        "lang", "phrase"
    ).agg(
        F.min(F.struct(F.call_function("div", above, below).alias("score"), "k", "l", "r")).alias("cut"),
        F.first("n").alias("a"), F.first("all").alias("n"),
    )
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), size -> transform(sequence(1, words - size + 1),"
        " start -> array_join(slice(parts, start, size), ' '))))"
    )
    within = phrases.where(F.col("words") > 2).select("lang", F.explode(inner).alias("phrase"), "n").groupBy(
        "lang", "phrase"
    ).agg(F.max("n").alias("longer"))
    kept = lowest.join(within, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"),
    )
