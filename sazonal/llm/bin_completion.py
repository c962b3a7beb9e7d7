"""Packing documents into as few token sequences as possible by bin completion.

Token counts are whole numbers up to the sequence length, so a corpus of any size is a table
of at most 2048 counts. The search runs on that table: it fills a sequence around the longest
piece that is left with one of the undominated fillings, uses the filling as often as the
counts allow, and goes on; branches whose waste already exceeds what the best known packing
wastes are cut, and best-fit solutions of what remains are the incumbents. The outcome is a
list of patterns (lengths, times). Every piece then looks up its place by its length and its
rank among the pieces of that length, which Spark counts without gathering them.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import claim, lean, stored, text_bytes

SEQUENCE = 2048
#: The id that ends every document.
END = 0

PIECES = (
    "row_id long, doc_id {id_type}, piece int, start long, length long, ids_crc32 long, "
    "deal long, nth long"
)


#: Byte-level vocabularies write a byte as a visible character: a visible Latin-1 character
#: stands for itself, the others are numbered from U+0100 on.
_HIDDEN = [*range(33), *range(127, 161), 173]
SHOWN = {byte: chr(256 + at) for at, byte in enumerate(_HIDDEN)}


# Token ids -----------------------------------------------------------------------------


class WordEncoder:
    """Ids of whole texts from ids of their words.

    The tokenizer lower-cases, drops white space and never joins across it, so the ids of a
    text are the ids of its words in a row. A word of Latin letters with ASCII marks after
    them is two tokens of the first split, which are looked up by themselves; any other word
    goes through the tokenizer whole. A full table of known words is set aside as the last
    one, from which words that come again move to the next; long words are not kept. So
    common words stay, and the bytes of both tables are bounded.
    """

    PLAIN = re.compile("([a-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\\[-`{-~]*)")
    #: Words of a table, and bytes of the longest of them.
    KNOWN, LONGEST = 240_000, 32

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.last: dict[bytes, bytes] = {}

    def encode(self, raw: bytes) -> bytes:
        """Little-endian 32-bit ids of a text given in UTF-8."""
        words = raw.lower().split()
        ids = list(map(self.known.get, words))
        if None in ids:
            look_up = self._look_up
            ids = [one if one is not None else look_up(word) for one, word in zip(ids, words)]
        return b"".join(ids)

    def _look_up(self, word: bytes) -> bytes:
        ids = self.known.get(word)
        if ids is not None:
            return ids
        ids = self.last.get(word)
        if ids is None:
            ids = self._part(word.decode()) if word.isalpha() else self._word(word.decode())
        if len(word) <= self.LONGEST:
            if len(self.known) >= self.KNOWN:
                self.known, self.last = {}, self.known
            self.known[word] = ids
        return ids

    def _word(self, word: str) -> bytes:
        plain = self.PLAIN.fullmatch(word.lower())
        if plain is None:
            return _bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)
        letters, marks = plain.groups()
        if marks:
            return self._look_up(letters.encode()) + self._look_up(marks.encode())
        return self._part(letters)

    def _part(self, part: str) -> bytes:
        # Visible ASCII stands for itself.
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(SHOWN)
        return _bytes([token.id for token in self.model.tokenize(shown)])


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of a Python worker; later tasks of the worker find its tables filled."""
    claim("encoder", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, length: int, end: int
) -> DataFrame:
    """One row per piece of each document; ``deal`` and ``nth`` number the pieces of one
    length within a task."""
    id_type = dict(docs.dtypes)[id_col]
    schema = PIECES.format(id_type=id_type)
    closing = np.array([end], "<u4").tobytes()
    cut = 4 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        deal = TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        row_id = deal << 33
        for batch in batches:
            ids, rows = batch.column(0), []
            for at, raw in enumerate(batch.column(1).to_pylist()):
                tokens = encode(raw) + closing
                for piece in range(-(-len(tokens) // cut)):
                    part = tokens[piece * cut : (piece + 1) * cut]
                    size = len(part) // 4
                    rows.append((row_id, at, piece, piece * length, size, zlib.crc32(part), seen[size]))
                    seen[size] += 1
                row_id += 1
            if not rows:
                continue
            row, at, piece, start, size, crc, nth = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row, pa.int64()), ids.take(pa.array(at)), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array([deal] * len(row), pa.int64()),
                    pa.array(nth, pa.int64()),
                ],
                names=["row_id", "doc_id", "piece", "start", "length", "ids_crc32", "deal", "nth"],
            )

    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), text_bytes(F.col(f"`{text_col}`")).alias("raw")
    ).mapInArrow(lean(run), schema)


# The search ----------------------------------------------------------------------------


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: the volume, or the pieces no two of which fit together."""
    volume = sum(size * n for size, n in counts.items())
    large = sum(n for size, n in counts.items() if 2 * size > capacity)
    return max(-(-volume // capacity), large)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: long pieces first, each into the fullest sequence that
    still takes it. Sequences that are filled alike are kept as one entry."""
    open_rooms: dict[int, list[list]] = {}
    rooms: list[int] = []
    closed = []
    for size in sorted((s for s, n in counts.items() if n), reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = open_rooms[room].pop()
                if not open_rooms[room]:
                    del open_rooms[room]
                    rooms.pop(at)
            else:
                room, pattern, times = capacity, (), left
            used = min(times, left)
            left -= used
            fresh = [((*pattern, size), used, room - size)]
            if used < times:
                fresh.append((pattern, times - used, room))
            for kept, n, space in fresh:
                if space == 0:
                    closed.append((kept, n))
                elif space in open_rooms:
                    open_rooms[space].append([kept, n])
                else:
                    open_rooms[space] = [[kept, n]]
                    bisect.insort(rooms, space)
    closed += [(pattern, n) for entries in open_rooms.values() for pattern, n in entries]
    return closed


def fillings(
    counts: dict[int, int], sizes: list[int], room: int, limit: int
) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room`` with pieces, least waste first.

    A filling is dominated if pieces of it could be exchanged for longer ones, or several for
    one at least as long as they are together, and still fit: whatever follows it can be
    packed as well after the other. ``limit`` bounds how many are looked at; an exact fill
    ends the search, for nothing dominates it.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    exact = False

    def extend(room: int, top: int, chosen: tuple[int, ...]) -> None:
        nonlocal exact
        at = bisect.bisect_right(sizes, min(room, top)) - 1
        grown = False
        while at >= 0 and not exact and len(found) < limit:
            size = sizes[at]
            if counts[size] - chosen.count(size) > 0:
                grown = True
                extend(room - size, size, (*chosen, size))
                if len(chosen) > 2:
                    break
            at -= 1
        if not grown:
            # Maximal among smaller pieces; a longer unused one may still fit.
            if not any(counts[s] - chosen.count(s) > 0 for s in sizes[: bisect.bisect_right(sizes, room)]):
                found.append((room, chosen))
                exact = exact or room == 0

    extend(room, room, ())
    found.sort(key=lambda entry: (entry[0], len(entry[1]), [-s for s in entry[1]]))
    kept = []
    for waste, chosen in found:
        if not _dominated(counts, sizes, waste, chosen):
            kept.append(chosen)
    return kept or [chosen for _, chosen in found[:1]]


def _dominated(counts: dict[int, int], sizes: list[int], waste: int, chosen: tuple[int, ...]) -> bool:
    def free_between(low: int, high: int) -> bool:
        for size in sizes[bisect.bisect_left(sizes, low) : bisect.bisect_right(sizes, high)]:
            if counts[size] - chosen.count(size) > 0:
                return True
        return False

    if waste == 0:
        # Only an exchange of equal volume could dominate: several pieces for one.
        return any(
            free_between(a + b, a + b) for i, a in enumerate(chosen) for b in chosen[i + 1 :]
        )
    if any(free_between(size + 1, size + waste) for size in set(chosen)):
        return True
    return any(
        free_between(a + b, a + b + waste) for i, a in enumerate(chosen) for b in chosen[i + 1 :]
    )


def complete_bins(
    counts: dict[int, int], capacity: int, branches: int = 6, looks: int = 128, nodes: int = 12_000
) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, times) that hold every counted piece, in few sequences.

    Depth-first search over fillings of the longest piece left. ``branches`` fillings are
    followed per node, ``looks`` bounds their enumeration, ``nodes`` the whole search; the
    best packing so far is returned when it ends, at once if the lower bound is met.
    """
    counts = {size: n for size, n in counts.items() if n > 0}
    bound = least_sequences(counts, capacity)
    best = best_fit(counts, capacity)
    best_n = sum(n for _, n in best)
    volume = sum(size * n for size, n in counts.items())
    path: list[tuple[tuple[int, ...], int]] = []
    left = dict(counts)
    sizes = sorted(left)
    visited = 0
    waste = 0
    # Frames hold the fillings not tried yet at a node, and the step that led to it.
    stack: list[list] = []

    def options() -> list[tuple[int, ...]]:
        longest = sizes[-1]
        left[longest] -= 1
        ways = fillings(left, sizes, capacity - longest, looks)[:branches]
        left[longest] += 1
        return [(longest, *way) for way in ways][::-1]

    def step(pattern: tuple[int, ...]) -> int:
        nonlocal waste
        need = {size: pattern.count(size) for size in set(pattern)}
        times = min(left[size] // n for size, n in need.items())
        for size, n in need.items():
            left[size] -= n * times
            if left[size] == 0:
                sizes.pop(bisect.bisect_left(sizes, size))
        waste += (capacity - sum(pattern)) * times
        path.append((pattern, times))
        return times

    def back() -> None:
        nonlocal waste
        pattern, times = path.pop()
        for size in set(pattern):
            if left[size] == 0:
                bisect.insort(sizes, size)
            left[size] += pattern.count(size) * times
        waste -= (capacity - sum(pattern)) * times

    if sizes and best_n > bound:
        stack.append(options())
    while stack and visited < nodes and best_n > bound:
        if not stack[-1]:
            stack.pop()
            if stack:
                back()
            continue
        step(stack[-1].pop())
        visited += 1
        # A packing better by one sequence leaves at most this much unused.
        if waste > (best_n - 1) * capacity - volume:
            back()
            continue
        if not sizes or visited % 50 == 0:
            rest = best_fit({s: left[s] for s in sizes}, capacity)
            n = sum(times for _, times in path) + sum(times for _, times in rest)
            if n < best_n:
                best, best_n = path + rest, n
            if not sizes:
                back()
                continue
        stack.append(options())
    return best


# Places --------------------------------------------------------------------------------


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length an array of rows (first rank, pieces per sequence, first sequence, offset):
    where the pieces of that length go, in the order of their ranks."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for size in sorted(set(pattern), reverse=True):
            n = pattern.count(size)
            out.setdefault(size, []).append((given.get(size, 0), n, sequence, offset))
            given[size] = given.get(size, 0) + n * times
            offset += n * size
        sequence += times
    return {size: np.array(rows, np.int64) for size, rows in out.items()}


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = SEQUENCE,
    end: int = END,
    **search,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Documents longer than ``length`` ids are cut; no others are. Null and empty texts are one
    piece that holds the end id alone. Repeated rows and ids are packed as often as they
    come; an empty table gives no rows. Only the counts per length reach the driver: at most
    ``length`` numbers, whatever the size of the corpus.
    """
    spark = docs.sparkSession
    pieces = stored(
        token_pieces(docs, tokenizer_path, id_col, text_col, length, end), "pack-pieces"
    )
    per_deal = pieces.groupBy("deal", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("deal").rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = per_deal.select(
        "deal", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    totals = {row["length"]: row["n"] for row in per_deal.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = totals.pop(length, 0)
    patterns = complete_bins(totals, length, **search) + ([((length,), full)] if full else [])
    plan = spark.sparkContext.broadcast(places(patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence = np.zeros(len(size), np.int64)
            offset = np.zeros(len(size), np.int64)
            for one in np.unique(size):
                mine = np.flatnonzero(size == one)
                rows = table[int(one)]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                turn = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 2] + turn // row[:, 1]
                offset[mine] = row[:, 3] + turn % row[:, 1] * one
            keep = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    names = ["row_id", "doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = pieces.join(base, ["deal", "length"]).select(
        *names, (F.col("base") + F.col("nth")).alias("rank")
    )
    kinds = dict(pieces.dtypes)
    schema = ", ".join(f"{name} {kinds[name]}" for name in names) + ", sequence_id long, offset long"
    return ranked.mapInArrow(lean(run), schema)
