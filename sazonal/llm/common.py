"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import string
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sazonal.session import scratch_path

#: Word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

MASK = (1 << 64) - 1

_SHIPPED: set[str] = set()


#: Bytes of a batch that goes to a Python worker. Texts and
#: shingle sets differ in length, so rows alone bound nothing; a batch lies in the executor's
#: native memory and the worker's at once.
ARROW_BYTES = 8 << 20


def ship(spark: SparkSession, batch_bytes: int = ARROW_BYTES) -> None:
    """Send this package's source to the Python workers, once per application, and bound the
    bytes of their batches. The driver serves the file; executors need no copy of the
    repository."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{batch_bytes}b")
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="sazonal-code-")) / "sazonal-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_HELD: dict[str, Callable[[], None]] = {}
_LIBC = ctypes.CDLL(None)


def give_back() -> None:
    """Return to the machine what allocators keep of memory that is free again."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def lean(run: Callable, forget: Callable[[], None] | None = None) -> Callable:
    """``run`` for mapInArrow, with free memory given back as a task begins and as it ends:
    workers outlive their tasks and lie idle beside others. ``forget``, a module's function,
    empties the task's tables of known words at its end, also if it is cut short."""

    def whole(batches):
        give_back()
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            give_back()

    return whole


def claim(owner: str, clear: Callable[[], None]) -> None:
    """Say, as a task begins, which operator's tables of known words its Python worker holds.
    Workers outlive tasks and serve one operator after another; the tables of the one before
    are emptied, so that only those of one stay, and what allocators keep of memory that is
    free again goes back to the machine. ``clear`` is a module's function, which a worker finds
    by its name: a table that a task's own code names is sent along and is a copy there."""
    if owner not in _HELD:
        for empty in _HELD.values():
            empty()
        _HELD.clear()
        _HELD[owner] = clear
    give_back()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage ends here and nothing
    above is computed twice, whichever executor is lost."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; null becomes the empty text."""
    return F.coalesce(text, F.lit("")).cast("binary")


def words_of(raw: bytes) -> list[bytes]:
    """Words of a text with A-Z lower-cased. ``bytes.split`` cuts at exactly the six ASCII
    white-space bytes, and ``bytes.lower`` touches only A-Z."""
    return raw.lower().split()


#: Bytes as ``words_of`` takes them: A-Z in lower case, white space as blanks.
WORD_BYTES = bytes(32 if byte in b"\t\n\v\f\r" else byte for byte in bytes(range(256)).lower())


def coded_words(texts: pa.Array, fold: bytes, least: int = 1) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a column of texts in bytes, the number among them of each word in
    reading order, and the position there of each text's first word (at last: of the end).

    ``fold`` maps every byte; words are what then lies between blanks. Words of fewer than
    ``least`` bytes are left out. The column is split at once, so no word becomes an object.
    """
    bounds = np.zeros(1, np.int64)
    if len(texts):
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    if bounds[-1] == bounds[0]:
        return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    raw = memoryview(data)[int(bounds[0]) : int(bounds[-1])].tobytes().translate(fold)
    raw, bounds = np.frombuffer(raw, np.uint8), bounds - bounds[0]
    inside = raw != 32
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # Words begin and end with their texts, too.
    begins, ends = bounds[:-1][bounds[:-1] < len(raw)], bounds[1:][bounds[1:] > 0] - 1
    first[begins], last[ends] = inside[begins], inside[ends]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    letters = raw[inside]
    if least > 1:
        long = sizes >= least
        letters = letters[np.repeat(long, sizes)]
        starts, sizes = starts[long], sizes[long]
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    coded = pa.BinaryArray.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    ).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.searchsorted(starts, bounds)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, and how often each occurs."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[at], np.diff(np.r_[at, len(keys)])


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def mixed(value: int) -> int:
    """64 well-mixed bits of an integer (the splitmix finaliser)."""
    value = (value + 0x9E3779B97F4A7C15) & MASK
    value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    value = ((value ^ (value >> 27)) * 0x94D049BB133111EB) & MASK
    return value ^ (value >> 31)


def uniform(*parts: int) -> float:
    """A draw from [0, 1) that depends on the given integers alone."""
    state = 0
    for part in parts:
        state = mixed(state ^ (part & MASK))
    return (state >> 11) / float(1 << 53)


#: log2 of the bits of a filter: 2 MB at most, whatever the number of keys.
FILTER_BITS = 24


def _position(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - FILTER_BITS)


def filter_bits(df: DataFrame, key: Column) -> DataFrame:
    """A one-hash Bloom filter of the keys of ``df``: rows of 4 KB, 512 at most."""
    return df.select(_position(key).alias("at")).groupBy(
        F.shiftright("at", 15).alias("part")
    ).agg(F.expr("bitmap_construct_agg(at & 32767)").alias("bits"))


def maybe_in(df: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """Adds ``hit``; where it is false the key is surely not in the filter. The filter is
    broadcast: FILTER_BITS bound it. It only spares rows a shuffle; what it lets through
    needs a join."""
    byte = (
        "cast(conv(hex(substring(bits, cast(shiftright(at & 32767, 3) as int) + 1, 1)), 16, 10)"
        " as bigint)"
    )
    return (
        df.withColumn("at", _position(key)).withColumn("part", F.shiftright("at", 15))
        .join(F.broadcast(bits), "part", "left")
        .withColumn("hit", F.expr(f"coalesce(getbit({byte}, cast(at & 7 as int)) = 1, false)"))
        .drop("part", "bits", "at")
    )
