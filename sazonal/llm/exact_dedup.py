"""Exact deduplication by a stream that keeps one state row per distinct text.

Documents pass as a stream of (digest, id, locator) rows. Its state, in RocksDB on the
executors' disks and checkpointed in the shared folder, never expires: per digest it holds
the largest id seen, the locator of that row's content, and the number of rows. The state is
read back as a table. Every row that hit a digest already held has its whole text compared;
digests under which texts differ are resolved by the texts themselves.

Only built-in expressions run on the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sazonal.session import scratch_path
from sazonal.sources.files import load_or_build
from sazonal.sources.headed import decoded

from .common import ascii_lower, filter_bits, maybe_in, stored

#: State store settings while the stream runs and its state is read.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # One batch is all that a store is opened for; kept open it would hold native memory.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass
class Deduplicated:
    """``rows``: one per document (id, keep_id, group_size, kept, digest, locator);
    ``documents``: the input rows that stay."""

    rows: DataFrame
    documents: DataFrame


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    state_dir: str | None = None,
    batch: str | None = None,
) -> Deduplicated:
    """Keep, of texts equal after lower-casing A-Z, the row with the largest id.

    ``docs`` is a plain read of Parquet files: the file's name and the row's number in it
    locate a row's content. With ``state_dir`` (a folder that all executors share) the state
    of earlier calls counts too, and the rows kept then stay known; without it a new state
    is begun. Texts of earlier calls whose digest is hit again are read at their locators, so
    their files have to stay. A call that is made again, after a failure or not, counts once if
    it gives the same ``batch``, a name fit for a folder; other batches hold other files.

    Null texts count as empty, and all empty texts are equal. A null id is smaller than any
    other. Of repeated rows (same id, same text) the one last in its file, and of files the
    last by name, stays. An empty table gives no rows. Other columns, whatever their names,
    are carried along in ``documents`` and looked at nowhere.
    """
    spark = docs.sparkSession
    tagged = _tagged(docs, id_col, text_col, digest, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    keys_path = scratch_path(spark, "dedup-keys") if state_dir is None else f"{state_dir}/keys"
    current = load_or_build(
        spark, f"{keys_path}/{batch or uuid.uuid4().hex}.whole", lambda: tagged.select("digest", "id", "place")
    )
    # What a call that failed has left half-written has another name.
    keys_path = f"{keys_path}/*.whole"
    keys = spark.read.schema(current.schema).parquet(keys_path)
    state = _pass_stream(keys, keys_path, state_dir or scratch_path(spark, "dedup-state"))

    assigned = keys.join(state, "digest", "left").select(
        "id", "digest", "place", F.col("keep.id").alias("keep_id"),
        F.col("keep.place").alias("keep_place"), "group_size",
    )
    hits = state.where("group_size > 1")
    bits = filter_bits(hits, F.col("digest"))
    doubtful = maybe_in(tagged, F.col("digest"), bits)
    texts, hit = tagged.select(*TEXT), doubtful.where("hit").select(*TEXT)
    if state_dir is not None:
        places = stored(
            keys.join(hits, "digest", "left_semi").select("place")
            .join(current.select("place"), "place", "left_anti").distinct(),
            "dedup-earlier",
        )
        earlier = _read_again(docs.select(f"`{id_col}`", f"`{text_col}`").schema, id_col, text_col, digest, places)
        texts, hit = texts.unionByName(earlier), hit.unionByName(earlier)
    clashes = stored(
        hit.select("digest", "norm").distinct()
        .groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
        .where("texts > 1").select("digest"),
        "dedup-clashes",
    )
    if not clashes.isEmpty():
        assigned = _resolve(texts, assigned, clashes)
    rows = assigned.select(
        "id", "keep_id", "group_size",
        (F.col("place") == F.col("keep_place")).alias("kept"), "digest", "place",
    )
    # A row outside the filter is alone under its digest. The others stay if their place is kept.
    stay = rows.where("kept and group_size > 1").select(
        "digest", F.col("place").alias("keep_place")
    )
    alone = doubtful.where("not hit").select("row.*")
    single = rows.where("group_size = 1").select("digest", F.col("place").alias("keep_place"))
    single = maybe_in(single, F.col("digest"), bits).where("hit").drop("hit")
    stay = stay.unionByName(single)
    repeated = doubtful.where("hit").alias("d").join(
        stay.alias("s"),
        (F.col("d.digest") == F.col("s.digest")) & (F.col("d.place") == F.col("s.keep_place")),
        "left_semi",
    )
    return Deduplicated(rows, alone.unionAll(repeated.select("row.*")))


#: What the comparison of whole texts needs of a row.
TEXT = ("digest", "norm", "id", "place")


def _tagged(
    docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], row: Column
) -> DataFrame:
    """(row, id, norm, place, digest) of each row of a plain read."""
    return docs.select(
        row.alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        ascii_lower(F.col(f"`{text_col}`")).alias("norm"),
        F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
        ).alias("place"),
    ).withColumn("digest", digest(F.col("norm")))


def _read_again(
    schema: StructType, id_col: str, text_col: str, digest: Callable[[Column], Column], places: DataFrame
) -> DataFrame:
    """The rows at stored locators. Only the names of their files reach the driver, as for
    any read."""
    spark = places.sparkSession
    names = [r[0] for r in places.select(decoded(F.col("place.file"))).distinct().collect()]
    found = spark.read.schema(schema).parquet(*names) if names else None
    if found is None:
        # No file to read: the columns of a read of none.
        return places.where("false").select(
            digest(F.lit("")).alias("digest"), F.lit("").alias("norm"),
            F.lit(None).cast(schema[id_col].dataType).alias("id"), "place",
        )
    tagged = _tagged(found, id_col, text_col, digest, F.lit(None))
    return tagged.join(places, "place", "left_semi").select(*TEXT)


def _pass_stream(keys: DataFrame, keys_path: str, state_dir: str) -> DataFrame:
    """Run the keys through the stream; its state as (digest, keep, group_size)."""
    spark = keys.sparkSession
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        stream = (
            spark.readStream.schema(keys.schema).parquet(keys_path)
            .groupBy("digest")
            .agg(F.max(F.struct("id", "place")).alias("keep"), F.count(F.lit(1)).alias("n"))
        )
        query = (
            stream.writeStream.outputMode("update").format("noop")
            .option("checkpointLocation", f"{state_dir}/checkpoint")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        if keys.isEmpty():
            return keys.groupBy("digest").agg(
                F.max(F.struct("id", "place")).alias("keep"),
                F.count(F.lit(1)).alias("group_size"),
            )
        state = spark.read.format("statestore").load(f"{state_dir}/checkpoint")
        return stored(
            state.select(
                F.col("key.digest").alias("digest"), F.col("value.max").alias("keep"),
                F.col("value.count").alias("group_size"),
            ),
            "dedup-index",
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _resolve(rows: DataFrame, assigned: DataFrame, clashes: DataFrame) -> DataFrame:
    """Rows under digests that several texts share, assigned by the text itself."""
    texts = rows.join(clashes, "digest", "left_semi").select(*TEXT)
    keep = texts.groupBy("digest", "norm").agg(
        F.max(F.struct("id", "place")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    exact = texts.join(keep, ["digest", "norm"]).select(
        "id", "digest", "place", F.col("keep.id").alias("keep_id"),
        F.col("keep.place").alias("keep_place"), "group_size",
    )
    return assigned.join(clashes, "digest", "left_anti").select(exact.columns).unionByName(exact)
