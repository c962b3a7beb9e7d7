"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words. Target over size is the expected number of
copies of each of its documents: a whole part, which all get, and a fraction, which pivotal
rounding turns into 0 or 1. Two documents with open fractions meet; words are moved from one
to the other until one fraction is 0 or 1, in the direction a seeded draw picks, with the
odds that keep both expectations. What the pair takes together never changes, so a source
ends within one document of its target.

Documents are dealt by hash into buckets of bounded expected size; each bucket leaves at most
one open document. These residuals meet in a tree with a fixed fan-in until one is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, lean, stored, uniform

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source is taken more than so many times over.
MOST = 3
#: Expected documents of a bucket, and residuals that meet in a node of the tree.
BUCKET, FAN_IN = 4096, 64

ITEM = "id long, source string, size long, rows long, bucket long, copies long, part double"


def word_count(text) -> F.Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in code-point order, null last, have ``weights`` in turn and share the words of
    all. A target ends at ``most`` times the source's size; what is above is shared among
    the others by weight until none is above. That is one water level: a source gets
    level x weight or its own bound, whichever is less. One row per source passes the
    windows.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turns = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn(
        "weight",
        F.element_at(turns, (F.row_number().over(ordered) - 1) % len(weights) + 1),
    ).withColumn("bound", F.col("source_size") * float(most))
    by_ratio = Window.orderBy(
        F.col("bound") / F.col("weight"), F.col("source").isNull(), F.col("source")
    )
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(so_far), F.lit(0.0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(so_far), F.lit(0.0))
    leveled = ranked.withColumn("level", left / weight_left).withColumn(
        "place", F.row_number().over(by_ratio)
    )
    fits = F.when(
        F.col("level") * F.col("weight") <= F.col("bound"), F.struct("place", "level")
    )
    level = F.coalesce(
        F.min(fits).over(Window.orderBy("place").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))["level"],
        F.lit(float("inf")),
    )
    return leveled.select(
        "source", "source_size",
        F.least(F.col("bound"), level * F.col("weight")).alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 1,
) -> DataFrame:
    """(id, source, size, rows, source_size, target, copies), one row per document.

    Size is the number of words of the whole text. ``copies`` is how often the mix takes the
    document: 0 to ``most``. Rows of one id, source and size are one item and get the same
    number of copies; ``rows`` says how many they are. The draws depend on the seed and the
    ids alone, not on how the rows are dealt, so reruns agree. Null and empty texts have no
    words: they get the whole part of their copies and take part in no pair. A null source is
    a source of its own, a null id an id of its own; an empty table gives no rows.
    """
    items = stored(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{source_col}`").alias("source"),
            word_count(F.col(f"`{text_col}`")).alias("size"),
        ).groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("rows")),
        "mix-items",
    )
    targets = stored(
        source_targets(items.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, most)
        .join(
            items.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BUCKET).alias("buckets"))
            .withColumnRenamed("source", "of"),
            F.col("source").eqNullSafe(F.col("of")),
        ).drop("of"),
        "mix-targets",
    )
    # Copies are computed in whole millionths of a millionth so that 3 stays 3.
    share = F.round(F.try_divide("target", "source_size"), 12)
    whole = F.coalesce(F.floor(share), F.lit(0)).cast("long")
    joined = items.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")
    dealt = joined.select(
        "id", "source", "size", "rows",
        F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.col("buckets")).cast("long").alias("bucket"),
        whole.alias("copies"),
        F.when(F.col("size") > 0, F.coalesce(share - F.floor(share), F.lit(0.0)))
        .otherwise(F.lit(0.0)).alias("part"),
    )
    buckets = targets.agg(F.max("buckets")).first()[0] or 1
    settled = []
    open_items = dealt
    level = 0
    while True:
        last = buckets <= 1
        done = stored(_meet(open_items, level, last, seed), f"mix-level{level}")
        settled.append(done.where("part = 0"))
        if last:
            break
        open_items = done.where("part > 0").withColumn(
            "bucket", F.floor(F.col("bucket") / FAN_IN).cast("long")
        )
        buckets, level = -(-buckets // FAN_IN), level + 1
    every = settled[0]
    for more in settled[1:]:
        every = every.unionAll(more)
    return every.drop("bucket", "part").join(
        targets.drop("buckets").withColumnRenamed("source", "of"),
        F.col("source").eqNullSafe(F.col("of")),
    ).drop("of")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``.
    Options as for ``mix``."""
    id_col, text_col, source_col = (
        options.get("id_col", "doc_id"), options.get("text_col", "text"),
        options.get("source_col", "source"),
    )
    taken = mix(docs, **options).where("copies > 0").select(
        F.col("id").alias("mix_id"), F.col("source").alias("mix_source"),
        F.col("size").alias("mix_size"), F.col("copies").cast("int").alias("mix_copies"),
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{source_col}`").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
    )
    joined = rows.join(
        taken,
        F.col("id").eqNullSafe(F.col("mix_id"))
        & F.col("source").eqNullSafe(F.col("mix_source")) & (F.col("size") == F.col("mix_size")),
    )
    return joined.withColumn(
        "again", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))
    ).select("row.*")


def _meet(items: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    """Let the open items of each (source, bucket) meet, long ones first: items of like size
    decide each other, so the one left open is short and its lone draw moves few words. Comes
    back with ``part`` 0 where settled; an item left open in its bucket keeps its fraction,
    but in the last round it is drawn alone."""
    dealt = items.repartition("source", "bucket").sortWithinPartitions(
        "source", "bucket", F.desc("size"), "id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, None
        names = None
        for batch in batches:
            names = batch.schema
            out = []
            for row in batch.to_pylist():
                if (row["source"], row["bucket"]) != group:
                    if held is not None:
                        out.append(_closed(held, last, seed))
                    group, held = (row["source"], row["bucket"]), None
                if not row["part"] > 0.0:
                    row["part"] = 0.0
                    out.append(row)
                elif held is None:
                    held = row
                else:
                    first, second = _pair(held, row, seed, level)
                    held = None
                    for item in (first, second):
                        if 0.0 < item["part"] < 1.0:
                            held = item
                        else:
                            item["copies"] += int(item["part"])
                            item["part"] = 0.0
                            out.append(item)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=names)
        if held is not None:
            yield pa.RecordBatch.from_pylist([_closed(held, last, seed)], schema=names)

    return dealt.mapInArrow(lean(run), ITEM)


def _closed(item: dict, last: bool, seed: int) -> dict:
    if last:
        item["copies"] += int(uniform(seed, -1, item["id"] or 0, item["size"]) < item["part"])
        item["part"] = 0.0
    return item


def _pair(a: dict, b: dict, seed: int, level: int) -> tuple[dict, dict]:
    """Move words between two open items until one is decided."""
    words_a, words_b = a["size"] * a["rows"], b["size"] * b["rows"]
    to_a = min((1.0 - a["part"]) * words_a, b["part"] * words_b)
    to_b = min(a["part"] * words_a, (1.0 - b["part"]) * words_b)
    source = zlib.crc32((a["source"] or "").encode())
    draw = uniform(seed, level, source, a["id"] or 0, b["id"] or 0, a["size"], b["size"])
    moved = to_a if draw * (to_a + to_b) < to_b else -to_b
    for item, words in ((a, moved / words_a), (b, -moved / words_b)):
        part = item["part"] + words
        # The item that decided the step is at 0 or 1 up to rounding.
        item["part"] = 0.0 if part < 1e-9 else 1.0 if part > 1.0 - 1e-9 else part
    return a, b
