"""Connected components of a link table, by stars that are merged until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that a row (a, b) of ``links`` touches and that is not
    itself the least node of its component; root is that least node.

    Each round lets every node point its larger neighbours at the least one it knows, then
    every node its smaller ones; paths shorten by a factor per round. A round is stored, and
    only its row count and a checksum reach the driver.
    """
    edges = links.select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    ).where("high > low").distinct()
    edges, mark = _kept(edges)
    while True:
        both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionAll(
            edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        outward = (
            both.join(least, "node").where("other > node")
            .select(F.col("other").alias("high"), F.least("node", "least").alias("low")).distinct()
        )
        least = outward.groupBy("high").agg(F.min("low").alias("least"))
        inward = (
            outward.join(least, "high").where("low > least")
            .select(F.col("low").alias("high"), F.col("least").alias("low"))
        ).unionAll(least.select("high", F.col("least").alias("low"))).distinct()
        edges, after = _kept(inward)
        if after == mark:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
        mark = after


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = stored(edges, "components")
    mark = edges.agg(
        F.count(F.lit(1)), F.expr("bit_xor(xxhash64(high, low))"),
        F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")),
    ).first()
    return edges, tuple(mark)
