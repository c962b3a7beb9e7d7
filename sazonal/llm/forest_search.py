"""Nearest neighbours by inner product in a forest of random-projection trees.

Trees are fitted on a bounded sample; every vector is then routed to its leaf in every tree.
A query goes down all trees at once with one priority queue: the branch whose split it is
least on the wrong side of comes next, in whichever tree, until the leaves found hold enough
vectors. Leaves and queries meet by leaf, crowded leaves cut into chunks, and candidates are
ranked by exact products of the original vectors.

An extra coordinate brings all vectors to one length, so that the nearest by angle are those
of the largest inner product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

#: Rows that the trees are fitted on at most, taken in the order of a hash of their ids.
SAMPLE = 16_384
TREES, LEVELS = 8, 5
#: A query looks into leaves until they hold so many times the rows of the table, counted over
#: all trees; 1.2 reaches about 70 % of evenly spread vectors of 64 dimensions, and fewer
#: leaves do where vectors form clusters.
VISITS = 1.2
#: Rows of a leaf that one task compares at a time.
CHUNK = 4096


@dataclass
class Forest:
    """(tree, node) -> normal and threshold; leaf sizes once the vectors are routed."""

    normals: np.ndarray
    cuts: np.ndarray
    longest: float
    sizes: np.ndarray | None = None

    @property
    def leaves(self) -> int:
        return self.cuts.shape[1] + 1

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = self.longest**2 - np.einsum("ij,ij->i", vectors, vectors)
        return np.column_stack([vectors, np.sqrt(np.maximum(rest, 0.0))])

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree."""
        points = self.lifted(vectors)
        at = np.zeros((len(points), len(self.cuts)), np.int64)
        for tree in range(len(self.cuts)):
            node = np.zeros(len(points), np.int64)
            while node.size and node[0] < self.leaves - 1:
                side = np.einsum("ij,ij->i", points, self.normals[tree, node]) > self.cuts[tree, node]
                node = 2 * node + 1 + side
            at[:, tree] = node - (self.leaves - 1)
        return at

    def search(self, query: np.ndarray, visits: float, least: int) -> list[tuple[int, int]]:
        """Leaves for a query, best first, from one queue over all trees. A leaf counts no
        more than half as many rows again as an even one, so that one crowd of equal vectors
        doesn't end the search; nor does it end before the leaves of one tree, which have no
        row in common, hold ``least`` rows or no leaf is left."""
        point = np.append(query, 0.0)
        margins = self.normals @ point - self.cuts
        total = self.sizes[0].sum()
        most = 1.5 * total / self.leaves
        queue = [(-np.inf, tree, 0) for tree in range(len(self.cuts))]
        heapq.heapify(queue)
        found, seen = [], 0.0
        held = np.zeros(len(self.cuts), np.int64)
        while queue and (seen < visits * total or held.max() < least):
            behind, tree, node = heapq.heappop(queue)
            if node >= self.leaves - 1:
                leaf = node - (self.leaves - 1)
                if self.sizes[tree, leaf]:
                    found.append((tree, leaf))
                    seen += min(self.sizes[tree, leaf], most)
                    held[tree] += self.sizes[tree, leaf]
                continue
            margin = margins[tree, node]
            heapq.heappush(queue, (max(behind, -margin), tree, 2 * node + 2))
            heapq.heappush(queue, (max(behind, margin), tree, 2 * node + 1))
        return found


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, values) of the rows that take part: id and vector given, of the dimension that
    most vectors have, all components finite, and not all zero."""
    column = F.col(f"`{vector_col}`")
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(
        F.col(f"`{id_col}`").isNotNull() & column.isNotNull() & ~bad & F.exists(column, lambda x: x != 0)
    ).select(F.col(f"`{id_col}`").cast("long").alias("id"), column.cast("array<double>").alias("values"))
    size = rows.agg(F.mode(F.size("values"), True).alias("n")).first()["n"]
    return rows.where(F.size("values") == (size or 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def fit_forest(
    rows: DataFrame, sample: int = SAMPLE, trees: int = TREES, levels: int = LEVELS, seed: int = 7
) -> Forest:
    """Trees over at most ``sample`` rows. A node parts its rows at the median along the line
    between two of them."""
    square = F.aggregate("values", F.lit(0.0), lambda total, x: total + x * x)
    longest = rows.agg(F.max(F.sqrt(square))).first()[0] or 0.0
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    vectors = np.array([row["values"] for row in taken], np.float64)
    size = vectors.shape[1] if len(vectors) else 0
    nodes = 2**levels - 1
    forest = Forest(np.zeros((trees, nodes, size + 1)), np.zeros((trees, nodes)), longest)
    if not len(vectors):
        return forest
    points = forest.lifted(vectors)
    draws = np.random.default_rng(seed)
    for tree in range(trees):
        at = np.zeros(len(points), np.int64)
        for node in range(nodes):
            mine = np.flatnonzero(at == node)
            normal = np.zeros(size + 1)
            if len(mine) > 1:
                a, b = draws.choice(mine, 2, replace=False)
                normal = points[a] - points[b]
            length = np.linalg.norm(normal)
            if length < 1e-12:
                normal = draws.normal(size=size + 1)
                length = np.linalg.norm(normal)
            forest.normals[tree, node] = normal / length
            along = points[mine] @ forest.normals[tree, node]
            forest.cuts[tree, node] = np.median(along) if len(mine) else 0.0
            at[mine] = 2 * node + 1 + (along > forest.cuts[tree, node])
    return forest


def _routed(rows: DataFrame, forest: Forest) -> DataFrame:
    """(id, vector, tree, leaf), one row per vector and tree."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("values"))
            leaves = shared.value.route(vectors)
            n, trees = leaves.shape
            packed = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("id").to_numpy(), trees)),
                    packed.take(pa.array(np.repeat(np.arange(n), trees))),
                    pa.array(np.tile(np.arange(trees), n), pa.int32()),
                    pa.array(leaves.ravel(), pa.int32()),
                ],
                names=["id", "vector", "tree", "leaf"],
            )

    return rows.mapInArrow(run, "id long, vector binary, tree int, leaf int")


def _asked(queries: DataFrame, forest: Forest, visits: float, least: int) -> DataFrame:
    """(id, vector, tree, leaf): the leaves in which each query looks."""
    shared = queries.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vector in zip(batch.column("id").to_pylist(), batch.column("values").to_pylist()):
                query = np.array(vector, np.float64)
                found = shared.value.search(query, visits, least)
                if found:
                    tree, leaf = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([at] * len(found), pa.int64()),
                            pa.array([query.tobytes()] * len(found), pa.binary()),
                            pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()),
                        ],
                        names=["id", "vector", "tree", "leaf"],
                    )

    return queries.mapInArrow(run, "id long, vector binary, tree int, leaf int")


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    vectors = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64)
    return ids, vectors.reshape(len(ids), -1)


def _nearest(k: int):
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        out = ([], [], [])
        if members.num_rows and queries.num_rows:
            ids, vectors = _unpacked(members)
            asked, points = _unpacked(queries)
            for start in range(0, len(asked), 256):
                rough = points[start : start + 256] @ vectors.T
                for query, point, row in zip(asked[start : start + 256], points[start : start + 256], rough):
                    row[ids == query] = -np.inf
                    # All that could be among the k nearest, rounding aside, are ranked by
                    # products that are equal for equal vectors.
                    if len(row) > k:
                        least = np.partition(row, -k)[-k]
                        near = np.flatnonzero(row >= least - 1e-9 * (1.0 + abs(least)))
                    else:
                        near = np.arange(len(row))
                    near = near[np.isfinite(row[near])]
                    exact = np.einsum("ij,j->i", vectors[near], point)
                    order = np.lexsort((ids[near], -exact))[:k]
                    out[0].extend([query] * len(order))
                    out[1].extend(ids[near][order])
                    out[2].extend(exact[order])
        return pa.table({
            "query_id": pa.array(out[0], pa.int64()), "id": pa.array(out[1], pa.int64()),
            "score": pa.array(out[2], pa.float64()),
        })

    return run


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id",
    vector_col: str = "embedding", visits: float = VISITS, **fit,
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of each row that ``queries`` selects.

    Score is the inner product in double precision; ties go to the smaller id. A row is no
    neighbour of its own id. Rows with a null id, a null or zero vector, null or non-finite
    components, or another dimension than most take no part. Of rows that share an id the
    best counts. Fewer than k candidates are all returned; an empty table gives no rows.
    """
    rows = stored(usable(vectors, id_col, vector_col), "ann-rows")
    forest = fit_forest(rows, **fit)
    members = stored(_routed(rows, forest), "ann-members")
    sizes = np.zeros((len(forest.cuts), forest.leaves), np.int64)
    for row in members.groupBy("tree", "leaf").count().collect():
        sizes[row["tree"], row["leaf"]] = row["count"]
    forest.sizes = sizes
    asked = _asked(rows.where(queries), forest, visits, k + 1)
    chunks = vectors.sparkSession.createDataFrame(
        [(t, leaf, -(-int(n) // CHUNK)) for t, line in enumerate(sizes) for leaf, n in enumerate(line) if n],
        "tree int, leaf int, chunks int",
    )
    chunks = F.broadcast(chunks)
    dealt = members.join(chunks, ["tree", "leaf"]).withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    )
    sent = asked.join(chunks, ["tree", "leaf"]).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    )
    key = ["tree", "leaf", "chunk"]
    found = (
        dealt.select(*key, "id", "vector").groupBy(*key)
        .cogroup(sent.select(*key, "id", "vector").groupBy(*key))
        .applyInArrow(_nearest(k), "query_id long, id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )
