"""Text quality by votes of labelled neighbours in a latent space.

A text is counted as terms that say how it is written, not what about: the shapes of its
words, pairs of shapes, and how much of it repeats. A bounded sample of labelled texts gives
term weights and, by a singular value decomposition, the latent axes. The labelled vectors are
broadcast; every document is compared with all of them, block by block, and the labels of the
nearest vote with weights that grow with the cosine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, fold_of, lean, text_bytes

#: Labelled rows that the model holds at most, taken in the order of a hash of their ids.
LABELLED = 4096
#: Latent axes, voters, and the power of the cosine that weighs a vote.
AXES, VOTERS, SHARPNESS = 32, 15, 8
#: Hashed terms: shapes, pairs of shapes, and three measures of repetition.
SHAPES, PAIRS = 256, 512
TERMS = SHAPES + PAIRS + 3

_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_FORMS = bytes(
    ord("x") if chr(b).islower() and b < 128 else ord("X") if 65 <= b <= 90
    else ord("9") if 48 <= b <= 57 else ord("x") if b >= 128 else b
    for b in range(256)
)
_SHAPE_OF: dict[bytes, int] = {}
_KNOWN = 200_000


def _shape(word: bytes) -> int:
    """Hashed shape: letters and digits by kind, runs of a sign as one."""
    at = _SHAPE_OF.get(word)
    if at is None:
        if len(_SHAPE_OF) > _KNOWN:
            _SHAPE_OF.clear()
        at = zlib.crc32(_RUNS.sub(rb"\1", word.translate(_FORMS))) % SHAPES
        _SHAPE_OF[word] = at
    return at


def _forget_shapes() -> None:
    _SHAPE_OF.clear()


def term_counts(raw: bytes) -> np.ndarray:
    """Shares of the terms in a whole text; zeros for a text without words."""
    words = raw.split()
    out = np.zeros(TERMS, np.float64)
    n = len(words)
    if n == 0:
        return out
    shapes = np.fromiter(map(_shape, words), np.int64, n)
    out[:SHAPES] = np.bincount(shapes, minlength=SHAPES) / n
    if n > 1:
        pairs = (shapes[:-1] * 31 + shapes[1:] * 17) % PAIRS
        out[SHAPES : SHAPES + PAIRS] = np.bincount(pairs, minlength=PAIRS) / n
        marks = np.fromiter(map(hash, words), np.int64, n)
        twice = marks[:-1] * np.int64(1_000_003) + marks[1:]
        out[-3] = np.count_nonzero(marks[:-1] == marks[1:]) / n
        out[-2] = 1.0 - len(np.unique(twice)) / len(twice)
        if n > 7:
            long = sum(marks[at : n - 7 + at] * np.int64(2 * at * at + 4093 * at + 1) for at in range(8))
            out[-1] = 1.0 - len(np.unique(long)) / len(long)
    return out


@dataclass
class NeighbourModel:
    """What is broadcast: at most LABELLED vectors of AXES numbers, and the projection."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = (np.sqrt(counts) * self.weights) @ self.axes
        norms = np.linalg.norm(latent, axis=1, keepdims=True)
        return (latent / np.where(norms > 0, norms, 1.0)).astype(np.float32)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest; the prior where nothing is near."""
        out = np.full(len(counts), self.prior)
        if not len(self.labels):
            return out
        k = min(VOTERS, len(self.labels))
        for start in range(0, len(counts), 1024):
            cosines = self.project(counts[start : start + 1024]) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.clip(np.take_along_axis(cosines, near, 1), 0, 1).astype(np.float64) ** SHARPNESS
            total = votes.sum(axis=1)
            found = total > 1e-9
            share = (votes * self.labels[near]).sum(axis=1)[found] / total[found]
            out[start : start + 1024][found] = np.clip(share, 0.0, 1.0)
        return out


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", labelled: int = LABELLED,
) -> NeighbourModel:
    """Model from labelled documents, ``labelled`` of them at most: the first in the order of
    a hash of the id. Labels other than 0 and 1, and labels of unknown ids, are passed over;
    an id with several labels counts as the mean of them, rounded. Without any labelled
    document every score is 0.5.
    """
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.round(F.avg(label_col)).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(labelled)
    )
    texts = docs.select(
        F.col(f"`{id_col}`").alias("id"), text_bytes(F.col(f"`{text_col}`")).alias("raw")
    ).join(F.broadcast(known), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("word shapes", _forget_shapes)
        for batch in batches:
            counts = [term_counts(raw).astype("<f8").tobytes() for raw in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(counts, pa.binary())],
                names=["id", "label", "counts"],
            )

    rows = texts.select("id", "label", "raw").mapInArrow(
        lean(run, _forget_shapes), f"id {dict(texts.dtypes)['id']}, label int, counts binary"
    )
    # Rows that share an id could exceed the bound: one of each is taken.
    rows = rows.groupBy("id").agg(F.min_by("label", "counts").alias("label"), F.min("counts").alias("counts")).collect()
    rows.sort(key=lambda row: row["id"])
    counts = np.array([np.frombuffer(row["counts"], "<f8") for row in rows]).reshape(-1, TERMS)
    votes = np.array([row["label"] for row in rows], np.float64)
    if not len(rows):
        return NeighbourModel(np.ones(TERMS), np.eye(TERMS, AXES), np.zeros((0, AXES), np.float32), votes)
    present = (counts > 0).sum(axis=0)
    weights = np.log((1.0 + len(rows)) / (1.0 + present)) + 1.0
    weighted = np.sqrt(counts) * weights
    _, axes = np.linalg.eigh(weighted.T @ weighted)
    model = NeighbourModel(weights, axes[:, ::-1][:, :AXES], np.zeros((0, AXES), np.float32), votes)
    model.vectors = model.project(counts)
    return model


def score_quality(
    docs: DataFrame, model: NeighbourModel, text_col: str = "text",
    columns: list[str] | None = None,
) -> DataFrame:
    """(row, quality_score): ``row`` holds ``columns`` of ``docs`` (all, if not given), the
    score is the likelihood of label 1.

    Whole texts are read. Null and empty texts have no terms and get the share of label 1
    among the labelled. Rows are scored one by one, so ids may repeat or be null; an empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"),
        text_bytes(F.col(f"`{text_col}`")).alias("raw"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("word shapes", _forget_shapes)
        for batch in batches:
            scores = []
            raws = batch.column("raw").to_pylist()
            for start in range(0, len(raws), 1024):
                counts = np.array([term_counts(raw) for raw in raws[start : start + 1024]])
                scores.append(shared.value.score(counts))
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores, pa.float64())], names=["row", "quality_score"]
            )

    kind = row.schema["row"].dataType.simpleString()
    return row.mapInArrow(lean(run, _forget_shapes), f"row {kind}, quality_score double")


def training_rows(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Labels outside the fold that is held out."""
    return labels.where(fold_of(F.col(id_col), 3) != 1)
