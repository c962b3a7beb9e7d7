"""One-hot encoding of columns with any number of categories, as sparse rows.

The categories stay in a table (col, category, place) that Spark numbers and joins; only the
number of categories and the mode of each column reach the driver. Each encoded row holds
the positions of its ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.series import positions
from ..session import materialize


@dataclass(frozen=True)
class SparseOneHot:
    """``places`` is (col, category, place), the places of a column dense from 0 in the order
    of its categories."""

    places: DataFrame
    cols: tuple[str, ...]
    modes: tuple[str, ...]
    sizes: tuple[int, ...]

    @property
    def size(self) -> int:
        return sum(self.sizes)

    @property
    def starts(self) -> list[int]:
        """The first feature of each column."""
        return list(accumulate(self.sizes, initial=0))[:-1]

    def features(self) -> DataFrame:
        """(feature, name) of all features, named like those of ``Preprocessor``."""
        start = F.coalesce(*[
            F.when(F.col("col") == c, F.lit(s)) for c, s in zip(self.cols, self.starts)
        ], F.lit(0))
        return self.places.select(
            (F.col("place") + start).alias("feature"),
            F.concat(F.lit("categorical__"), "col", F.lit("_"), "category").alias("name"),
        )

    def transform(self, df: DataFrame, keep: Iterable[str] = (), output: str = "features") -> DataFrame:
        """The columns of ``keep`` and a struct (size, indices, values). Nulls count as the
        mode; a category that was not there when fitting leaves its column's part empty."""
        values = [
            F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(mode)).alias(f"_category{i}")
            for i, (c, mode) in enumerate(zip(self.cols, self.modes))
        ]
        keep = list(keep)
        out = df.select(*[F.col(f"`{c}`") for c in keep], *values)
        for i, (c, start) in enumerate(zip(self.cols, self.starts)):
            table = self.places.where(F.col("col") == c).select(
                F.col("category").alias(f"_category{i}"), (F.col("place") + start).alias(f"_place{i}")
            )
            out = out.join(table, f"_category{i}", "left")
        found = F.array_compact(F.array(*[F.col(f"_place{i}") for i in range(len(self.cols))]))
        return out.select(
            *[F.col(f"`{c}`") for c in keep],
            F.struct(
                F.lit(self.size).cast("long").alias("size"), found.alias("indices"),
                F.transform(found, lambda _: F.lit(1.0)).alias("values"),
            ).alias(output),
        )


def fit_sparse(df: DataFrame, cols: Sequence[str]) -> SparseOneHot:
    """Modes (the smallest among ties) and numbered categories of ``cols``. One pass counts
    the values of all columns; a column without any value is left out."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").cast("string").alias("category")) for c in cols
    ])
    counts = materialize(
        df.select(F.inline(entries)).where("category is not null")
        .groupBy("col", "category").agg(F.count(F.lit(1)).alias("n"))
    )
    facts = {
        r["col"]: r for r in counts.groupBy("col").agg(
            F.count(F.lit(1)).alias("size"), F.min(F.struct(-F.col("n"), "category")).alias("top")
        ).collect()
    }
    known = tuple(c for c in dict.fromkeys(cols) if c in facts)
    places = positions(counts.select("col", "category"), ["category"], ["col"], "place")
    return SparseOneHot(
        materialize(places), known,
        tuple(facts[c]["top"]["category"] for c in known), tuple(facts[c]["size"] for c in known),
    )


def as_vector(encoded: Column) -> Column:
    """The struct of ``transform`` as a vector of Spark ML, for its models. Spark has no
    built-in way to a sparse vector, so this runs row by row."""
    make = F.udf(lambda row: Vectors.sparse(row["size"], row["indices"], row["values"]), VectorUDT())
    return make(encoded)
