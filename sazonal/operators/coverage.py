"""How many rows with a target each key has, and keeping the well-covered keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encode import bin_label
from ..functions.missing import drop_missing

# Quarter bins of the largest count, left-closed.
QUARTERS = (0.0, 0.25, 0.5, 0.75)
QUARTER_LABELS = (
    "menos_de_1_quarto",
    "entre_1_e_2_quartos",
    "entre_2_e_3_quartos",
    "entre_3_e_4_quartos",
)


def target_counts(
    df: DataFrame, keys: Sequence[str], target: str, name: str = "qtd_exemplos_com_dengue"
) -> DataFrame:
    """Rows with a target per key, largest first."""
    return (
        drop_missing(df, [*keys, target])
        .groupBy(*keys)
        .agg(F.count("*").alias(name))
        .orderBy(F.desc(name), *keys)
    )


def largest(counts: DataFrame, name: str) -> Column:
    """Largest count as a scalar subquery; no join and nothing kept on the driver."""
    return counts.agg(F.max(name).alias("largest")).scalar()


def covered_keys(
    df: DataFrame, keys: Sequence[str], target: str, frac: float = 0.5
) -> DataFrame:
    """Keys with at least ``frac`` of the largest count of rows with a target."""
    counts = drop_missing(df, [*keys, target]).groupBy(*keys).agg(F.count("*").alias("_n"))
    limit = counts.agg((F.max("_n") * F.lit(frac)).alias("_limit")).scalar()
    return counts.where(F.col("_n") >= limit).select(*keys)


def coverage_filter(
    df: DataFrame, keys: Sequence[str], target: str, frac: float = 0.5
) -> DataFrame:
    """Rows of the keys that ``covered_keys`` keeps."""
    return df.join(covered_keys(df, keys, target, frac), list(keys), "left_semi")


def coverage_bins(
    counts: DataFrame,
    value: str = "qtd_exemplos_com_dengue",
    edges: Sequence[float] = QUARTERS,
    labels: Sequence[str] = QUARTER_LABELS,
    label: str = "faixa_qtd_exemplos",
) -> DataFrame:
    """Add the bin label; edges are shares of the largest value, the last is that plus 1."""
    top = largest(counts, value)
    cuts = [top * F.lit(float(e)) for e in edges] + [top + F.lit(1)]
    return counts.withColumn(label, bin_label(F.col(value), cuts, labels))


def bin_histogram(
    binned: DataFrame,
    label: str = "faixa_qtd_exemplos",
    labels: Sequence[str] = QUARTER_LABELS,
    name: str = "qtd_municipios",
) -> DataFrame:
    """Rows per bin in bin order, empty bins included."""
    found = binned.groupBy(label).agg(F.count("*").alias(name))
    listed = F.array(*[F.lit(v) for v in labels])
    bins = binned.sparkSession.range(1).select(F.posexplode(listed).alias("_at", label))
    return (
        bins.join(found, label, "left")
        .select("_at", label, F.coalesce(name, F.lit(0)).alias(name))
        .orderBy("_at")
        .drop("_at")
    )
