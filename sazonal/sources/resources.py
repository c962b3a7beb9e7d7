"""Choosing download addresses out of a package listing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACKAGE_SCHEMA = "result struct<resources: array<struct<name: string, url: string>>>"


def listed_resources(packages: DataFrame) -> DataFrame:
    """``at, name, url`` of each resource in listing order."""
    return packages.select(F.posexplode("result.resources").alias("at", "r")).select(
        "at", "r.name", "r.url"
    )


def select_resources(
    resources: DataFrame,
    years: Iterable[int],
    word: str = "Dengue",
    suffix: str = ".csv",
    strict: bool = True,
) -> DataFrame:
    """``ano, url``: per year the last listed resource whose name contains it.

    Fails when a year has none, unless ``strict`` is off.
    """
    years = sorted(years)
    named = resources.where(
        F.col("name").contains(word) & F.lower("url").endswith(suffix)
    )
    wanted = F.filter(
        F.array(*[F.lit(str(y)) for y in years]), lambda y: F.contains(F.col("name"), y)
    )
    chosen = (
        named.select("at", "url", F.explode(wanted).alias("ano"))
        .groupBy(F.col("ano").cast("int").alias("ano"))
        .agg(F.max_by("url", "at").alias("url"))
    )
    if strict:
        absent = sorted(set(years) - {r.ano for r in chosen.select("ano").collect()})
        if absent:
            raise RuntimeError(f"No resource found for years: {absent}")
    return chosen
