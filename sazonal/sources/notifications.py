"""Yearly notification files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import unique_names
from ..operators.schema import CASE_NAMES, rename_present, union_all
from .files import require_files

# File years and the years whose files use a comma.
YEARS = tuple(range(2013, 2022))
COMMA_YEARS = (2015, 2019)
FILE_NAME = "casos-de-dengue-{year}.csv"


def read_notifications(
    spark: SparkSession,
    folder: str,
    years: Iterable[int] = YEARS,
    comma_years: Iterable[int] = COMMA_YEARS,
    file_name: str = FILE_NAME,
) -> DataFrame:
    """``id, data`` as text with the file year and the place of each row in its file.

    Each year's file has its own header and separator, so there is one scan per year;
    all are checked to be there before the first is read. Quoted cells may hold line breaks,
    separators and doubled quotes, so the parser has to see a file from its start: a year's
    file is one task, which streams through it. A year of cases bounds its length; what
    Spark wrote as a folder is a task per part.
    """
    paths = {y: f"{folder}/{file_name.format(year=y)}" for y in years}
    require_files(spark, paths.values(), "notifications")
    commas = set(comma_years)
    frames = []
    for year, path in paths.items():
        sep = "," if year in commas else ";"
        table = spark.read.csv(path, header=True, sep=sep, multiLine=True, escape='"')
        placed = table.select(
            "*",
            F.col("_metadata.file_path").alias("_arquivo"),
            F.col("_metadata.file_block_start").alias("_bloco"),
        ).withColumn("_linha", F.monotonically_increasing_id())
        place = ["_arquivo", "_bloco", "_linha"]
        plain = placed.toDF(*unique_names(table.columns), *place)
        named = rename_present(plain, CASE_NAMES).select("id", "data", *place)
        frames.append(named.withColumn("ano_arquivo", F.lit(year)))
    return union_all(frames)
