"""Hourly station files and the yearly archives they come in."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import text_columns
from ..functions.text import decimal_comma
from .headed import headers, read_headed

# First cell of a station file's header row, and the files' encoding.
HEADER_CELLS = ("data", "data_yyyy_mm_dd")
ENCODING = "ISO-8859-1"


def read_stations(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All station files as text columns; the file year is the last year in the name."""
    table = read_headed(spark, paths, ";", ENCODING, HEADER_CELLS)
    years = F.regexp_extract_all("arquivo", F.lit(r"((?:19|20)\d\d)"), F.lit(1))
    return table.withColumn("ano_arquivo", F.element_at(years, -1).cast("int"))


def sensors_as_numbers(table: DataFrame) -> DataFrame:
    """Decimal-comma text of every sensor to double."""
    keep = ("caminho", "arquivo", "data", "data_yyyy_mm_dd", "hora", "hora_utc")
    sensors = text_columns(table, exclude=keep)
    return table.withColumns({c: decimal_comma(F.col(c)) for c in sensors})


def station_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per station file with its header names."""
    return headers(spark, paths, ";", ENCODING, HEADER_CELLS)


def archive_members(spark: SparkSession, paths: str | Sequence[str], pattern: str) -> DataFrame:
    """``archive, member, content`` of the matching members, first per archive.

    Archives are spread over tasks by their size; a task opens one at a time.
    ``pattern`` is a regular expression on the member's file name.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    names = pd.Series(archive.namelist(), dtype="object")
                    hit = names[names.str.split("/").str[-1].str.contains(pattern)].head(1)
                    yield pd.DataFrame(
                        {
                            "archive": path,
                            "member": hit,
                            "content": [archive.read(n) for n in hit],
                        }
                    )

    return files.mapInPandas(members, "archive string, member string, content binary")


def require_members(spark: SparkSession, archives: DataFrame, members: DataFrame) -> None:
    """Fail, naming every archive without a matching member."""
    lost = archives.select("archive").join(members.select("archive"), "archive", "left_anti")
    names = sorted(r[0] for r in lost.collect())
    if names:
        raise RuntimeError(f"No matching station file in: {names}")
