"""Finding, checking and loading stored datasets."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.schema import CONCRETE_NAMES


def _path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def length(spark: SparkSession, path: str) -> int:
    """Bytes of a file, given as an encoded address."""
    address = spark.sparkContext._jvm.java.net.URI(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(address)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(target).getLen()


def content_length(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder, markers and checksums left out."""
    target, fs = _path(spark, path)
    if not fs.getFileStatus(target).isDirectory():
        return fs.getFileStatus(target).getLen()
    parts = fs.listStatus(target)
    return sum(s.getLen() for s in parts if s.getPath().getName()[0] not in "._")


def matches(spark: SparkSession, glob: str) -> list[str]:
    """Paths that a glob finds, sorted."""
    target, fs = _path(spark, glob)
    return sorted(s.getPath().toString() for s in fs.globStatus(target) or [])


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none when it is absent."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def require_files(spark: SparkSession, paths: Iterable[str], label: str) -> None:
    """Fail before any job, naming every absent file."""
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"Files of {label} that are not there: {', '.join(missing)}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, or CSV with a header when the name ends in ``.csv``."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a dataset is there in whole: a file, or a folder that its job has marked."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return False
    return not fs.getFileStatus(target).isDirectory() or exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the stored dataset, or build and store it first.

    It is written aside and renamed when it is whole, so a job that ends halfway leaves nothing
    that looks built; a folder without its mark is built anew. If another job has stored the
    dataset meanwhile, its copy stays.
    """
    if is_complete(spark, path):
        return read_table(spark, path)
    plain = path.rstrip("/")
    aside = f"{plain}.{uuid.uuid4().hex}.tmp"
    out = build()
    if plain.endswith(".csv"):
        out.write.csv(aside, header=True)
    else:
        out.write.parquet(aside)
    target, fs = _path(spark, plain)
    if fs.exists(target) and not is_complete(spark, plain):
        fs.delete(target, True)
    # Renaming onto a folder would move the copy into it.
    if fs.exists(target) or not fs.rename(_path(spark, aside)[0], target):
        fs.delete(_path(spark, aside)[0], True)
        if not is_complete(spark, plain):
            raise OSError(f"Could not store {plain}")
    return read_table(spark, path)


def load_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Read the first of several places that exists."""
    for path in paths:
        if exists(spark, path):
            return read_table(spark, path)
    raise FileNotFoundError("Could not find a dataset in " + " or ".join(paths))


def read_columns(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], sep: str = ","
) -> DataFrame:
    """Only the named columns of CSV files; the scan is pruned to them."""
    return spark.read.csv(paths, header=True, sep=sep).select(*columns)


def load_positional(
    df: DataFrame, names: Sequence[str] = CONCRETE_NAMES, target: str = "strength"
) -> tuple[DataFrame, list[str]]:
    """Rename columns by position; returns the frame and its feature columns."""
    if len(df.columns) != len(names):
        raise ValueError(f"Expected {len(names)} columns, found {len(df.columns)}")
    return df.toDF(*names), [n for n in names if n != target]


def supervised(df: DataFrame, target: str) -> tuple[DataFrame, list[str]]:
    """A stored dataset as one frame with its feature columns."""
    return df, [c for c in df.columns if c != target]
