"""Writing datasets, predictions, reports and search results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.missing import finite
from .functions.names import slug_text


def new_run_id(now: datetime | None = None) -> str:
    """UTC time as ``yyyymmddThhmmssZ``."""
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def run_folder(base: str, kind: str, run_id: str | None = None) -> str:
    """``<base>/results/<kind>/<run_id>``; the kind is made folder-safe part by part."""
    safe = "/".join(slug_text(part) for part in kind.split("/"))
    return f"{base}/results/{safe}/{run_id or new_run_id()}"


def write_dataset(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> str:
    """Overwrite a dataset; CSV gets a header."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> str:
    cols = [c for c in ("data", "actual", "predicted", "residual") if c in df.columns]
    return write_dataset(df.select(*cols), path, fmt)


def write_report(report: DataFrame, path: str) -> str:
    """One nested document as JSON; text stays as it is, nulls are kept."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_safe(df: DataFrame) -> DataFrame:
    """Columns that JSON can hold: NaN and infinities null, times and dates as text."""
    out = {}
    for field in df.schema:
        kind = field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            out[field.name] = finite(F.col(field.name))
        elif isinstance(
            kind, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DayTimeIntervalType)
        ):
            out[field.name] = F.col(field.name).cast("string")
        elif isinstance(kind, T.BinaryType):
            out[field.name] = F.base64(field.name)
    return df.withColumns(out) if out else df


def json_records(df: DataFrame, name: str = "record") -> DataFrame:
    """One JSON text per row."""
    safe = json_safe(df)
    return safe.select(F.to_json(F.struct(*safe.columns), {"ignoreNullFields": "false"}).alias(name))


def save_search(
    history: DataFrame, best_model: DataFrame, metadata: DataFrame, folder: str
) -> dict[str, str]:
    """The five files of a search: report, history (JSON and CSV), best model, metadata."""
    paths = {
        "output_dir": folder,
        "report_json": f"{folder}/report.json",
        "search_history_json": f"{folder}/search_history.json",
        "search_history_csv": f"{folder}/search_history.csv",
        "best_model_json": f"{folder}/best_model.json",
        "metadata_json": f"{folder}/metadata.json",
    }
    safe = json_safe(history)
    # A search has at most its budget of models, so its history is a short list.
    models = safe.agg(F.collect_list(F.struct(*safe.columns)).alias("search_history"))
    best, about = json_safe(best_model), json_safe(metadata)
    report = about.select(
        models.scalar().alias("search_history"),
        best.select(F.struct("*").alias("best_model")).scalar().alias("best_model"),
        F.struct("*").alias("metadata"),
    )
    write_report(report, paths["report_json"])
    listed = models.select(F.to_json("search_history", {"ignoreNullFields": "false"}))
    listed.write.mode("overwrite").text(paths["search_history_json"])
    write_dataset(safe, paths["search_history_csv"], "csv")
    write_report(best, paths["best_model_json"])
    write_report(about, paths["metadata_json"])
    return paths
