"""Stored model-search runs: ``<base>/<framework>/<run_id>/*.json``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import HISTORY_LINE, parse_history_text
from ..operators.schema import union_all
from .files import child_folders, content_length, exists, matches
from .headed import decoded, read_headed

# Framework folders.
FRAMEWORKS = ("h2o", "tpot")

METADATA = (
    "backend string, task_type string, run_id string, preset string, "
    "optimization_metric string, resolved_params map<string,string>, "
    "training_time_seconds string, output_dir string, created_at string"
)
BEST_MODEL = (
    "model_name string, model_family string, "
    "hyperparameters struct<steps: array<array<string>>>, "
    "score struct<metric: string, value: string, source: string>, artifact_path string"
)
RECORDS = "framework string, run_id string, posicao bigint, record variant"
KEY = ["framework", "run_id"]


def list_runs(spark: SparkSession, base: str, framework: str) -> DataFrame:
    """Run ids of a framework, newest first; an absent folder gives no rows."""
    ids = [(framework, name) for name in child_folders(spark, f"{base}/{framework}")]
    return spark.createDataFrame(ids, "framework string, run_id string").orderBy(F.desc("run_id"))


def _texts(spark: SparkSession, base: str, name: str) -> DataFrame:
    """(framework, run_id, value): the whole text of that document of each run that has it."""
    glob = f"{base}/*/*/{name}.json"
    if not matches(spark, glob):
        return spark.createDataFrame([], "framework string, run_id string, value string")
    text = spark.read.text(glob, wholetext=True)
    return text.select(*_run_key(F.col("_metadata.file_path")), "value")


def _document(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    """One struct per run; absent or unreadable files give no struct."""
    return _texts(spark, base, name).select(*KEY, F.from_json("value", schema).alias(name))


def load_runs(
    spark: SparkSession, base: str, frameworks: Sequence[str] = FRAMEWORKS
) -> DataFrame:
    """``framework, run_id, run_dir, metadata, best_model, report`` of every run folder.

    The report is a document of any shape and stays a VARIANT. A document that is absent or
    unreadable is null.
    """
    listed = union_all(list_runs(spark, base, f) for f in frameworks).withColumn(
        "run_dir", F.concat_ws("/", F.lit(base), "framework", "run_id")
    )
    metadata = _document(spark, base, "metadata", METADATA)
    best = _document(spark, base, "best_model", BEST_MODEL)
    report = _texts(spark, base, "report").select(*KEY, F.try_parse_json("value").alias("report"))
    return listed.join(metadata, KEY, "left").join(best, KEY, "left").join(report, KEY, "left")


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest run of each framework."""
    others = [c for c in runs.columns if c not in KEY]
    newest = runs.groupBy("framework").agg(
        F.max_by(F.struct("run_id", *others), "run_id").alias("_run")
    )
    return newest.select("framework", "_run.*")


def _run_key(path: Column) -> list[Column]:
    """Framework and run id out of a file's path; a document may be a file or a folder."""
    pattern = r"([^/]+)/([^/]+)/(?:metadata|best_model|report|search_history)\.(?:json|csv)"
    path = decoded(path)
    return [
        F.regexp_extract(path, pattern, 1).alias("framework"),
        F.regexp_extract(path, pattern, 2).alias("run_id"),
    ]


def _sources(spark: SparkSession, base: str, frameworks: Sequence[str]) -> tuple[list[str], list[str]]:
    """The CSV and the JSON histories to read: CSV first, JSON where the CSV is not there or empty."""
    folders = [f"{base}/{f}/{r}" for f in frameworks for r in child_folders(spark, f"{base}/{f}")]
    csv, json = [], []
    for folder in folders:
        table, document = f"{folder}/search_history.csv", f"{folder}/search_history.json"
        if exists(spark, table) and content_length(spark, table):
            csv.append(table)
        elif exists(spark, document):
            json.append(document)
    return csv, json


def _csv_tables(spark: SparkSession, csv: list[str]) -> DataFrame:
    table = read_headed(spark, csv, ",", quoted=True)
    skip = {"caminho", "arquivo", "_bloco", "_linha", "colunas"}
    return table.select(*_run_key(F.col("caminho")), *[c for c in table.columns if c not in skip])


def load_search_history(
    spark: SparkSession, base: str, frameworks: Sequence[str] = FRAMEWORKS
) -> DataFrame:
    """Search histories of all runs as text columns, by the first format a run has.

    CSV first, then JSON in any form that ``history_records`` reads. Runs with none give no
    rows. The columns are the names that occur, so this looks at all records once;
    ``history_records`` does without.
    """
    csv, json = _sources(spark, base, frameworks)
    frames = [_csv_tables(spark, csv)] if csv else []
    if json:
        documents = spark.read.text(json, wholetext=True)
        read = documents.select(*_run_key(F.col("_metadata.file_path")), F.try_parse_json("value").alias("doc"))
        cells = _records(read).withColumn("_record", F.col("record").cast("map<string,string>"))
        names = cells.select(F.explode(F.map_keys("_record")).alias("name")).distinct()
        found = [r.name for r in names.orderBy("name").collect()]
        frames.append(cells.select(*KEY, *[F.col("_record")[n].alias(n) for n in found]))
    if not frames:
        return spark.createDataFrame([], "framework string, run_id string")
    return union_all(frames)


def history_records(
    spark: SparkSession, base: str, frameworks: Sequence[str] = FRAMEWORKS, reports: bool = True
) -> DataFrame:
    """``framework, run_id, posicao, record``: one VARIANT object per model that a run tried.

    A run's history is taken from the first of these that gives records: ``search_history``
    in its report (unless ``reports`` is off), its CSV, its JSON. The JSON may be a list of
    records, an object of columns (each a list, or an object by row label), an object that
    holds either or printed text as ``search_history``, or printed text. No list of columns is
    needed: fields are read with ``try_variant_get``. Anything else gives no rows.
    """
    csv, json = _sources(spark, base, frameworks)
    frames = []
    if csv:
        table = _csv_tables(spark, csv)
        fields = [c for c in table.columns if c not in KEY]
        frames.append(table.select(
            *KEY, F.monotonically_increasing_id().alias("posicao"),
            F.to_variant_object(F.struct(*fields)).alias("record"),
        ))
    if json:
        documents = spark.read.text(json, wholetext=True)
        frames.append(_records(documents.select(
            *_run_key(F.col("_metadata.file_path")), F.try_parse_json("value").alias("doc")
        )))
    stored = union_all(frames) if frames else spark.createDataFrame([], RECORDS)
    if not reports:
        return stored
    told = _texts(spark, base, "report").where(F.col("framework").isin(list(frameworks))).select(
        *KEY, F.try_variant_get(F.try_parse_json("value"), "$.search_history", "variant").alias("doc")
    )
    reported = _records(told.where("doc is not null"))
    return reported.unionByName(stored.join(reported.select(*KEY).distinct(), KEY, "left_anti"))


def _kind(doc: Column) -> Column:
    return F.schema_of_variant(doc)


def _records(documents: DataFrame) -> DataFrame:
    """Records of (framework, run_id, doc), whatever form the documents have."""
    inner = F.try_variant_get("doc", "$.search_history", "variant")
    body = documents.select(*KEY, F.coalesce(inner, F.col("doc")).alias("doc"))
    listed = body.where(_kind(F.col("doc")).startswith("ARRAY")).select(
        *KEY, F.posexplode(F.col("doc").cast("array<variant>")).alias("posicao", "record")
    ).where(_kind(F.col("record")).startswith("OBJECT"))

    # An object of columns: cells meet again by their row label.
    columns = body.where(_kind(F.col("doc")).startswith("OBJECT")).select(
        *KEY, F.explode(F.col("doc").cast("map<string,variant>")).alias("name", "cells")
    )
    kind = _kind(F.col("cells"))
    ordered = columns.where(kind.startswith("ARRAY")).select(
        *KEY, "name", F.posexplode(F.col("cells").cast("array<variant>")).alias("at", "cell")
    ).withColumn("label", F.col("at").cast("string"))
    labelled = columns.where(kind.startswith("OBJECT")).select(
        *KEY, "name", F.explode(F.col("cells").cast("map<string,variant>")).alias("label", "cell")
    ).withColumn("at", F.col("label").try_cast("int"))
    turned = ordered.unionByName(labelled).groupBy(*KEY, "label").agg(
        F.min("at").cast("bigint").alias("posicao"),
        F.to_variant_object(F.map_from_entries(F.collect_list(F.struct("name", "cell")))).alias("record"),
    ).drop("label")

    text = F.try_variant_get("doc", "$", "string")
    printed = body.where(_kind(F.col("doc")) == "STRING").select(*KEY, text.alias("_text"))
    lines = parse_history_text(printed.where(F.col("_text").rlike("(?m)" + HISTORY_LINE)), "_text")
    fields = [c for c in lines.columns if c not in (*KEY, "_text")]
    read = lines.select(
        *KEY, F.col("indice").alias("posicao"), F.to_variant_object(F.struct(*fields)).alias("record")
    )
    place = F.col("posicao").cast("bigint").alias("posicao")
    return listed.select(*KEY, place, "record").unionByName(turned).unionByName(read.select(*KEY, place, "record"))
