"""Comparing stored runs: one row per run on a common score scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encode import NEGATED_SCORES, comparable_rmse, seconds_to_minutes
from ..functions.missing import drop_missing, finite
from ..functions.text import first_number, parse_best_text

KEY = ["framework", "run_id"]


def best_negated(history: DataFrame) -> DataFrame:
    """Largest stored (negated) score of each run, the column it stands in (the first of the
    known ones that the run has) and the number of models. ``history`` has text columns or
    VARIANT records."""
    if "record" in history.columns:
        cells = {
            name: F.try_variant_get("record", f"$.{name}", "string") for name in NEGATED_SCORES
        }
    else:
        cells = {name: F.col(name).cast("string") for name in NEGATED_SCORES if name in history.columns}
    per_run = history.groupBy(*KEY).agg(
        F.count("*").alias("total_modelos_testados"),
        *[F.max(finite(c.try_cast("double"))).alias(f"_best_{name}") for name, c in cells.items()],
        *[F.max(c.isNotNull()).alias(f"_has_{name}") for name, c in cells.items()],
    )
    column, best = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name in reversed(cells):
        here = F.col(f"_has_{name}")
        column = F.when(here, F.lit(name)).otherwise(column)
        best = F.when(here, F.col(f"_best_{name}")).otherwise(best)
    return per_run.select(*KEY, "total_modelos_testados", column.alias("_column"), best.alias("_best"))


def _filled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def compare_runs(runs: DataFrame, history: DataFrame) -> DataFrame:
    """One row per run, best comparable RMSE first, runs without one last.

    The metric falls back on the run's setting and, for evolutionary runs, on the score column
    of the history; the folder falls back on where the run was found. The time may be text.
    """
    joined = runs.join(best_negated(history), KEY, "left")
    meta, best = F.col("metadata"), F.col("best_model")
    score = best["score"]
    told = F.when(F.col("framework") == "tpot", F.col("_column"))
    metric = F.coalesce(_filled(score["metric"]), _filled(meta["optimization_metric"]), told)
    value = first_number(score["value"])
    seconds = first_number(meta["training_time_seconds"])
    place = F.col("run_dir") if "run_dir" in runs.columns else F.lit(None).cast("string")
    rmse = comparable_rmse(F.col("framework"), metric, value, F.col("_best"))
    return joined.select(
        "framework",
        "run_id",
        meta["preset"].alias("preset"),
        meta["optimization_metric"].alias("optimization_metric"),
        seconds.alias("training_time_seconds"),
        seconds_to_minutes(seconds).alias("training_time_minutes"),
        metric.alias("raw_score_metric"),
        value.alias("raw_score_value"),
        F.when(rmse.isNotNull(), F.lit("RMSE")).alias("comparable_metric"),
        rmse.alias("comparable_score"),
        best["model_name"].alias("best_model_name"),
        best["model_family"].alias("best_model_family"),
        F.coalesce(_filled(meta["output_dir"]), place).alias("output_dir"),
    ).orderBy(F.asc_nulls_last("comparable_score"), *KEY)


def search_summary(runs: DataFrame, history: DataFrame) -> DataFrame:
    """Per run: preset, metric, minutes, models tested, best model and its score."""
    joined = runs.join(best_negated(history), KEY, "left")
    meta, best = F.col("metadata"), F.col("best_model")
    return joined.select(
        *KEY,
        meta["preset"].alias("preset"),
        meta["optimization_metric"].alias("metrica"),
        seconds_to_minutes(first_number(meta["training_time_seconds"])).alias("tempo_total_min"),
        F.coalesce("total_modelos_testados", F.lit(0)).alias("total_modelos_testados"),
        best["model_name"].alias("melhor_modelo"),
        best["model_family"].alias("familia_melhor_modelo"),
        first_number(best["score"]["value"]).alias("score"),
    )


def evolution_summary(runs: DataFrame) -> DataFrame:
    """Per evolutionary run whose best individual was printed: where and how it was found."""
    meta, best = F.col("metadata"), F.col("best_model")
    told = runs.where(F.col("framework") == "tpot").withColumn("_printed", best["score"]["value"])
    return parse_best_text(told, "_printed").select(
        "run_id",
        meta["preset"].alias("preset"),
        meta["optimization_metric"].alias("metrica"),
        seconds_to_minutes(first_number(meta["training_time_seconds"])).alias("tempo_total_min"),
        F.col("indice").alias("melhor_indice"),
        F.col("Generation").alias("geracao_do_melhor"),
        F.col("RMSE").alias("melhor_RMSE"),
        F.col("root_mean_squared_error").alias("score_original_negativo"),
        F.col("Parents").alias("parents"),
        F.col("Variation_Function").alias("operador"),
        best["model_family"].alias("familia_final"),
    )


def chart_inputs(
    comparison: DataFrame, need: tuple[str, ...] = ("training_time_minutes", "comparable_score")
) -> DataFrame:
    """Rows that have every value a chart needs."""
    return drop_missing(comparison, need).select("framework", "run_id", *need)
