"""Metrics, cross-validation, training workflows and their reports."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, fields
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import with_date
from ..operators.schema import union_all
from ..sinks import new_run_id, run_folder, write_dataset, write_predictions, write_report
from .folds import add_medians, expanding_scores, sum_segments
from .forest import ForestModel, fit_forest, importance_table
from .linear import LinearModel, coefficient_table, fit_linear
from .preprocess import Preprocessor, fit_preprocessor
from .split import (
    Fold, chronological_split, row_folds, row_segments, row_split, time_segments,
)

# Fits whose jobs run at the same time.
MAX_SIDE_BY_SIDE = 4
METRICS = ("mae", "mse", "rmse", "r2")
METRIC_FIELDS = "mae: double, mse: double, rmse: double, r2: double"
REPORT_SCHEMA = (
    "metadata struct<backend: string, model_name: string, task_type: string, run_id: string, "
    "created_at: string, training_time_seconds: double>, "
    "methodology struct<split_strategy: string, validation_strategy: string, "
    "metrics: array<string>, params: map<string,string>>, "
    "data struct<train_rows: bigint, test_rows: bigint, feature_count: int, "
    "target_name: string, target_train_mean: double, target_test_mean: double, "
    "train_start_date: string, train_end_date: string, test_start_date: string, "
    "test_end_date: string, dropped_non_model_columns: array<string>>, "
    f"cross_validation struct<fold_metrics: array<struct<fold: int, {METRIC_FIELDS}>>, "
    f"mean_metrics: struct<{METRIC_FIELDS}>>, "
    f"test_metrics struct<{METRIC_FIELDS}>, "
    "coefficients array<struct<feature: string, coefficient: double, abs_coefficient: double>>, "
    "feature_importances array<struct<feature: string, importance: double>>, "
    "artifacts map<string,string>"
)


@dataclass(frozen=True)
class LinearParams:
    """Defaults of the linear workflow."""

    test_size: float = 0.2
    n_splits: int = 5
    fit_intercept: bool = True
    positive: bool = False
    scale_features: bool = True


@dataclass(frozen=True)
class ForestParams:
    """Defaults of the forest workflow."""

    test_size: float = 0.2
    n_splits: int = 5
    n_estimators: int = 100
    max_depth: int | None = None
    random_state: int = 42
    scale_features: bool = False


def resolve(kind: type, params: dict[str, Any] | Any | None):
    """Parameters of ``kind`` from a dict; unknown names are ignored."""
    if isinstance(params, kind):
        return params
    given = dict(params or {})
    known = {}
    for f in fields(kind):
        if f.name in given:
            default = f.default
            value = given[f.name]
            known[f.name] = value if default is None or value is None else type(default)(value)
    return kind(**known)


def regression_metrics(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = ()
) -> DataFrame:
    """``mae, mse, rmse, r2`` in one pass.

    For a constant target r2 is 1 when every prediction is exact and 0 otherwise.
    """
    a, error = F.col(actual), F.col(actual) - F.col(predicted)
    parts = df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(a).alias("_var"),
        (F.max(a) == F.min(a)).alias("_same"),
    )
    constant = F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("_same"), constant).otherwise(1.0 - F.col("mse") / F.col("_var"))
    return parts.select(*by, "mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


def prediction_table(
    df: DataFrame, target: str, predicted: str = "predicted", date_col: str | None = "data"
) -> DataFrame:
    """``[data,] actual, predicted, residual``."""
    dates = [date_col] if date_col and date_col in df.columns else []
    actual = F.col(target).cast("double")
    return df.select(
        *dates,
        actual.alias("actual"),
        F.col(predicted).alias("predicted"),
        (actual - F.col(predicted)).alias("residual"),
    )


Fitted = Callable[[DataFrame], DataFrame]


def cross_validate(
    df: DataFrame, folds: Sequence[Fold], fit: Callable[[DataFrame], Fitted], target: str
) -> DataFrame:
    """Metrics per fold: ``fit`` on the fold's training rows gives a predictor.

    The folds' jobs share the cluster side by side; all folds are scored in one job.
    """
    if not folds:
        return no_folds(df.sparkSession)

    def score(fold: Fold) -> DataFrame:
        predict = fit(df.where(fold.train))
        rows = prediction_table(predict(df.where(fold.valid)), target, date_col=None)
        return rows.withColumn("fold", F.lit(fold.number))

    with ThreadPoolExecutor(max_workers=min(MAX_SIDE_BY_SIDE, len(folds))) as pool:
        scored = list(pool.map(score, folds))
    return fold_metrics(union_all(scored))


@dataclass
class TrainResult:
    model: LinearModel | ForestModel
    preprocessor: Preprocessor
    report: dict[str, Any]
    predictions: DataFrame
    artifacts: dict[str, str] = field(default_factory=dict)


def linear_fit(features: Sequence[str], target: str, p: LinearParams):
    """A fit for ``cross_validate`` that also returns its parts for the final model."""

    def parts(train: DataFrame) -> tuple[LinearModel, Preprocessor]:
        prep = fit_preprocessor(train, features, scale=p.scale_features, also=[target])
        names = prep.feature_names
        # Scaled columns have mean zero, so no further pass looks for their means.
        centre = [*[0.0] * len(names), *prep.means] if p.scale_features else None
        ready = prep.transform(train, [target])
        model = fit_linear(ready, names, target, p.fit_intercept, p.positive, centre)
        return model, prep

    def predictor(model: LinearModel, prep: Preprocessor) -> Fitted:
        def predict(df: DataFrame) -> DataFrame:
            keep = [c for c in ("data", target) if c in df.columns]
            return prep.transform(df, keep).select(*keep, model.predict().alias("predicted"))

        return predict

    return parts, predictor


def forest_fit(features: Sequence[str], target: str, p: ForestParams):
    def parts(train: DataFrame) -> tuple[ForestModel, Preprocessor]:
        prep = fit_preprocessor(train, features, scale=p.scale_features, exclude=("ano",))
        ready = prep.transform(train, [target])
        model = fit_forest(
            ready, prep.feature_names, target, p.n_estimators, p.max_depth, p.random_state
        )
        return model, prep

    def predictor(model: ForestModel, prep: Preprocessor) -> Fitted:
        def predict(df: DataFrame) -> DataFrame:
            keep = [c for c in ("data", target) if c in df.columns]
            return model.predict(prep.transform(df, keep)).select(*keep, "predicted")

        return predict

    return parts, predictor


def _part_summary(df: DataFrame, target: str, dated: bool) -> dict[str, Any]:
    day = F.col("data").cast("date").cast("string") if dated else F.lit(None).cast("string")
    row = df.agg(F.count("*"), F.avg(target), F.min(day), F.max(day)).first()
    return dict(zip(("rows", "mean", "start", "end"), row))


def build_report(
    kind: str,
    params: LinearParams | ForestParams,
    train: DataFrame,
    test: DataFrame,
    target: str,
    feature_count: int,
    fold_metrics: DataFrame,
    test_metrics: DataFrame,
    training_time: float,
    ranking: DataFrame,
    by_date: bool,
) -> dict[str, Any]:
    """The run's document. It holds one entry per fold and feature, never rows."""
    dated = "data" in train.columns
    a, b = _part_summary(train, target, dated), _part_summary(test, target, dated)
    folds = [r.asDict() for r in fold_metrics.collect()]
    means = {m: sum(f[m] for f in folds) / len(folds) for m in METRICS} if folds else None
    ranked = [r.asDict() for r in ranking.collect()]
    linear = kind == "LinearRegression"
    suffix = " by date" if by_date else ""
    return {
        "metadata": {
            "backend": "spark",
            "model_name": kind,
            "task_type": "regression",
            "run_id": new_run_id(),
            "created_at": datetime.now(timezone.utc).isoformat(),
            "training_time_seconds": float(training_time),
        },
        "methodology": {
            "split_strategy": "chronological holdout" + suffix,
            "validation_strategy": "expanding time folds" + suffix + " on training data",
            "metrics": ["MAE", "MSE", "RMSE", "R2"],
            "params": {k: str(v) for k, v in asdict(params).items()},
        },
        "data": {
            "train_rows": a["rows"],
            "test_rows": b["rows"],
            "feature_count": feature_count,
            "target_name": target,
            "target_train_mean": a["mean"],
            "target_test_mean": b["mean"],
            "train_start_date": a["start"],
            "train_end_date": a["end"],
            "test_start_date": b["start"],
            "test_end_date": b["end"],
            "dropped_non_model_columns": ["data"] if dated else [],
        },
        "cross_validation": {"fold_metrics": folds, "mean_metrics": means},
        "test_metrics": test_metrics.first().asDict(),
        "coefficients": ranked if linear else None,
        "feature_importances": None if linear else ranked,
        "artifacts": {},
    }


def report_frame(spark: SparkSession, report: dict[str, Any]) -> DataFrame:
    """The document as one nested row."""
    return spark.createDataFrame([report], REPORT_SCHEMA)


def _parts(df: DataFrame, test_size: float, order_by: Sequence[str]):
    """Training and test rows, and whether dates part them."""
    dated = with_date(df)
    if "data" in dated.columns:
        return *chronological_split(dated, "data", test_size), True
    if not order_by:
        raise ValueError("Rows without a date need order_by.")
    return *row_split(dated, order_by, test_size), False


def no_folds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"fold int, {METRIC_FIELDS.replace(':', '')}")


def fold_metrics(scored: DataFrame) -> DataFrame:
    return regression_metrics(scored, by=["fold"]).orderBy("fold")


def train_linear(
    df: DataFrame,
    target: str = "casos_dengue",
    params: dict[str, Any] | LinearParams | None = None,
    order_by: Sequence[str] = (),
) -> TrainResult:
    """Split by date, cross-validate by date, fit, predict the test part, report.

    The folds and the final fit share their passes over the training rows (``folds``).
    """
    p = resolve(LinearParams, params)
    train, test, by_date = _parts(df, p.test_size, order_by)
    features = [c for c in train.columns if c not in (target, "data")]
    how = {"intercept": p.fit_intercept, "positive": p.positive, "scale": p.scale_features}
    _, predictor = linear_fit(features, target, p)
    train = train.persist()
    try:
        placed, segment, k = train, F.lit(0), 0
        if p.n_splits >= 2 and by_date:
            segment, k = time_segments(train, "data", p.n_splits)
        elif p.n_splits >= 2:
            placed, segment, k = row_segments(train, order_by, p.n_splits)
        if k:
            cv, fits = expanding_scores(placed, features, target, segment, k, fold_metrics, **how)
        else:
            cv, fits = no_folds(df.sparkSession), sum_segments(placed, features, target, segment)
        started = time.perf_counter()
        add_medians(fits, placed, segment, [k + 1], fits.numbers)
        model, prep = fits.fit(range(k + 1), **how)
        seconds = time.perf_counter() - started
        predictions = prediction_table(predictor(model, prep)(test), target, date_col="data")
        report = build_report(
            "LinearRegression", p, train, test, target, len(features), cv,
            regression_metrics(predictions), seconds, coefficient_table(model, train), by_date and k > 0,
        )
    finally:
        train.unpersist()
    return TrainResult(model, prep, report, predictions)


def train_forest(
    df: DataFrame,
    target: str = "casos_dengue",
    params: dict[str, Any] | ForestParams | None = None,
    order_by: Sequence[str] = (),
) -> TrainResult:
    """As ``train_linear`` with a forest, folds by row, and the year left out. Rows of one date
    stand in the order of their other columns, so a row's fold does not vary."""
    p = resolve(ForestParams, params)
    train, test, by_date = _parts(df, p.test_size, order_by)
    features = [c for c in train.columns if c not in (target, "data")]
    parts, predictor = forest_fit(features, target, p)
    # The training rows feed every fold's fit and score.
    train = train.persist()
    try:
        folds, framed = [], train
        if p.n_splits >= 2:
            order = ["data", *[c for c in train.columns if c != "data"]] if by_date else order_by
            framed, folds = row_folds(train, order, p.n_splits)
        cv = cross_validate(framed, folds, lambda t: predictor(*parts(t)), target)
        started = time.perf_counter()
        model, prep = parts(train)
        seconds = time.perf_counter() - started
        predictions = prediction_table(predictor(model, prep)(test), target, date_col=None)
        report = build_report(
            "RandomForestRegressor", p, train, test, target, len(features), cv,
            regression_metrics(predictions), seconds, importance_table(model, train), False,
        )
    finally:
        train.unpersist()
    return TrainResult(model, prep, report, predictions)


def save_run(result: TrainResult, base: str, kind: str | None = None) -> dict[str, str]:
    """Write model, preparation, predictions and report; returns their paths."""
    spark = result.predictions.sparkSession
    linear = isinstance(result.model, LinearModel)
    kind = kind or ("linear_regression" if linear else "random_forest")
    folder = run_folder(base, kind, result.report["metadata"]["run_id"])
    paths = {
        "output_dir": folder,
        "model_path": f"{folder}/{kind}.model",
        "preparation_path": f"{folder}/{kind}.preparation",
        "report_path": f"{folder}/report.json",
        "predictions_path": f"{folder}/predictions.csv",
    }
    if linear:
        write_dataset(result.model.table(result.predictions), paths["model_path"])
    else:
        result.model.forest.write().overwrite().save(paths["model_path"])
    write_dataset(preparation_table(spark, result.preprocessor), paths["preparation_path"])
    write_predictions(result.predictions, paths["predictions_path"])
    result.artifacts = result.report["artifacts"] = paths
    write_report(report_frame(spark, result.report), paths["report_path"])
    return paths


def preparation_table(spark: SparkSession, prep: Preprocessor) -> DataFrame:
    """The fitted preparation, one row per source column."""
    rows = [(i, s.col, s.median, s.mean, s.scale, None, None) for i, s in enumerate(prep.numeric)]
    rows += [
        (len(rows) + i, s.col, None, None, None, s.mode, list(s.categories))
        for i, s in enumerate(prep.categorical)
    ]
    schema = (
        "at int, col string, median double, mean double, scale double, "
        "mode string, categories array<string>"
    )
    return spark.createDataFrame(rows, schema)
