"""Budgeted search over regression models, ranked by time-ordered cross-validation."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import Model
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import with_date
from ..operators.schema import union_all
from ..sinks import new_run_id, save_search
from .evaluate import MAX_SIDE_BY_SIDE, METRICS, prediction_table, regression_metrics
from .forest import assemble
from .preprocess import Preprocessor, fit_preprocessor
from .split import Fold, row_folds, time_folds

# The budgets of both search styles.
LEADERBOARD_PRESETS = {
    "low": {
        "max_runtime_secs": 600, "max_models": 25, "max_runtime_secs_per_model": 60, "nfolds": 3,
        "stopping_metric": "RMSE", "sort_metric": "RMSE", "stopping_rounds": 10, "stopping_tolerance": 0.01, "seed": 42,
    },
    "medium": {
        "max_runtime_secs": 3600, "max_models": 35, "max_runtime_secs_per_model": 120, "nfolds": 5,
        "stopping_metric": "RMSE", "sort_metric": "RMSE", "stopping_rounds": 10, "stopping_tolerance": 0.001, "seed": 42,
    },
    "high": {
        "max_runtime_secs": 6000, "max_models": 50, "max_runtime_secs_per_model": 2000, "nfolds": 5,
        "stopping_metric": "RMSE", "sort_metric": "RMSE", "stopping_rounds": 15, "stopping_tolerance": 0.0001, "seed": 42,
    },
}
EVOLUTION_PRESETS = {
    "low": {"generations": 8, "population_size": 17, "early_stop": 4, "cv": 3},
    "medium": {"generations": 10, "population_size": 20, "early_stop": 6, "cv": 3},
    "high": {"generations": 12, "population_size": 36, "early_stop": 8, "cv": 5},
}
HISTORY_SCHEMA = (
    "model_id string, algo string, rmse double, mse double, mae double, r2 double, "
    "training_time_ms double, predict_time_per_row_ms double, params map<string,string>"
)


def resolve_preset(
    params: dict[str, Any] | None, presets: dict[str, dict] | None = None
) -> dict[str, Any]:
    """Budget of the named preset, with nulls removed; the given dict is not changed."""
    given = dict(params or {})
    presets = given.pop("presets", None) or presets or LEADERBOARD_PRESETS
    preset = given.pop("preset", None)
    if preset not in presets:
        raise ValueError(f"Unknown preset: {preset}")
    given.pop("task_type", None)
    metric = str(given.pop("optimization_metric", "RMSE"))
    merged = {**given, **presets[preset]}
    return {
        "preset": preset,
        "optimization_metric": metric,
        **{k: v for k, v in merged.items() if v is not None},
    }


@dataclass(frozen=True)
class Budget:
    max_models: int
    folds: int
    seconds: float
    patience: int
    tolerance: float
    seed: int
    model_seconds: float = float("inf")

    @classmethod
    def of(cls, resolved: dict[str, Any]) -> Budget:
        """Either style of preset as one budget."""
        generations = resolved.get("generations", 1)
        size = resolved.get("population_size", 20)
        early = resolved.get("early_stop")
        return cls(
            max_models=resolved.get("max_models", generations * size),
            folds=resolved.get("nfolds", resolved.get("cv", 5)),
            seconds=resolved.get("max_runtime_secs", float("inf")),
            patience=resolved.get("stopping_rounds", early * size if early else 0),
            tolerance=resolved.get("stopping_tolerance", 0.0),
            seed=resolved.get("seed", resolved.get("random_state", 42)),
            model_seconds=resolved.get("max_runtime_secs_per_model") or float("inf"),
        )


@dataclass(frozen=True)
class Candidate:
    model_id: str
    algo: str
    params: dict[str, Any]

    def estimator(self, label: str, seed: int):
        kind = FAMILIES[self.algo][0]
        extra = {"seed": seed} if self.algo in ("DT", "DRF", "GBM") else {}
        return kind(featuresCol="_features", labelCol=label, **self.params, **extra)


Draw = Callable[[random.Random], Any]


def _real(low: float, high: float) -> Draw:
    return lambda draw: float(f"{draw.uniform(low, high):.6g}")


def _scale(low: float, high: float) -> Draw:
    """Alike on every order of magnitude."""
    return lambda draw: float(f"{low * (high / low) ** draw.random():.6g}")


def _whole(low: int, high: int) -> Draw:
    return lambda draw: draw.randint(low, high)


def _one(*values: Any) -> Draw:
    return lambda draw: draw.choice(values)


# Model families and what their parameters are drawn from.
FAMILIES: dict[str, tuple[type, dict[str, Draw]]] = {
    "LR": (LinearRegression, {"regParam": _scale(1e-4, 10.0), "elasticNetParam": _real(0.0, 1.0)}),
    "GLM": (GeneralizedLinearRegression, {"regParam": _scale(1e-4, 10.0), "family": _one("gaussian")}),
    "DT": (
        DecisionTreeRegressor,
        {"maxDepth": _whole(3, 12), "minInstancesPerNode": _whole(1, 20), "minInfoGain": _scale(1e-6, 1e-2)},
    ),
    "DRF": (
        RandomForestRegressor,
        {
            "numTrees": _whole(20, 100), "maxDepth": _whole(5, 12), "subsamplingRate": _real(0.5, 1.0),
            "featureSubsetStrategy": _one("all", "onethird", "sqrt"),
        },
    ),
    "GBM": (
        GBTRegressor,
        {"maxIter": _whole(20, 100), "maxDepth": _whole(3, 5), "stepSize": _scale(0.02, 0.3)},
    ),
}
#: Draws in a row that repeat a setting before a family counts as used up.
REPEATS = 1000


def candidates(n: int, seed: int = 42, families: Sequence[str] | None = None) -> list[Candidate]:
    """``n`` distinct settings: families in turn, settings drawn from their ranges by the seed.

    Fewer only where no family has a setting left.
    """
    left = list(families or FAMILIES)
    draws = {algo: random.Random(f"{seed} {algo}") for algo in left}
    seen: set[tuple] = set()
    out: list[Candidate] = []
    while len(out) < n and left:
        for algo in list(left):
            if len(out) == n:
                break
            for _ in range(REPEATS):
                setting = {name: draw(draws[algo]) for name, draw in FAMILIES[algo][1].items()}
                key = (algo, *setting.items())
                if key not in seen:
                    seen.add(key)
                    out.append(Candidate(f"{algo}_{len(out) + 1}", algo, setting))
                    break
            else:
                left.remove(algo)
    return out


@dataclass
class SearchResult:
    model: Model
    preprocessor: Preprocessor
    leader: Candidate
    history: DataFrame
    best_model: dict[str, Any]
    metadata: dict[str, Any]
    outer: DataFrame | None = None

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        ready = assemble(self.preprocessor.transform(df, keep), self.preprocessor.feature_names)
        scored = self.model.setPredictionCol("predicted").transform(ready)
        return scored.select(*keep, "predicted")


@dataclass
class _Prepared:
    """A fold ready for every candidate: prepared once, kept for all of them."""

    train: DataFrame
    valid: DataFrame


def _prepare(df: DataFrame, folds: Sequence[Fold], features: Sequence[str], target: str):
    out = []
    for fold in folds:
        part = df.where(fold.train)
        prep = fit_preprocessor(part, features)
        ready = [
            assemble(prep.transform(d, [target]), prep.feature_names)
            .select(F.col(target).cast("double").alias(target), "_features")
            .persist()
            for d in (part, df.where(fold.valid))
        ]
        out.append(_Prepared(*ready))
    return out


def _score(candidate: Candidate, folds: list[_Prepared], target: str, seed: int, tag: str) -> dict:
    """Mean fold metrics of one candidate; fits run side by side on the cluster. All its jobs
    carry ``tag``."""
    started = time.perf_counter()
    context = folds[0].train.sparkSession.sparkContext

    def fit(fold: _Prepared) -> Model:
        context.addJobTag(tag)
        try:
            return candidate.estimator(target, seed).fit(fold.train)
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=min(MAX_SIDE_BY_SIDE, len(folds))) as pool:
        models = list(pool.map(fit, folds))
    fitted = time.perf_counter()
    context.addJobTag(tag)
    scored = union_all(
        prediction_table(m.transform(f.valid), target, "prediction", None).withColumn(
            "fold", F.lit(i)
        )
        for i, (m, f) in enumerate(zip(models, folds))
    )
    per_fold = regression_metrics(scored, by=["fold"])
    row = per_fold.agg(*[F.avg(m).alias(m) for m in METRICS]).first().asDict()
    rows = scored.count()
    row.update(
        model_id=candidate.model_id,
        algo=candidate.algo,
        params={k: str(v) for k, v in candidate.params.items()},
        training_time_ms=(fitted - started) * 1000.0,
        predict_time_per_row_ms=(time.perf_counter() - fitted) * 1000.0 / max(rows, 1),
    )
    return row


def _score_within(
    candidate: Candidate, folds: list[_Prepared], target: str, seed: int, seconds: float
) -> dict | None:
    """``_score``, or nothing if it takes longer than ``seconds``: then its jobs are cancelled,
    those running and those that a fit still starts, until it has ended."""
    context = folds[0].train.sparkSession.sparkContext
    tag = f"search-{candidate.model_id}-{uuid.uuid4().hex}"
    with ThreadPoolExecutor(max_workers=1) as pool:
        scoring = pool.submit(_score, candidate, folds, target, seed, tag)
        wait([scoring], timeout=None if seconds == float("inf") else max(seconds, 0.0))
        late = not scoring.done()
        while not scoring.done():
            context.cancelJobsWithTag(tag)
            wait([scoring], timeout=0.2)
        if late and scoring.exception() is not None:
            return None
        return scoring.result()


# Long names of the metrics in search settings.
METRIC_NAMES = {
    "mean_absolute_error": "mae", "mean_squared_error": "mse",
    "root_mean_squared_error": "rmse", "r2_score": "r2", "auto": "rmse", "deviance": "rmse",
}


def _sort_metric(metric: str) -> str:
    name = metric.lower().removeprefix("neg_")
    name = METRIC_NAMES.get(name, name)
    if name not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; known are {sorted({*METRICS, *METRIC_NAMES})}")
    return name


def _better(metric: str, a: float, b: float) -> bool:
    return a > b if metric == "r2" else a < b


def model_search(
    df: DataFrame,
    target: str = "casos_dengue",
    params: dict[str, Any] | None = None,
    features: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    families: Sequence[str] | None = None,
    outer_folds: int = 0,
    output: str | None = None,
) -> SearchResult:
    """Score candidates within the preset's budget and refit the best on all rows.

    The best is the first by ``sort_metric``. The search stops early when the last
    ``stopping_rounds`` models brought no gain of ``stopping_metric`` above the tolerance; both
    are the optimization metric unless given. A model that takes longer than
    ``max_runtime_secs_per_model``, or than what is left of ``max_runtime_secs``, is cancelled
    and has no place on the leaderboard; if that leaves none, this fails. With ``outer_folds`` the whole search is also run on each of that many
    expanding folds and scored on what follows. ``output`` gets the result files, and
    each scored model as soon as it is known.
    """
    resolved = resolve_preset(params)
    budget = Budget.of(resolved)
    metric = _sort_metric(resolved["optimization_metric"])
    sort_by = _sort_metric(resolved.get("sort_metric", metric))
    stop_by = _sort_metric(resolved.get("stopping_metric", metric))
    dated = with_date(df)
    if features is None:
        features = [c for c in dated.columns if c not in (target, "data")]

    outer = None
    if outer_folds >= 2:
        framed, folds = _folds(dated, outer_folds, order_by)
        scored = []
        for fold in folds:
            inner = model_search(
                framed.where(fold.train), target, params, features, order_by, families
            )
            rows = inner.predict(framed.where(fold.valid), [target])
            scored.append(
                prediction_table(rows, target, date_col=None).withColumn("fold", F.lit(fold.number))
            )
        outer = regression_metrics(union_all(scored), by=["fold"]).orderBy("fold")

    started = time.perf_counter()
    spark = df.sparkSession
    framed, folds = _folds(dated, budget.folds, order_by)
    if not folds:
        raise ValueError("Too few dates or rows for time-ordered folds.")
    prepared = _prepare(framed, folds, features, target)
    history: list[dict] = []
    best, record, since = None, None, 0
    cancelled: list[str] = []
    try:
        for candidate in candidates(budget.max_models, budget.seed, families):
            left = budget.seconds - (time.perf_counter() - started)
            if left <= 0:
                break
            row = _score_within(candidate, prepared, target, budget.seed, min(left, budget.model_seconds))
            if row is None:
                cancelled.append(candidate.model_id)
                continue
            history.append(row)
            if output:
                one = spark.createDataFrame([row], HISTORY_SCHEMA)
                one.write.mode("append").parquet(f"{output}/checkpoints")
            if best is None or _better(sort_by, row[sort_by], best[1][sort_by]):
                best = (candidate, row)
            value = row[stop_by]
            if record is None or _better(stop_by, value, record):
                gain = 1.0 if record is None else abs(record - value) / max(abs(record), 1e-12)
                record, since = value, 0 if gain > budget.tolerance else since + 1
            else:
                since += 1
            if budget.patience and since >= budget.patience:
                break
    finally:
        for fold in prepared:
            fold.train.unpersist()
            fold.valid.unpersist()
    if best is None:
        raise RuntimeError(f"No model was scored within its time; cancelled: {', '.join(cancelled) or 'none'}")

    leader, row = best
    prep = fit_preprocessor(dated, features)
    ready = assemble(prep.transform(dated, [target]), prep.feature_names)
    model = leader.estimator(target, budget.seed).fit(ready)
    order = F.desc_nulls_last(sort_by) if sort_by == "r2" else F.asc_nulls_last(sort_by)
    table = spark.createDataFrame(history, HISTORY_SCHEMA).orderBy(order, "model_id")
    run_id = new_run_id()
    best_model = {
        "model_name": leader.model_id,
        "model_family": leader.algo,
        "hyperparameters": {k: str(v) for k, v in leader.params.items()},
        "score": {"metric": metric, "value": float(row[metric]), "source": "leaderboard"},
        "artifact_path": f"{output}/artifacts/model" if output else None,
        "artifacts": {"artifact_path": f"{output}/artifacts/model"} if output else {},
        "extra": {
            "raw_leaderboard_row": {k: str(v) for k, v in row.items()},
            "training_info": {
                "scored_models": str(len(history)), "cancelled_models": ",".join(cancelled),
                "sort_metric": sort_by, "stopping_metric": stop_by,
            },
        },
    }
    metadata = {
        "backend": "spark",
        "task_type": "regression",
        "run_id": run_id,
        "preset": resolved["preset"],
        "optimization_metric": resolved["optimization_metric"],
        "resolved_params": {k: str(v) for k, v in resolved.items()},
        "use_leaderboard_frame": bool(resolved.get("use_leaderboard_frame", True)),
        "training_time_seconds": time.perf_counter() - started,
        "output_dir": output,
        "created_at": datetime.now(timezone.utc).isoformat(),
    }
    result = SearchResult(model, prep, leader, table, best_model, metadata, outer)
    if output:
        model.write().overwrite().save(best_model["artifact_path"])
        save_search(*result_frames(result), output)
    return result


def result_frames(result: SearchResult) -> tuple[DataFrame, DataFrame, DataFrame]:
    """History, best model and metadata as frames for ``save_search``."""
    spark = result.history.sparkSession
    best = spark.createDataFrame(
        [result.best_model],
        "model_name string, model_family string, hyperparameters map<string,string>, "
        "score struct<metric: string, value: double, source: string>, artifact_path string, "
        "artifacts map<string,string>, "
        "extra struct<raw_leaderboard_row: map<string,string>, training_info: map<string,string>>",
    )
    metadata = spark.createDataFrame(
        [result.metadata],
        "backend string, task_type string, run_id string, preset string, "
        "optimization_metric string, resolved_params map<string,string>, "
        "use_leaderboard_frame boolean, training_time_seconds double, output_dir string, created_at string",
    )
    plain = result.history.withColumn("params", F.to_json("params"))
    return plain, best, metadata


def _folds(df: DataFrame, n: int, order_by: Sequence[str]) -> tuple[DataFrame, list[Fold]]:
    if "data" in df.columns:
        return df, time_folds(df, "data", n)
    if not order_by:
        raise ValueError("Rows without a date need order_by.")
    return row_folds(df, order_by, n)
