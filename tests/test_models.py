import datetime as dt
import json
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sazonal.models import evaluate as E
from sazonal.models import linear as L
from sazonal.models.components import pca_variance
from sazonal.models.onehot import as_vector, fit_sparse
from sazonal.models.preprocess import fit_preprocessor
from sazonal.models.search import EVOLUTION_PRESETS, FAMILIES, Budget, candidates, model_search, resolve_preset
from sazonal.models.split import (
    block_folds, chronological_split, expanding_bounds, hash_split, random_split, row_folds, row_split,
    split_index, time_folds,
)
from sazonal.sinks import new_run_id, read_report, run_folder

DAY = dt.date(2024, 1, 1)


def frame(spark, columns):
    names = list(columns)
    rows = [tuple(v.item() if hasattr(v, "item") else v for v in r) for r in zip(*columns.values())]
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def workflow_rows(spark):
    days = [DAY + dt.timedelta(days=i // 2) for i in range(60)]
    return frame(
        spark,
        {
            "data": days,
            "temperatura_ar_media_c": list(range(60)),
            "umidade_relativa_media": [70 + i % 5 for i in range(60)],
            "mes": [d.month for d in days],
            "dia": [d.day for d in days],
            "casos_dengue": [2.0 * i + 0.5 * (i % 5) for i in range(60)],
        },
    )


def test_linear_workflow(spark, workflow_rows, tmp_path):
    params = {"test_size": 0.2, "n_splits": 3, "fit_intercept": True, "positive": False, "scale_features": True}
    result = E.train_linear(workflow_rows, "casos_dengue", params)
    report = result.report
    assert report["metadata"]["model_name"] == "LinearRegression"
    assert (report["data"]["train_rows"], report["data"]["test_rows"]) == (48, 12)
    assert report["data"]["feature_count"] == 4
    assert report["data"]["test_start_date"] == "2024-01-25"
    assert len(report["cross_validation"]["fold_metrics"]) == 3
    assert result.predictions.columns == ["data", "actual", "predicted", "residual"]
    assert report["test_metrics"]["rmse"] == pytest.approx(0.0, abs=1e-6)

    paths = E.save_run(result, str(tmp_path))
    assert all(Path(p).exists() for p in paths.values())
    saved = read_report(spark, paths["report_path"], E.REPORT_SCHEMA).first()
    assert saved.artifacts == paths
    assert saved.data.train_rows == 48
    table = {r.feature: r.coefficient for r in spark.read.parquet(paths["model_path"]).collect()}
    assert table["numeric__mes"] == 0.0
    assert spark.read.csv(paths["predictions_path"], header=True).count() == 12


def test_chronological_split_keeps_dates_apart(spark):
    df = frame(
        spark,
        {"data": [DAY + dt.timedelta(days=i // 3) for i in range(30)], "value": list(range(30))},
    )
    train, test = chronological_split(df, "data", 0.3)
    a = {r.data for r in train.collect()}
    b = {r.data for r in test.collect()}
    assert not a & b and min(b) == dt.date(2024, 1, 8)


def test_split_errors(spark):
    df = frame(spark, {"data": [DAY, DAY, DAY + dt.timedelta(days=1)], "x": [1, 2, 3]})
    with pytest.raises(ValueError, match="unique dates"):
        chronological_split(df)
    with pytest.raises(ValueError, match="3 rows"):
        chronological_split(df.limit(2))
    with pytest.raises(ValueError, match="between 0 and 1"):
        chronological_split(df, test_size=1.0)
    assert split_index(10, 0.9) == 1 and split_index(10, 0.01) == 9


def test_folds(spark):
    assert expanding_bounds(10, 3) == [(1, 4, 6), (2, 6, 8), (3, 8, 10)]
    df = frame(spark, {"data": [DAY + dt.timedelta(days=i // 2) for i in range(20)], "x": list(range(20))})
    sizes = [(df.where(f.train).count(), df.where(f.valid).count()) for f in time_folds(df, "data", 3)]
    assert sizes == [(8, 4), (12, 4), (16, 4)]
    assert time_folds(df.where("x < 4"), "data", 3) == []
    placed, folds = row_folds(df, ["data", "x"], 3)
    assert [(placed.where(f.train).count(), placed.where(f.valid).count()) for f in folds] == [(5, 5), (10, 5), (15, 5)]
    placed, folds = block_folds(df, ["data", "x"], 3)
    assert [placed.where(f.valid).count() for f in folds] == [7, 7, 6]
    train, test = row_split(df, ["data", "x"], 0.25)
    assert (train.count(), [r.x for r in test.orderBy("x").collect()]) == (15, [15, 16, 17, 18, 19])


def test_hash_split_is_stable(spark):
    df = spark.range(5000).toDF("k")
    first = {r.k for r in hash_split(df, ["k"])[0].collect()}
    again = {r.k for r in hash_split(df.repartition(7), ["k"])[0].collect()}
    assert first == again and 3800 < len(first) < 4200


def test_random_split_has_its_exact_size(spark):
    df = spark.range(5003).toDF("k")
    train, test = random_split(df, ["k"], 0.2, 7)
    first = {r.k for r in test.collect()}
    assert (train.count(), len(first)) == (4002, 1001)
    assert first == {r.k for r in random_split(df.repartition(7), ["k"], 0.2, 7)[1].collect()}
    assert first != {r.k for r in random_split(df, ["k"], 0.2, 8)[1].collect()}
    # Whole keys stay together; rows without a key are one of them.
    same = spark.createDataFrame([(None,)] * 5 + [("a",)] * 40 + [("b",)] * 3, "k string")
    train, test = random_split(same, ["k"])
    assert train.count() >= 38 and not {r.k for r in train.collect()} & {r.k for r in test.collect()}
    with pytest.raises(ValueError):
        random_split(spark.range(1).toDF("k"), ["k"])


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3)) * [1, 5, 0.1] + [10, -3, 0]
    y = x @ [2.0, -1.0, 30.0] + 4 + rng.normal(size=200)
    return x, y, frame(spark, {"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})


def test_least_squares(spark, numbers):
    x, y, df = numbers
    want = np.linalg.lstsq(np.c_[x, np.ones(len(y))], y, rcond=None)[0]
    model = L.fit_linear(df, ["a", "b", "c"], "y")
    assert [*model.coefficients, model.intercept] == pytest.approx(list(want), rel=1e-8)
    near = L.fit_linear(df, ["a", "b", "c"], "y", centre=[10.5, -3.5, 0.0, 20.0])
    assert near.coefficients == pytest.approx(model.coefficients, rel=1e-8)
    flat = L.fit_linear(df, ["a", "b", "c"], "y", fit_intercept=False)
    assert list(flat.coefficients) == pytest.approx(list(np.linalg.lstsq(x, y, rcond=None)[0]), rel=1e-7)
    assert flat.intercept == 0.0


def test_dependent_columns_take_the_least_norm(spark, numbers):
    x, y, df = numbers
    twice = df.withColumn("d", F.col("a") * 2)
    xc = np.c_[x, 2 * x[:, 0]]
    xc = xc - xc.mean(axis=0)
    want = np.linalg.lstsq(xc, y - y.mean(), rcond=None)[0]
    model = L.fit_linear(twice, ["a", "b", "c", "d"], "y")
    assert list(model.coefficients) == pytest.approx(list(want), rel=1e-6)


def test_non_negative_against_all_subsets():
    rng = np.random.default_rng(2)
    for _ in range(20):
        x, y = rng.normal(size=(30, 4)), rng.normal(size=30)
        g, b = x.T @ x, x.T @ y
        best = 0.0
        for mask in range(1, 16):
            on = [i for i in range(4) if mask >> i & 1]
            w = np.zeros(4)
            w[on] = np.linalg.solve(g[np.ix_(on, on)], b[on])
            if (w >= 0).all():
                best = min(best, 0.5 * w @ g @ w - b @ w)
        w = L.non_negative_solve(g, b)
        assert (w >= 0).all()
        assert 0.5 * w @ g @ w - b @ w == pytest.approx(best, abs=1e-9)


def test_ridge_leave_one_out_against_refits(spark, numbers):
    x, y, df = numbers
    x, y = x[:40], y[:40]
    small = frame(spark, {"a": x[:, 0], "b": x[:, 1], "y": y})
    model, errors = L.ridge_loo(small, ["a", "b"], "y", (0.1, 5.0), "mae")
    for alpha in (0.1, 5.0):
        total = 0.0
        for i in range(40):
            keep = np.arange(40) != i
            xi, yi = x[keep][:, :2], y[keep]
            xc, yc = xi - xi.mean(axis=0), yi - yi.mean()
            w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
            total += abs(y[i] - yi.mean() - (x[i, :2] - xi.mean(axis=0)) @ w)
        assert errors[alpha] == pytest.approx(total / 40, rel=1e-9)
    assert model.alpha == min(errors, key=errors.get)


def test_components(spark, numbers):
    x, _, df = numbers
    xc = x - x.mean(axis=0)
    values = np.linalg.eigvalsh(np.cov(xc.T))[::-1]
    fitted = pca_variance(df, ["a", "b", "c"], 0.95)
    assert list(fitted.ratios) == pytest.approx(list(values / values.sum()), rel=1e-9)
    k = int((np.cumsum(values / values.sum()) <= 0.95).sum()) + 1
    scores = fitted.transform(df)
    assert scores.columns == [f"PC{i + 1}" for i in range(k)] + ["y"]
    assert scores.agg(F.var_samp("PC1")).first()[0] == pytest.approx(values[0], rel=1e-9)


def test_preparation(spark):
    train = spark.createDataFrame(
        [(1.0, None, 7, "b"), (2.0, None, 7, "a"), (None, None, 7, "a"), (9.0, None, 7, None)],
        "x double, gone double, same int, c string",
    )
    prep = fit_preprocessor(train, ["x", "gone", "same", "c"])
    assert prep.feature_names == ["numeric__x", "numeric__same", "categorical__c_a", "categorical__c_b"]
    filled = np.array([1.0, 2.0, 2.0, 9.0])
    new = spark.createDataFrame([(None, 8, "z"), (9.0, 7, None)], "x double, same int, c string")
    got = [tuple(r) for r in prep.transform(new).collect()]
    z = lambda v: (v - filled.mean()) / filled.std()
    assert got[0] == pytest.approx((z(2.0), 1.0, 0.0, 0.0))
    assert got[1] == pytest.approx((z(9.0), 0.0, 1.0, 0.0))


def test_sparse_one_hot(spark):
    train = spark.createDataFrame([("b", 1, None), ("a", 2, None), ("a", None, None)], "c string, n int, gone string")
    fitted = fit_sparse(train, ["c", "n", "gone"])
    assert (fitted.cols, fitted.modes, fitted.sizes) == (("c", "n"), ("a", "1"), (2, 2))
    names = {r.feature: r["name"] for r in fitted.features().collect()}
    assert names == {0: "categorical__c_a", 1: "categorical__c_b", 2: "categorical__n_1", 3: "categorical__n_2"}
    new = spark.createDataFrame([(0, "b", 2, "x"), (1, None, None, None), (2, "z", 9, "x")], "id int, c string, n int, gone string")
    got = {r.id: (r.features, r.v) for r in fitted.transform(new, ["id"]).withColumn("v", as_vector(F.col("features"))).collect()}
    assert [sorted(got[i][0]["indices"]) for i in range(3)] == [[1, 3], [0, 2], []]
    assert [got[i][1].toArray().tolist() for i in range(3)] == [[0, 1, 0, 1], [1, 0, 1, 0], [0, 0, 0, 0]]


def test_sparse_one_hot_of_many_categories(spark):
    df = spark.range(100_000).selectExpr("id", "lpad(id, 6, '0') AS c")
    fitted = fit_sparse(df, ["c"])
    assert fitted.size == 100_000
    encoded = fitted.transform(df, ["id"])
    assert encoded.where("features.indices != array(id)").isEmpty() and encoded.count() == 100_000


def test_folds_do_not_leak(spark):
    rows = [(DAY + dt.timedelta(days=i), float(i), 2.0 * i) for i in range(40)]
    df = spark.createDataFrame(rows, "data date, x double, y double")
    folds = time_folds(df, "data", 3)
    poisoned = df.withColumn("x", F.when(folds[-1].valid, 1e9).otherwise(F.col("x")))
    parts, _ = E.linear_fit(["x"], "y", E.LinearParams())
    clean = parts(df.where(folds[-1].train))
    dirty = parts(poisoned.where(folds[-1].train))
    assert clean == dirty


def test_metrics_of_a_constant_target(spark):
    df = spark.createDataFrame([("e", 2.0, 2.0), ("e", 2.0, 2.0), ("w", 2.0, 3.0)], "g string, actual double, predicted double")
    got = {r.g: r.r2 for r in E.regression_metrics(df, by=["g"]).collect()}
    assert got == {"e": 1.0, "w": 0.0}


def test_forest_workflow(spark, workflow_rows, tmp_path):
    df = workflow_rows.withColumn("ano", F.year("data"))
    result = E.train_forest(df, params={"n_splits": 2, "n_estimators": 5, "max_depth": 4})
    assert result.predictions.columns == ["actual", "predicted", "residual"]
    assert "numeric__ano" not in result.model.features
    assert len(result.report["feature_importances"]) == 4
    assert len(result.report["cross_validation"]["fold_metrics"]) == 2
    paths = E.save_run(result, str(tmp_path))
    assert Path(paths["model_path"]).exists()


def test_parameters():
    assert E.resolve(E.LinearParams, {"n_splits": "3", "other": 1}) == E.LinearParams(n_splits=3)
    assert E.resolve(E.ForestParams, {"max_depth": 15}).max_depth == 15
    with pytest.raises(ValueError, match="Unknown preset"):
        resolve_preset({"preset": "huge"})
    given = {"preset": "low", "optimization_metric": "neg_mean_squared_error", "verbosity": None}
    resolved = resolve_preset(given, EVOLUTION_PRESETS)
    assert "preset" in given and "verbosity" not in resolved
    assert Budget.of(resolved).max_models == 8 * 17
    drawn = candidates(Budget.of(resolved).max_models)
    assert len({(c.algo, str(c.params)) for c in drawn}) == len(drawn) == 136
    assert candidates(136) == drawn and candidates(20, seed=7) != drawn[:20]
    assert Budget.of(resolve_preset({"preset": "medium"})).model_seconds == 120


def test_search(spark, workflow_rows, tmp_path):
    out = str(tmp_path / "search")
    params = {"preset": "t", "presets": {"t": {"max_models": 3, "nfolds": 2, "stopping_rounds": 3}}}
    search = model_search(workflow_rows, params=params, families=("LR", "DT"), output=out, outer_folds=2)
    board = search.history.collect()
    assert len(board) == 3 and board[0].model_id == search.best_model["model_name"]
    assert [r.rmse for r in board] == sorted(r.rmse for r in board)
    assert search.outer.count() == 2
    report = json.loads(next(Path(out, "report.json").glob("part-*")).read_text())
    assert set(report) == {"search_history", "best_model", "metadata"}
    assert len(report["search_history"]) == 3
    assert spark.read.parquet(f"{out}/checkpoints").count() == 3
    assert search.predict(workflow_rows, ["data"]).columns == ["data", "predicted"]


class Slow:
    """An estimator whose fit is one job of two minutes."""

    def __init__(self, featuresCol, labelCol, **params):
        pass

    def fit(self, df):
        @F.udf("long")
        def slow(x):
            time.sleep(120)
            return x

        return df.sparkSession.range(1).select(slow("id")).collect()


def test_slow_models_are_cancelled(spark, workflow_rows, monkeypatch):
    families = {"SLOW": (Slow, {"x": lambda draw: draw.random()}), "LR": FAMILIES["LR"]}
    monkeypatch.setattr("sazonal.models.search.FAMILIES", families)
    budget = {"max_models": 3, "nfolds": 2, "max_runtime_secs_per_model": 10, "sort_metric": "mae"}
    params = {"preset": "t", "presets": {"t": budget}}
    started = time.perf_counter()
    search = model_search(workflow_rows, params=params)
    assert time.perf_counter() - started < 100
    assert [r.algo for r in search.history.collect()] == ["LR"]
    info = search.best_model["extra"]["training_info"]
    assert info["cancelled_models"] == "SLOW_1,SLOW_3" and info["sort_metric"] == "mae"
    assert search.best_model["extra"]["raw_leaderboard_row"]["algo"] == "LR"
    params = {"preset": "t", "presets": {"t": {**budget, "max_models": 1, "max_runtime_secs_per_model": 2}}}
    with pytest.raises(RuntimeError, match="SLOW_1"):
        model_search(workflow_rows, params=params, families=["SLOW"])


def test_run_folder():
    stamp = new_run_id(dt.datetime(2024, 5, 6, 7, 8, 9))
    assert stamp == "20240506T070809Z"
    assert run_folder("/b", "autoML/H2O AutoML", stamp) == f"/b/results/automl/h2o_automl/{stamp}"
