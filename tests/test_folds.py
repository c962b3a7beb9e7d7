"""Folds fitted from sums per segment give what a fit of each fold's rows gives."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sazonal.models import evaluate as E
from sazonal.models.folds import (
    add_medians, expanding_scores, raw_prediction, ridge_block_scores, sum_segments,
)
from sazonal.models.split import row_blocks, time_folds, time_segments

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(7)
    data = []
    for i in range(400):
        x, z = draw.gauss(1000, 3), draw.choice([None, float("nan"), draw.uniform(0, 1), draw.uniform(0, 1)])
        kind = draw.choice(["a", "b", None] if i < 200 else ["a", "b", "c", "d"])
        late = None if i < 150 else draw.gauss(0, 1)
        y = 3 * x + 5 * (z if z is not None and z == z else 0.4) + 2 * (kind == "b") + draw.gauss(0, 1)
        data.append((DAY + dt.timedelta(days=i // 4), x, z, 7.0 if i < 300 else 8.0, kind, late, y))
    return spark.createDataFrame(
        data, "data date, x double, z double, step double, kind string, late double, y double"
    )


FEATURES = ["x", "z", "step", "kind", "late"]


@pytest.mark.parametrize("scale", [True, False])
@pytest.mark.parametrize("positive", [False, True])
def test_sums_serve_every_fold(rows, scale, positive):
    params = E.LinearParams(scale_features=scale, positive=positive)
    parts, predictor = E.linear_fit(FEATURES, "y", params)
    plain = E.cross_validate(rows, time_folds(rows), lambda t: predictor(*parts(t)), "y").collect()
    segment, k = time_segments(rows)
    got, fits = expanding_scores(rows, FEATURES, "y", segment, k, E.fold_metrics, scale=scale, positive=positive)
    got = got.collect()
    assert [r.fold for r in got] == [r.fold for r in plain] == [1, 2, 3, 4, 5]
    for a, b in zip(got, plain):
        assert tuple(a) == pytest.approx(tuple(b), rel=1e-6)
    add_medians(fits, rows, segment, [k + 1], fits.numbers)
    model, prep = fits.fit(range(k + 1), scale=scale, positive=positive)
    want, wanted = parts(rows)
    assert model.features == want.features and prep.categorical == wanted.categorical
    assert [s.median for s in prep.numeric] == [s.median for s in wanted.numeric]
    assert model.coefficients == pytest.approx(want.coefficients, rel=1e-5, abs=1e-8)
    ours = [r[0] for r in rows.select(raw_prediction(model, prep)).collect()]
    theirs = [r[0] for r in predictor(want, wanted)(rows).select("predicted").collect()]
    assert ours == pytest.approx(theirs, rel=1e-7)


def test_cross_validation_reads_little(spark, rows):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = rows.select("data", "x", "y").mapInArrow(seen, "data date, x double, y double")
    segment, k = time_segments(counted)
    assert expanding_scores(counted, ["x"], "y", segment, k, E.fold_metrics)[0].count() == 5
    assert read.value <= 5 * 400


def test_rows_without_date_or_target_take_no_part(spark, rows):
    more = rows.unionByName(rows.limit(9).withColumn("data", F.lit(None).cast("date"))).unionByName(
        rows.limit(5).withColumn("y", F.lit(None).cast("double"))
    )
    segment, k = time_segments(more)
    fits = sum_segments(more, ["x"], "y", segment)
    assert sum(p.rows for p in fits.products.values()) == 400


def test_block_ridge_against_all_fits(spark, rows):
    data = rows.select("x", (F.coalesce(F.nanvl("z", F.lit(0.5)), F.lit(0.4))).alias("z"), "y").toPandas().to_numpy()
    frame = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data[:103])], "i int, x double, z double, y double")
    alphas = (0.1, 10.0, 500.0)
    placed, block = row_blocks(frame.repartition(5), ["i"], 5)
    got = {r.fold: r for r in ridge_block_scores(placed, ["x", "z"], "y", block, 5, alphas).collect()}
    edges = np.cumsum([0, 21, 21, 21, 20, 20])

    def fitted(train, alpha):
        x, y = train[:, :2], train[:, 2]
        g = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) + alpha * np.eye(2)
        w = np.linalg.solve(g, (x - x.mean(axis=0)).T @ (y - y.mean()))
        return lambda rows: y.mean() + (rows[:, :2] - x.mean(axis=0)) @ w

    for k in range(5):
        held = np.arange(103) // 1
        inside = (held >= edges[k]) & (held < edges[k + 1])
        train, valid = data[:103][~inside], data[:103][inside]
        errors = []
        for alpha in alphas:
            out = [
                abs(fitted(np.delete(train, i, 0), alpha)(train[i : i + 1])[0] - train[i, 2]) for i in range(len(train))
            ]
            errors.append(np.mean(out))
        alpha = alphas[int(np.argmin(errors))]
        rmse = np.sqrt(np.mean((fitted(train, alpha)(valid) - valid[:, 2]) ** 2))
        assert (got[k + 1].alpha, got[k + 1]["rows"]) == (alpha, len(valid))
        assert got[k + 1].rmse == pytest.approx(rmse, rel=1e-8)
    assert ridge_block_scores(placed.limit(0), ["x"], "y", block, 5).count() == 0
