"""Row windows: expected values are typed in; blocked runs must equal plain ones."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sazonal.operators import series as S


def _rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).orderBy(*cols[:2]).collect()]


def test_prior_mean_needs_every_row(spark):
    data = [(i, v) for i, v in enumerate([1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0])]
    df = spark.createDataFrame(data, "t int, x double")
    out = S.prior_window_mean(df, ["x"], ["t"], window=2)
    assert [r.x for r in out.orderBy("t").collect()] == [None, None, 1.5, None, None, 4.5, 5.5]


def test_prior_mean_is_by_row_not_by_day(spark):
    d = dt.date
    df = spark.createDataFrame(
        [(d(2020, 1, 1), 1.0), (d(2020, 1, 2), 3.0), (d(2020, 5, 1), 9.0)], "data date, x double"
    )
    out = S.prior_window_mean(df, ["x"], window=2)
    assert [r.x for r in out.orderBy("data").collect()] == [None, None, 2.0]


def test_rolling_median_uses_unfilled_values(spark):
    values = [None, 1.0, None, 5.0, None, None, None, None, None, None, 2.0]
    df = spark.createDataFrame(list(enumerate(values)), "t int, x double")
    out = S.rolling_impute(df, ["x"], "median", 6, 2, ["t"])
    assert [r.x for r in out.orderBy("t").collect()] == [
        None, 1.0, None, 5.0, 3.0, 3.0, 3.0, None, None, None, 2.0
    ]


def test_rolling_mean(spark):
    values = [2.0, None, 4.0, None, None, None]
    df = spark.createDataFrame(list(enumerate(values)), "t int, x double")
    out = S.rolling_impute(df, ["x"], "mean", 4, 2, ["t"])
    assert [r.x for r in out.orderBy("t").collect()] == [2.0, None, 4.0, 3.0, None, None]


def test_lags_skip_absent_columns_and_rename(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "t int, x double")
    out = S.add_lags(df, {"x": "short", "gone": "g"}, (1, 2), ["t"])
    assert out.columns == ["t", "x", "short_lag_1", "short_lag_2"]
    assert _rows(out, "t", "short_lag_1", "short_lag_2") == [(2, 1.0, 0.0), (3, 2.0, 1.0), (4, 3.0, 2.0)]


def test_lag_matrix_drops_same_day(spark):
    df = spark.createDataFrame(
        [("a", "x", i, float(i)) for i in range(3)], "uf string, municipio string, data int, s double"
    )
    out = S.lag_matrix(df, ["s"], 2)
    assert out.columns == ["uf", "municipio", "data", "s_dia_1", "s_dia_2"]
    assert [r.s_dia_2 for r in out.orderBy("data").collect()] == [None, None, 0.0]


@pytest.fixture(scope="module")
def skewed(spark):
    # One key holds most rows; another is null; ties are broken by the second column.
    return spark.range(3000).select(
        F.when(F.col("id") % 10 < 8, "hot")
        .when(F.col("id") % 10 == 8, F.concat(F.lit("k"), F.col("id") % 7))
        .alias("k"),
        (F.col("id") * 37 % 1000).alias("t"),
        "id",
        F.when(F.col("id") % 7 != 0, (F.col("id") * 13 % 101).cast("double")).alias("x"),
    )


@pytest.fixture(scope="module", params=[(3, 10_000), (40, 7)])
def borders(spark, request):
    """Few parts in large batches; many parts, shorter than the windows, in small batches."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {n: spark.conf.get(n) for n in names}
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    for name, value in zip(names, request.param):
        spark.conf.set(name, value)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_borders_change_nothing(spark, skewed, borders, keys):
    rows = skewed.where("id < 900") if borders[0] > 3 else skewed
    calls = [
        lambda how: S.prior_window_mean(rows, ["x"], ["t", "id"], keys, 5, **how),
        lambda how: S.rolling_impute(rows, ["x"], "median", 6, 2, ["t", "id"], keys, **how),
        lambda how: S.rolling_impute(rows, ["x"], "mean", 30, 2, ["t", "id"], keys, **how),
        lambda how: S.add_lags(rows, ["x", "k"], (1, 7, 40), ["t", "id"], keys, dropna=False, **how),
    ]
    for call in calls:
        plain = {r.id: r.asDict() for r in call({"bounded": True}).collect()}
        parted = {r.id: r.asDict() for r in call({}).collect()}
        assert plain.keys() == parted.keys()
        for at, row in plain.items():
            for name, value in row.items():
                assert parted[at][name] == (pytest.approx(value, rel=1e-12) if isinstance(value, float) else value)


def test_nothing_is_joined_or_shuffled_again(spark, skewed):
    out = S.rolling_impute(skewed, ["x"], order_by=["t", "id"], partition_by=["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_positions_are_dense_beyond_one_task(spark, skewed, borders):
    placed = S.positions(skewed, ["t", "id"])
    rows = placed.orderBy("_pos").collect()
    assert [r._pos for r in rows] == list(range(3000))
    assert [(r.t, r.id) for r in rows] == sorted((r.t, r.id) for r in rows)
    by_key = {}
    for r in S.positions(skewed, ["t", "id"], ["k"]).collect():
        by_key.setdefault(r.k, []).append((r._pos, r.t, r.id))
    for held in by_key.values():
        held.sort()
        assert [p for p, *_ in held] == list(range(len(held)))
        assert [r[1:] for r in held] == sorted(r[1:] for r in held)


def test_empty_series(spark, skewed):
    assert S.positions(skewed.limit(0), ["t"]).count() == 0
    assert S.prior_window_mean(skewed.limit(0), ["x"], ["t"]).count() == 0
