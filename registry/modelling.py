"""Splits, preparation, models, metrics and workflows."""

from __future__ import annotations

from pyspark.sql import functions as F

from sazonal.models import evaluate as E
from sazonal.models.components import pca_variance
from sazonal.models.folds import expanding_scores, ridge_block_scores
from sazonal.models.forest import importance_table
from sazonal.models.linear import coefficient_table, fit_linear, ridge_loo
from sazonal.models.onehot import fit_sparse
from sazonal.models.preprocess import fit_preprocessor
from sazonal.models.search import model_search
from sazonal.models.split import (
    block_folds,
    chronological_split,
    label_split,
    random_split,
    row_blocks,
    row_folds,
    row_split,
    split_summary,
    time_folds,
    time_segments,
)
from sazonal.operators.profile import scaling_check
from sazonal.operators.schema import union_all
from sazonal.plans.city import city_dataset, city_supervised

from .cleaning import GAPPY, gappy
from .common import SENSORS, dates_as_text, notifications, query, readings, rounded, table

REGRESSION = """
    lines AS (
        SELECT CAST(l_shipdate AS DATE) AS data, l_quantity AS x1, round(l_discount * 100) AS x2,
               round(l_extendedprice) AS y FROM lineitem)"""


def _lines(spark, sf_dir):
    """Line price explained by quantity and discount; whole numbers."""
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("data"),
        F.col("l_quantity").alias("x1"),
        F.round(F.col("l_discount") * 100).alias("x2"),
        F.round("l_extendedprice").alias("y"),
    )


SPLIT = f"""
    {REGRESSION}, dates AS (SELECT data, row_number() OVER (ORDER BY data) - 1 AS i,
                            count(*) OVER () AS n FROM (SELECT DISTINCT data FROM lines)),
    cut AS (SELECT data AS cutoff FROM dates
            WHERE i = least(greatest(CAST(floor(n * (1 - 0.2::DOUBLE)) AS BIGINT), 1), n - 1)),
    train AS (SELECT * FROM lines WHERE data < (SELECT cutoff FROM cut)),
    test AS (SELECT * FROM lines WHERE data >= (SELECT cutoff FROM cut))"""


@query(f"""
    WITH {SPLIT}
    SELECT split, count(*) AS rows, round(avg(y), 4) AS target_mean, CAST(min(data) AS VARCHAR) AS start_date,
           CAST(max(data) AS VARCHAR) AS end_date
    FROM (SELECT 'train' AS split, * FROM train UNION ALL SELECT 'test', * FROM test) GROUP BY 1""")
def chronological_split_summary(spark, sf_dir):
    train, test = chronological_split(_lines(spark, sf_dir), "data", 0.2)
    out = split_summary(label_split(train, test), "y")
    return dates_as_text(rounded(out, {"target_mean": 4}))


ROWS = """
    placed AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos,
               count(*) OVER () AS n FROM orders)"""


@query(f"""
    WITH {ROWS}
    SELECT CASE WHEN pos < CAST(floor(n * (1 - 0.3::DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split,
           count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
           CAST(sum(o_orderkey) AS BIGINT) AS key_sum
    FROM placed GROUP BY 1""")
def row_order_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    both = label_split(*row_split(orders, ["o_orderdate", "o_orderkey"], 0.3))
    return both.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
        F.sum("o_orderkey").alias("key_sum"),
    )


def _fold_sizes(df, folds, key):
    """Rows, and summed keys, of both parts of every fold."""
    parts = []
    for fold in folds:
        for name, rows in (("train", fold.train), ("valid", fold.valid)):
            parts.append(
                df.where(rows).select(F.lit(fold.number).alias("fold"), F.lit(name).alias("part"), key)
            )
    return union_all(parts).groupBy("fold", "part").agg(
        F.count("*").alias("rows"), F.sum(key).alias("key_sum")
    )


def fold_sql(n: int, k: int, pos: str, total: str) -> str:
    """Training and validation condition of expanding fold ``k`` of ``n``."""
    size = f"({total} // {n + 1})"
    start = f"({total} - {n - k + 1} * {size})"
    return f"{pos} < {start}", f"{pos} >= {start} AND {pos} < {start} + {size}"


def folds_union(n: int, source: str, pos: str, total: str) -> str:
    out = []
    for k in range(1, n + 1):
        for name, cond in zip(("train", "valid"), fold_sql(n, k, pos, total)):
            out.append(f"SELECT CAST({k} AS INTEGER) AS fold, '{name}' AS part, * FROM {source} WHERE {cond}")
    return " UNION ALL ".join(out)


@query(f"""
    WITH ordered AS (SELECT o_orderkey, dense_rank() OVER (ORDER BY CAST(o_orderdate AS DATE)) - 1 AS pos FROM orders),
    placed AS (SELECT *, (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders) AS n FROM ordered)
    SELECT fold, part, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
    FROM ({folds_union(5, 'placed', 'pos', 'n')}) GROUP BY 1, 2""")
def time_fold_sizes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("data"))
    return _fold_sizes(orders, time_folds(orders, "data", 5), "o_orderkey")


@query(f"""
    WITH {ROWS}
    SELECT fold, part, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
    FROM ({folds_union(4, 'placed', 'pos', 'n')}) GROUP BY 1, 2""")
def row_fold_sizes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    placed, folds = row_folds(orders, ["o_orderdate", "o_orderkey"], 4)
    return _fold_sizes(placed, folds, "o_orderkey")


@query(f"""
    WITH {ROWS}, blocks AS (SELECT k, (k - 1) * (n // 7) + least(k - 1, n % 7) AS a,
                            k * (n // 7) + least(k, n % 7) AS b
                            FROM (SELECT unnest(range(1, 8)) AS k), (SELECT count(*) AS n FROM orders))
    SELECT CAST(k AS INTEGER) AS fold, CASE WHEN pos >= a AND pos < b THEN 'valid' ELSE 'train' END AS part,
           count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
    FROM placed CROSS JOIN blocks GROUP BY 1, 2""")
def block_fold_sizes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    placed, folds = block_folds(orders, ["o_orderdate", "o_orderkey"], 7)
    return _fold_sizes(placed, folds, "o_orderkey")


@query(f"""
    WITH {GAPPY}, medians AS (SELECT median(valor) AS a, median(umidade) AS b FROM gappy),
    filled AS (SELECT event_id, coalesce(valor, a) AS valor, coalesce(umidade, b) AS umidade FROM gappy, medians),
    stats AS (SELECT avg(valor) AS m1, stddev_pop(valor) AS s1, avg(umidade) AS m2, stddev_pop(umidade) AS s2 FROM filled)
    SELECT event_id, round((valor - m1) / s1, 9) AS numeric__valor,
           round((umidade - m2) / s2, 9) AS numeric__umidade, 0.0::DOUBLE AS numeric__constante
    FROM filled, stats""")
def impute_scale(spark, sf_dir):
    df = gappy(spark, sf_dir).withColumn("constante", F.lit(3.0))
    prep = fit_preprocessor(df, ["valor", "umidade", "constante"])
    out = prep.transform(df, ["event_id"])
    return rounded(out, {c: 9 for c in prep.feature_names})


@query(f"""
    WITH {GAPPY} SELECT 'numeric__valor' AS coluna, 0.0::DOUBLE AS mean,
           round(sqrt(count(*) / (count(*) - 1.0)), 9) AS std FROM gappy""")
def scaled_column_check(spark, sf_dir):
    df = gappy(spark, sf_dir)
    prep = fit_preprocessor(df, ["valor"])
    out = scaling_check(prep.transform(df), prep.feature_names)
    return out.withColumns({"mean": F.round("mean", 9) + 0.0, "std": F.round("std", 9)})


STATUSES = ("F", "O", "P")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(f"""
    WITH texts AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice < 400000 THEN o_orderpriority END AS p FROM orders),
    modes AS (SELECT p FROM texts WHERE p IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, p LIMIT 1),
    filled AS (SELECT o_orderkey, o_orderstatus AS s, coalesce(texts.p, modes.p) AS p FROM texts, modes)
    SELECT o_orderkey, {', '.join(f"CASE WHEN s = '{c}' THEN 1.0::DOUBLE ELSE 0.0 END AS categorical__status_{c}" for c in STATUSES)},
           {', '.join(f'''CASE WHEN p = '{c}' THEN 1.0::DOUBLE ELSE 0.0 END AS "categorical__prioridade_{c}"''' for c in PRIORITIES)}
    FROM filled""")
def one_hot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_totalprice") < 400000, F.col("o_orderpriority")).alias("prioridade"),
    )
    prep = fit_preprocessor(orders, ["status", "prioridade"])
    return prep.transform(orders, ["o_orderkey"])


@query("""
    WITH texts AS (SELECT o_orderkey, year(o_orderdate) < 1997 AS old, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS a,
                          CASE WHEN o_totalprice < 400000 THEN CAST(o_custkey AS VARCHAR) END AS b FROM orders),
    a_places AS (SELECT a, row_number() OVER (ORDER BY a) - 1 AS place FROM (SELECT DISTINCT a FROM texts WHERE old AND a IS NOT NULL)),
    b_places AS (SELECT b, row_number() OVER (ORDER BY b) - 1 AS place FROM (SELECT DISTINCT b FROM texts WHERE old AND b IS NOT NULL)),
    facts AS (SELECT (SELECT count(*) FROM a_places) AS a_size, (SELECT count(*) FROM b_places) AS b_size,
                     (SELECT a FROM texts WHERE old AND a IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, a LIMIT 1) AS a_mode,
                     (SELECT b FROM texts WHERE old AND b IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, b LIMIT 1) AS b_mode)
    SELECT o_orderkey, a_size + b_size AS size, a_places.place AS day, a_size + b_places.place AS customer
    FROM texts CROSS JOIN facts
    LEFT JOIN a_places ON a_places.a = coalesce(texts.a, a_mode)
    LEFT JOIN b_places ON b_places.b = coalesce(texts.b, b_mode)""")
def one_hot_sparse(spark, sf_dir):
    """Days and customers of the orders before 1997 as features of all orders; those that
    are new since then have none."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.to_date("o_orderdate").alias("day"),
        F.when(F.col("o_totalprice") < 400000, F.col("o_custkey")).alias("customer"),
    )
    fitted = fit_sparse(orders.where(F.year("o_orderdate") < 1997), ["day", "customer"])
    days = F.lit(fitted.sizes[0])
    of = lambda inside: F.get(F.filter("features.indices", inside), F.lit(0))
    return fitted.transform(orders, ["o_orderkey"]).select(
        "o_orderkey", "features.size",
        of(lambda at: at < days).alias("day"), of(lambda at: at >= days).alias("customer"),
    )


@query("""
    WITH drawn AS (SELECT l_orderkey, l_linenumber, CAST('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber), 1, 15) AS BIGINT) AS draw FROM lineitem),
    placed AS (SELECT *, rank() OVER (ORDER BY draw) AS place, count(*) OVER () AS n FROM drawn)
    SELECT l_orderkey, l_linenumber, CASE WHEN place <= n - CAST(ceil(n * 0.2) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM placed""")
def random_split_exact(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return label_split(*random_split(lines, ["l_orderkey", "l_linenumber"], 0.2, 42))


FIT_TEST = """
    fit AS (SELECT regr_slope(y, x1) AS b, regr_intercept(y, x1) AS a FROM train),
    scored AS (SELECT data, y AS actual, a + b * x1 AS predicted FROM test, fit)"""
FITTED = f"{SPLIT}, {FIT_TEST}"


def _scored(spark, sf_dir):
    train, test = chronological_split(_lines(spark, sf_dir), "data", 0.2)
    model = fit_linear(train, ["x1"], "y")
    return E.prediction_table(test.withColumn("predicted", model.predict()), "y")


@query(f"""
    WITH {FITTED}
    SELECT CAST(data AS VARCHAR) AS data, actual, round(predicted, 4) AS predicted,
           round(actual - predicted, 4) AS residual FROM scored""")
def predictions(spark, sf_dir):
    return dates_as_text(rounded(_scored(spark, sf_dir), {"predicted": 4, "residual": 4}))


METRIC_SQL = """
    round(avg(abs(actual - predicted)), 3) AS mae,
    round(avg((actual - predicted) ** 2) / 1e6, 6) AS mse,
    round(sqrt(avg((actual - predicted) ** 2)), 3) AS rmse,
    round(1 - avg((actual - predicted) ** 2) / var_pop(actual), 9) AS r2"""


def _rounded_metrics(df):
    # The squared error is given in millions.
    millions = df.withColumn("mse", F.col("mse") / 1e6)
    return rounded(millions, {"mae": 3, "mse": 6, "rmse": 3, "r2": 9})


@query(f"WITH {FITTED} SELECT {METRIC_SQL} FROM scored")
def regression_metrics(spark, sf_dir):
    return _rounded_metrics(E.regression_metrics(_scored(spark, sf_dir)))


OLS = f"""
    {REGRESSION}, m AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM lines),
    g AS (SELECT sum((x1 - m1) * (x1 - m1)) AS g11, sum((x1 - m1) * (x2 - m2)) AS g12,
                 sum((x2 - m2) * (x2 - m2)) AS g22, sum((x1 - m1) * (y - my)) AS b1,
                 sum((x2 - m2) * (y - my)) AS b2 FROM lines, m)"""


@query(f"""
    WITH {OLS}, w AS (SELECT (g22 * b1 - g12 * b2) / (g11 * g22 - g12 * g12) AS w1,
                             (g11 * b2 - g12 * b1) / (g11 * g22 - g12 * g12) AS w2 FROM g)
    SELECT 'x1' AS feature, round(w1, 4) AS coefficient, round(abs(w1), 4) AS abs_coefficient FROM w
    UNION ALL SELECT 'x2', round(w2, 4), round(abs(w2), 4) FROM w""")
def ols_coefficients(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    out = coefficient_table(fit_linear(lines, ["x1", "x2"], "y"), lines)
    return rounded(out, {"coefficient": 4, "abs_coefficient": 4})


@query(f"""
    WITH {OLS}, n AS (SELECT g11, g12, g22, b1, -b2 AS b2, -g12 AS h12 FROM g),
    w AS (SELECT *, (g22 * b1 - h12 * b2) / (g11 * g22 - h12 * h12) AS w1,
                 (g11 * b2 - h12 * b1) / (g11 * g22 - h12 * h12) AS w2 FROM n)
    SELECT 'x1' AS feature, round(CASE WHEN w2 < 0 THEN greatest(b1 / g11, 0) WHEN w1 < 0 THEN 0 ELSE w1 END, 4) AS coefficient FROM w
    UNION ALL SELECT 'negado', round(CASE WHEN w1 < 0 THEN greatest(b2 / g22, 0) WHEN w2 < 0 THEN 0 ELSE w2 END, 4) FROM w""")
def non_negative_coefficients(spark, sf_dir):
    """Least squares without negative coefficients; one column has its sign turned."""
    lines = _lines(spark, sf_dir).withColumn("negado", -F.col("x2"))
    model = fit_linear(lines, ["x1", "negado"], "y", positive=True)
    out = coefficient_table(model, lines).drop("abs_coefficient")
    return rounded(out, {"coefficient": 4})


ALPHAS = (0.1, 1.0, 10.0, 100.0, 1000.0)


@query(f"""
    WITH {OLS}, size AS (SELECT count(*) AS n FROM lines), alphas AS (SELECT unnest({list(ALPHAS)}::DOUBLE[]) AS alpha),
    e AS (SELECT alpha, abs((y - my) - (x1 - m1) * b1 / (g11 + alpha))
                        / (1 - 1.0 / n - (x1 - m1) ** 2 / (g11 + alpha)) AS e
          FROM lines, m, g, size, alphas)
    SELECT alpha, round(sqrt(avg(e * e)), 5) AS rmse, round(avg(e), 5) AS mae FROM e GROUP BY 1""")
def ridge_leave_one_out(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    mse = ridge_loo(lines, ["x1"], "y", ALPHAS, "mse")[1]
    mae = ridge_loo(lines, ["x1"], "y", ALPHAS, "mae")[1]
    rows = [(a, float(mse[a]) ** 0.5, float(mae[a])) for a in ALPHAS]
    out = spark.createDataFrame(rows, "alpha double, rmse double, mae double")
    return rounded(out, {"rmse": 5, "mae": 5})


@query(f"""
    WITH {REGRESSION}, s AS (SELECT avg(x1) AS m1, stddev_pop(x1) AS s1, avg(x2) AS m2, stddev_pop(x2) AS s2, corr(x1, x2) AS r FROM lines),
    half AS (SELECT 0.5 * (1 + abs(r)) AS first FROM s)
    SELECT CAST(k AS INTEGER) AS component, round(CASE k WHEN 1 THEN first ELSE 1 - first END, 9) AS ratio
    FROM half, (SELECT unnest([1, 2]) AS k)""")
def component_variance(spark, sf_dir):
    """Variance shares of two scaled columns; both are needed for 95 %."""
    lines = _lines(spark, sf_dir)
    prep = fit_preprocessor(lines, ["x1", "x2"])
    fitted = pca_variance(prep.transform(lines), prep.feature_names, 0.95)
    assert len(fitted.vectors) == 2
    rows = [(i + 1, r) for i, r in enumerate(fitted.ratios)]
    return rounded(spark.createDataFrame(rows, "component int, ratio double"), {"ratio": 9})


@query(f"""
    WITH {REGRESSION}, s AS (SELECT avg(x1) AS m1, stddev_pop(x1) AS s1, avg(x2) AS m2, stddev_pop(x2) AS s2, corr(x1, x2) AS r FROM lines),
    p AS (SELECT y, (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2, r FROM lines, s)
    SELECT y, round(abs(z1 + sign(r) * z2) / sqrt(2), 6) AS "PC1", round(abs(z1 - sign(r) * z2) / sqrt(2), 6) AS "PC2" FROM p""")
def component_scores(spark, sf_dir):
    """Scores beside a passed-through column; their size, as signs are arbitrary."""
    lines = _lines(spark, sf_dir)
    prep = fit_preprocessor(lines, ["x1", "x2"])
    fitted = pca_variance(prep.transform(lines), prep.feature_names, 0.95)
    scores = fitted.transform(prep.transform(lines, ["y"]), ["y"])
    return scores.select(
        "y", F.round(F.abs("PC1"), 6).alias("PC1"), F.round(F.abs("PC2"), 6).alias("PC2")
    )


def fold_fits(n: int) -> str:
    """Per fold: fit on its training rows, score its validation rows."""
    parts = []
    for k in range(1, n + 1):
        train, valid = fold_sql(n, k, "pos", "n")
        parts.append(
            f"SELECT CAST({k} AS INTEGER) AS fold, y AS actual, a + b * x1 AS predicted FROM placed, "
            f"(SELECT regr_slope(y, x1) AS b, regr_intercept(y, x1) AS a FROM placed WHERE {train}) "
            f"WHERE {valid}"
        )
    return " UNION ALL ".join(parts)


@query(f"""
    WITH {SPLIT}, placed AS (SELECT train.*, i AS pos, (SELECT count(DISTINCT data) FROM train) AS n
                             FROM train JOIN dates USING (data))
    SELECT fold, {METRIC_SQL} FROM ({fold_fits(5)}) GROUP BY 1""")
def cross_validation(spark, sf_dir):
    """Expanding folds by date: fitted, imputed and scaled inside each fold only."""
    train, _ = chronological_split(_lines(spark, sf_dir), "data", 0.2)
    segment, folds = time_segments(train)
    cv, _ = expanding_scores(train, ["x1"], "y", segment, folds, E.fold_metrics)
    return _rounded_metrics(cv)


BLOCK_ALPHAS = (0.1, 1000.0, 1000000.0)


@query(f"""
    WITH lines AS (
        SELECT l_quantity AS x, round(l_extendedprice) AS y, row_number() OVER (
                   ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS pos,
               count(*) OVER () AS n FROM lineitem),
    blocks AS (SELECT *, CAST(CASE WHEN pos < (n // 5 + 1) * (n % 5) THEN pos // (n // 5 + 1)
                                   ELSE (pos - n % 5) // (n // 5) END AS INTEGER) + 1 AS block FROM lines),
    fits AS (
        SELECT k AS fold, count(*) AS m, avg(x) AS mx, avg(y) AS my,
               count(*) * var_pop(x) AS sxx, count(*) * covar_pop(x, y) AS sxy
        FROM blocks, (SELECT unnest(range(1, 6)) AS k) WHERE block <> k GROUP BY 1),
    e AS (
        SELECT fold, alpha, block = fold AS held, y - my - (x - mx) * sxy / (sxx + alpha) AS e,
               1 - 1.0 / m - (x - mx) ** 2 / (sxx + alpha) AS room
        FROM blocks, fits, (SELECT unnest({list(BLOCK_ALPHAS)}::DOUBLE[]) AS alpha)),
    scored AS (
        SELECT fold, alpha, sum(abs(e / room)) FILTER (NOT held) AS out, count(*) FILTER (held) AS rows,
               sqrt(avg(e * e) FILTER (held)) AS rmse
        FROM e GROUP BY 1, 2)
    SELECT CAST(fold AS INTEGER) AS fold, arg_min(alpha, out) AS alpha, arg_min(rows, out) AS rows,
           round(arg_min(rmse, out), 4) AS rmse
    FROM scored GROUP BY 1""")
def block_fold_rmse(spark, sf_dir):
    """Ridge on unshuffled blocks, its penalty chosen anew without each of them."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("x"), F.round("l_extendedprice").alias("y"),
    )
    placed, block = row_blocks(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 5)
    return rounded(ridge_block_scores(placed, ["x"], "y", block, 5, BLOCK_ALPHAS), {"rmse": 4})


@query(f"""
    WITH {SPLIT}, placed AS (SELECT train.*, i AS pos, (SELECT count(DISTINCT data) FROM train) AS n
                             FROM train JOIN dates USING (data)),
    per_fold AS (SELECT fold, sqrt(avg((actual - predicted) ** 2)) AS rmse FROM ({fold_fits(5)}) GROUP BY 1),
    {FIT_TEST},
    counts AS (SELECT (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows)
    SELECT train_rows, test_rows, (SELECT CAST(min(data) AS VARCHAR) FROM test) AS test_start_date,
           (SELECT round(avg(rmse), 3) FROM per_fold) AS cv_rmse,
           (SELECT round(sqrt(avg((actual - predicted) ** 2)), 3) FROM scored) AS test_rmse,
           CAST(5 AS BIGINT) AS folds
    FROM counts""")
def linear_workflow(spark, sf_dir):
    """Split, cross-validation, fit, predictions and report in one call."""
    report = E.train_linear(_lines(spark, sf_dir).drop("x2"), "y").report
    doc = E.report_frame(spark, report)
    return doc.select(
        F.col("data.train_rows").alias("train_rows"),
        F.col("data.test_rows").alias("test_rows"),
        F.col("data.test_start_date").alias("test_start_date"),
        F.round("cross_validation.mean_metrics.rmse", 3).alias("cv_rmse"),
        F.round("test_metrics.rmse", 3).alias("test_rmse"),
        F.size("cross_validation.fold_metrics").cast("long").alias("folds"),
    )


def _city(spark, sf_dir):
    city = city_dataset(notifications(spark, sf_dir), readings(spark, sf_dir), 30, SENSORS)
    # Every fold reads the dataset; it has one row per day.
    return city_supervised(city)[0]


@query()
def forest_workflow(spark, sf_dir):
    """Forest on the daily dataset; its trees are Spark's own."""
    params = {"n_splits": 2, "n_estimators": 10, "max_depth": 5}
    result = E.train_forest(_city(spark, sf_dir), "casos_dengue", params)
    return importance_table(result.model, result.predictions)


@query()
def model_search_leaderboard(spark, sf_dir):
    """A small search over model families with time-ordered folds."""
    params = {
        "preset": "mini",
        "presets": {"mini": {"max_models": 5, "nfolds": 2, "stopping_rounds": 5, "seed": 42}},
    }
    search = model_search(_city(spark, sf_dir), "casos_dengue", params)
    return search.history.select("model_id", "algo", "rmse", "mse", "mae", "r2")


@query(f"""
    WITH {OLS}, pen AS (SELECT unnest({list(ALPHAS)}::DOUBLE[]) AS alpha),
    w AS (SELECT alpha, ((g22 + alpha) * b1 - g12 * b2) / ((g11 + alpha) * (g22 + alpha) - g12 * g12) AS w1,
                 ((g11 + alpha) * b2 - g12 * b1) / ((g11 + alpha) * (g22 + alpha) - g12 * g12) AS w2,
                 (g22 + alpha) / ((g11 + alpha) * (g22 + alpha) - g12 * g12) AS i11,
                 (g11 + alpha) / ((g11 + alpha) * (g22 + alpha) - g12 * g12) AS i22,
                 -g12 / ((g11 + alpha) * (g22 + alpha) - g12 * g12) AS i12 FROM g, pen),
    e AS (SELECT alpha, ((y - my) - (x1 - m1) * w1 - (x2 - m2) * w2)
              / (1 - 1.0 / (SELECT count(*) FROM lines) - i11 * (x1 - m1) ** 2 - i22 * (x2 - m2) ** 2
                 - 2 * i12 * (x1 - m1) * (x2 - m2)) AS e FROM lines, m, w),
    loo AS (SELECT alpha, avg(e * e) AS mse FROM e GROUP BY 1),
    chosen AS (SELECT alpha FROM loo ORDER BY mse, alpha LIMIT 1)
    SELECT alpha, round(w1, 4) AS w1, round(w2, 4) AS w2 FROM w JOIN chosen USING (alpha)""")
def ridge_sensors_only(spark, sf_dir):
    """Ridge on the sensors alone, the penalty chosen by leave-one-out."""
    model, _ = ridge_loo(_lines(spark, sf_dir).drop("data"), ["x1", "x2"], "y", ALPHAS)
    row = [(float(model.alpha), *model.coefficients)]
    return rounded(spark.createDataFrame(row, "alpha double, w1 double, w2 double"), {"w1": 4, "w2": 4})
