"""Missingness, distribution and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sazonal.functions.missing import numeric_columns, text_columns
from sazonal.models.split import hash_split
from sazonal.operators.aggregate import family_summary, top_models
from sazonal.operators.profile import (
    column_presence,
    corr_matrix,
    describe_exact,
    missing_profile,
    per_file_missing,
)
from sazonal.operators.schema import column_profile
from sazonal.operators.series import rolling_impute

from .cleaning import GAPPY, gappy
from .common import query, rounded, table

GAP_COLUMNS = ("valor", "umidade", "chuva")


@query(f"""
    WITH {GAPPY}
    SELECT 'event_id' AS coluna, 0.0::DOUBLE AS percentual_faltantes
    {''.join(f" UNION ALL SELECT '{c}', avg(CAST({c} IS NULL AS INT)) * 100 FROM gappy" for c in GAP_COLUMNS)}""")
def missing_percent(spark, sf_dir):
    return missing_profile(gappy(spark, sf_dir).select("event_id", *GAP_COLUMNS))


@query(f"""
    WITH {GAPPY}
    {' UNION ALL '.join(
        f"SELECT arquivo, '{c}' AS coluna, avg(CAST({c} IS NULL AS INT)) * 100 AS percentual_faltantes FROM gappy GROUP BY 1"
        for c in GAP_COLUMNS)}""")
def missing_percent_by_file(spark, sf_dir):
    return missing_profile(gappy(spark, sf_dir).drop("event_id", "ts"), by=["arquivo"])


@query(f"""
    WITH {GAPPY}, shares AS ({' UNION ALL '.join(
        f"SELECT arquivo, '{c}' AS coluna, avg(CAST({c} IS NULL AS INT)) AS share FROM gappy "
        + ("WHERE arquivo <> 'view' " if c == 'umidade' else "") + "GROUP BY 1" for c in GAP_COLUMNS)})
    SELECT coluna, round(avg(share) * 100, 9) AS media_percentual_faltantes FROM shares GROUP BY 1""")
def per_file_missing_mean(spark, sf_dir):
    """A file that lacks a column is left out of that column's mean."""
    named = gappy(spark, sf_dir).drop("event_id", "ts").withColumn(
        "colunas",
        F.when(F.col("arquivo") == "view", F.array(F.lit("valor"), F.lit("chuva"))).otherwise(
            F.array(F.lit("valor"), F.lit("umidade"), F.lit("chuva"))
        ),
    )
    out = per_file_missing(named, cols=list(GAP_COLUMNS), present="colunas")
    return rounded(out, {"media_percentual_faltantes": 9})


@query(f"""
    WITH {GAPPY}, filled AS (
        SELECT arquivo, coalesce(chuva, CASE WHEN count(chuva) OVER w >= 2 THEN 0 END) AS chuva
        FROM gappy WINDOW w AS (PARTITION BY arquivo ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
    shares AS (SELECT arquivo, avg(CAST(chuva IS NULL AS INT)) AS share FROM filled GROUP BY 1)
    SELECT 'chuva' AS coluna, round(avg(share) * 100, 9) AS media_percentual_faltantes FROM shares""")
def per_file_missing_after_fill(spark, sf_dir):
    """The same after the rolling mean has filled what it can."""
    filled = rolling_impute(
        gappy(spark, sf_dir).select("arquivo", "ts", "event_id", "chuva"),
        ["chuva"], "mean", 4, 2, ["ts", "event_id"], ["arquivo"],
    )
    out = per_file_missing(filled, cols=["chuva"])
    return rounded(out, {"media_percentual_faltantes": 9})


@query("""
    SELECT event_type AS coluna, count(DISTINCT user_id) AS qtd_arquivos FROM events GROUP BY 1""")
def column_presence_by_file(spark, sf_dir):
    """Users as files, the event types a user has as the file's header."""
    pairs = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    headers = pairs.select("user_id", F.array("event_type").alias("colunas"))
    return column_presence(headers)


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STAT_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS coluna, count({c}) AS count, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
        round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75,
        max({c}) AS max FROM lineitem"""
    for c in PROFILED
)


@query(STAT_SQL)
def describe_columns(spark, sf_dir):
    out = describe_exact(table(spark, sf_dir, "lineitem"), PROFILED)
    return rounded(out, {"mean": 4, "std": 4, "p25": 6, "p50": 6, "p75": 6})


@query(f"""
    WITH {GAPPY}, r AS (SELECT corr(valor, umidade) AS vu, corr(valor, chuva) AS vc, corr(umidade, chuva) AS uc FROM gappy
                        WHERE arquivo <> 'error')
    SELECT a, b, round(corr, 9) AS corr FROM (
        SELECT 'valor' AS a, 'valor' AS b, 1.0 AS corr UNION ALL SELECT 'umidade', 'umidade', 1.0
        UNION ALL SELECT 'chuva', 'chuva', 1.0
        UNION ALL SELECT 'valor', 'umidade', vu FROM r UNION ALL SELECT 'umidade', 'valor', vu FROM r
        UNION ALL SELECT 'valor', 'chuva', vc FROM r UNION ALL SELECT 'chuva', 'valor', vc FROM r
        UNION ALL SELECT 'umidade', 'chuva', uc FROM r UNION ALL SELECT 'chuva', 'umidade', uc FROM r)""")
def correlation_matrix(spark, sf_dir):
    """Pairwise-complete Pearson correlation of the numeric columns after a filter."""
    df = gappy(spark, sf_dir).where("arquivo <> 'error'")
    return rounded(corr_matrix(df, numeric_columns(df, exclude=("event_id",))), {"corr": 9})


@query("""
    SELECT * FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
        ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string')) t("column", type),
        (SELECT count(*) AS non_null FROM orders)""")
def column_listing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    assert text_columns(orders) == ["o_orderstatus", "o_orderpriority"]
    return column_profile(orders)


@query("""
    SELECT event_type AS algo, count(event_id) AS qtd_modelos, min(value) AS melhor_rmse,
           round(avg(value), 6) AS rmse_medio, round(avg(user_id), 6) AS tempo_medio_treino_ms,
           round(avg(user_id) / 1000, 9) AS tempo_medio_treino_s
    FROM events GROUP BY 1""")
def family_summary_by_algo(spark, sf_dir):
    board = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("algo"),
        F.col("event_id").alias("model_id"),
        F.col("value").alias("rmse"),
        F.col("user_id").alias("training_time_ms"),
    )
    return rounded(
        family_summary(board),
        {"rmse_medio": 6, "tempo_medio_treino_ms": 6, "tempo_medio_treino_s": 9},
    )


@query("""
    SELECT event_id AS model_id, event_type AS algo, value AS rmse FROM events
    ORDER BY value ASC NULLS LAST, event_id LIMIT 10""")
def top_models_by_score(spark, sf_dir):
    board = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("model_id"), F.col("event_type").alias("algo"), F.col("value").alias("rmse")
    )
    return top_models(board, 10, ties=["model_id"])


@query()
def hash_split_counts(spark, sf_dir):
    """Rows of a seeded 80/20 split by key; the draw is Spark's own hash."""
    train, test = hash_split(table(spark, sf_dir, "orders"), ["o_orderkey"], 0.8, 42)
    return (
        train.select(F.lit("train").alias("split"))
        .unionByName(test.select(F.lit("test").alias("split")))
        .groupBy("split")
        .agg(F.count("*").alias("rows"))
    )
