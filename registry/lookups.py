"""Lookup joins, semi-joins and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from sazonal.operators.aggregate import distinct_values, keys_missing_target
from sazonal.operators.coverage import (
    bin_histogram,
    coverage_bins,
    coverage_filter,
    target_counts,
)
from sazonal.operators.lookup import municipality_map, panel_cases, panel_weather

from .common import dates_as_text, query, table


def _municipalities(spark, sf_dir):
    """Nations as municipalities: a code with a check digit, a name, a state code."""
    return table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") * 10 + F.col("n_regionkey")).alias("codigo_ibge"),
        F.col("n_name").alias("nome"),
        # One state has no row in the states table.
        F.when(F.col("n_regionkey") == 4, 99).otherwise(F.col("n_regionkey")).alias("codigo_uf"),
    )


def _states(spark, sf_dir):
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("codigo_uf"), F.col("r_name").alias("uf")
    )


@query("""
    SELECT n_name AS nome, r_name AS uf, n_nationkey AS codigo_municipio
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND n_regionkey <> 4""")
def municipality_lookup(spark, sf_dir):
    return municipality_map(_municipalities(spark, sf_dir), _states(spark, sf_dir)).select(
        "nome", "uf", F.col("codigo_municipio").cast("int")
    )


@query("""
    WITH codes AS (
        SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'F'
        UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'
        UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    SELECT c_custkey, c_name FROM customer SEMI JOIN codes USING (c_custkey)""")
def dimension_semi_reduce(spark, sf_dir):
    """A dimension reduced to the keys that occur in any of three files."""
    orders = table(spark, sf_dir, "orders")
    files = [orders.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    codes = distinct_values(files, "o_custkey", "c_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return customers.join(codes, "c_custkey", "left_semi")


@query("""
    SELECT CAST(o_orderdate AS DATE)::VARCHAR AS data, upper(r_name) AS uf, lower(n_name) AS municipio,
           count(*) AS casos_dengue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    WHERE n_regionkey <> 4 AND o_orderpriority <> '5-LOW'
    GROUP BY 1, 2, 3""")
def panel_cases_by_place(spark, sf_dir):
    """Orders as national notifications; unreadable dates and unknown places vanish."""
    homes = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").join(homes, F.col("o_custkey") == F.col("c_custkey"))
    text = F.when(F.col("o_orderpriority") == "5-LOW", "ignorado").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    cases = orders.select(text.alias("DT_NOTIFIC"), F.col("c_nationkey").alias("ID_MUNICIP"))
    codes = distinct_values([cases], "ID_MUNICIP", "codigo_municipio")
    places = municipality_map(_municipalities(spark, sf_dir), _states(spark, sf_dir), codes)
    return dates_as_text(panel_cases(cases, places))


@query("""
    WITH raw AS (
        SELECT event_type AS arquivo, CAST(ts AS DATE) AS data, hour(ts) AS hora,
               min_by(value, event_id) AS a, count(*) AS n FROM events GROUP BY 1, 2, 3),
    gaps AS (SELECT arquivo, data, hora, CASE WHEN a <= 80 THEN a END AS maxima, CAST(n AS DOUBLE) AS contagem FROM raw),
    filled AS (
        SELECT arquivo, data, contagem, coalesce(maxima, CASE WHEN count(maxima) OVER w >= 2 THEN avg(maxima) OVER w END) AS maxima
        FROM gaps WINDOW w AS (PARTITION BY arquivo ORDER BY data, hora ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
    daily AS (SELECT arquivo, data, avg(maxima) AS maxima, avg(contagem) AS contagem
              FROM filled WHERE maxima IS NOT NULL GROUP BY 1, 2)
    SELECT 'PE' AS uf, CASE WHEN arquivo IN ('click', 'view') THEN 'recife' ELSE arquivo END AS municipio,
           CAST(data AS VARCHAR) AS data, round(avg(maxima), 6) AS maxima, round(avg(contagem), 6) AS contagem
    FROM daily GROUP BY 1, 2, 3""")
def panel_weather_by_place(spark, sf_dir):
    """Hourly text readings of several stations, two of them in one city."""
    kind = F.col("event_type")
    city = F.when(kind.isin("click", "view"), "RECIFE").otherwise(F.upper(kind))
    hours = table(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("INMET_NE_pe_"), kind, F.lit("_"), city, F.lit("_2024.CSV")).alias("arquivo"),
        F.date_format("ts", "yyyy/MM/dd").alias("Data"),
        F.date_format("ts", "HHmm 'UTC'").substr(1, 2).alias("hora"),
    ).agg(F.min_by("value", "event_id").alias("a"), F.count("*").alias("n"))
    comma = F.translate(F.col("a").cast("string"), ".", ",")
    texts = hours.select(
        "arquivo",
        F.col("Data").alias("data"),
        "hora",
        F.when(F.col("a") <= 80, comma).otherwise("").alias("maxima"),
        F.col("n").cast("string").alias("contagem"),
        F.lit("7,5").alias("radiacao_global_kj_m"),
    )
    out = panel_weather(texts, bounded=True)
    return dates_as_text(
        out.select("uf", "municipio", "data", F.round("maxima", 6).alias("maxima"), F.round("contagem", 6).alias("contagem"))
    )


@query("""
    WITH days AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS data FROM orders),
    counts AS (SELECT o_custkey, count(*) AS n FROM days GROUP BY 1)
    SELECT o_custkey, CAST(data AS VARCHAR) AS data FROM days SEMI JOIN (
        SELECT o_custkey FROM counts WHERE n >= (SELECT max(n) / 2 FROM counts)) USING (o_custkey)""")
def coverage_filter_rows(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("data"))
    per_day = days.groupBy("o_custkey", "data").agg(F.count("*").alias("casos_dengue"))
    return dates_as_text(coverage_filter(per_day, ["o_custkey"], "casos_dengue").drop("casos_dengue"))


COUNTS = """
    counts AS (SELECT o_custkey, count(DISTINCT CAST(o_orderdate AS DATE)) AS qtd_exemplos_com_dengue
               FROM orders GROUP BY 1),
    binned AS (
        SELECT *, CASE WHEN qtd_exemplos_com_dengue < m * 0.25 THEN 'menos_de_1_quarto'
            WHEN qtd_exemplos_com_dengue < m * 0.5 THEN 'entre_1_e_2_quartos'
            WHEN qtd_exemplos_com_dengue < m * 0.75 THEN 'entre_2_e_3_quartos'
            ELSE 'entre_3_e_4_quartos' END AS faixa_qtd_exemplos
        FROM counts, (SELECT max(qtd_exemplos_com_dengue) AS m FROM counts))"""


def _coverage(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("data"))
    return target_counts(days.distinct(), ["o_custkey"], "data")


@query(f"WITH {COUNTS} SELECT o_custkey, qtd_exemplos_com_dengue, faixa_qtd_exemplos FROM binned")
def coverage_bin_labels(spark, sf_dir):
    return coverage_bins(_coverage(spark, sf_dir))


@query(f"""
    WITH {COUNTS}, bins AS (SELECT unnest(['menos_de_1_quarto', 'entre_1_e_2_quartos',
        'entre_2_e_3_quartos', 'entre_3_e_4_quartos']) AS faixa_qtd_exemplos)
    SELECT faixa_qtd_exemplos, count(o_custkey) AS qtd_municipios
    FROM bins LEFT JOIN binned USING (faixa_qtd_exemplos) GROUP BY 1""")
def coverage_histogram(spark, sf_dir):
    return bin_histogram(coverage_bins(_coverage(spark, sf_dir)))


@query("""
    SELECT DISTINCT c_nationkey, c_mktsegment FROM customer LEFT JOIN
        (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) ON o_custkey = c_custkey
    WHERE o_custkey IS NULL""")
def keys_without_target(spark, sf_dir):
    """Every order counts towards its buyer; only large ones are cases, and none is missing."""
    cases = F.count_if(F.col("o_totalprice") > 400000)
    buyers = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.nullif(cases, F.lit(0)).alias("casos_dengue")
    )
    joined = table(spark, sf_dir, "customer").join(
        buyers, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    return keys_missing_target(joined, ["c_nationkey", "c_mktsegment"], "casos_dengue")
