"""Parsing, null handling and column choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from sazonal.functions import dates as D
from sazonal.functions.encode import encode_calendar, millis_to_seconds, share_to_percent
from sazonal.functions.missing import (
    drop_missing,
    drop_sparse_rows,
    nonfinite_to_null,
    numeric_columns,
    sentinel_to_null,
)
from sazonal.functions.names import fold_accents, slug, strip_prefixes
from sazonal.functions.text import decimal_comma, lower_key, upper_key
from sazonal.operators.aggregate import first_per_key, last_rows, sort_nulls_last
from sazonal.operators.clean import clean_weather, mask_sparse_columns
from sazonal.operators.profile import drop_sparse_columns
from sazonal.operators.schema import (
    FEATURE_NAMES,
    drop_matching,
    rename_present,
    require_columns,
    union_all,
)

from .common import HOURLY, dates_as_text, hourly, query, table

# File year of a notification: spreads the order years over all date formats.
YEAR_SHIFT = 19


@query(f"""
    WITH texts AS (
        SELECT o_orderkey AS id, CAST(year(o_orderdate) + {YEAR_SHIFT} AS INTEGER) AS ano,
               o_orderpriority, o_orderdate AS t FROM orders),
    written AS (
        SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN strftime(t, '%d.%m.%Y')
            WHEN ano < 2015 THEN strftime(t, '%Y/%m/%d %H:%M:%S')
            WHEN ano BETWEEN 2015 AND 2020 THEN strftime(t, '%Y-%m-%d')
            ELSE strftime(t, '%d/%m/%Y') END AS texto FROM texts)
    SELECT id, ano, CAST(CAST(CASE WHEN ano < 2015 THEN try_strptime(texto, '%Y/%m/%d %H:%M:%S')
            WHEN ano BETWEEN 2015 AND 2020 THEN try_strptime(texto, '%Y-%m-%d')
            ELSE try_strptime(texto, '%d/%m/%Y') END AS DATE) AS VARCHAR) AS data
    FROM written""")
def parse_notification_dates(spark, sf_dir):
    t = F.col("o_orderdate")
    ano = (F.year(t) + YEAR_SHIFT).alias("ano")
    orders = table(spark, sf_dir, "orders").select("*", ano)
    texto = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_format(t, "dd.MM.yyyy"))
        .when(F.col("ano") < 2015, F.date_format(t, D.FORMAT_TO_2014))
        .when(F.col("ano") <= 2020, F.date_format(t, D.FORMAT_ISO))
        .otherwise(F.date_format(t, D.FORMAT_DAY_FIRST))
    )
    parsed = D.notification_time(texto, F.col("ano")).cast("date")
    return dates_as_text(orders.select(F.col("o_orderkey").alias("id"), "ano", parsed.alias("data")))


@query("""
    WITH texts AS (
        SELECT event_id, event_type, CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d')
               WHEN 'view' THEN strftime(ts, '%Y/%m/%d') WHEN 'error' THEN 'sem data'
               ELSE CAST(CAST(ts AS DATE) AS VARCHAR) || ' 10:30:00' END AS texto FROM events)
    SELECT event_id,
           CAST(CAST(coalesce(try_strptime(texto, '%Y/%m/%d'), try_strptime(texto, '%Y-%m-%d')) AS DATE) AS VARCHAR) AS estacao,
           CAST(CASE WHEN event_type IN ('click', 'signup', 'purchase')
                THEN CAST(left(texto, 10) AS DATE) END AS VARCHAR) AS dia
    FROM texts""")
def parse_station_dates(spark, sf_dir):
    kind, ts = F.col("event_type"), F.col("ts")
    texto = (
        F.when(kind == "click", F.date_format(ts, D.STATION_DASHED))
        .when(kind == "view", F.date_format(ts, D.STATION_SLASHED))
        .when(kind == "error", "sem data")
        .otherwise(F.concat(F.to_date(ts).cast("string"), F.lit(" 10:30:00")))
    )
    out = table(spark, sf_dir, "events").select(
        "event_id",
        D.station_date(texto).alias("estacao"),
        D.day_of(texto).alias("dia"),
    )
    return dates_as_text(out)


@query("""
    SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS ano,
           CAST(month(o_orderdate) AS INTEGER) AS mes, CAST(1 + o_custkey % 31 AS INTEGER) AS dia,
           CAST(TRY_CAST(strftime(o_orderdate, '%Y-%m-') || (1 + o_custkey % 31) AS DATE) AS VARCHAR) AS data
    FROM orders""")
def date_from_parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").alias("ano"),
        F.month("o_orderdate").alias("mes"),
        (1 + F.col("o_custkey") % 31).cast("int").alias("dia"),
    )
    return dates_as_text(D.with_date(orders))


@query("""
    SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS ano,
           CAST(month(o_orderdate) AS INTEGER) AS mes, CAST(day(o_orderdate) AS INTEGER) AS dia,
           CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dia_da_semana
    FROM orders""")
def calendar_parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("data")
    )
    return D.calendar_parts(orders).drop("data")


@query("""
    SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS ano,
           round(sin(2 * pi() * month(o_orderdate) / 12), 9) AS mes_sin,
           round(cos(2 * pi() * month(o_orderdate) / 12), 9) AS mes_cos,
           round(sin(2 * pi() * day(o_orderdate) / 31), 9) AS dia_sin,
           round(cos(2 * pi() * day(o_orderdate) / 31), 9) AS dia_cos,
           round(sin(2 * pi() * (isodow(o_orderdate) - 1) / 7), 9) AS dia_da_semana_sin,
           round(cos(2 * pi() * (isodow(o_orderdate) - 1) / 7), 9) AS dia_da_semana_cos
    FROM orders""")
def cyclical(spark, sf_dir):
    encoded = encode_calendar(calendar_parts(spark, sf_dir))
    # Adding zero turns a rounded -0.0 into 0.0.
    waves = [c for c in encoded.columns if c.endswith(("_sin", "_cos"))]
    return encoded.withColumns({c: F.round(c, 9) + 0.0 for c in waves})


@query("""
    SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN NULL ELSE hour(ts) END AS INTEGER) AS hora
    FROM events""")
def hour_parse(spark, sf_dir):
    kind, ts = F.col("event_type"), F.col("ts")
    texto = (
        F.when(kind.isin("click", "view"), F.date_format(ts, "HH:mm"))
        .when(kind == "error", "n/d")
        .otherwise(F.concat(F.date_format(ts, "HHmm"), F.lit(" UTC")))
    )
    return table(spark, sf_dir, "events").select("event_id", D.station_hour(texto).alias("hora"))


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS valor FROM events""")
def decimal_comma_values(spark, sf_dir):
    written = F.concat(F.lit("  "), F.translate(F.col("value").cast("string"), ".", ","), F.lit(" "))
    texto = F.when(F.col("event_type") == "error", "erro").otherwise(written)
    return table(spark, sf_dir, "events").select("event_id", decimal_comma(texto).alias("valor"))


@query("""
    SELECT c_custkey, upper(trim('  ' || c_mktsegment || ' ')) AS uf,
           lower(trim(c_name || '  ')) AS municipio,
           coalesce(nullif(trim(regexp_replace(lower('  ' || c_name || '!!'), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'automl') AS pasta
    FROM customer""")
def key_normalization(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        upper_key(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("uf"),
        lower_key(F.concat("c_name", F.lit("  "))).alias("municipio"),
        slug(F.concat(F.lit("  "), "c_name", F.lit("!!"))).alias("pasta"),
    )


@query("""SELECT doc_id, md5(strip_accents(lower(text))) AS texto FROM documents""")
def accent_folding(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(fold_accents(F.col("text"))).alias("texto"))


SENSOR_LIMITS = {"valor": 10.0, "umidade": 20.0, "chuva": 40.0}
GAPPY = """
    gappy AS (
        SELECT event_id, event_type AS arquivo, ts,
               CASE WHEN value >= 10 THEN value END AS valor,
               CASE WHEN value >= 20 AND event_type <> 'view' THEN value * 2 END AS umidade,
               CASE WHEN value >= 40 THEN value + 1 END AS chuva FROM events)"""


def gappy(spark, sf_dir):
    """Three sensors with different shares of missing readings; one file lacks one."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("arquivo"),
        "ts",
        F.when(value >= 10, value).alias("valor"),
        F.when((value >= 20) & (F.col("event_type") != "view"), value * 2).alias("umidade"),
        F.when(value >= 40, value + 1).alias("chuva"),
    )


@query(f"""
    WITH {GAPPY} SELECT event_id, valor, umidade, chuva FROM gappy
    WHERE (CAST(valor IS NULL AS INT) + CAST(umidade IS NULL AS INT) + CAST(chuva IS NULL AS INT)) / 4.0 < 0.6""")
def null_fraction_rows(spark, sf_dir):
    return drop_sparse_rows(gappy(spark, sf_dir).select("event_id", "valor", "umidade", "chuva"))


@query(f"""WITH {GAPPY} SELECT event_id, arquivo, valor FROM gappy""")
def null_fraction_columns(spark, sf_dir):
    """Two of three sensors miss more than 40 % of all rows and go."""
    return drop_sparse_columns(gappy(spark, sf_dir).drop("ts"), 0.4)


@query(f"""
    WITH {GAPPY}, shares AS (
        SELECT arquivo, avg(CAST(valor IS NULL AS INT)) AS a, avg(CAST(umidade IS NULL AS INT)) AS b,
               avg(CAST(chuva IS NULL AS INT)) AS c FROM gappy GROUP BY 1)
    SELECT event_id, CASE WHEN a < 0.45 THEN valor END AS valor,
           CASE WHEN b < 0.45 THEN umidade END AS umidade
    FROM gappy JOIN shares USING (arquivo)""")
def mask_sparse_by_file(spark, sf_dir):
    """A sensor is nulled in the files where it is too sparse, dropped when in all."""
    out, names = mask_sparse_columns(
        gappy(spark, sf_dir), ["arquivo"], ["valor", "umidade", "chuva"], 0.45
    )
    return out.select("event_id", *names)


@query(f"""
    WITH raw AS (
        SELECT event_type AS arquivo, CAST(ts AS DATE) AS data, CAST(hour(ts) AS INTEGER) AS hora,
               min_by(value, event_id) AS a, max_by(value, event_id) AS b
        FROM events GROUP BY 1, 2, 3),
    readings AS (
        SELECT arquivo, data, hora, CASE WHEN a <= 60 THEN a END AS maxima,
               CASE WHEN b >= 4 THEN b END AS minima FROM raw),
    shares AS (SELECT arquivo, avg(CAST(maxima IS NULL AS INT)) < 0.6 AS ka,
                      avg(CAST(minima IS NULL AS INT)) < 0.6 AS kb FROM readings GROUP BY 1),
    masked AS (
        SELECT arquivo, data, hora, ka, kb, CASE WHEN ka THEN maxima END AS maxima,
               CASE WHEN kb THEN minima END AS minima FROM readings JOIN shares USING (arquivo)),
    filled AS (
        SELECT arquivo, data, hora, ka, kb,
               coalesce(maxima, CASE WHEN count(maxima) OVER w >= 2 THEN quantile_cont(maxima, 0.5) OVER w END) AS maxima,
               coalesce(minima, CASE WHEN count(minima) OVER w >= 2 THEN quantile_cont(minima, 0.5) OVER w END) AS minima
        FROM masked WINDOW w AS (PARTITION BY arquivo ORDER BY data, hora ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
    SELECT arquivo, CAST(data AS VARCHAR) AS data, hora, round(maxima, 6) AS maxima, round(minima, 6) AS minima
    FROM filled
    WHERE (CAST(ka AND maxima IS NULL AS INT) + CAST(kb AND minima IS NULL AS INT))
          / (2.0 + CAST(ka AS INT) + CAST(kb AS INT)) < 0.4""")
def clean_weather_readings(spark, sf_dir):
    """The whole cleaning of station readings, from text dates and a sentinel."""
    events = table(spark, sf_dir, "events")
    raw = events.groupBy(
        F.col("event_type").alias("arquivo"), F.to_date("ts").alias("data"), F.hour("ts").alias("hora")
    ).agg(F.min_by("value", "event_id").alias("a"), F.max_by("value", "event_id").alias("b"))
    gone = F.lit(-9999.0)
    texts = raw.select(
        "arquivo",
        F.year("data").alias("ano_arquivo"),
        F.date_format("data", "yyyy/MM/dd").alias("data_yyyy_mm_dd"),
        F.format_string("%02d00 UTC", "hora").alias("hora_utc"),
        F.when(F.col("a") <= 60, F.col("a")).otherwise(gone).alias("maxima"),
        F.when(F.col("b") >= 4, F.col("b")).otherwise(gone).alias("minima"),
        F.lit(1.0).alias("vento_rajada_maxima_m_s"),
    )
    # Hours bound a file's rows, so each file is one short series.
    out = clean_weather(texts, max_col_null=0.6, max_row_null=0.4, bounded=True)
    return dates_as_text(
        out.select("arquivo", "data", "hora", F.round("maxima", 6).alias("maxima"), F.round("minima", 6).alias("minima"))
    )


@query("""
    SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view', 'signup') THEN value END AS valor
    FROM events WHERE event_type <> 'click'""")
def missing_markers(spark, sf_dir):
    """Sentinel, NaN and infinities all become null; rows without a key are dropped."""
    kind = F.col("event_type")
    valor = (
        F.when(kind == "error", F.lit(-9999.0))
        .when(kind == "view", F.lit(float("nan")))
        .when(kind == "signup", F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    marked = table(spark, sf_dir, "events").select(
        "event_id", valor.alias("valor"), F.when(kind != "click", kind).alias("arquivo")
    )
    clean = sentinel_to_null(nonfinite_to_null(marked), cols=["valor"])
    return drop_missing(clean, ["arquivo"]).drop("arquivo")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1""")
def first_line_per_order(spark, sf_dir):
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *order)
    return first_per_key(lines, ["l_orderkey"], order)


@query("""
    SELECT CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_suppkey END AS id, min(l_partkey) AS l_partkey
    FROM lineitem GROUP BY 1""")
def first_per_null_key(spark, sf_dir):
    """Null ids, a third of the rows, collapse to one row."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "A", F.col("l_suppkey")).alias("id"), "l_partkey"
    )
    return first_per_key(lines, ["id"], ["l_partkey"])


@query("""
    SELECT l_orderkey, l_quantity AS umidade_relativa_media, l_tax AS temperatura_min_media_c
    FROM lineitem""")
def feature_renames(spark, sf_dir):
    """Pattern and exact drops, then the sensor names."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_quantity").alias("umidade_relativa_do_ar_horaria"),
        F.col("l_tax").alias("temperatura_minima_na_hora_ant_aut_c"),
        F.col("l_discount").alias("RADIACAO GLOBAL (Kj/m)"),
        F.col("l_linestatus").alias("Unnamed: 19"),
    )
    kept = drop_matching(lines).drop("hora", "vento_rajada_maxima_m_s")
    require_columns(kept, ["l_orderkey"])
    return rename_present(kept, FEATURE_NAMES)


@query("""
    SELECT o_orderkey AS id, o_totalprice AS valor, NULL::INTEGER AS linha FROM orders
    UNION ALL SELECT l_orderkey, l_extendedprice, l_linenumber FROM lineitem""")
def union_tolerant(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("valor")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("linha"),
        F.col("l_extendedprice").alias("valor"),
        F.col("l_orderkey").alias("id"),
    )
    return union_all([orders, lines])


@query(f"""
    WITH {HOURLY} SELECT event_id, valor FROM hourly
    ORDER BY valor ASC NULLS LAST, event_id LIMIT 50""")
def sorted_nulls_last_head(spark, sf_dir):
    return sort_nulls_last(hourly(spark, sf_dir), ["valor", "event_id"]).select("event_id", "valor").limit(50)


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS VARCHAR)[1:10] AS data FROM orders
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""")
def last_rows_by_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("data"))
    return dates_as_text(last_rows(orders, 10, ["data", "o_orderkey"]))


@query("""
    SELECT event_id, value / 1000.0 AS segundos, value * 100.0 AS percentual FROM events""")
def unit_conversion(spark, sf_dir):
    """Numeric columns found by type, then converted; encoder prefixes removed."""
    events = table(spark, sf_dir, "events").drop("ts", "event_type", "props", "user_id")
    assert numeric_columns(events, exclude=("event_id",)) == ["value"]
    out = events.select(
        F.col("event_id").alias("remainder__event_id"),
        millis_to_seconds(F.col("value")).alias("remainder__segundos"),
        share_to_percent(F.col("value")).alias("onehot__percentual"),
    )
    return strip_prefixes(out)
