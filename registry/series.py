"""Windows, lags, daily aggregates and the datasets made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from sazonal.functions.dates import calendar_parts
from sazonal.operators.aggregate import count_per_key, mean_per_key, sum_per_key
from sazonal.operators.series import add_lags, lag_matrix, prior_window_mean, rolling_impute
from sazonal.plans.city import city_dataset, city_supervised, named_lags, weather_cases
from sazonal.plans.panel import lag_panel_dataset, panel_dataset, panel_supervised

from .common import (
    COLD, HOURLY, HUMIDITY, NOTIFICATIONS, PRESSURE, RAIN, READINGS, SENSORS,
    dates_as_text, hourly, notifications, query, readings, rounded, table,
)

WINDOW_DIGITS = {HUMIDITY: 6, PRESSURE: 6, RAIN: 6, COLD: 6}
DAILY = (
    "daily AS (SELECT data, "
    + ", ".join(f"avg({c}) AS {c}" for c in SENSORS)
    + " FROM readings GROUP BY data)"
)
PER_DAY = "per_day AS (SELECT data, count(*) AS contagem FROM notifications GROUP BY data)"


def prior_sql(col: str, n: int, over: str) -> str:
    frame = f"OVER ({over} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({col}) {frame} = {n} THEN avg({col}) {frame} END"


BEFORE = (
    "before AS (SELECT data, "
    + ", ".join(f"{prior_sql(c, 30, 'ORDER BY data')} AS {c}" for c in SENSORS)
    + " FROM daily)"
)
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in SENSORS)
ROUNDED = ", ".join(f"round({c}, {d}) AS {c}" for c, d in WINDOW_DIGITS.items())


@query(f"WITH {NOTIFICATIONS} SELECT CAST(data AS VARCHAR) AS data, count(*) AS contagem "
       "FROM notifications GROUP BY 1")
def daily_count(spark, sf_dir):
    return dates_as_text(count_per_key(notifications(spark, sf_dir), ["data"]))


@query(f"""
    WITH {HOURLY}
    SELECT CAST(data AS VARCHAR) AS data, avg(hora) AS hora, avg(round(valor * 100)) AS valor
    FROM hourly GROUP BY 1""")
def daily_mean(spark, sf_dir):
    whole = hourly(spark, sf_dir).withColumn("valor", F.round(F.col("valor") * 100))
    return dates_as_text(mean_per_key(whole, ["data"], ["hora", "valor"]))


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
           count(*) AS casos_dengue, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS chuva
    FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) IN (1996, 1997, 1998)
    GROUP BY 1, 2""")
def monthly_sum(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    dated = calendar_parts(orders.withColumn("data", F.to_date("o_orderdate")))
    chosen = dated.where(F.col("ano").isin(1996, 1997, 1998)).select(
        "ano",
        "mes",
        F.lit(1).cast("long").alias("casos_dengue"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("chuva"),
    )
    return sum_per_key(chosen, ["ano", "mes"], ["casos_dengue", "chuva"])


@query(f"WITH {READINGS}, {DAILY}, {BEFORE} SELECT CAST(data AS VARCHAR) AS data, {ROUNDED} FROM before")
def prior_window_mean_single(spark, sf_dir):
    daily = mean_per_key(readings(spark, sf_dir), ["data"], SENSORS)
    return dates_as_text(rounded(prior_window_mean(daily, SENSORS, bounded=True), WINDOW_DIGITS))


@query(f"""
    WITH {READINGS}, daily AS (
        SELECT estacao, data, avg({HUMIDITY}) AS {HUMIDITY}, avg({RAIN}) AS {RAIN}
        FROM readings GROUP BY 1, 2)
    SELECT estacao, CAST(data AS VARCHAR) AS data,
           round({prior_sql(HUMIDITY, 30, 'PARTITION BY estacao ORDER BY data')}, 6) AS {HUMIDITY},
           round({prior_sql(RAIN, 30, 'PARTITION BY estacao ORDER BY data')}, 6) AS {RAIN}
    FROM daily""")
def prior_window_mean_by_key(spark, sf_dir):
    cols = [HUMIDITY, RAIN]
    daily = mean_per_key(readings(spark, sf_dir), ["estacao", "data"], cols)
    out = prior_window_mean(daily, cols, ["data"], ["estacao"], bounded=True)
    return dates_as_text(rounded(out, {c: 6 for c in cols}))


@query(f"""
    WITH {HOURLY}
    SELECT event_id, arquivo, round(coalesce(valor, CASE WHEN count(valor) OVER w >= 2
           THEN quantile_cont(valor, 0.5) OVER w END), 6) AS valor
    FROM hourly
    WINDOW w AS (PARTITION BY arquivo ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def rolling_median_impute(spark, sf_dir):
    out = rolling_impute(
        hourly(spark, sf_dir), ["valor"], "median", 6, 2, ["ts", "event_id"], ["arquivo"]
    )
    return out.select("event_id", "arquivo", F.round("valor", 6).alias("valor"))


@query(f"""
    WITH {HOURLY}
    SELECT event_id, arquivo, round(coalesce(valor, CASE WHEN count(valor) OVER w >= 2
           THEN avg(valor) OVER w END), 6) AS valor
    FROM hourly
    WINDOW w AS (PARTITION BY arquivo ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def rolling_mean_impute(spark, sf_dir):
    out = rolling_impute(
        hourly(spark, sf_dir), ["valor"], "mean", 4, 2, ["ts", "event_id"], ["arquivo"]
    )
    return out.select("event_id", "arquivo", F.round("valor", 6).alias("valor"))


LAGS_SQL = ", ".join(
    f"lag({c}, {k}) OVER (ORDER BY data) AS {c}_lag_{k}"
    for c in (HUMIDITY, "contagem")
    for k in (7, 14, 21)
)
LAG_NAMES = [f"{c}_lag_{k}" for c in (HUMIDITY, "contagem") for k in (7, 14, 21)]


@query(f"""
    WITH {READINGS}, {NOTIFICATIONS}, {DAILY}, {PER_DAY}, lagged AS (
        SELECT data, {HUMIDITY}, contagem, {LAGS_SQL} FROM daily JOIN per_day USING (data))
    SELECT CAST(data AS VARCHAR) AS data, {HUMIDITY}, contagem, {', '.join(LAG_NAMES)} FROM lagged
    WHERE {LAG_NAMES[2]} IS NOT NULL AND {LAG_NAMES[5]} IS NOT NULL""")
def lag_features(spark, sf_dir):
    daily = mean_per_key(readings(spark, sf_dir), ["data"], [HUMIDITY])
    per_day = count_per_key(notifications(spark, sf_dir), ["data"])
    joined = daily.join(per_day, "data")
    return dates_as_text(add_lags(joined, [HUMIDITY, "contagem", "ausente"], bounded=True))


@query(f"""
    WITH {READINGS}, daily AS (
        SELECT estacao, data, avg({HUMIDITY}) AS umidade, avg({RAIN}) AS chuva
        FROM readings GROUP BY 1, 2)
    SELECT estacao, CAST(data AS VARCHAR) AS data, {', '.join(
        f'lag({c}, {k}) OVER w AS {c}_dia_{k}' for c in ('umidade', 'chuva') for k in range(1, 31))}
    FROM daily WINDOW w AS (PARTITION BY estacao ORDER BY data)""")
def lag_matrix_by_key(spark, sf_dir):
    named = readings(spark, sf_dir).withColumnsRenamed({HUMIDITY: "umidade", RAIN: "chuva"})
    daily = mean_per_key(named, ["estacao", "data"], ["umidade", "chuva"])
    return dates_as_text(
        lag_matrix(daily, ["umidade", "chuva"], 30, ["data"], ["estacao"], bounded=True)
    )


NAMED = {"casos": "casos", "numeric__temperatura_min_media_c": "temp_min"}
NAMED_COLS = [f"{n}_lag_{k}" for n in NAMED.values() for k in (7, 14, 21, 28)]


@query(f"""
    WITH {READINGS}, {NOTIFICATIONS}, {DAILY}, {PER_DAY}, joined AS (
        SELECT data, contagem AS casos, {COLD} AS numeric__temperatura_min_media_c
        FROM daily JOIN per_day USING (data)),
    lagged AS (SELECT *, {', '.join(
        f'lag({c}, {k}) OVER (ORDER BY data) AS {n}_lag_{k}'
        for c, n in NAMED.items() for k in (7, 14, 21, 28))} FROM joined)
    SELECT * REPLACE (CAST(data AS VARCHAR) AS data) FROM lagged
    WHERE casos_lag_28 IS NOT NULL AND temp_min_lag_28 IS NOT NULL""")
def named_lag_features(spark, sf_dir):
    daily = mean_per_key(readings(spark, sf_dir), ["data"], [COLD])
    per_day = count_per_key(notifications(spark, sf_dir), ["data"], "casos")
    joined = per_day.join(daily, "data").withColumnsRenamed(
        {COLD: "numeric__temperatura_min_media_c"}
    )
    return dates_as_text(named_lags(joined, "casos", bounded=True))


WEATHER_CASES = f"""
    WITH {READINGS}, {NOTIFICATIONS}, {DAILY}, {PER_DAY}, {BEFORE}, joined AS (
        SELECT * FROM before JOIN per_day USING (data) WHERE {COMPLETE})"""


@query(f"{WEATHER_CASES} SELECT CAST(data AS VARCHAR) AS data, {ROUNDED}, contagem FROM joined")
def weather_cases_join(spark, sf_dir):
    joined = weather_cases(notifications(spark, sf_dir), readings(spark, sf_dir), 30, SENSORS)
    return dates_as_text(rounded(joined, WINDOW_DIGITS))


CITY_NAMES = {
    HUMIDITY: "umidade_relativa_media",
    PRESSURE: "pressao_atmosferica_media_mb",
    RAIN: "precipitacao_total_media_mm",
    COLD: "temperatura_min_media_c",
}
CITY_DIGITS = {CITY_NAMES[c]: d for c, d in WINDOW_DIGITS.items()}
CITY_SQL = f"""{WEATHER_CASES}, city AS (
    SELECT data, {', '.join(f'{c} AS {n}' for c, n in CITY_NAMES.items())},
           contagem AS casos_dengue, CAST(year(data) AS INTEGER) AS ano,
           CAST(month(data) AS INTEGER) AS mes, CAST(day(data) AS INTEGER) AS dia,
           CAST(isodow(data) - 1 AS INTEGER) AS dia_da_semana
    FROM joined)"""
CITY_ROUNDED = ", ".join(f"round({c}, {d}) AS {c}" for c, d in CITY_DIGITS.items())


@query(f"{CITY_SQL} SELECT {CITY_ROUNDED}, casos_dengue, ano, mes, dia, dia_da_semana FROM city")
def city_dataset_daily(spark, sf_dir):
    out = city_dataset(notifications(spark, sf_dir), readings(spark, sf_dir), 30, SENSORS)
    return rounded(out, CITY_DIGITS)


CITY_LAGGED = ("temperatura_min_media_c", "precipitacao_total_media_mm", "casos_dengue")


@query(f"""{CITY_SQL}, lagged AS (
    SELECT *, {', '.join(f'lag({c}, {k}) OVER (ORDER BY data) AS {c}_lag_{k}'
                         for c in CITY_LAGGED for k in (7, 14, 21))} FROM city)
    SELECT {CITY_ROUNDED}, casos_dengue, ano, mes, dia, dia_da_semana,
           {', '.join(f'round({c}_lag_{k}, 6) AS {c}_lag_{k}' for c in CITY_LAGGED[:2] for k in (7, 14, 21))},
           casos_dengue_lag_7, casos_dengue_lag_14, casos_dengue_lag_21
    FROM lagged WHERE casos_dengue_lag_21 IS NOT NULL""")
def city_supervised_lags(spark, sf_dir):
    city = city_dataset(notifications(spark, sf_dir), readings(spark, sf_dir), 30, SENSORS)
    out, _ = city_supervised(city)
    lagged = {f"{c}_lag_{k}": 6 for c in CITY_LAGGED[:2] for k in (7, 14, 21)}
    return rounded(out, {**CITY_DIGITS, **lagged})


def _panel_inputs(spark, sf_dir):
    """Suppliers as places; returned lines as cases, all lines as readings."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("data"), "l_suppkey", "l_quantity", "l_discount", "l_returnflag"
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    def placed(per_day):
        # One lookup after the other, so that each is judged by its own size.
        named = per_day.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        return named.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("n_name").alias("uf"),
            F.col("s_name").alias("municipio"),
            *[c for c in per_day.columns if c != "l_suppkey"],
        )

    # Shrink to one row per place and day before the lookup.
    weather = lines.groupBy("l_suppkey", "data").agg(
        F.avg("l_quantity").alias("umidade"), F.avg(F.round(F.col("l_discount") * 100)).alias("chuva")
    )
    cases = (
        lines.where("l_returnflag = 'R'")
        .groupBy("l_suppkey", "data")
        .agg(F.count("*").alias("casos_dengue"))
    )
    return placed(weather), placed(cases)


PANEL_FRAC = 0.85
PANEL_INPUTS = """
    WITH places AS (
        SELECT s_suppkey, n_name AS uf, s_name AS municipio
        FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    weather AS (
        SELECT uf, municipio, CAST(l_shipdate AS DATE) AS data, avg(l_quantity) AS umidade,
               avg(round(l_discount * 100)) AS chuva
        FROM lineitem JOIN places ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
    cases AS (
        SELECT uf, municipio, CAST(l_shipdate AS DATE) AS data, count(*) AS casos_dengue
        FROM lineitem JOIN places ON l_suppkey = s_suppkey WHERE l_returnflag = 'R'
        GROUP BY 1, 2, 3)"""
PANEL_TAIL = f"""
    joined AS (SELECT * FROM before LEFT JOIN cases USING (uf, municipio, data)),
    counts AS (SELECT uf, municipio, count(*) AS n FROM joined
               WHERE casos_dengue IS NOT NULL GROUP BY 1, 2),
    kept AS (SELECT * FROM joined SEMI JOIN (
                SELECT uf, municipio FROM counts WHERE n >= (SELECT max(n) * {PANEL_FRAC} FROM counts)
             ) USING (uf, municipio) WHERE casos_dengue IS NOT NULL)"""
PARTS = """CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
           CAST(day(data) AS INTEGER) AS dia, CAST(isodow(data) - 1 AS INTEGER) AS dia_da_semana"""
OVER_PLACE = "PARTITION BY uf, municipio ORDER BY data"
PANEL_SQL = f"""{PANEL_INPUTS}, before AS (
        SELECT uf, municipio, data, {prior_sql('umidade', 30, OVER_PLACE)} AS umidade,
               {prior_sql('chuva', 30, OVER_PLACE)} AS chuva FROM weather), {PANEL_TAIL}
    SELECT uf, municipio, round(umidade, 6) AS umidade, round(chuva, 6) AS chuva, casos_dengue, {PARTS}
    FROM kept WHERE umidade IS NOT NULL AND chuva IS NOT NULL"""


@query(PANEL_SQL)
def panel_dataset_by_place(spark, sf_dir):
    out = panel_dataset(*_panel_inputs(spark, sf_dir), 30, PANEL_FRAC)
    return rounded(out, {"umidade": 6, "chuva": 6})


@query(f"""
    SELECT umidade, chuva, casos_dengue, ano, mes, dia, dia_da_semana,
           CAST(make_date(ano, mes, dia) AS VARCHAR) AS data FROM ({PANEL_SQL})""")
def panel_supervised_rows(spark, sf_dir):
    panel = rounded(
        panel_dataset(*_panel_inputs(spark, sf_dir), 30, PANEL_FRAC), {"umidade": 6, "chuva": 6}
    )
    out, _ = panel_supervised(panel)
    return dates_as_text(out)


@query(f"""{PANEL_INPUTS}, before AS (
        SELECT uf, municipio, data, {', '.join(
            f'lag({c}, {k}) OVER ({OVER_PLACE}) AS {c}_dia_{k}'
            for c in ('umidade', 'chuva') for k in range(1, 31))} FROM weather), {PANEL_TAIL}
    SELECT * EXCLUDE (data), {PARTS} FROM kept
    WHERE umidade_dia_30 IS NOT NULL AND chuva_dia_30 IS NOT NULL""")
def lag_panel_dataset_by_place(spark, sf_dir):
    return lag_panel_dataset(*_panel_inputs(spark, sf_dir), 30, PANEL_FRAC)
