"""Files written out of the tables, then read by the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from sazonal.functions.dates import station_date, station_hour
from sazonal.operators.clean import clean_cases
from sazonal.operators.profile import column_presence
from sazonal.operators.schema import STATION_NAMES, rename_present
from sazonal.plans.city import STATION_FILE, build_city
from sazonal.reports.compare import compare_runs
from sazonal.session import scratch_path
from sazonal.sinks import write_dataset, write_predictions, write_report
from sazonal.sources.files import load_first, load_or_build, load_positional, read_columns
from sazonal.sources.headed import file_catalogue
from sazonal.sources.notifications import COMMA_YEARS, FILE_NAME, read_notifications
from sazonal.sources.runs import history_records, load_runs
from sazonal.sources.stations import read_stations, sensors_as_numbers, station_headers

from .common import dates_as_text, query, rounded, table
from .modelling import FITTED, _scored

# Order years and the file years they are written under: all date formats occur.
FILE_YEARS = {1995: 2013, 1996: 2014, 1997: 2015, 1998: 2018, 1999: 2019, 2000: 2020, 2001: 2021}
FILE_YEAR_SQL = "CASE year({0}) " + " ".join(f"WHEN {a} THEN {b}" for a, b in FILE_YEARS.items()) + " END"


def write_notifications(spark, sf_dir) -> str:
    """Yearly notification files with each era's names, separator and date format; the cells
    of the first column hold line breaks, separators and quotes."""
    folder = scratch_path(spark, "notifications")
    orders = table(spark, sf_dir, "orders")
    for year, file_year in FILE_YEARS.items():
        fmt = (
            "yyyy/MM/dd HH:mm:ss" if file_year < 2015
            else "yyyy-MM-dd" if file_year < 2021 else "dd/MM/yyyy"
        )
        names = (
            ("Nú_Notificação", "DT NOTIFICACAO") if file_year < 2021 else ("NU_NOTIFIC", "dt_notific")
        )
        start, end = f"{year}-01-01", f"{year + 1}-01-01"
        rows = orders.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end)).select(
            F.concat("o_orderpriority", F.lit('\n"centro", norte;\n')).alias("bairro"),
            F.date_format("o_orderdate", fmt).alias(names[1]),
            F.col("o_orderkey").alias(names[0]),
        )
        sep = "," if file_year in COMMA_YEARS else ";"
        rows.write.csv(f"{folder}/{FILE_NAME.format(year=file_year)}", header=True, sep=sep, escape='"')
    return folder


@query(f"""
    SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data,
           CAST({FILE_YEAR_SQL.format('o_orderdate')} AS INTEGER) AS ano_arquivo
    FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2001""")
def notification_files(spark, sf_dir):
    raw = read_notifications(spark, write_notifications(spark, sf_dir), FILE_YEARS.values())
    cases = clean_cases(raw)
    return dates_as_text(cases.withColumn("id", F.col("id").try_cast("long")))


PREAMBLE = [
    "REGIAO:;NE", "UF:;PE", "ESTAÇÃO:;RECIFE", "CODIGO (WMO):;A301", "LATITUDE:;-8,05",
    "LONGITUDE:;-34,95", "ALTITUDE:;11,3", "DATA DE FUNDAÇÃO:;22/12/04",
]


def write_station(hours, path: str, titles: list[str]) -> None:
    """One station file: preamble, header, then a line per hour.

    ``hours`` has ``seq`` and ``line``; hours bound its length, so it is one part.
    """
    spark = hours.sparkSession
    head = [(i - 9, line) for i, line in enumerate([*PREAMBLE, ";".join(titles) + ";"])]
    lines = spark.createDataFrame(head, "seq long, line string").unionByName(hours)
    one = lines.repartition(1).sortWithinPartitions("seq").select("line")
    one.write.csv(path, encoding="ISO-8859-1", quote="", sep="\u0001", emptyValue="")


def _comma(c):
    return F.translate(F.col(c).cast("string"), ".", ",")


OLD_TITLES = ["DATA (YYYY-MM-DD)", "HORA (UTC)"]
NEW_TITLES = ["Data", "Hora UTC"]
RAIN_TITLE = "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)"
WET_TITLE = "UMIDADE RELATIVA DO AR, HORARIA (%)"


def write_stations(spark, sf_dir) -> str:
    """A file per event type, in two layouts; one lacks a column."""
    folder = scratch_path(spark, "stations")
    events = table(spark, sf_dir, "events")
    hours = events.groupBy(
        "event_type", F.to_date("ts").alias("data"), F.hour("ts").alias("hora")
    ).agg(F.max("value").alias("a"), F.count("*").cast("double").alias("b")).persist()
    for kind in ("click", "error", "purchase", "signup", "view"):
        old, short = kind in ("click", "view"), kind == "error"
        day = F.date_format("data", "yyyy-MM-dd" if old else "yyyy/MM/dd")
        hour = F.format_string("%02d:00" if old else "%02d00 UTC", "hora")
        sensors = [_comma("a")] if short else [_comma("a"), _comma("b")]
        lines = hours.where(F.col("event_type") == kind).select(
            (F.unix_date("data") * 24 + F.col("hora")).cast("long").alias("seq"),
            F.concat(F.concat_ws(";", day, hour, *sensors), F.lit(";")).alias("line"),
        )
        titles = (OLD_TITLES if old else NEW_TITLES) + ([RAIN_TITLE] if short else [RAIN_TITLE, WET_TITLE])
        name = f"INMET_NE_PE_A301_{kind}_{2018 if old else 2024}.CSV"
        write_station(lines, f"{folder}/{name}", titles)
    hours.unpersist()
    return f"{folder}/*.CSV"


STATION_HOURS = """
    hours AS (
        SELECT 'INMET_NE_PE_A301_' || event_type || CASE WHEN event_type IN ('click', 'view') THEN '_2018.CSV' ELSE '_2024.CSV' END AS arquivo,
               event_type, CAST(ts AS DATE) AS data, CAST(hour(ts) AS INTEGER) AS hora, max(value) AS a,
               CAST(count(*) AS DOUBLE) AS b FROM events GROUP BY 1, 2, 3, 4)"""


@query(f"""
    WITH {STATION_HOURS}
    SELECT arquivo, CAST(CASE WHEN event_type IN ('click', 'view') THEN 2018 ELSE 2024 END AS INTEGER) AS ano_arquivo,
           CAST(data AS VARCHAR) AS data, hora, a AS precipitacao_total_horario_mm,
           CASE WHEN event_type <> 'error' THEN b END AS umidade_relativa_do_ar_horaria
    FROM hours""")
def station_files(spark, sf_dir):
    """Preambles, two header layouts, Latin-1 names and decimal commas."""
    raw = read_stations(spark, write_stations(spark, sf_dir))
    out = rename_present(sensors_as_numbers(raw), STATION_NAMES).select(
        "arquivo",
        "ano_arquivo",
        station_date(F.col("data"), F.col("ano_arquivo")).alias("data"),
        station_hour(F.col("hora")).alias("hora"),
        "precipitacao_total_horario_mm",
        "umidade_relativa_do_ar_horaria",
    )
    return dates_as_text(out)


@query(f"""
    WITH {STATION_HOURS}
    SELECT CAST(CASE WHEN event_type IN ('click', 'view') THEN 2018 ELSE 2024 END AS INTEGER) AS ano, arquivo,
           count(*) AS qtd_linhas, CAST(CASE WHEN event_type = 'error' THEN 3 ELSE 4 END AS INTEGER) AS qtd_colunas
    FROM hours GROUP BY 1, 2, 4""")
def station_catalogue(spark, sf_dir):
    return file_catalogue(read_stations(spark, write_stations(spark, sf_dir))).drop("caminho")


@query(f"""
    SELECT * FROM (VALUES ('data_yyyy_mm_dd', 2::BIGINT), ('data', 3), ('hora_utc', 5),
        ('precipitacao_total_horario_mm', 5), ('umidade_relativa_do_ar_horaria', 4)) t(coluna, qtd_arquivos)
    WHERE EXISTS (SELECT 1 FROM events)""")
def station_header_presence(spark, sf_dir):
    return column_presence(station_headers(spark, write_stations(spark, sf_dir)))


def write_city_stations(spark, sf_dir) -> str:
    """Order lines as hourly station files of each file year; the line number is the hour."""
    folder = scratch_path(spark, "city-stations")
    hours = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("data"), F.col("l_linenumber").alias("hora"))
        .agg(
            F.min(F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"))["l_quantity"].alias("a"),
            F.min("l_quantity").alias("b"),
        )
        .persist()
    )
    for year, file_year in FILE_YEARS.items():
        old = file_year < 2019
        day = F.date_format("data", "yyyy-MM-dd" if old else "yyyy/MM/dd")
        hour = F.format_string("%02d:00" if old else "%02d00 UTC", "hora")
        rain = F.when(F.col("a") >= 42, "-9999").otherwise(_comma("a"))
        lines = hours.where(F.year("data") == year).select(
            (F.unix_date("data") * 24 + F.col("hora")).cast("long").alias("seq"),
            F.concat(F.concat_ws(";", day, hour, rain, _comma("b")), F.lit(";")).alias("line"),
        )
        titles = [*(OLD_TITLES if old else NEW_TITLES), RAIN_TITLE, WET_TITLE]
        write_station(lines, f"{folder}/{STATION_FILE.format(year=file_year)}", titles)
    hours.unpersist()
    return folder


@query("""
    WITH hours AS (
        SELECT CAST(l_shipdate AS DATE) AS data, year(l_shipdate) AS f, l_linenumber AS hora,
               min({a: l_orderkey, b: l_partkey, c: l_suppkey, d: l_quantity}).d AS a, min(l_quantity) AS b
        FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 2001 GROUP BY 1, 2, 3),
    gaps AS (SELECT data, f, hora, CASE WHEN a < 42 THEN a END AS a, b FROM hours),
    shares AS (SELECT f, avg(CAST(a IS NULL AS INT)) < 0.3 AS ka, avg(CAST(b IS NULL AS INT)) < 0.3 AS kb FROM gaps GROUP BY 1),
    masked AS (SELECT data, f, hora, ka, kb, CASE WHEN ka THEN a END AS a, CASE WHEN kb THEN b END AS b
               FROM gaps JOIN shares USING (f)),
    filled AS (
        SELECT data, hora, ka, kb, coalesce(a, CASE WHEN count(a) OVER w >= 2 THEN quantile_cont(a, 0.5) OVER w END) AS a, b
        FROM masked WINDOW w AS (PARTITION BY f ORDER BY data, hora ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
    kept AS (SELECT * FROM filled
             WHERE (CAST(ka AND a IS NULL AS INT) + CAST(kb AND b IS NULL AS INT)) / (2.0 + CAST(ka AS INT) + CAST(kb AS INT)) < 0.6),
    daily AS (SELECT data, avg(hora) AS h, avg(a) AS a, avg(b) AS b FROM kept GROUP BY 1),
    before AS (
        SELECT data, CASE WHEN count(h) OVER w = 30 THEN avg(h) OVER w END AS h,
               CASE WHEN count(a) OVER w = 30 THEN avg(a) OVER w END AS a,
               CASE WHEN count(b) OVER w = 30 THEN avg(b) OVER w END AS b
        FROM daily WINDOW w AS (ORDER BY data ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
    cases AS (SELECT CAST(o_orderdate AS DATE) AS data, count(*) AS casos_dengue FROM orders
              WHERE year(o_orderdate) BETWEEN 1995 AND 2001 GROUP BY 1)
    SELECT round(a, 6) AS precipitacao_total_media_mm, round(b, 6) AS umidade_relativa_media, casos_dengue,
           CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
           CAST(day(data) AS INTEGER) AS dia, CAST(isodow(data) - 1 AS INTEGER) AS dia_da_semana
    FROM before JOIN cases USING (data) WHERE h IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL""")
def city_from_files(spark, sf_dir):
    """The single-city dataset from yearly files on disk to model-ready rows."""
    cases, weather = write_notifications(spark, sf_dir), write_city_stations(spark, sf_dir)
    out = build_city(spark, cases, weather, FILE_YEARS.values())
    return rounded(out, {"precipitacao_total_media_mm": 6, "umidade_relativa_media": 6})


# Framework, metric and form of history that event types take in turn.
RUN_KINDS = (
    ("h2o", "RMSE", "csv"), ("h2o", "MSE", "list"), ("tpot", None, "columns"),
    ("tpot", None, "labels"), ("tpot", None, "report"),
)


def write_runs(spark, sf_dir) -> str:
    """One stored run per event type: documents and a history of 24 models."""
    base = scratch_path(spark, "runs")
    events = table(spark, sf_dir, "events")
    models = events.groupBy("event_type", F.hour("ts").alias("model")).agg(F.max("value").alias("top"))
    models = models.persist()
    kinds = sorted(r.event_type for r in models.select("event_type").distinct().collect())
    for at, kind in enumerate(kinds):
        framework, metric, form = RUN_KINDS[at % len(RUN_KINDS)]
        mine = models.where(F.col("event_type") == kind)
        folder = f"{base}/{framework}/{kind}"
        seconds = F.count("*").cast("string")
        metadata = mine.agg(
            F.lit(kind).alias("preset"),
            F.lit("neg_rmse" if framework == "h2o" else "").alias("optimization_metric"),
            F.concat(seconds, F.lit(",5 s")).alias("training_time_seconds"),
        )
        best = mine.agg(
            F.lit(f"modelo {kind} é").alias("model_name"),
            F.lit(framework.upper()).alias("model_family"),
            F.struct(
                F.lit(metric).alias("metric"), F.min("top").alias("value"), F.lit("x").alias("source")
            ).alias("score"),
        )
        write_report(metadata, f"{folder}/metadata.json")
        write_report(best, f"{folder}/best_model.json")
        negated = mine.select(
            F.concat(F.lit("m, "), F.col("model").cast("string")).alias("model_id"),
            (-F.col("top")).alias("neg_root_mean_squared_error"),
        )
        if form == "csv":
            write_dataset(negated, f"{folder}/search_history.csv", "csv")
            continue
        rows = F.collect_list(F.struct("*"))
        document = {
            "list": rows,
            "columns": F.struct(*[F.collect_list(c).alias(c) for c in negated.columns]),
            "labels": F.struct(*[
                F.map_from_entries(F.collect_list(F.struct("model_id", c))).alias(c) for c in negated.columns
            ]),
            "report": F.struct(rows.alias("search_history"), F.lit(1).alias("version")),
        }[form]
        name = "report" if form == "report" else "search_history"
        negated.agg(F.to_json(document).alias("value")).write.text(f"{folder}/{name}.json")
    models.unpersist()
    # A folder without any document is still a run.
    write_dataset(events.limit(0), f"{base}/h2o/vazia/artifacts")
    return base


RUN_ROWS = """
    models AS (SELECT event_type AS kind, hour(ts) AS h, max(value) AS top FROM events GROUP BY 1, 2),
    kinds AS (SELECT kind, (row_number() OVER (ORDER BY kind) - 1) % 5 AS form FROM (SELECT DISTINCT kind FROM models)),
    runs AS (SELECT kind, form, CASE WHEN form < 2 THEN 'h2o' ELSE 'tpot' END AS framework,
                    min(top) AS low, count(*) AS n FROM models JOIN kinds USING (kind) GROUP BY 1, 2)"""


@query(f"""
    WITH {RUN_ROWS}
    SELECT framework, kind AS run_id, kind AS preset, n + 0.5::DOUBLE AS training_time_seconds,
           CASE form WHEN 0 THEN 'RMSE' WHEN 1 THEN 'MSE' ELSE 'neg_root_mean_squared_error' END AS raw_score_metric,
           low AS raw_score_value, CASE WHEN form = 1 THEN sqrt(low) ELSE low END AS comparable_score,
           'modelo ' || kind || ' é' AS best_model_name, framework || '/' || kind AS output_dir
    FROM runs UNION ALL SELECT 'h2o', 'vazia', NULL, NULL, NULL, NULL, NULL, NULL, 'h2o/vazia'""")
def run_documents(spark, sf_dir):
    """Stored runs read back and compared; one run has no documents."""
    base = write_runs(spark, sf_dir)
    out = compare_runs(load_runs(spark, base), history_records(spark, base))
    return out.select(
        "framework", "run_id", "preset", "training_time_seconds", "raw_score_metric",
        "raw_score_value", "comparable_score", "best_model_name",
        F.substring_index("output_dir", "/", -2).alias("output_dir"),
    )


@query(f"""
    WITH {RUN_ROWS}
    SELECT framework, kind AS run_id, 'm, ' || h AS model_id, -top AS score FROM models JOIN runs USING (kind)""")
def search_histories(spark, sf_dir):
    """Histories of all runs: CSV, lists, objects of columns, and the one in a report."""
    history = history_records(spark, write_runs(spark, sf_dir))
    return history.select(
        "framework", "run_id",
        F.try_variant_get("record", "$.model_id", "string").alias("model_id"),
        F.try_variant_get("record", "$.neg_root_mean_squared_error", "double").alias("score"),
    )


@query("""
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders""")
def dataset_round_trip(spark, sf_dir):
    """Built once, stored by year, then read from the second place looked in."""
    path = scratch_path(spark, "dataset")

    def build():
        orders = table(spark, sf_dir, "orders")
        return orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("ano"))

    load_or_build(spark, path, build)
    return load_first(spark, [f"{path}-absent", path])


@query("""
    SELECT o_orderkey, o_totalprice FROM orders""")
def csv_columns(spark, sf_dir):
    """Two columns of a CSV with more."""
    path = write_dataset(table(spark, sf_dir, "orders"), scratch_path(spark, "csv"), "csv")
    out = read_columns(spark, path, ["o_orderkey", "o_totalprice"])
    return out.select(F.col("o_orderkey").cast("long"), F.col("o_totalprice").cast("double"))


@query(f"""
    WITH {FITTED} SELECT CAST(data AS VARCHAR) AS data, actual, round(predicted, 4) AS predicted FROM scored""")
def prediction_files(spark, sf_dir):
    path = write_predictions(_scored(spark, sf_dir), scratch_path(spark, "predictions"))
    out = spark.read.csv(path, header=True, schema="data string, actual double, predicted double, residual double")
    return rounded(out.drop("residual"), {"predicted": 4})


@query("""
    SELECT p_partkey AS cement, p_size AS water, p_retailprice AS strength FROM part""")
def positional_names(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    out, features = load_positional(parts, ["cement", "water", "strength"], "strength")
    return out.select(*features, "strength")
