"""Numbers and structure out of text, and comparison of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sazonal.functions.text import (
    expand_steps,
    first_number,
    parse_best_text,
    parse_history_text,
    summarize_steps,
)
from sazonal.reports.compare import chart_inputs, compare_runs, evolution_summary, search_summary
from sazonal.sinks import json_records
from sazonal.sources.resources import select_resources
from sazonal.sources.runs import latest_run

from .common import query, rounded, table

NUMBER_SQL = r"([-+]?\d*\.?\d+(?:[eE][-+]?\d+)?)"


@query(rf"""
    SELECT doc_id, TRY_CAST(nullif(regexp_extract(replace(text, ',', '.'), '{NUMBER_SQL}', 1), '') AS DOUBLE) AS numero
    FROM documents""")
def first_number_in_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", first_number(F.col("text")).alias("numero"))


@query(rf"""
    SELECT event_id, TRY_CAST(regexp_extract(props, '{NUMBER_SQL}', 1) AS DOUBLE) AS k FROM events""")
def first_number_in_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", first_number(F.col("props")).alias("k"))


# Fixed value: frequent letter groups of the texts, in place of step names.
GROUPS = "the|and|ing|les|der|sch|tion|ment|que|ous|est|con"
FOUND = f"regexp_extract_all(text, '({GROUPS})', 1)"


@query(f"""
    WITH found AS (SELECT doc_id, text, {FOUND} AS f FROM documents),
    named AS (SELECT doc_id, text, list_filter(f, lambda x, i: list_position(f, x) = i) AS n FROM found)
    SELECT doc_id, CASE WHEN len(n) > 0 THEN array_to_string(n[1:8], ' → ')
           ELSE substring(text, 1, 120) || CASE WHEN length(text) > 120 THEN '...' ELSE '' END END AS resumo
    FROM named""")
def step_summary(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", summarize_steps(F.col("text"), pattern=GROUPS).alias("resumo")
    )


@query(f"""
    WITH steps AS (
        SELECT conv_id, turn, 1 AS ordem, role AS etapa, text AS detalhe FROM conversations
        UNION ALL SELECT conv_id, turn, 2, 'detalhe', reverse(text) FROM conversations),
    named AS (SELECT *, regexp_extract_all(detalhe, '({GROUPS})', 1) AS f FROM steps)
    SELECT conv_id, turn, ordem, etapa,
           CASE WHEN len(f) > 0 THEN array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i)[1:8], ' → ')
           ELSE substring(detalhe, 1, 120) || CASE WHEN length(detalhe) > 120 THEN '...' ELSE '' END END AS resumo,
           detalhe
    FROM named""")
def step_expansion(spark, sf_dir):
    """Two named steps per turn, expanded in order."""
    steps = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.array(
            F.struct(F.col("role").alias("nome"), F.col("text").alias("objeto")),
            F.struct(F.lit("detalhe").alias("nome"), F.reverse("text").alias("objeto")),
        ).alias("steps"),
    )
    return expand_steps(steps, "steps", GROUPS)


@query("""
    SELECT event_id, event_id AS indice, -value AS root_mean_squared_error, value AS "RMSE",
           CASE WHEN event_type = 'error' THEN NULL ELSE '(' || user_id || ', 7)' END AS "Parents",
           CASE WHEN event_type = 'view' THEN NULL ELSE 'mutate ' || event_type END AS "Variation_Function",
           'None' AS "Eval_Error", CASE WHEN event_type = 'click' THEN NULL ELSE CAST(user_id AS DOUBLE) END AS "Pareto_Front",
           '<' || event_type || ' at 0x7f>' AS "Instance", 'search_history_visivel' AS origem
    FROM events WHERE event_type <> 'signup'""")
def history_lines(spark, sf_dir):
    """A printed history per event: header, blank, cut, one row and a size line.

    One type's rows lack the parents, so they do not match and vanish.
    """
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    parents = F.when(kind == "error", "NaN").otherwise(F.concat(F.lit("("), user, F.lit(", 7)")))
    variation = F.when(kind == "view", "NaN").otherwise(F.concat(F.lit("mutate "), kind))
    front = F.when(kind == "click", "NaN").otherwise(F.concat(user, F.lit(".0")))
    row = F.concat_ws(
        "  ",
        F.col("event_id").cast("string"),
        F.concat(F.lit("-"), F.format_string("%.2f", "value")),
        F.when(kind != "signup", parents),
        variation,
        F.lit("..."),
        F.lit("None"),
        front,
        F.concat(F.lit("<"), kind, F.lit(" at 0x7f>")),
    )
    text = F.concat_ws(
        "\n",
        F.lit("   root_mean_squared_error  Parents  Variation_Function ..."),
        F.lit("  "),
        row,
        F.lit("..  ...  ..."),
        F.lit("[45 rows x 9 columns]"),
    )
    texts = table(spark, sf_dir, "events").select("event_id", text.alias("_text"))
    parsed = parse_history_text(texts, "_text").drop("_text")
    # Adding zero turns -0.0 into 0.0.
    return parsed.withColumn("root_mean_squared_error", F.col("root_mean_squared_error") + 0.0)


@query("""
    SELECT event_id, event_id AS indice, CAST(user_id AS DOUBLE) AS "Generation",
           -value AS root_mean_squared_error, value AS "RMSE", '(' || user_id || ', 3)' AS "Parents",
           'mutate ' || event_type AS "Variation_Function", 1.0::DOUBLE AS "Pareto_Front",
           '<' || event_type || '>' AS "Instance", 'melhor_individuo' AS origem
    FROM events WHERE event_type <> 'error'""")
def best_record(spark, sf_dir):
    """The printed record of a best individual; without a score it is dropped."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    text = F.concat_ws(
        "\n",
        F.when(
            kind != "error",
            F.concat(F.lit("root_mean_squared_error        -"), F.format_string("%.2f", "value")),
        ),
        F.concat(F.lit("Parents                (") , user, F.lit(", 3)")),
        F.concat(F.lit("Variation_Function     mutate "), kind),
        F.concat(F.lit("Generation             "), user, F.lit(".0")),
        F.lit("Pareto_Front           1.0"),
        F.concat(F.lit("Instance               <"), kind, F.lit(">")),
        F.concat(F.lit("Name: "), F.col("event_id").cast("string"), F.lit(", dtype: object")),
    )
    texts = table(spark, sf_dir, "events").select("event_id", text.alias("_text"))
    parsed = parse_best_text(texts, "_text").drop("_text")
    return parsed.withColumn("root_mean_squared_error", F.col("root_mean_squared_error") + 0.0)


def _runs(spark, sf_dir):
    """One run per user and event type; its events are its search history."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    framework = F.when(kind.isin("click", "view", "error"), "h2o").otherwise("tpot")
    rows = events.select(
        framework.alias("framework"),
        F.format_string("%06d-%s", "user_id", "event_type").alias("run_id"),
        kind,
        "value",
    )
    per_run = rows.groupBy("framework", "run_id", "event_type").agg(
        F.max("value").alias("top"), F.sum(F.round(F.col("value") * 100)).alias("cents")
    )
    metric = (
        F.when(F.col("event_type") == "click", "RMSE")
        .when(F.col("event_type") == "view", "mse")
        .when(F.col("event_type") == "error", "MAE")
    )
    none = F.lit(None).cast("string")
    runs = per_run.select(
        "framework",
        "run_id",
        F.struct(
            F.col("event_type").alias("preset"),
            F.lit("neg_rmse").alias("optimization_metric"),
            F.col("cents").alias("training_time_seconds"),
            none.alias("output_dir"),
        ).alias("metadata"),
        F.struct(
            F.col("run_id").alias("model_name"),
            F.col("event_type").alias("model_family"),
            F.struct(
                metric.alias("metric"),
                F.translate(F.format_string("score %.2f", "top"), ".", ",").alias("value"),
                none.alias("source"),
            ).alias("score"),
        ).alias("best_model"),
    )
    history = rows.where(kind != "purchase").select(
        "framework", "run_id", (-F.col("value")).alias("neg_root_mean_squared_error")
    )
    return runs, history


RUNS_SQL = """
    runs AS (
        SELECT CASE WHEN event_type IN ('click', 'view', 'error') THEN 'h2o' ELSE 'tpot' END AS framework,
               printf('%06d-%s', user_id, event_type) AS run_id, event_type AS preset,
               max(value) AS raw_score_value, sum(round(value * 100)) AS training_time_seconds,
               min(value) AS lowest, count(*) AS n
        FROM events GROUP BY 1, 2, 3),
    compared AS (
        SELECT *, 'neg_rmse' AS optimization_metric, training_time_seconds / 60 AS training_time_minutes,
               CASE preset WHEN 'click' THEN 'RMSE' WHEN 'view' THEN 'mse' WHEN 'error' THEN 'MAE' ELSE 'neg_rmse' END AS raw_score_metric,
               CASE preset WHEN 'click' THEN raw_score_value WHEN 'view' THEN sqrt(raw_score_value)
                    WHEN 'signup' THEN lowest WHEN 'purchase' THEN raw_score_value END AS comparable_score,
               run_id AS best_model_name, preset AS best_model_family, NULL::VARCHAR AS output_dir
        FROM runs)"""


@query(f"""
    WITH {RUNS_SQL}
    SELECT framework, run_id, preset, optimization_metric, training_time_seconds, training_time_minutes,
           raw_score_metric, raw_score_value, CASE WHEN comparable_score IS NOT NULL THEN 'RMSE' END AS comparable_metric,
           comparable_score, best_model_name, best_model_family, output_dir FROM compared""")
def run_comparison(spark, sf_dir):
    return compare_runs(*_runs(spark, sf_dir))


@query(f"""
    WITH {RUNS_SQL}
    SELECT framework, run_id, training_time_minutes, comparable_score FROM compared
    WHERE comparable_score IS NOT NULL""")
def run_chart_inputs(spark, sf_dir):
    return chart_inputs(compare_runs(*_runs(spark, sf_dir)))


@query(f"""
    WITH {RUNS_SQL}
    SELECT framework, run_id, preset, 'neg_rmse' AS metrica, training_time_minutes AS tempo_total_min,
           CASE WHEN preset = 'purchase' THEN 0 ELSE n END AS total_modelos_testados,
           run_id AS melhor_modelo, preset AS familia_melhor_modelo, raw_score_value AS score
    FROM compared""")
def run_search_summary(spark, sf_dir):
    return search_summary(*_runs(spark, sf_dir))


@query("""
    SELECT 'r' || l_orderkey || '-' || l_linenumber AS run_id, l_returnflag AS preset, l_linestatus AS metrica,
           round(sum(l_quantity) / 60, 6) AS tempo_total_min, min(l_suppkey) AS melhor_indice,
           CAST(min(l_linenumber) AS DOUBLE) AS geracao_do_melhor, max(l_quantity) AS melhor_RMSE,
           -max(l_quantity) AS score_original_negativo, '(' || min(l_partkey) || ', 0)' AS parents,
           CAST(NULL AS VARCHAR) AS operador, l_returnflag AS familia_final
    FROM lineitem GROUP BY l_orderkey, l_linenumber, l_linestatus, l_returnflag""")
def run_evolution_summary(spark, sf_dir):
    """Order lines as evolutionary runs whose best individual is printed text."""
    key = ["l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag"]
    rows = table(spark, sf_dir, "lineitem").groupBy(*key).agg(
        F.min("l_suppkey").alias("at"), F.min("l_partkey").alias("parent"),
        F.max("l_quantity").alias("top"), F.sum("l_quantity").alias("seconds"),
    )
    printed = F.format_string(
        "Generation   %d\nroot_mean_squared_error  -%s\nParents  (%d, 0)\nName: %d, dtype: object",
        "l_linenumber", F.col("top").cast("string"), "parent", "at",
    )
    runs = rows.select(
        F.lit("tpot").alias("framework"),
        F.concat(
            F.lit("r"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
        ).alias("run_id"),
        F.struct(
            F.col("l_returnflag").alias("preset"), F.col("l_linestatus").alias("optimization_metric"),
            F.col("seconds").cast("string").alias("training_time_seconds"),
        ).alias("metadata"),
        F.struct(
            F.col("l_returnflag").alias("model_family"), F.struct(printed.alias("value")).alias("score")
        ).alias("best_model"),
    )
    return rounded(evolution_summary(runs), {"tempo_total_min": 6})


@query(f"""
    WITH {RUNS_SQL}
    SELECT framework, run_id, preset FROM compared
    WHERE (framework, run_id) IN (SELECT framework, max(run_id) FROM runs GROUP BY 1)""")
def latest_run_per_framework(spark, sf_dir):
    runs, _ = _runs(spark, sf_dir)
    return latest_run(runs).select("framework", "run_id", F.col("metadata.preset").alias("preset"))


@query("""
    WITH listed AS (
        SELECT o_orderkey AS seq, year(o_orderdate) AS y,
               'http://x/' || o_orderkey || CASE WHEN o_orderstatus = 'F' THEN '.CSV' ELSE '.csv' END AS url
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW')
    SELECT CAST(y AS INTEGER) AS ano, max_by(url, seq) AS url FROM listed WHERE y BETWEEN 1995 AND 1999 GROUP BY 1""")
def resource_selection(spark, sf_dir):
    """Orders as listed resources: the last fitting one of each year."""
    status = F.col("o_orderstatus")
    suffix = F.when(status == "F", ".CSV").when(status == "P", ".pdf").otherwise(".csv")
    word = F.when(F.col("o_orderpriority") == "5-LOW", "Zika").otherwise("Casos de Dengue")
    listed = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("at"),
        F.concat_ws(" ", word, F.year("o_orderdate").cast("string")).alias("name"),
        F.concat(F.lit("http://x/"), F.col("o_orderkey").cast("string"), suffix).alias("url"),
    )
    return select_resources(listed, range(1995, 2000))


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS valor,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS data, event_type AS tipo FROM events""")
def json_safe_records(spark, sf_dir):
    """Rows to JSON text with NaN as null, and back."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", float("nan")).otherwise(F.col("value")).alias("valor"),
        F.to_date("ts").alias("data"),
        F.col("event_type").alias("tipo"),
    )
    back = F.from_json("record", "event_id bigint, valor double, data string, tipo string")
    return json_records(events).select(back.alias("r")).select("r.*")
