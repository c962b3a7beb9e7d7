"""Registration and the stand-ins that give the tables their roles here."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

HUMIDITY = "umidade_relativa_do_ar_horaria"
PRESSURE = "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb"
RAIN = "precipitacao_total_horario_mm"
COLD = "temperatura_minima_na_hora_ant_aut_c"
SENSORS = [HUMIDITY, PRESSURE, RAIN, COLD]


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL when there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = dedent(sql).strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so that both engines print them alike."""
    out = {f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType.typeName() == "date"}
    return df.withColumns(out) if out else df


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sensor readings of a station (their supplier); whole numbers."""
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("data"),
        F.col("l_suppkey").alias("estacao"),
        F.col("l_quantity").alias(HUMIDITY),
        F.round(F.col("l_extendedprice") / 1000).alias(PRESSURE),
        F.round(F.col("l_discount") * 100).alias(RAIN),
        F.round(F.col("l_tax") * 100).alias(COLD),
    )


READINGS = f"""
    readings AS (
        SELECT CAST(l_shipdate AS DATE) AS data, l_suppkey AS estacao,
               l_quantity AS {HUMIDITY}, round(l_extendedprice / 1000) AS {PRESSURE},
               round(l_discount * 100) AS {RAIN}, round(l_tax * 100) AS {COLD}
        FROM lineitem)"""


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as case notifications."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.to_date("o_orderdate").alias("data"),
        F.col("o_custkey").alias("municipio"),
    )


NOTIFICATIONS = """
    notifications AS (
        SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS data, o_custkey AS municipio
        FROM orders)"""

# Events below this value count as not measured.
DETECTION_LIMIT = 10.0


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as hourly readings of a station (their type), with gaps."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("event_type").alias("arquivo"),
        F.to_date("ts").alias("data"),
        F.hour("ts").alias("hora"),
        F.when(value >= DETECTION_LIMIT, value).alias("valor"),
    )


HOURLY = f"""
    hourly AS (
        SELECT event_id, ts, event_type AS arquivo, CAST(ts AS DATE) AS data,
               CAST(hour(ts) AS INTEGER) AS hora,
               CASE WHEN value >= {DETECTION_LIMIT} THEN value END AS valor
        FROM events)"""
