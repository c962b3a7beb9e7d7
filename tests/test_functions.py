import datetime as dt

import pytest
from pyspark.sql import functions as F

from sazonal.functions import dates, encode, missing, names, text


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr(F.col("c"))).first()[0]


def test_normalize_name():
    assert names.normalize_name("PRECIPITAÇÃO TOTAL, HORÁRIO (mm)") == "precipitacao_total_horario_mm"
    assert names.normalize_name("  Data (YYYY-MM-DD)_ ") == "data_yyyy_mm_dd"
    assert names.normalize_name("RADIACAO GLOBAL (Kj/m²)") == "radiacao_global_kj_m2"
    assert names.unique_names(["A", "a", "", ""]) == ["a", "a_1", "", ""]


def test_slug(spark):
    assert one(spark, names.slug, "H2O AutoML!") == "h2o_automl"
    assert one(spark, names.slug, "***") == "automl"
    assert names.slug_text("auto-sklearn") == "auto_sklearn"
    assert one(spark, names.fold_accents, "São João Ç") == "sao joao c"


@pytest.mark.parametrize(
    "year, value, want",
    [
        (2013, "2013/02/28 00:00:00", dt.date(2013, 2, 28)),
        (2013, "2013-02-28", None),
        (2016, "2016-02-30", None),
        (2020, "2020-02-29", dt.date(2020, 2, 29)),
        (2021, "05/04/2021", dt.date(2021, 4, 5)),
        (2022, "2022-01-09", dt.date(2022, 1, 9)),
        (2024, "31/12/2024", dt.date(2024, 12, 31)),
    ],
)
def test_notification_time(spark, year, value, want):
    got = one(spark, lambda c: dates.notification_time(c, F.lit(year)).cast("date"), value)
    assert got == want


def test_other_dates(spark):
    assert one(spark, dates.station_hour, "1300 UTC", ) == 13
    assert one(spark, dates.station_hour, "07:00") == 7
    assert one(spark, dates.station_hour, "cedo") is None
    parts = spark.createDataFrame([(2024, 2, 29), (2023, 2, 29)], "ano int, mes int, dia int")
    assert [r.data for r in dates.with_date(parts).orderBy("ano").collect()] == [None, dt.date(2024, 2, 29)]
    monday = spark.createDataFrame([(dt.date(2024, 1, 1),)], "data date")
    assert dates.calendar_parts(monday).first().dia_da_semana == 0


def test_missing(spark):
    df = spark.createDataFrame(
        [(1, float("nan")), (2, float("inf")), (3, -9999.0), (4, 5.0)], "i int, x double"
    )
    clean = missing.sentinel_to_null(missing.nonfinite_to_null(df))
    assert [r.x for r in clean.orderBy("i").collect()] == [None, None, None, 5.0]
    assert missing.drop_missing(clean).count() == 1
    wide = spark.createDataFrame([(1, None, None), (1, None, 2)], "a int, b int, c int")
    assert missing.drop_sparse_rows(wide, 0.6).count() == 1


@pytest.mark.parametrize(
    "value, want",
    [("rmse 12,5 ok", 12.5), ("-.5e2x", -50.0), ("nada", None), (None, None), ("7", 7.0)],
)
def test_first_number(spark, value, want):
    assert one(spark, text.first_number, value) == want


def test_decimal_comma(spark):
    assert one(spark, text.decimal_comma, " 1,25 ") == 1.25
    assert one(spark, text.decimal_comma, "") is None


HISTORY = """   root_mean_squared_error                Parents  ...  Instance
0               -31.25                    NaN                NaN  ...  None  NaN  <a at 0x1>
1               -30                 (3, 4)   ind_mutate  ...  None  1.0  <b at 0x2>
..                 ...
44                 bad line
[45 rows x 9 columns]"""


def test_history_text(spark):
    df = spark.createDataFrame([("r", HISTORY)], "run string, t string")
    rows = text.parse_history_text(df, "t").orderBy("indice").collect()
    assert [(r.run, r.indice, r.RMSE, r.Parents, r.Variation_Function, r.Pareto_Front) for r in rows] == [
        ("r", 0, 31.25, None, None, None),
        ("r", 1, 30.0, "(3, 4)", "ind_mutate", 1.0),
    ]


def test_summarize_steps(spark):
    made = "Pipeline(StandardScaler(), RFE(StandardScaler()), XGBRegressor())"
    assert one(spark, text.summarize_steps, made) == "StandardScaler → RFE → XGBRegressor"
    assert one(spark, text.summarize_steps, "x" * 121) == "x" * 120 + "..."
    assert one(spark, text.summarize_steps, "x" * 120) == "x" * 120
    assert one(spark, text.summarize_steps, None) is None


def test_expand_steps(spark):
    df = spark.createDataFrame(
        [(1, [("scale", "StandardScaler()"), ("model", "f(x)")])],
        "run int, steps array<struct<n: string, o: string>>",
    )
    rows = text.expand_steps(df, "steps").orderBy("ordem").collect()
    assert [tuple(r) for r in rows] == [
        (1, 1, "scale", "StandardScaler", "StandardScaler()"),
        (1, 2, "model", "f(x)", "f(x)"),
    ]


def test_scores(spark):
    rows = [("h2o", "RMSE", 4.0, None), ("h2o", "mse", 9.0, None), ("h2o", "MAE", 9.0, None),
            ("tpot", None, -7.0, -5.0), ("tpot", None, -7.0, None), ("tpot", None, None, None)]
    df = spark.createDataFrame(rows, "f string, m string, v double, b double")
    got = df.select(encode.comparable_rmse(*[F.col(c) for c in "fmvb"])).collect()
    assert [r[0] for r in got] == [4.0, 3.0, None, 5.0, 7.0, None]
    assert encode.first_column(df, ["x", "v", "b"]) == "v"
    assert encode.score_candidates("RMSE")[:3] == ["RMSE", "rmse", "RMSE"]
