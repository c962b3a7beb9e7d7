"""NaN and infinities are missing values; numbers in text are whole numbers of text."""

import math

import pytest
from pyspark.sql import functions as F

from sazonal.functions.text import decimal_comma
from sazonal.models.forest import fit_forest
from sazonal.models.preprocess import fit_preprocessor
from sazonal.models.search import _sort_metric
from sazonal.operators.profile import describe_exact, missing_profile
from sazonal.operators.quantiles import exact_quantiles

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def rows(spark):
    values = [float(i) for i in range(20)] + [INF] * 15 + [NAN] * 10 + [-INF] * 5 + [None] * 2
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_quantiles_end_on_nonfinite_values(rows):
    assert exact_quantiles(rows, ["x"], (0.0, 0.5, 0.9, 1.0))["x"] == pytest.approx([0.0, 9.5, 17.1, 19.0])


def test_profiles_skip_nonfinite_values(rows):
    found = describe_exact(rows).first()
    assert (found["count"], found["mean"], found["max"]) == (20, 9.5, 19.0)
    assert missing_profile(rows).first()["percentual_faltantes"] == pytest.approx(100 * 32 / 52)


def test_nonfinite_values_are_imputed(spark):
    df = spark.createDataFrame([(NAN,), (1.0,), (2.0,), (3.0,), (INF,)], "x double")
    prep = fit_preprocessor(df, ["x"])
    out = [r[0] for r in prep.transform(df).select(prep.feature_names[0]).collect()]
    assert all(math.isfinite(v) for v in out) and sum(out) == pytest.approx(0.0)


def test_decimal_texts(spark):
    texts = ["1,5", " -2.25 ", "1e3", ",5", "NaN", "Infinity", "5d", "5f", "", " ", "1e999", "1,2,3", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(decimal_comma(F.col("t"))).collect()]
    assert got == [1.5, -2.25, 1000.0, 0.5] + [None] * 9


def test_names_and_depths_that_are_unknown_are_refused(spark):
    assert _sort_metric("neg_mean_absolute_error") == "mae" and _sort_metric("RMSE") == "rmse"
    with pytest.raises(ValueError):
        _sort_metric("accuracy")
    with pytest.raises(ValueError):
        fit_forest(spark.range(3), ["id"], "id", max_depth=31)
