import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sazonal.operators import quantiles
from sazonal.operators.quantiles import (
    exact_quantiles, from_bits, grouped_quantiles, most_frequent, ordered_bits,
)


def _check(spark, values, probs):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    got = exact_quantiles(df, ["x"], probs)["x"]
    want = np.quantile([v for v in values if v is not None], probs)
    assert got == pytest.approx(list(want), rel=1e-12)


PROBS = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)


def test_few_values(spark):
    _check(spark, [3.0, 1.0, None, 2.0, 10.0], PROBS)


def test_continuous(spark):
    draw = random.Random(1)
    _check(spark, [draw.gauss(0, 1) * 10 ** draw.randint(-9, 9) for _ in range(4001)], PROBS)


def test_heavy_ties(spark):
    values = [1.0] * 1500 + [2.0] * 1500 + [7.5] * 3 + [9.0] * 997
    _check(spark, values, (0.1, 0.3749, 0.375, 0.5, 0.75, 0.9))


def test_neighbours_in_the_last_bit(spark):
    # All upper bits agree; only the last pass tells the values apart.
    values = [float(np.nextafter(1.0, 2.0)), 1.0, float(np.nextafter(1.0, 0.0)), -0.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert exact_quantiles(df, ["x"], (0.0, 0.25, 0.5, 0.75, 1.0))["x"] == sorted(values)


def test_constant(spark):
    _check(spark, [4.0] * 2000, (0.0, 0.5, 1.0))


def test_bits_keep_the_order():
    values = np.array(sorted([-1e300, -2.5, -5e-324, 0.0, 5e-324, 1.0, 1.5, 1e300, 7.25]))
    bits = ordered_bits(values)
    assert (np.diff(bits.astype(object)) > 0).all()
    assert [from_bits(int(b)) for b in bits] == values.tolist()


def test_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], (0.5,)) == {"x": [None]}


def test_groups_share_the_passes(spark):
    draw = random.Random(2)
    rows = [(draw.randrange(5), draw.choice([None, draw.uniform(-9, 9)]), float(draw.randrange(40))) for _ in range(900)]
    df = spark.createDataFrame(rows, "s int, x double, `y.z` double").withColumnRenamed("y.z", "y")
    found = grouped_quantiles(df, ["x", "y"], (0.5, 0.9), F.col("s"), [1, 3, 5])
    found += grouped_quantiles(df, ["x", "y"], (0.5, 0.9), F.col("s"), [4])
    for bound, got in zip([1, 3, 5, 4], found):
        for at, name in ((1, "x"), (2, "y")):
            held = [r[at] for r in rows if r[0] < bound and r[at] is not None]
            assert got[name] == pytest.approx(list(np.quantile(held, (0.5, 0.9))), rel=1e-12)


def test_no_size_chooses_the_path():
    assert not [name for name in vars(quantiles) if name.startswith("MAX_")]


def test_mode_takes_smallest_of_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "c string")
    assert most_frequent(df, "c") == "a"
