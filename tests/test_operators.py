import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from sazonal.operators import coverage, lookup, profile, schema
from sazonal.operators.aggregate import first_per_key, mean_per_key
from sazonal.plans.panel import panel_dataset, panel_supervised
from sazonal.sources.files import load_positional, supervised


def test_bins_are_left_closed_and_empty_bins_stay(spark):
    df = spark.createDataFrame([("a", 8), ("b", 2), ("c", 3), ("d", 4)], "k string, n long")
    binned = coverage.coverage_bins(df, "n")
    got = {r.k: r.faixa_qtd_exemplos for r in binned.collect()}
    assert got == {
        "a": "entre_3_e_4_quartos", "b": "entre_1_e_2_quartos",
        "c": "entre_1_e_2_quartos", "d": "entre_2_e_3_quartos",
    }
    counts = [tuple(r) for r in coverage.bin_histogram(binned).collect()]
    assert counts == [
        ("menos_de_1_quarto", 0), ("entre_1_e_2_quartos", 2),
        ("entre_2_e_3_quartos", 1), ("entre_3_e_4_quartos", 1),
    ]


def test_coverage_keeps_half_of_the_largest(spark):
    rows = [("a", i, 1) for i in range(4)] + [("b", i, 1) for i in range(2)] + [("c", 0, 1)]
    rows += [("c", i, None) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "k string, d int, y int")
    kept = coverage.coverage_filter(df, ["k"], "y")
    assert sorted({r.k for r in kept.collect()}) == ["a", "b"]


def test_null_keys_form_no_group_but_one_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, x double")
    assert [tuple(r) for r in mean_per_key(df, ["k"]).collect()] == [("a", 5.0)]
    assert sorted(str(r.x) for r in first_per_key(df, ["k"], ["x"]).collect()) == ["1.0", "5.0"]


def test_describe_and_correlation(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 7.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    stats = {r.coluna: r for r in profile.describe_exact(df).collect()}
    assert (stats["a"]["count"], stats["a"].p50, stats["a"].p25) == (4, 2.5, 1.75)
    r = {(x.a, x.b): x.corr for x in profile.corr_matrix(df).collect()}
    assert r["a", "b"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 5, 7])[0, 1])
    assert r["a", "a"] == pytest.approx(1.0)


def test_many_columns_are_correlated_in_parts(spark, monkeypatch):
    monkeypatch.setattr(profile, "MAX_PAIR_COLUMNS", 2)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], list("abcd"))
    got = {(r.a, r.b): r.corr for r in profile.corr_matrix(df).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 16
    for (i, p), (j, q) in itertools.product(enumerate("abcd"), repeat=2):
        assert got[p, q] == pytest.approx(want[i, j])


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, None, 2), (None, 5, 3)], "nu_notific int, nu_notificacao int, x int")
    merged = schema.rename_present(df, schema.CASE_NAMES)
    assert [r.id for r in merged.orderBy("x").collect()] == [1, 5]
    with pytest.raises(ValueError, match=r"\['a', 'b'\]"):
        schema.require_columns(df, ["b", "a", "x"])
    assert schema.columns_in_rows(df, 2) == [["nu_notific", "nu_notificacao"], ["x"]]
    named, features = load_positional(df, ["a", "b", "y"], "y")
    assert (named.columns, features) == (["a", "b", "y"], ["a", "b"])
    with pytest.raises(ValueError):
        load_positional(df, ["a"], "a")
    assert supervised(named, "y")[1] == ["a", "b"]


def test_lookup_and_panel_cases(spark):
    cities = spark.createDataFrame(
        [(2611606, "Recife", 26), (2927408, "São Paulo", 29), (9999999, "Nenhum", 99)],
        "codigo_ibge long, nome string, codigo_uf int",
    )
    states = spark.createDataFrame([(26, "pe "), (29, "BA")], "codigo_uf int, uf string")
    rows = [("2024-01-01", 261160), ("2024-01-01 10:00:00", 261160), ("ruim", 261160),
            ("2024-01-02", 292740), ("2024-01-02", 999999), ("2024-01-02", 1), ("2024-01-02", None)]
    cases = spark.createDataFrame(rows, "DT_NOTIFIC string, ID_MUNICIP long")
    codes = cases.select(F.col("ID_MUNICIP").alias("codigo_municipio")).distinct()
    places = lookup.municipality_map(cities, states, codes)
    assert places.count() == 3
    got = sorted((str(r.data), r.uf, r.municipio, r.casos_dengue) for r in lookup.panel_cases(cases, places).collect())
    assert got == [("2024-01-01", "PE", "recife", 2), ("2024-01-02", "BA", "são paulo", 1)]
    plain = lookup.panel_cases(cases, places, accents=False)
    assert "sao paulo" in {r.municipio for r in plain.collect()}


def test_panel_weather_sentinels(spark):
    rows = [("INMET_NE_PE_A301_RECIFE_2024.CSV", "2024/01/01", f"{h:02d}00 UTC", v)
            for h, v in enumerate(["1,0", "3,0", "-9999", "5,0"])]
    df = spark.createDataFrame(rows, "arquivo string, data string, hora string, chuva string")
    assert lookup.panel_weather(df, sentinels=(-9999,)).first().chuva == pytest.approx(11 / 4)
    kept = lookup.panel_weather(df).first()
    assert (kept.uf, kept.municipio, kept.chuva) == ("PE", "recife", pytest.approx(-9990 / 4))


def test_panel_dataset(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    weather = spark.createDataFrame(
        [(p, p.lower(), d, float(i)) for p in ("A", "B") for i, d in enumerate(days)],
        "uf string, municipio string, data date, chuva double",
    )
    cases = spark.createDataFrame(
        [("A", "a", d, 3) for d in days] + [("B", "b", days[0], 1)],
        "uf string, municipio string, data date, casos_dengue long",
    )
    out = panel_dataset(weather, cases, window=2)
    assert sorted((r.uf, r.dia, r.chuva) for r in out.collect()) == [
        ("A", 3, 0.5), ("A", 4, 1.5), ("A", 5, 2.5), ("A", 6, 3.5)
    ]
    rows, features = panel_supervised(out)
    assert "data" in features and "uf" not in rows.columns
    with pytest.raises(ValueError, match="ano"):
        panel_supervised(weather)
