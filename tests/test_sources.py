import datetime as dt
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sazonal.operators.clean import clean_cases
from sazonal.operators.lookup import panel_weather
from sazonal.plans.city import STATION_FILE, build_city
from sazonal.reports.compare import compare_runs, search_summary
from sazonal.sinks import json_records, save_search
from sazonal.sources import files, notifications, resources, runs, stations
from sazonal.sources.headed import file_catalogue, read_headed


def test_required_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    files.require_files(spark, [str(tmp_path / "a.csv")], "data")
    with pytest.raises(FileNotFoundError) as error:
        files.require_files(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv")], "data")
    assert "b.csv" in str(error.value) and "c.csv" in str(error.value)
    assert "a.csv" not in str(error.value)


def test_load_or_build_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "set")
    assert files.load_or_build(spark, path, build).count() == 3
    assert files.load_or_build(spark, path, build).count() == 3
    assert calls == [1]
    assert files.load_first(spark, [str(tmp_path / "none"), path]).count() == 3
    with pytest.raises(FileNotFoundError):
        files.load_first(spark, [str(tmp_path / "none")])


def test_half_written_datasets_are_built_again(spark, tmp_path):
    path = str(tmp_path / "set")
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("crash"))))
    with pytest.raises(Exception, match="crash"):
        files.load_or_build(spark, path, lambda: broken.toDF("id"))
    assert not files.exists(spark, path)
    # What a job without a commit would have left.
    spark.range(2).write.parquet(path)
    (tmp_path / "set" / "_SUCCESS").unlink()
    assert files.load_or_build(spark, path, lambda: spark.range(5)).count() == 5
    assert files.load_or_build(spark, path, lambda: spark.range(9)).count() == 5
    one = tmp_path / "one.csv"
    one.write_text("a\n1\n")
    assert files.load_or_build(spark, str(one), lambda: spark.range(9)).count() == 1

    def other():
        spark.range(7).write.parquet(str(tmp_path / "raced"))
        return spark.range(8)

    assert files.load_or_build(spark, str(tmp_path / "raced"), other).count() == 7


def test_notifications_with_line_breaks(spark, tmp_path):
    text = 'bairro;nu_notific;dt_notific;obs\n"a\nb;""c""";1;02/01/2021;x\nd;2;03/01/2021;"\n\n;"\n\ne\\;3;04/01/2021;\n'
    (tmp_path / "casos-de-dengue-2021.csv").write_text(text)
    cases = clean_cases(notifications.read_notifications(spark, str(tmp_path), (2021,)))
    rows = {r.id: str(r.data)[:10] for r in cases.collect()}
    assert rows == {"1": "2021-01-02", "2": "2021-01-03", "3": "2021-01-04"}


def test_notifications(spark, tmp_path):
    (tmp_path / "casos-de-dengue-2014.csv").write_text(
        "nu_notificacao;bairro;dt_notificacao\n1;x;2014/01/02 00:00:00\n1;y;2014/01/03 00:00:00\n"
        ";z;2014/01/04 00:00:00\n;w;2014/01/05 00:00:00\n2;v;\n3;u;ruim\n3;t;2014/01/09 00:00:00\n"
    )
    (tmp_path / "casos-de-dengue-2015.csv").write_text("dt_notificacao,nu_notificacao\n2015-03-04,1\n")
    (tmp_path / "casos-de-dengue-2021.csv").write_text("NU_NOTIFIC;DT_NOTIFIC\n9;05/06/2021\n")
    raw = notifications.read_notifications(spark, str(tmp_path), (2014, 2015, 2021))
    got = sorted((r.ano_arquivo, str(r.id), str(r.data)) for r in clean_cases(raw).collect())
    # First row per id and year; null ids are one id; an unreadable date may come first.
    assert got == [
        (2014, "1", "2014-01-02"),
        (2014, "3", "None"),
        (2014, "None", "2014-01-04"),
        (2015, "1", "2015-03-04"),
        (2021, "9", "2021-06-05"),
    ]


def station(path, year, rows, wet=True, preamble=8):
    old = year < 2019
    titles = ["DATA (YYYY-MM-DD)", "HORA (UTC)"] if old else ["Data", "Hora UTC"]
    titles += ["PRECIPITAÇÃO TOTAL, HORÁRIO (mm)", "RADIACAO GLOBAL (Kj/m²)"]
    titles += ["UMIDADE RELATIVA DO AR, HORARIA (%)"] if wet else []
    lines = [f"ESTAÇÃO {i}:;x" for i in range(preamble)] + [";".join(titles) + ";"]
    for day, hour, rain, humid in rows:
        date = f"{day:%Y-%m-%d}" if old else f"{day:%Y/%m/%d}"
        time = f"{hour:02d}:00" if old else f"{hour:02d}00 UTC"
        cells = [date, time, str(rain).replace(".", ","), "1,5", *([str(humid)] if wet else [])]
        lines.append(";".join(cells) + ";")
    path.write_bytes(("\r\n".join(lines) + "\r\n").encode("latin1"))


def test_stations(spark, tmp_path):
    d = dt.date
    station(tmp_path / "INMET_NE_PE_A301_SÃO X_2018.CSV", 2018, [(d(2018, 1, 1), 0, 0.5, 80), (d(2018, 1, 1), 1, "", 81)])
    station(tmp_path / "INMET_NE_BA_A401_SALVADOR_2023.CSV", 2023, [(d(2023, 1, 1), 0, -9999, 70)], wet=False, preamble=6)
    table = stations.read_stations(spark, str(tmp_path / "*.CSV"))
    rows = {
        (r.data or r.data_yyyy_mm_dd, r.hora_utc): (
            r.precipitacao_total_horario_mm, r.umidade_relativa_do_ar_horaria
        )
        for r in stations.sensors_as_numbers(table).collect()
    }
    assert rows == {
        ("2018-01-01", "00:00"): (0.5, 80.0),
        ("2018-01-01", "01:00"): (None, 81.0),
        ("2023/01/01", "0000 UTC"): (-9999.0, None),
    }
    listed = {r.arquivo: (r.ano, r.qtd_linhas, r.qtd_colunas) for r in file_catalogue(table).collect()}
    assert listed["INMET_NE_PE_A301_SÃO X_2018.CSV"] == (2018, 2, 5)
    assert listed["INMET_NE_BA_A401_SALVADOR_2023.CSV"] == (2023, 1, 4)
    (tmp_path / "empty.CSV").write_text("")
    assert stations.station_headers(spark, str(tmp_path / "*.CSV")).count() == 2
    (tmp_path / "sem título.CSV").write_bytes("ESTAÇÃO;x\r\n1;2\r\n".encode("latin1"))
    for i in range(25):
        (tmp_path / f"sem título {i}.CSV").write_bytes("ESTAÇÃO;x\r\n1;2\r\n".encode("latin1"))
    with pytest.raises(ValueError, match="No header row") as lost:
        stations.station_headers(spark, str(tmp_path / "*.CSV"))
    assert str(lost.value).count("sem%20t") == 26
    assert "Join" not in table._jdf.queryExecution().executedPlan().toString()
    # A file without a column keeps its rows; the radiation column is ignored.
    daily = {r.municipio: r for r in panel_weather(table).collect()}
    assert daily["são x"].precipitacao_total_horario_mm == 0.5
    assert daily["salvador"].umidade_relativa_do_ar_horaria is None
    assert "radiacao_global_kj_m2" not in daily["são x"].asDict()


def reference_days(rows):
    """The station cleaning and trailing mean, again with pandas."""
    df = pd.DataFrame(rows, columns=["data", "hora", "chuva", "umidade"]).astype({"chuva": float, "umidade": float})
    parts = []
    for _, g in df.groupby(pd.to_datetime(df["data"]).dt.year):
        g = g.replace(-9999, float("nan"))
        g = g.loc[:, g.isnull().mean() < 0.3]
        cols = [c for c in g.columns if c not in ("data", "hora")]
        g[cols] = g[cols].fillna(g[cols].rolling(window=6, min_periods=2).median())
        parts.append(g.loc[g.isnull().mean(axis=1) < 0.6])
    days = pd.concat(parts).groupby("data").mean()
    return days.shift(1).rolling(window=3).mean()


def test_city_from_files(spark, tmp_path):
    days = [dt.date(2018, 12, 20) + dt.timedelta(days=i) for i in range(25)]
    rows = []
    for i, day in enumerate(days):
        for hour in range(4):
            rain = -9999 if (i * 4 + hour) % 9 == 0 else (i * 7 + hour * 3) % 11
            rows.append((day, hour, rain, 60 + (i * 5 + hour) % 17))
    for year in (2018, 2019):
        station(tmp_path / STATION_FILE.format(year=year), year, [r for r in rows if r[0].year == year])
        written = [
            f"{n};{day:%Y-%m-%d}" if year == 2018 else f"{n},{day:%Y-%m-%d}"
            for n, day in enumerate(d for d in days if d.year == year for _ in range(1 + d.day % 3) if d.day % 5)
        ]
        head = "nu_notificacao;dt_notificacao" if year == 2018 else "nu_notificacao,dt_notificacao"
        (tmp_path / f"casos-de-dengue-{year}.csv").write_text("\n".join([head, *written]) + "\n")
    got = build_city(spark, str(tmp_path), str(tmp_path), (2018, 2019), window=3).collect()
    before = reference_days(rows)
    want = [
        (day.year, day.month, day.day, day.weekday(), 1 + day.day % 3, before.loc[day, "chuva"], before.loc[day, "umidade"])
        for day in days
        if day.day % 5 and before.loc[day].notna().all()
    ]
    assert [(r.ano, r.mes, r.dia, r.dia_da_semana, r.casos_dengue) for r in got] == [w[:5] for w in want]
    for r, w in zip(got, want):
        assert r.precipitacao_total_media_mm == pytest.approx(w[5], rel=1e-9)
        assert r.umidade_relativa_media == pytest.approx(w[6], rel=1e-9)
    with pytest.raises(FileNotFoundError):
        build_city(spark, str(tmp_path), str(tmp_path), (2018, 2020), window=3)


def test_resources(spark):
    rows = [
        (0, "Casos de Dengue 2020", "u0.csv"), (1, "Casos de Dengue 2020", "u1.CSV"),
        (2, "Dengue 2020 e 2021", "u2.csv"), (3, "Dengue 2021", "u3.pdf"), (4, "Zika 2021", "u4.csv"),
    ]
    listed = spark.createDataFrame(rows, "at int, name string, url string")
    got = {r.ano: r.url for r in resources.select_resources(listed, (2020, 2021)).collect()}
    assert got == {2020: "u2.csv", 2021: "u2.csv"}
    with pytest.raises(RuntimeError, match="2019"):
        resources.select_resources(listed, (2019, 2020))


def test_package_listing(spark, tmp_path):
    doc = {"result": {"resources": [{"name": "Dengue 2020", "url": "a.csv"}, {"name": "b", "url": "c"}]}}
    (tmp_path / "p.json").write_text(json.dumps(doc))
    packages = spark.read.schema(resources.PACKAGE_SCHEMA).json(str(tmp_path / "p.json"))
    assert [tuple(r) for r in resources.listed_resources(packages).orderBy("at").collect()] == [
        (0, "Dengue 2020", "a.csv"), (1, "b", "c"),
    ]


def test_archives(spark, tmp_path):
    def archive(name, members):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for member, text in members.items():
                z.writestr(member, text)

    archive("2020.zip", {"2020/A302_X.CSV": "no", "2020/A301_RECIFE_2020.CSV": "yes", "A301_RECIFE_2020b.CSV": "late"})
    archive("2021.zip", {"2021/other.csv": "no"})
    found = stations.archive_members(spark, str(tmp_path / "*.zip"), r"A301_RECIFE.*(?i:\.csv)$")
    rows = found.collect()
    assert [(r.member, bytes(r.content)) for r in rows] == [("2020/A301_RECIFE_2020.CSV", b"yes")]
    archives = spark.read.format("binaryFile").load(str(tmp_path / "*.zip")).select(F.col("path").alias("archive"))
    with pytest.raises(RuntimeError, match="2021.zip"):
        stations.require_members(spark, archives, found)


PRINTED = """     root_mean_squared_error  Parents
0   -12.5   NaN   NaN  ...  None  NaN  <a>
1   -11.5   (0, 0)  mutate  ...  None  1.0  <b>
[2 rows x 9 columns]"""


def write_run(folder, metadata=None, best=None, csv=None, history=None):
    folder.mkdir(parents=True)
    for name, doc in (("metadata", metadata), ("best_model", best), ("search_history", history)):
        if doc is not None:
            text = doc if isinstance(doc, str) and doc.startswith("{") else json.dumps(doc)
            (folder / f"{name}.json").write_text(text)
    if csv is not None:
        (folder / "search_history.csv").write_text(csv)


def test_runs(spark, tmp_path):
    score = {"metric": "MSE", "value": 16.0, "source": "leaderboard"}
    write_run(tmp_path / "h2o" / "20240102", {"preset": "low", "training_time_seconds": 120.0},
              {"model_name": "m1", "model_family": "GBM", "score": score},
              csv='model_id,rmse\n"a, ""b""",4\nc,5\n')
    write_run(tmp_path / "h2o" / "20240101", metadata="{broken")
    write_run(tmp_path / "tpot" / "1", {"optimization_metric": "neg_rmse"},
              {"score": {"value": "root_mean_squared_error  -9.5\nName: 3"}, "hyperparameters": {"steps": [["s", "X()"]]}},
              history=[{"root_mean_squared_error": -8.0}, {"root_mean_squared_error": -7.0, "Generation": 2}])
    write_run(tmp_path / "tpot" / "2", {}, {"score": {"value": None}}, history={"search_history": PRINTED})
    base = str(tmp_path)
    listed = [r.run_id for r in runs.list_runs(spark, base, "h2o").collect()]
    assert listed == ["20240102", "20240101"]
    assert runs.list_runs(spark, base, "none").count() == 0
    loaded, history = runs.load_runs(spark, base), runs.load_search_history(spark, base)
    table = {(r.framework, r.run_id): r for r in compare_runs(loaded, history).collect()}
    assert len(table) == 4
    assert table["h2o", "20240102"].comparable_score == 4.0
    assert table["h2o", "20240102"].training_time_minutes == 2.0
    assert table["h2o", "20240101"].comparable_score is None
    assert table["tpot", "1"].comparable_score == 7.0
    assert table["tpot", "2"].comparable_score == 11.5
    counts = {(r.framework, r.run_id): r.total_modelos_testados for r in search_summary(loaded, history).collect()}
    assert counts["h2o", "20240102"] == 2 and counts["tpot", "2"] == 2 and counts["h2o", "20240101"] == 0
    quoted = history.where("run_id = '20240102' AND rmse = '4'").first()
    assert quoted.model_id == 'a, "b"'
    newest = {r.framework: r.run_id for r in runs.latest_run(loaded).collect()}
    assert newest == {"h2o": "20240102", "tpot": "2"}


def test_histories_of_any_form(spark, tmp_path):
    score = "root_mean_squared_error"
    write_run(tmp_path / "tpot" / "columns", {}, history={score: [-3.0, -2.0], "step": ["a", "b"]})
    write_run(tmp_path / "tpot" / "labels", {}, history={score: {"0": -5.0, "1": -4.0}, "step": {"1": "x"}})
    write_run(tmp_path / "tpot" / "inner", {}, history={"search_history": {"neg_" + score: [-1.0]}})
    write_run(tmp_path / "tpot" / "empty_csv", {}, csv="", history=[{score: -6.0}])
    write_run(tmp_path / "tpot" / "report", {}, csv=f"{score}\n-9\n")
    (tmp_path / "tpot" / "report" / "report.json").write_text(json.dumps({"search_history": PRINTED}))
    write_run(tmp_path / "tpot" / "scalars", {}, history={score: -1.0})
    write_run(tmp_path / "tpot" / "broken", {}, history="{broken")
    base = str(tmp_path)
    records = runs.history_records(spark, base).withColumn(
        "score", F.try_variant_get("record", f"$.{score}", "double")
    )
    found = {}
    for r in records.orderBy("run_id", "posicao").collect():
        found.setdefault(r.run_id, []).append(r.score)
    assert found == {
        "columns": [-3.0, -2.0], "labels": [-5.0, -4.0], "inner": [None], "empty_csv": [-6.0],
        "report": [-12.5, -11.5],
    }
    steps = records.where("run_id = 'labels'").select(F.try_variant_get("record", "$.step", "string").alias("s"))
    assert sorted(r.s or "" for r in steps.collect()) == ["", "x"]
    stored = runs.history_records(spark, base, reports=False).where("run_id = 'report'")
    assert stored.select(F.try_variant_get("record", f"$.{score}", "double")).first()[0] == -9.0
    wide = runs.load_search_history(spark, base)
    assert wide.where("run_id = 'columns'").count() == 2 and "step" in wide.columns
    loaded = runs.load_runs(spark, base)
    table = {r.run_id: r for r in compare_runs(loaded, records).collect()}
    assert (table["inner"].raw_score_metric, table["inner"].comparable_score) == ("neg_" + score, 1.0)
    assert (table["columns"].raw_score_metric, table["columns"].comparable_score) == (score, 2.0)
    assert table["broken"].raw_score_metric is None
    assert table["broken"].output_dir == f"{base}/tpot/broken"
    told = {r.run_id: r.has for r in loaded.select("run_id", F.col("report").isNotNull().alias("has")).collect()}
    assert told["report"] and not told["broken"]


def test_saved_search_reads_back(spark, tmp_path):
    history = spark.createDataFrame([("a", 2.0), ("b", float("nan"))], "model_id string, rmse double")
    best = spark.sql("SELECT 'a' AS model_name, 'GLM' AS model_family, named_struct('metric', 'rmse', 'value', 2.0D, 'source', 's') AS score")
    metadata = spark.sql("SELECT 'p' AS preset, 60.0D AS training_time_seconds")
    save_search(history, best, metadata, str(tmp_path / "h2o" / "r1"))
    row = compare_runs(runs.load_runs(spark, str(tmp_path)), runs.load_search_history(spark, str(tmp_path))).first()
    assert (row.run_id, row.comparable_score, row.best_model_family) == ("r1", 2.0, "GLM")


def test_json_records(spark):
    df = spark.createDataFrame([(float("nan"), dt.datetime(2024, 1, 2))], "x double, t timestamp")
    assert json.loads(json_records(df).first().record) == {"x": None, "t": "2024-01-02 00:00:00"}


def test_quoted_files_of_any_width(spark, tmp_path):
    wide = [f"c{i}" for i in range(300)]
    cells = [f'"{i};""x"""' for i in range(300)]
    (tmp_path / "a [1].csv").write_text(";".join(wide) + "\n" + ";".join(cells) + "\n")
    (tmp_path / "b.csv").write_text('"linha\numa";c299;c299\n"um\ndois";2;3\n4;5;6;7\n')
    table = read_headed(spark, [str(tmp_path / "a \\[1\\].csv"), str(tmp_path / "b.csv")], quoted=True)
    rows = {r.arquivo: r for r in table.collect() if r.linha_uma != "4"}
    assert rows["a [1].csv"].c299 == '299;"x"' and rows["a [1].csv"].c0 == '0;"x"'
    assert (rows["b.csv"].linha_uma, rows["b.csv"].c299, rows["b.csv"].c299_1, rows["b.csv"].c5) == ("um\ndois", "2", "3", None)
    assert table.count() == 3


def test_preambles_over_many_blocks(spark, tmp_path):
    for name, preamble, n in (("x", 3, 4000), ("y", 0, 2500), ("z", 5, 1)):
        lines = ["Data;repeated"] * 0 + [f"p{i};q" for i in range(preamble)] + ["Data;valor;"]
        lines += [f"{name}{i};{i};" for i in range(n)] + ["Data;valor;"]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, "4096")
        table = read_headed(spark, str(tmp_path / "*.csv"), first_cells=["data"])
        got = {(r.arquivo, r.data): r.valor for r in table.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # The first header line counts; a later one like it is a row.
    assert len(got) == 4000 + 2500 + 1 + 3
    assert got["x.csv", "x3999"] == "3999" and got["z.csv", "Data"] == "valor"
