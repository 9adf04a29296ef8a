"""Value examples and edge cases of single operators."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tamiz.functions import dates, money, text
from tamiz.operators import bi, cleaning, forecast, incremental, lake, olap, profile, quality, rules, semantic, statistics, structure, view
from tamiz.plans import pipeline, q_rules
from tamiz.sources import files, sinks


def one(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.select("i", f(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_prices(spark):
    given = ["USD 15.50", "15,50", "1.200,50", "1,200.50", "un millon", "3.5 millones", "-1.500,75", "mil", "abc", "$1 500", "$1.200.000", "40 mil", "350k", "1.200", None, ""]
    assert one(spark, money.parse_price, given) == [15.5, 15.5, 1200.5, 1200.5, 1e6, 3.5e6, -1500.75, 1000.0, None, 1500.0, 1.2e6, 40000.0, 350.0, 1200.0, None, None]


def test_number_words(spark):
    assert one(spark, money.words_to_number, ["sesenta lucas", "doscientos treinta y cinco", "mil", "dos millones", "nada", None]) == [60000.0, 235.0, 1000.0, 2e6, None, None]


def test_money_texts(spark):
    given = ["1.200.000", "sesenta lucas", "350k", "1,200.00", "un palo", "-5000", "USD 200", "", None, "dos millones"]
    assert one(spark, money.parse_money_text, given) == [1.2e6, 60000.0, 350000.0, 1200.0, 1e6, 5000.0, 200.0, None, None, 2e6]


def test_currencies(spark):
    assert one(spark, money.detect_currency, ["US$ 5", "5 euros", "10 pesos", "7 usd", "5 lucas", "5", None]) == ["CLP", "EUR", "CLP", "USD", "CLP", "DESCONOCIDA", "DESCONOCIDA"]
    assert one(spark, money.extract_currency, ["15 usd", "$5", "x", None]) == ["USD", "$", None, None]


def test_ids(spark):
    assert one(spark, text.restore_id, ["123", "TRX-45", "invalid", None, "000", "0012345"]) == ["TRX-0123", "TRX-0045", None, None, "TRX-0000", "TRX-12345"]


def test_dates(spark):
    given = ["2026-04-01", "01/04/2026", "Apr 01 2026", "2026/04/01", "06-04-2026", "14-May-2026", "15/05/26", "05/13/2026", "Ayer", "", None]
    got = [str(d) if d else None for d in one(spark, dates.parse_date, given)]
    assert got == ["2026-04-01"] * 4 + ["2026-04-06", "2026-05-14", "2026-05-15", "2026-05-13", None, None, None]
    assert [str(d) for d in one(spark, dates.serial_to_date, [45425], "int")] == ["2024-05-13"]


def test_serial_columns(spark):
    df = spark.createDataFrame([(45425.0, -1.0, 45425.5), (45428.0, 45426.0, 45426.0)], "a double, b double, c double")
    assert {r[0]: r[1] for r in semantic.serial_date_columns(df).collect()} == {"a": True, "b": False, "c": False}


@pytest.mark.parametrize("given, domains, bounds, want", [
    ([1200000, 5000, 850, 200, 60000], None, (5000, 5000000), {850: 850000, 200: 200000}),
    ([1200000, 850, 2500, 350, 450000], [None, None, "foreign", None, None], (5000, 5000000), {850: 850000, 350: 350000}),
    ([5000, 3500, 8000, 10000], None, (1000, 50000), {}),
])
def test_scale(spark, given, domains, bounds, want):
    rows = [(float(v), (domains or [None] * len(given))[i]) for i, v in enumerate(given)]
    df = spark.createDataFrame(rows, "x double, d string")
    out = semantic.normalize_scale(df, "x", "y", *map(float, bounds), domain="d", scale_down=bounds[0] == 5000)
    assert {r.x: r.y for r in out.collect()} == {float(v): float(want.get(v, v)) for v in given}


def test_retail_names(spark):
    assert one(spark, text.strip_code_prefix, ["J501-JUMBO BILBAO", "N678 - N678 - X", "CORONEL-MANUEL MONTT", None]) == ["JUMBO BILBAO", "X", "CORONEL MANUEL MONTT", None]
    assert one(spark, text.pack_label, ["LENTEJAS 5 MM 500 G", "HARINA 1KG", "10 KG", "x", None]) == ["500 g", None, "10000 g", None, None]
    assert one(spark, lambda c: text.title_case(c), ["o'higgins", "tal-tal", "SAN PEDRO"]) == ["O'Higgins", "Tal-Tal", "San Pedro"]


def test_unique_rule(spark):
    df = spark.createDataFrame([(c,) for c in ["a", "b", "a", "c", "b", None]], "k string")
    ruleset = rules.RuleSet("x", (), (rules.Rule("u", "k", "unique", "quarantine"),))
    out = rules.validate(df, ruleset)
    assert out.violations.first()["n"] == 4 and out.valid.count() == 2 and out.quarantined.count() == 4


def test_missing_required_column_is_fatal(spark):
    out = rules.validate(spark.range(3), rules.RuleSet("x", ("absent",), ()))
    assert out.fatal and out.valid.isEmpty()


def test_failing_rule_is_fatal(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    assert rules.validate(df, rules.RuleSet("x", (), (rules.Rule("n", "a", "not_null", "fail"),))).fatal


def test_join_guard(spark):
    left, right = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(lake.JoinGuardError):
        lake.guarded_left_join(left, right, "k")


def test_orphans_of_an_empty_fact(spark):
    empty = spark.createDataFrame([], "fk int")
    assert lake.orphans(empty, spark.createDataFrame([(1,)], "pk int"), "fk", "pk").first()["confidence"] == 1.0


def test_inclusions_of_many_columns(spark):
    wide = spark.range(40).select(*[(F.col("id") % (i + 1)).alias(f"c{i}") for i in range(70)], F.lit(None).cast("string").alias("none"), F.lit("7").alias("text"))
    keys = spark.range(60).select((F.col("id")).alias("k"), F.lit(1.5).alias("real"), F.when(F.col("id") > 0, F.col("id")).alias("holed"))
    got = {(r["fk"], r["pk"]): r["confidence"] for r in lake.inclusions({"f": wide, "d": keys}, 0.0).collect() if r["fact"] == "f"}
    assert got == {(c, "k"): 1.0 for c in [*[f"c{i}" for i in range(70)], "text"]}  # a column with a null is no key, and one without values no foreign key
    part = {(r["fk"], r["confidence"]) for r in lake.inclusions({"f": wide, "d": keys.where("k < 10")}, 0.5).collect() if r["fact"] == "f"}
    assert ("c19", 0.5) in part and ("c20", round(10 / 21, 6)) not in part and ("c9", 1.0) in part
    plan = lake.value_index({"f": wide, "d": keys})[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_reports_of_batches_add_up(spark, tmp_path):
    x = F.col("id")
    df = spark.range(9000).select(x.alias("k"), F.when(x % 4 > 0, (x * 7919 % 9000).cast("double")).alias("v"), F.when(x % 9 == 0, float("nan")).otherwise(F.col("id") / 2).alias("n"), F.array(F.when(x % 5 == 0, "a").otherwise("b"), F.lit("c")).alias("data_quality_flags"), (x % 101).cast("int").alias("quality_score"))
    report = incremental.Report(spark, str(tmp_path / "r"))
    assert report.columns().isEmpty() and report.flags().isEmpty() and report.scores().isEmpty()
    report.add("t", "one", df.where("k < 4000"))
    report.add("t", "two", df.where("k >= 4000").drop("n"))
    report.add("t", "none", df.where("k < 0"))
    report.add("other", "one", df.select("k"))
    got = {r["column_name"]: r for r in report.columns().where("table_name = 't'").collect()}
    assert (got["k"]["n_rows"], got["k"]["nulls"], got["k"]["least"], got["k"]["most"]) == (9000, 0, 0.0, 8999.0)
    assert got["v"]["nulls"] == 2250 and got["n"]["nulls"] == 5000 and got["n"]["total"] == sum(i / 2 for i in range(4000) if i % 9)
    assert abs(got["k"]["uniques"] - 9000) < 0.0324 * 9000 and got["v"]["uniques"] < 1.0324 * 6750
    assert all(abs(got["k"][p] - q * 9000) < 0.01 * 9000 for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))) and got["quality_score"]["p50"] in range(48, 53)
    assert {r["flag"]: r["n"] for r in report.flags().collect()} == {"a": 1800, "b": 7200, "c": 9000}
    whole, merged = quality.score_distribution(df).first(), report.scores().drop("table_name").first()
    assert tuple(whole) == tuple(merged)
    report.add("t", "two", df.where("k >= 4000 and k < 5000").drop("n"))  # a batch again
    assert report.columns().where("table_name = 't' and column_name = 'k'").first()["n_rows"] == 5000


def test_footers_answer_without_data(spark, tmp_path):
    x = F.col("id")
    df = spark.range(500).select(x.alias("k"), F.when(x % 3 > 0, x / 4).alias("v"), F.lit("a").alias("s.t"), F.date_add(F.lit("2024-01-01").cast("date"), x.cast("int")).alias("d"))
    df.repartition(4).write.parquet(str(tmp_path / "a"))
    df.select("k", F.when(F.col("k") == 7, float("nan")).otherwise(F.col("v")).alias("v")).write.parquet(str(tmp_path / "b"))
    got = {(r["table_name"], r["column_name"]): tuple(r)[3:] for r in lake.footer_figures(spark, {"a": [str(tmp_path / "a")], "b": [str(tmp_path / "b")]}).collect()}
    assert got["a", "k"] == (500, 0, 0.0, 499.0, True) and got["a", "v"] == (500, 167, 0.25, 124.75, True) and got["a", "s.t"] == (500, 0, None, None, True) and got["a", "d"][:2] == (500, 0)
    assert got["b", "k"][:4] == (500, 0, 0.0, 499.0) and got["b", "v"][:2] == (500, 167)
    plan = lake.footer_aggregate(lake.footer_session(spark), [str(tmp_path / "a")])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan


def test_primary_keys():
    assert lake.infer_pk("DimProduct", ["ProductKey", "OtherKey"]) == "ProductKey"
    assert lake.infer_pk("x", ["a", "only_key"]) == "only_key" and lake.infer_pk("x", ["a_key", "b_key"]) is None


def test_names():
    assert structure.unique_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]
    assert structure.snake_names([" Fecha Venta ", "Código"]) == ["fecha_venta", "código"]
    assert files.table_name("/x/2024 Ventas ñandú.csv") == "t_2024_ventas_nandu"
    assert files.distinct_names(["a", "a", "b", "a"]) == ["a", "a_2", "b", "a_3"]
    assert profile.name_has("cliente_codigo", profile.ID_TOKENS) and not profile.name_has("unidades", profile.ID_TOKENS) and not profile.name_has("trimestre", ("mes",))
    assert view.readable(["monto_currency", "fecha_fecha", "k"], ["k"]) == {"monto_currency": "Monto Moneda", "fecha_fecha": "Fecha", "k": "k"}


def test_cleaner_choice():
    assert cleaning.choose(["PERIODO", "Unidades ", "VENTA", "Comuna", "Region", "COSTO PRODUCTO", "Grupo Clientes"]).name == "retail_sales"
    assert cleaning.choose(["monto", "fecha"]).name == "transactional" and cleaning.choose(["x"]) is None
    assert cleaning.choose(["x"], hint="car_prices_2024").name == "car_prices"


def test_flat_series_forecast_is_flat(spark):
    import datetime as dt

    months = [dt.date(2019 + k // 12, k % 12 + 1, 1) for k in range(48)]
    df = spark.createDataFrame([("flat", m, 500.0) for m in months] + [("short", m, 7.0) for m in months[:12]], "series_id string, month date, y double")
    out = forecast.forecast(forecast.completed(df)).collect()
    assert len(out) == 24 and all(abs(r.p - (500 if r.series_id == "flat" else 7)) < 1e-6 for r in out)
    factors = forecast.seasonal_index(forecast.completed(df)).groupBy("series_id").agg(F.avg("factor").alias("a")).collect()
    assert all(abs(r.a - 1) < 1e-9 for r in factors)


def test_mape(spark):
    a = spark.createDataFrame([("s", 1, 100.0), ("s", 2, 200.0)], "series_id string, month int, y double")
    b = spark.createDataFrame([("s", 1, 110.0), ("s", 2, 180.0)], "series_id string, month int, p double")
    assert abs(forecast.mape(a, b).first()["mape"] - 10) < 1e-9


def test_shares_sum_to_a_hundred(spark):
    df = spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 1, 1), (None, 3, 1, 1)], "k string, venta long, unidades long, costo long")
    assert abs(bi.with_share(bi.rollup(df, "k")).agg(F.sum("share")).first()[0] - 100) < 1e-4


def test_concentration_in_range_partitions(spark, monkeypatch):
    held = []
    monkeypatch.setattr(bi, "staged", lambda df, f=bi.staged: held.append(f(df)) or held[-1], raising=False)
    df = spark.range(5000).selectExpr("id AS k", "id % 3 AS g", "id % 4000 + 1 AS venta").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one partition
    try:
        got = bi.concentration(df, "k", "g").first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sums, run, n = sorted((i % 4000 + 1 for i in range(5000)), reverse=True), 0, 0
    for x in sums:
        run += x
        n += run <= 0.8 * sum(sums)
    assert (got["members"], got["n_share"]) == (5000, n + 1)
    assert len(held) == 1 and held[0].select("_part").distinct().count() > 1


def test_sequential_ids_without_pattern(spark):
    df = spark.createDataFrame([(1, None), (2, " "), (3, "x")], "n int, id string")
    assert {r.n: r.id for r in bi.sequential_ids(df, "id", ["n"]).collect()} == {1: "AUTO-0001", 2: "AUTO-0002", 3: "x"}


def test_star_keys_join_back(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "n string, v int")
    fact, dims = olap.star(df, {"d": ["n"]}, [], ["v"])
    assert fact.join(dims["d"], "d_key").count() == 3


def test_schema_freeze(spark):
    a = spark.createDataFrame([(1,)], "a int")
    assert quality.drift(a, a).isEmpty() and quality.fingerprint(a) != quality.fingerprint(a.withColumn("b", F.lit(1))) and json.loads(quality.freeze(a))["fields"][0]["name"] == "a"


@pytest.mark.parametrize("name, body, want", [
    ("a.csv", "x;y\n1;2\n3;4\n", {("1", "2"), ("3", "4")}),
    ("b.txt", "Informe mensual|\nnombre|monto\nana|5\nluis|6\n", {("ana", "5"), ("luis", "6")}),
    ("c.tsv", "x\ty\n1\t2\n", {("1", "2")}),
    ("d.json", '{"meta": 1, "items": [{"x": 1, "y": {"z": 2}}, {"x": 3, "y": {"z": 4}}]}', {(1, 2), (3, 4)}),
    ("e.json", '[{"x": 1, "y": {"z": 2}}]', {(1, 2)}),
    ("f.json", '{"x": 1, "y": {"z": 2}}', {(1, 2)}),
    ("g.json", '{"x": 1, "y": 2}\n{"x": 3, "y": 4}\n', {(1, 2), (3, 4)}),
])
def test_files(spark, tmp_path, name, body, want):
    (tmp_path / name).write_text(body, encoding="utf-8")
    assert {tuple(r) for r in files.read(spark, str(tmp_path / name)).collect()} == want


def test_latin1(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("producto,n\nñandú,1\n".encode("latin-1"))
    assert files.read_delimited(spark, str(tmp_path / "a.csv")).first()["producto"] == "ñandú"


def test_latin1_after_the_first_lines(spark, tmp_path):
    rows = "producto,n\n" + "".join(f"x{i},{i}\n" for i in range(60))
    (tmp_path / "one").mkdir()
    (tmp_path / "one/a.csv").write_bytes((rows + "ñandú,60\n").encode("latin-1"))
    assert files.read_delimited(spark, str(tmp_path / "one")).where("n = 60").first()["producto"] == "ñandú"
    (tmp_path / "one/b.csv").write_text(rows + "ñandú,60\n", encoding="utf-8")
    got = files.read_delimited(spark, str(tmp_path / "one"))
    assert got.count() == 122 and [r["producto"] for r in got.where("n = 60").collect()] == ["ñandú", "ñandú"]


def test_preamble_is_cut_by_place(spark, tmp_path):
    (tmp_path / "a.txt").write_text('Informe mensual|\nnombre|monto\nana|5\nInforme mensual|\nnombre|monto\n"lu\nis"|6\nana|5\n')
    got = [tuple(r) for r in files.read_delimited(spark, str(tmp_path / "a.txt")).collect()]
    assert sorted(got, key=str) == sorted([("ana", "5"), ("Informe mensual", None), ("nombre", "monto"), ("lu\nis", "6"), ("ana", "5")], key=str)


def test_one_bad_file_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.docx").write_text("?")
    (tmp_path / ".hidden.csv").write_text("x\n1\n")
    found = files.discover_tables(spark, str(tmp_path))
    assert set(found.tables) == {"a"} and len(found.errors) == 1
    with pytest.raises(ValueError, match="supported"):
        files.discover_tables(spark, str(tmp_path / "b.docx"))


def test_run(spark, tmp_path):
    body = "id_venta,fecha_venta,monto,producto,estado,notas_jose\n1,2026-04-01,1500.50,Mouse,vendido,\n2,fecha-invalida,$1.200.000,Mouse,xyz,\n,,,,xyz,\n4,01/04/2026,40 mil,Teclado,cambio,devolucion\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/ventas.csv").write_text(body)
    done = pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r1")
    total = done.totals.where("table_name = 'total'").first()
    assert not done.errors and total["extracted"] == total["cleaned"] + total["quarantined"] == 4 and not done.passed
    # The manifest's digests are those of the files themselves.
    import hashlib

    digest = lambda paths: hashlib.sha256(",".join(sorted(hashlib.sha256(p.read_bytes()).hexdigest() for p in paths)).encode()).hexdigest()
    (tmp_path / "in/otra.docx").write_text("?")
    assert sinks.latest_run(spark, str(tmp_path / "out")) == "r1" and sinks.latest_run(spark, str(tmp_path / "in")) is None
    pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r2")
    told = json.loads(spark.read.text(str(tmp_path / "out/r2/manifest")).first()[0])
    (one,), (read,) = told["outputs"], told["inputs"]
    assert one["rows"] == done.tables["ventas"].count() and one["sha256"] == digest((tmp_path / "out/r2/ventas/clean").glob("*.parquet"))
    assert read["sha256"] == digest([tmp_path / "in/ventas.csv"]) and read["bytes"] == len(body.encode()) and "otra.docx" in next(iter(told["errors"])) and told["settings"]["passed"] == "False"
    assert sinks.latest_run(spark, str(tmp_path / "out")) == "r2" and spark.read.parquet(str(tmp_path / "out/r1/ventas/clean")).count() == one["rows"]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id_venta string, fecha_venta string, monto string, estado string")
    assert quality.null_profile(empty).count() == 4 and profile.histogram(spark.createDataFrame([], "x double"), "x").isEmpty()
    assert rules.gate(empty, empty, empty).first()["passed"]


def test_free_dates(spark):
    given = ["1/4/2026", "2026-04-01 10:00:00", "2026-04-01T10:00:00Z", "1 April 2026", "April 1, 2026", "Wed, 01 Apr 2026", "20260401", "2026-4-1", "01.04.2026", "1-4-26 7:05", "Apr 2026", "2026-04"]
    assert {str(d) for d in one(spark, dates.parse_date, given)} == {"2026-04-01"}
    assert one(spark, dates.parse_date, ["2026-04-01 25:00", "31/02/2026", "2026-13-01", "abc 2026", "1/2", "12", "99999999", "1 Apr Apr 2026"]) == [None] * 8


def test_typed_dates_stay(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-05 10:00:00' AS fecha_a, DATE'2024-01-06' AS fecha_b, 45425 AS fecha_c, CAST(NULL AS TIMESTAMP) AS fecha_d, 'nope' AS fecha_e, 1.0D AS monto")
    row = cleaning.clean_transactional(df.withColumn("fecha_f", F.col("fecha_a").cast("timestamp"))).first()
    assert [str(row[f"fecha_{c}"]) for c in "abcf"] == ["2024-01-05", "2024-01-06", "2024-05-13", "2024-01-05"]
    assert row["data_quality_flags"] == ["invalid_date_fecha_e"]


def test_compatible_forms(spark):
    import unicodedata

    given = ["ﬁne ½ x² ① Ⅳ ㎏ ＡＢＣ１２", "cafe\u0301 n\u0303 A\u030a e\u0302\u0301", "ｶﾞ ﷺ …", "plain", "漢字 😀 é", "a\u00a0b\u3000c", None, ""]
    assert one(spark, text.nfkc, given) == [x if x is None else unicodedata.normalize("NFKC", x) for x in given]


def test_exact_quantiles(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    values = [float(x) for x in np.concatenate([rng.lognormal(3, 2, 6000), np.repeat(7.0, 2500), [1e12, -1e12, 0.0]])]
    df = spark.createDataFrame([(v, i % 3 == 0) for i, v in enumerate(values)], "v double, some boolean").repartition(5)
    some = [v for i, v in enumerate(values) if i % 3 == 0]
    want = {f"q{p}": float(np.quantile(values, p)) for p in (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)} | {"some": float(np.median(some))}
    asked = {f"q{p}": (F.col("v"), p) for p in (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)} | {"some": (F.when(F.col("some"), F.col("v")), 0.5)}
    for gathered, accuracy in ((50_000, 10_000), (60, 200)):  # at once, and by narrowing bounds
        monkeypatch.setattr(statistics, "GATHERED", gathered)
        monkeypatch.setattr(statistics, "ACCURACY", accuracy)
        got = statistics.quantiles(df, asked)
        assert all(abs(got[k] - want[k]) <= 1e-9 * max(1, abs(want[k])) for k in want)
    assert statistics.quantiles(df.limit(0), {"m": (F.col("v"), 0.5)}) == {"m": None}
    assert statistics.quantiles(df.where("v = 7"), {"m": (F.col("v"), 0.3)}) == {"m": 7.0}


def test_quantiles_of_a_column_with_nan_and_infinities(spark, monkeypatch):
    import math

    inf, nan = math.inf, math.nan
    df = spark.range(4000).select(F.when(F.col("id") % 100 == 0, nan).when(F.col("id") % 100 == 1, inf).when(F.col("id") % 100 == 2, -inf).otherwise(F.col("id").cast("double")).alias("v")).repartition(3)
    values = sorted(inf if i % 100 == 1 else -inf if i % 100 == 2 else float(i) for i in range(4000) if i % 100) + [nan] * 40
    collected, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: collected.append(collect(self)) or collected[-1])
    monkeypatch.setattr(statistics, "GATHERED", 10)
    monkeypatch.setattr(statistics, "ACCURACY", 200)
    for share in (0.0, 0.005, 0.3, 0.5, 0.98, 0.985, 0.995, 1.0):
        rank = share * 3999
        low, high = values[int(rank)], values[math.ceil(rank)]
        want = low if low == high or rank == int(rank) else low + (high - low) * (rank - int(rank))
        got = statistics.quantiles(df, {"m": (F.col("v"), share)})["m"]
        assert got == pytest.approx(want, rel=1e-12) or math.isnan(got) and math.isnan(want), share
    assert max((len(rows) for rows in collected), default=0) <= 10
    assert math.isnan(statistics.quantiles(df.where("isnan(v)"), {"m": (F.col("v"), 0.5)})["m"])


def test_anchors_are_versions(spark, tmp_path):
    df = spark.createDataFrame([("1", "$ 1.200.000", "Mouse logitech"), ("2", "850", "Mouse logitech"), ("3", None, "Pizza"), ("4", "900.000", "RTX 4090")], "id string, monto string, producto string")
    first = semantic.learn(df)
    path = str(tmp_path / "anchors")
    assert first.save(spark, path, 4) == 1 and semantic.Anchors({"monto": semantic.Anchor("USD", 7.0)}, ["x"]).save(spark, path) == 2
    assert semantic.Anchors.read(spark, path, 1) == first and semantic.Anchors.read(spark, path).money["monto"].anchor == 7.0
    assert sorted(semantic.enrich(df, first).collect()) == sorted(semantic.enrich(df).collect()) and semantic.enrich(df, first).columns == semantic.enrich(df).columns
    # Nothing is counted under anchors: rows one by one give the same.
    one = [semantic.enrich(df.where(F.col("id") == i), first).first() for i in "1234"]
    assert sorted(one) == sorted(semantic.enrich(df).collect())


def test_distinct_counts(spark):
    x = F.col("id")
    df = spark.range(5000).select(
        (x % 7).alias("few"), F.when(x % 2 == 0, x).alias("many"), (x % 50 / 7).alias("real"), F.lit(None).cast("string").alias("none"), F.when(x % 3 == 0, -0.0).when(x % 3 == 1, 0.0).otherwise(float("nan")).alias("a.zero"),
        F.timestamp_seconds(x % 40 * 1800 + 1729987200).alias("clock"), F.array(x % 3, F.lit(None).cast("long")).alias("list"), F.to_binary((x % 9).cast("string"), F.lit("utf-8")).alias("raw"), F.date_add(F.lit("2024-01-01").cast("date"), (x % 31).cast("int")).alias("day"))
    want = {"few": 7, "many": 2500, "real": 50, "none": 0, "a.zero": 2, "clock": 40, "list": 3, "raw": 9, "day": 31}
    assert statistics.distinct_counts(df, df.columns) == want and statistics.distinct_counts(df.limit(0), ["few"]) == {"few": 0} and statistics.distinct_counts(df, []) == {}
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")  # the clock goes back within these hours
    try:
        assert statistics.distinct_counts(df, ["clock"]) == {"clock": 40}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_redundant_pairs(spark):
    df = spark.range(300).select((F.col("id") % 20).alias("a"), (F.col("id") % 20 * 3).cast("string").alias("b"), (F.col("id") % 21).alias("c"), (F.col("id") % 10).alias("d"))
    assert [tuple(r) for r in profile.redundant_pairs(df, ["a", "b", "c", "d"]).collect()] == [("a", "b")]


def test_rule_files(spark, tmp_path):
    spec = {"dataset": "ventas", "required_columns": ["x"], "rules": [{"name": "x_min", "column": "x", "type": "range", "min": 2, "on_violation": "quarantine"}]}
    (tmp_path / "ventas.json").write_text(json.dumps(spec))
    (tmp_path / "otros.yaml").write_text("rules:\n  - name: x_there\n    column: x\n    type: not_null\n")
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    found = rules.RuleSet.for_dataset("ventas", str(tmp_path))
    assert found == rules.RuleSet.from_dict(spec) and rules.validate(df, found).quarantined.count() == 1
    pytest.importorskip("yaml")
    assert rules.RuleSet.for_dataset("otros", str(tmp_path)).rules[0].kind == "not_null" and rules.RuleSet.for_dataset("absent", str(tmp_path)) is None


def test_late_rows_and_state(spark, tmp_path):
    """An hour's figures grow while it may still change; rows behind the watermark are left out."""
    from tamiz.streaming import streams

    top, kind = str(tmp_path), "ts timestamp, v string"
    def arrive(*rows):
        spark.createDataFrame([(r,) for r in rows], "t string").select(F.col("t").cast("timestamp").alias("ts"), F.lit(None).cast("string").alias("v")).coalesce(1).write.mode("append").parquet(f"{top}/in")
        stream = spark.readStream.schema(kind).parquet(f"{top}/in")
        streams.write_hourly(streams.hourly_quality(stream, "ts", ["v"]), f"{top}/out", f"{top}/checkpoint")
        return {str(r["hour"])[11:13]: (r["n"], r["nulls_v"]) for r in streams.read_hourly(spark, f"{top}/out").collect()}

    assert arrive("2024-01-01 08:10:00", "2024-01-01 09:05:00") == {"08": (1, 1), "09": (1, 1)}
    assert arrive("2024-01-01 09:20:00", "2024-01-01 12:00:00") == {"08": (1, 1), "09": (2, 2), "12": (1, 1)}
    assert arrive("2024-01-01 09:40:00", "2024-01-01 12:30:00")["09"] == (2, 2)  # far behind 12:00 less ten minutes


def test_flags_by_hour_with_late_rows_and_bounded_state(spark, tmp_path):
    from tamiz.streaming import streams

    top, kind = str(tmp_path), "ts timestamp, v string, tags array<string>, score int"

    def arrive(*rows):
        spark.createDataFrame(rows, "t string, v string, tags array<string>, score int").select(F.col("t").cast("timestamp").alias("ts"), "v", "tags", "score").coalesce(1).write.mode("append").parquet(f"{top}/in")
        stream = spark.readStream.schema(kind).parquet(f"{top}/in")
        done = streams.write_hourly(streams.hourly_flags(stream, "ts", ["v"], "tags", "score"), f"{top}/out", f"{top}/checkpoint")
        return {(str(r["hour"])[11:13], r["flag"]): (r["n"], r["nulls_v"], r["score_sum"], r["scored"]) for r in streams.read_hourly(spark, f"{top}/out", ["flag"]).collect()}, done

    got, _ = arrive(("2024-01-01 08:10:00", None, ["a", "b"], 50), ("2024-01-01 08:20:00", "x", ["a"], None), ("2024-01-01 09:05:00", "x", None, 90))
    assert got == {("08", None): (2, 1, 50, 1), ("08", "a"): (2, 1, 50, 1), ("08", "b"): (1, 1, 50, 1), ("09", None): (1, 0, 90, 1)}
    got, _ = arrive(("2024-01-01 09:20:00", None, ["b", "b"], 10), ("2024-01-01 13:00:00", "x", [], 70))
    assert got["09", None] == (2, 1, 100, 2) and got["09", "b"] == (2, 2, 20, 2) and got["13", None] == (1, 0, 70, 1) and ("13", "b") not in got
    got, done = arrive(("2024-01-01 09:40:00", None, ["a"], 1), ("2024-01-01 13:30:00", "x", ["c"], 30))  # the first is far behind
    assert got["09", None] == (2, 1, 100, 2) and ("09", "a") not in got and got["13", None] == (2, 0, 100, 2)
    # Hours behind the watermark have left the state; the open hour has its total and one flag.
    assert done.lastProgress.stateOperators[0].numRowsTotal == 2


def test_database_scan_in_ranges(spark, tmp_path):
    url, driver = f"jdbc:derby:memory:{tmp_path.name};create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    rows = spark.range(1, 1001).select((F.col("id") * 3).alias("K"), (F.col("id") % 7).cast("int").alias("V"))
    try:
        rows.write.format("jdbc").options(url=url, dbtable="T", driver=driver).save()
    except Exception as error:  # noqa: BLE001  no database on the class path
        pytest.skip(str(error)[:80])
    got = files.read_jdbc(spark, url, "T", "K", 250, driver=driver)
    assert got.rdd.getNumPartitions() == 4 and sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_checksums_of_any_size(spark, tmp_path):
    """Ranges against hashlib: below, at and above the limit; a path with a space; and above the 2 GB of one value."""
    import hashlib

    (tmp_path / "in a folder").mkdir()
    bodies = {"empty.parquet": b"", "limit.parquet": b"x" * 100, "above.parquet": bytes(range(101)), "many.parquet": os.urandom(1234)}
    for name, body in bodies.items():
        (tmp_path / "in a folder" / name).write_bytes(body)

    def told(body, kind, n=100):
        parts = [hashlib.new(kind, body[i : i + n]).hexdigest() for i in range(0, len(body), n)]
        return hashlib.new(kind, body).hexdigest() if len(body) <= n else f"{hashlib.new(kind, ''.join(parts).encode()).hexdigest()}-{len(parts)}"

    for kind in ("sha256", "md5"):
        got = {os.path.basename(r["path"]): (r["bytes"], r["checksum"]) for r in sinks.checksums(spark, str(tmp_path / "in a folder"), kind, block=100).collect()}
        assert got == {name: (len(body), told(body, kind)) for name, body in bodies.items() if body}
    size, start = 2**31 + 5, hashlib.md5(bytes(sinks.BLOCK)).hexdigest()
    (tmp_path / "large").mkdir()
    with open(tmp_path / "large/zeros.parquet", "wb") as file:
        file.truncate(size)  # takes no room on disk
    (got,) = sinks.checksums(spark, str(tmp_path / "large"), "md5").collect()
    parts = [start] * (size // sinks.BLOCK) + [hashlib.md5(bytes(5)).hexdigest()]
    assert got["bytes"] == size and got["checksum"] == f"{hashlib.md5(''.join(parts).encode()).hexdigest()}-{len(parts)}"


def test_a_second_run_overwrites_its_quarantine(spark, tmp_path):
    df = spark.range(5)
    for _ in range(2):
        sinks.quarantine(df, f"{tmp_path}/q", "first")
        sinks.quarantine(df.limit(2), f"{tmp_path}/q", "second")
    assert {r[0]: r[1] for r in spark.read.parquet(f"{tmp_path}/q").groupBy("reason").count().collect()} == {"first": 5, "second": 2}


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "b"), (2, "b"), (3, "c")], "k int, v string")
    assert sorted(map(str, rules.members_of_duplicates(df, ["k", "v"]).collect())) == sorted(map(str, df.where("k = 2 or v is null").collect()))


def test_multipliers_of_an_amount_take_one_pass_and_not_a_nested_one_each(spark):
    texts = ["10 mil", "20k", "sesenta lucas", "3 mil k", "1.500 palos", "2m", "milk 3k", "kk 5 miles", "4 millones", "USD 7", "", None, "un millon", "12,5 mil pesos"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    parsed = df.select(money.parse_money_text(F.col("s")).alias("v"))
    assert [r["v"] for r in parsed.collect()] == [10e3, 20e3, 60e3, 3e6, 1500e6, 2e6, 3e6, 5e3, 4e6, 7.0, None, None, 1e6, 12.5e3]
    # Lambda functions nested a level for each multiplier were slow.
    assert parsed._jdf.queryExecution().analyzed().toString().count("lambdafunction(") < 10


def test_exact_counts_of_columns_do_not_copy_the_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "n int, s string")
    counts = q_rules._exact(df, "n").unionByName(q_rules._exact(df, "s"))
    assert sorted(map(tuple, counts.collect())) == [("n", 3), ("s", 1)]
    assert "Expand" not in counts._jdf.queryExecution().optimizedPlan().toString()
