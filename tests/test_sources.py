"""Extracts that end early, and files with bad lines."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from tamiz.operators import semantic
from tamiz.plans import pipeline
from tamiz.sources import extract, files, schemas


def some(spark, n=100):
    return spark.range(n).select((F.col("id") * 3).alias("k"), F.concat(F.lit("v"), F.col("id") % 5).alias("v")).unionByName(spark.createDataFrame([(None, "no key"), (5, None)], "k long, v string"))


def bag(df):
    return sorted(map(repr, df.select("k", "v").collect()))


def test_an_extract_is_resumed(spark, tmp_path):
    df, reads = some(spark), []
    table = extract.from_table(df, "k")

    def read(parts):
        reads.append([p.n for p in parts])
        return table(parts)

    job = extract.Extract(spark, str(tmp_path / "x"))
    parts = job.plan(extract.planned(df, "k", 10))
    assert parts[-1].low is None and len(parts) > 10
    job.run(read, wave=3, waves=2)
    assert {r["status"]: r["chunks"] for r in job.summary().collect()} == {"completed": 6, "pending": len(parts) - 6}
    # Another process takes it up: the plan is the first one's, and nothing is read twice.
    again = extract.Extract(spark, str(tmp_path / "x"))
    assert again.plan(extract.planned(df, "k", 50)) == parts
    again.run(read, wave=3)
    assert sorted(sum(reads, [])) == [p.n for p in parts]
    assert bag(again.rows()) == bag(df) and again.damaged().count() == 0
    summary = again.summary().collect()
    assert [(r["status"], r["chunks"], r["rows"], r["retries"]) for r in summary] == [("completed", len(parts), 102, 0)]
    again.run(read)
    assert sorted(sum(reads, [])) == [p.n for p in parts]


def test_a_write_that_was_not_recorded_is_not_read(spark, tmp_path, monkeypatch):
    df = some(spark)
    job = extract.Extract(spark, str(tmp_path / "x"))
    job.plan(extract.planned(df, "k", 30))
    record = extract.Extract._record

    def ends(self, rows):
        raise KeyboardInterrupt  # after the data are written, before the ledger is

    monkeypatch.setattr(extract.Extract, "_record", ends)
    with pytest.raises(KeyboardInterrupt):
        job.run(extract.from_table(df, "k"), wave=2)
    assert glob.glob(f"{tmp_path}/x/data/chunk=0/*/*.parquet") and job.ledger().count() == 0
    monkeypatch.setattr(extract.Extract, "_record", record)
    job.run(extract.from_table(df, "k"), wave=2)
    assert bag(job.rows()) == bag(df)


def test_failures_are_recorded_and_hold_up_no_other_chunk(spark, tmp_path):
    df, tries = some(spark), []
    table = extract.from_table(df, "k")

    def read(parts):
        tries.append([p.n for p in parts])
        if any(p.n == 2 for p in parts) and sum(2 in t for t in tries) < 3 or any(p.n == 4 for p in parts) and sum(4 in t for t in tries) < 9:
            raise OSError("the server went away")
        return table(parts)

    job = extract.Extract(spark, str(tmp_path / "x"))
    n = len(job.plan(extract.planned(df, "k", 10)))
    job.run(read, wave=n, attempts=3)
    state = {r["n"]: r for r in job.chunks().collect()}
    assert state[2]["status"] == "completed" and state[2]["retries"] == 1 and state[4]["status"] == "failed" and state[4]["retries"] == 2
    assert state[4]["error"] == "the server went away" and [p.n for p in job.pending()] == [4] and sum(r["status"] == "completed" for r in state.values()) == n - 1
    job.run(read, attempts=9)
    assert bag(job.rows()) == bag(df) and job.ledger().where("n = 4 and status = 'failed'").count() == 7


def test_damage_is_found(spark, tmp_path):
    df = some(spark)
    job = extract.Extract(spark, str(tmp_path / "x"))
    job.plan(extract.planned(df, "k", 30))
    job.run(extract.from_table(df, "k"))
    lost = sorted(glob.glob(f"{tmp_path}/x/data/chunk=1/*/*.parquet"))[0]
    os.remove(lost)
    assert [r["n"] for r in job.damaged().collect()] == [1]


def test_an_extract_of_nothing_and_of_empty_ranges(spark, tmp_path):
    df = some(spark)
    job = extract.Extract(spark, str(tmp_path / "none"))
    assert job.plan(extract.planned(df.where("k > 9999"), "k", 30)) == []
    job.run(extract.from_table(df, "k"))
    assert job.summary().count() == 0
    job = extract.Extract(spark, str(tmp_path / "gap"))
    job.plan([extract.Range(0, -50, -1), extract.Range(1, 0, 30), extract.Range(2, 400, 500)])
    job.run(extract.from_table(df, "k"), wave=1)
    assert {r["n"]: (r["status"], r["rows"]) for r in job.chunks().collect()} == {0: ("completed", 0), 1: ("completed", 12), 2: ("completed", 0)}
    assert job.rows().count() == 12 and job.damaged().count() == 0


def test_jobs_and_directories_of_an_extract_do_not_grow_with_its_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(extract, "PASSES", 3, raising=False)
    monkeypatch.setattr(extract, "DIRECTORIES", 20, raising=False)
    df, reads = some(spark, 900), []
    table = extract.from_table(df, "k")

    def read(parts):
        reads.append([p.n for p in parts])
        if 400 in reads[-1] and len(parts) > 1:
            raise OSError("the server went away")
        return table(parts)

    job = extract.Extract(spark, str(tmp_path / "x"))
    parts = job.plan(extract.planned(df, "k", 2))
    assert len(parts) > 400
    job.run(read, wave=1, waves=1)
    job.run(read)
    # One chunk at first, then three jobs, of which that with chunk 400 is taken apart: three jobs, and one for each chunk of the last.
    assert len(reads) == 1 + 3 + 3 + sum(len(r) == 1 for r in reads[1:]) and sum(len(r) == 1 for r in reads) < 70
    assert len(glob.glob(f"{tmp_path}/x/data/chunk=*")) <= 20
    bounds = {p.n: (p.low, p.high) for p in parts}
    rows = job.rows().collect()
    assert bag(job.rows()) == bag(df) and all(r["k"] is None if bounds[r["chunk"]][0] is None else bounds[r["chunk"]][0] <= r["k"] <= bounds[r["chunk"]][1] for r in rows)
    assert {r["n"]: r["rows"] for r in job.chunks().collect()} == {n: sum(r["chunk"] == n for r in rows) for n in bounds}
    lost = sorted(glob.glob(f"{tmp_path}/x/data/chunk=0/*/*.parquet"))[0]
    gone = spark.read.parquet(lost).groupBy("_chunk").count().collect()
    os.remove(lost)
    assert sorted(r["n"] for r in job.damaged().collect()) == sorted(r["_chunk"] for r in gone)


def test_chunks_of_many_separate_ranges_are_told(spark):
    parts = [extract.Range(2 * i, 10 * i, 10 * i + 4) for i in range(1500)] + [extract.Range(7000 + i, -(2**63) + 3 * i, -(2**63) + 3 * i + 2) for i in range(4)] + [extract.Range(9000, 2**63 - 5, 2**63 - 1), extract.Range(9001, None, None)]
    keys = [None, 0, 4, 5, 9, 7777, 14990, 14994, 14995, -(2**63), -(2**63) + 5, -(2**63) + 12, 2**63 - 6, 2**63 - 1]
    want = [next((p.n for p in parts if (k is None) == (p.low is None) and (k is None or p.low <= k <= p.high)), None) for k in keys]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k long")
    assert [r["c"] for r in df.select("i", extract.chunk_of("k", parts).alias("c")).orderBy("i").collect()] == want


def test_a_database_is_extracted_by_one_query_a_chunk(spark, tmp_path):
    url, driver = f"jdbc:derby:memory:{tmp_path.name};create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    df = some(spark, 40).toDF("K", "V")
    try:
        df.write.format("jdbc").options(url=url, dbtable="T", driver=driver).save()
    except Exception as error:  # noqa: BLE001  no database on the class path
        pytest.skip(str(error)[:80])
    job = extract.Extract(spark, str(tmp_path / "x"))
    job.plan(extract.planned(df, "K", 10))
    job.run(extract.from_jdbc(spark, url, "T", "K", driver=driver), wave=3)
    assert bag(job.rows().toDF("chunk", "k", "v")) == bag(df.toDF("k", "v")) and job.ledger().where("status <> 'completed'").count() == 0


def scanned(spark, path, **options):
    scan = files.scan_delimited(spark, str(path), **options)
    return [tuple(r) for r in scan.rows.collect()], sorted((r["reason"], r["kept"], r["line"]) for r in scan.rejected.collect())


def test_bad_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,a,x\n2,b,y,extra\n3,c\n\n4,"d,e","f ""g"""\n5,5" disk,z\n6,"h\ni, j",k\n7,"l",m,n,o\n')
    rows, bad = scanned(spark, tmp_path / "a.csv")
    assert sorted(rows) == [("1", "a", "x"), ("3", "c", None), ("4", "d,e", 'f "g"'), ("5", '5" disk', "z"), ("6", "h\ni, j", "k")]
    assert bad == [(files.TOO_FEW, True, "3,c"), (files.TOO_MANY, False, "2,b,y,extra"), (files.TOO_MANY, False, '7,"l",m,n,o')]


def test_a_quote_that_never_closes_is_reported_and_takes_nothing_in(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text('id,name\n1,a\n2,"b\n3,c\n4,d\n')
    (tmp_path / "in/b.csv").write_text("id,name\n5,e\n6,f,g\n")
    rows, bad = scanned(spark, tmp_path / "in")
    assert sorted(rows) == [("1", "a"), ("5", "e")]
    assert bad == [(files.TOO_MANY, False, "6,f,g")] + [(files.UNCLOSED, False, x) for x in ('2,"b', "3,c", "4,d")]


@pytest.mark.parametrize("coding", ["utf-8", "iso-8859-1"])
def test_quoted_files_stay_split(spark, tmp_path, coding):
    """Records over several lines and over the borders of blocks, against Python's reader."""
    import csv
    import random

    rng = random.Random(6)
    cell = lambda: "".join(rng.choice(["a", "é", ",", "\n", '"', " ", "bc", "\n\n"]) for _ in range(rng.randrange(9)))
    rows = [[f"{i}", cell(), cell() + "x"] for i in range(3000)]
    with open(tmp_path / "a.csv", "w", newline="", encoding=coding) as out:
        csv.writer(out, lineterminator="\n").writerows([["id", "name", "note"], *rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = files.scan_delimited(spark, str(tmp_path / "a.csv"))
        assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 10
        assert sorted(map(tuple, scan.rows.collect())) == sorted((a, b or None, c) for a, b, c in rows)
        assert scan.rejected.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_only_files_with_odd_quotes_are_joined(spark, tmp_path):
    top = tmp_path / "in put"
    top.mkdir()
    (top / "a.csv").write_text("\ufeffid;name\n1;a\n", encoding="utf-8")
    (top / "b.csv").write_text('id;name\n2;"b\nb"\n')
    (top / "c.csv").write_bytes('id;name\n3;ñ\n'.encode("latin-1"))
    kinds = files.file_kinds(spark, str(top))
    assert {k: [os.path.basename(f) for f in v] for k, v in kinds.items()} == {("utf-8", False): ["a.csv"], ("utf-8", True): ["b.csv"], ("iso-8859-1", False): ["c.csv"]}
    rows, bad = scanned(spark, top)
    assert sorted(rows) == [("1", "a"), ("2", "b\nb"), ("3", "ñ")] and bad == []
    assert files.scan_delimited(spark, str(top)).rows.columns == ["id", "name"]


def test_delimited_edge_cases(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert scanned(spark, tmp_path / "empty.csv") == ([], [])
    (tmp_path / "head.csv").write_text("a,b\n")
    assert scanned(spark, tmp_path / "head.csv") == ([], [])
    (tmp_path / "twice.csv").write_text('a,,a,"b.c"\n1,2,3,4\n')
    scan = files.scan_delimited(spark, str(tmp_path / "twice.csv"))
    assert scan.rows.columns == ["a", "_c1", "a_2", "b.c"] and scan.rows.first() == ("1", "2", "3", "4")
    wide = ",".join(f"c{i}" for i in range(6000))
    (tmp_path / "wide.csv").write_text(wide + "\n" + '"a\nb"' + "," * 5999 + '\n"' + '""' * 30000 + '"' + "," * 6000 + "\n")
    scan = files.scan_delimited(spark, str(tmp_path / "wide.csv"))
    assert len(scan.rows.columns) == 6000 and [r["c0"] for r in scan.rows.select("c0").collect()] == ["a\nb"] and [r["reason"] for r in scan.rejected.collect()] == [files.TOO_MANY]
    (tmp_path / "known.csv").write_bytes("a,b\né,1\n".encode("latin-1"))
    assert scanned(spark, tmp_path / "known.csv", encoding="iso-8859-1", separator=",")[0] == [("é", "1")]


def test_runs_are_held_against_the_registry(spark, tmp_path):
    body = "id_venta,fecha_venta,monto,producto,estado\n1,2026-04-01,1500.50,Mouse,vendido\n2,2026-04-02,200,Teclado,cambio\n"
    for name, text in {"a": body, "b": body.replace("estado\n", "estado,canal\n").replace("vendido\n", "vendido,web\n").replace("cambio\n", "cambio,web\n"), "c": body.replace("monto", "otra")}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "ventas.csv").write_text(text)
    run = lambda name: pipeline.run(spark, str(tmp_path / name), str(tmp_path / "out"), name, schemas=str(tmp_path / "schemas"), anchors=str(tmp_path / "anchors"))
    first, wider, broken = run("a"), run("b"), run("c")
    # Each run that got through left a version of the statistics, under which its rows come out as they did.
    saved = semantic.Anchors.read(spark, str(tmp_path / "anchors/ventas"), 1)
    assert set(saved.money) == {"monto"} and sorted(f.name for f in (tmp_path / "anchors/ventas").iterdir()) == ["version=1", "version=2"]
    done = first.tables["ventas"]
    assert sorted(semantic.enrich(done.select("monto", "producto"), saved).select("monto_final").collect()) == sorted(done.select("monto_final").collect())
    assert first.schemas["ventas"].first_time and not first.errors
    assert not wider.errors and wider.schemas["ventas"].changes == [("canal", "added", "warn")]
    assert "monto missing" in broken.errors["ventas"] and not broken.tables
    log = schemas.Registry(spark, str(tmp_path / "schemas")).log()
    assert {(r["run"], r["first_time"], r["fatal"]) for r in log.collect()} == {("a", True, False), ("b", False, False), ("c", False, True)}


def test_versions_are_compared_and_appended(spark, tmp_path):
    registry = schemas.Registry(spark, str(tmp_path / "s"))
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1, "x")], "a long, b string")
    assert registry.load("t") is None and registry.evaluate("t", one, "r1").first_time
    assert not registry.append("t", two, "other", 0)  # the version is taken
    assert registry.evaluate("t", two, "r2").changes == [("a", "widened", "warn"), ("b", "added", "warn")]
    assert registry.accept("t", two, "r2") == 2 and registry.evaluate("t", two, "r3").changes == []
    assert registry.load("t", 1)["run"] == "r1" and registry.evaluate("t", one, "r4").fatal
    with pytest.raises(schemas.DriftError, match="b missing"):
        registry.check("t", one, "r5")
