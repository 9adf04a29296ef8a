"""Queries of sources, sinks and streams. They write to a folder of their own under spark.checkpoint.dir and read it again."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tamiz.operators import cleaning, rules, semantic
from tamiz.operators.stage import shared_home
from tamiz.plans import pipeline
from tamiz.plans import q_clean as C
from tamiz.plans import q_semantic as S
from tamiz.plans.catalog import query
from tamiz.sources import extract, files, sinks
from tamiz.streaming import streams


def _folder(df, name):
    return f"{shared_home(df.sparkSession)}/tamiz-queries/{uuid.uuid4().hex}-{name}"


D = "dirty_sales"


@query("s1_discover_tables", "customer orders", "SELECT 'customer' AS table_name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders")
def _(c, o):
    top = _folder(c, "lake")
    c.write.parquet(f"{top}/customer.parquet")
    o.write.parquet(f"{top}/orders.parquet")
    out = None
    for name, t in files.discover_tables(c.sparkSession, top).tables.items():
        one = t.df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("s3_delimited_scan", "customer", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def _(c):
    path = _folder(c, "customers.csv")
    c.select("c_custkey", "c_name", "c_mktsegment").write.options(sep=";", header=True).csv(path)
    return files.read_delimited(c.sparkSession, path)


_BAD = "CASE WHEN c_custkey % 10 = 3 THEN 'too many fields' WHEN c_custkey % 10 = 7 THEN 'too few fields' END"


def _broken_file(c):
    """Customers as delimited files, each with a header; some lines have a field too many, some one too few, some names a line break in quotes."""
    name = F.when(F.col("c_custkey") % 10 == 1, F.concat(F.lit('"'), F.col("c_name"), F.lit(";\n"), F.col("c_mktsegment"), F.lit('"'))).otherwise(F.col("c_name"))
    last = F.when(F.col("c_custkey") % 10 == 3, F.concat(F.lit(";"), F.col("c_mktsegment"), F.lit(";odd"))).when(F.col("c_custkey") % 10 == 7, F.lit("")).otherwise(F.concat(F.lit(";"), F.col("c_mktsegment")))
    rows = c.select((F.col("c_custkey") % 4).alias("part"), F.col("c_custkey").alias("place"), F.concat(F.col("c_custkey").cast("string"), F.lit(";"), name, last).alias("line"))
    heads = c.sparkSession.range(4).select(F.col("id").alias("part"), F.lit(-1).cast("long").alias("place"), F.lit("key;name;segment").alias("line"))
    path = _folder(c, "broken.csv")
    rows.unionByName(heads).repartition("part").sortWithinPartitions("part", "place").select("line", "part").write.partitionBy("part").text(path)
    return files.scan_delimited(c.sparkSession, path)


@query("s3_rejected_lines", "customer", f"SELECT {_BAD} AS reason, c_custkey % 10 = 7 AS kept, c_custkey || ';' || c_name || CASE WHEN c_custkey % 10 = 3 THEN ';' || c_mktsegment || ';odd' ELSE '' END AS line FROM customer WHERE c_custkey % 10 IN (3, 7)")
def _(c):
    return _broken_file(c).rejected.select("reason", "kept", "line")


@query("s3_rows_beside_rejected", "customer", "SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 10 = 1 THEN c_name || ';' || chr(10) || c_mktsegment ELSE c_name END AS name, CASE WHEN c_custkey % 10 <> 7 THEN c_mktsegment END AS segment FROM customer WHERE c_custkey % 10 <> 3")
def _(c):
    return _broken_file(c).rows


@query("s5_tsv_scan", "customer", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def _(c):
    path = _folder(c, "customers.tsv")
    c.select("c_custkey", "c_name").write.options(sep="\t", header=True).csv(path)
    return files.read(c.sparkSession, path, "tsv")


@query("s6_json_flatten", "events", "SELECT event_id, event_type AS \"kind.type\", CAST(json_extract_string(props, '$.k') AS BIGINT) AS \"kind.props.k\" FROM events")
def _(e):
    path = _folder(e, "events.json")
    nested = e.select("event_id", F.struct(F.col("event_type").alias("type"), F.from_json("props", "k long").alias("props")).alias("kind"))
    nested.write.json(path)
    return files.read(e.sparkSession, path, "jsonl")


@query("s7_json_lines", "events", "SELECT event_id, user_id FROM events")
def _(e):
    path = _folder(e, "lines.jsonl")
    e.select("event_id", "user_id").write.json(path)
    return files.read(e.sparkSession, path, "jsonl")


@query("s8_parquet_scan", "lineitem", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def _(li):
    return li.select("l_orderkey", "l_quantity").where("l_quantity > 45")


@query("s9_typed_tsv", "titles", r"SELECT tconst, TRY_CAST(startYear AS INT) AS startYear, TRY_CAST(runtimeMinutes AS INT) AS runtimeMinutes FROM titles WHERE tconst <> '\N'")
def _(t):
    path = _folder(t, "basics.tsv")
    null = F.lit(None).cast("string")
    t.select("tconst", "titleType", "primaryTitle", null.alias("originalTitle"), null.alias("isAdult"), "startYear", null.alias("endYear"), "runtimeMinutes", null.alias("genres")).write.options(sep="\t", header=True, nullValue=r"\N").csv(path)
    return files.read_titles(t.sparkSession, path, "title_basics").where("tconst is not null").select("tconst", "startYear", "runtimeMinutes")


@query("s10_compatible_union", "orders", "SELECT o_orderkey AS \"Order Key\", o_orderstatus AS \"Estado\", o_totalprice AS \"Total\", 'a' AS hoja_origen FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, NULL, 'b' FROM orders")
def _(o):
    a = o.select(F.col("o_orderkey").alias("Order Key"), F.col("o_orderstatus").alias("Estado"), F.col("o_totalprice").alias("Total"))
    b = o.select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("ESTADO "), F.lit(None).cast("double").alias("total"))
    return files.union_parts({"a": a, "b": b, "c": o.select("o_custkey")})[0]


@query("s11_range_plan", "orders", "WITH s AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b, count(*) AS n FROM orders), t AS (SELECT *, CAST(greatest(500, ceil(500 * (b - a + 1) / n::DOUBLE)) AS BIGINT) AS st FROM s) SELECT CAST((x - a) / st AS INT) AS n, x AS low, least(x + st - 1, b) AS high FROM (SELECT *, unnest(generate_series(a, b, st)) AS x FROM t)")
def _(o):
    return files.plan_ranges(o, "o_orderkey", 500)


@query("s12_pending_chunks", "orders", "WITH s AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders) SELECT CAST((x - a) / 500 AS INT) AS n, x AS low, least(x + 499, b) AS high FROM (SELECT *, unnest(generate_series(a, b, 500)) AS x FROM s) WHERE CAST((x - a) / 500 AS INT) % 3 <> 0")
def _(o):
    plan = files.plan_ranges(o, "o_orderkey", 500)
    return files.pending(plan, plan.select("n", F.when(F.col("n") % 3 == 0, "completed").otherwise("failed").alias("status")))


@query("s12_ledger_summary", "orders", "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'completed' ELSE 'failed' END AS status, count(*) AS chunks, CAST(sum(o_custkey) AS BIGINT) AS rows, CAST(sum(o_orderkey % 2) AS BIGINT) AS retries, round(avg(o_totalprice), 6) AS mean_seconds FROM orders GROUP BY 1")
def _(o):
    return files.ledger_summary(o.select(F.when(F.col("o_orderkey") % 3 == 0, "completed").otherwise("failed").alias("status"), F.col("o_custkey").alias("rows"), (F.col("o_orderkey") % 2).alias("retries"), F.col("o_totalprice").alias("seconds")))


_CHUNKS = "WITH s AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b, count(*) AS n FROM orders), t AS (SELECT *, CAST(greatest(500, ceil(500 * (b - a + 1) / n::DOUBLE)) AS BIGINT) AS st FROM s)"


def _extracted(o):
    """An extract that ended after its first chunks and was taken up again."""
    job = extract.Extract(o.sparkSession, _folder(o, "s12"))
    job.plan(extract.planned(o, "o_orderkey", 500))
    read = extract.from_table(o.select("o_orderkey", "o_totalprice"), "o_orderkey")
    job.run(read, wave=2, waves=1)
    job.run(read)
    return job


@query("s12_resumed_extract", "orders", f"{_CHUNKS} SELECT o_orderkey, o_totalprice, CAST((o_orderkey - a) // st AS INT) AS chunk FROM orders, t")
def _(o):
    return _extracted(o).rows()


@query("s12_extract_ledger", "orders", f"""{_CHUNKS} SELECT CAST((o_orderkey - a) // st AS INT) AS n, a + ((o_orderkey - a) // st) * st AS low, least(a + ((o_orderkey - a) // st) * st + st - 1, b) AS high, 'completed' AS status, count(*) AS rows,
 CAST(0 AS BIGINT) AS retries, true AS intact FROM orders, t GROUP BY ALL""")
def _(o):
    job = _extracted(o)
    return job.chunks().join(job.damaged().select("n", F.lit(False).alias("intact")), "n", "left").select("n", "low", "high", "status", "rows", "retries", F.coalesce("intact", F.lit(True)).alias("intact"))


@query("s14_sql_views", "orders customer", "SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def _(o, c):
    files.register_views(o.sparkSession, {"s14_orders": o, "s14_customer": c})
    return o.sparkSession.sql("SELECT c_mktsegment, count(*) AS n FROM s14_orders JOIN s14_customer ON o_custkey = c_custkey GROUP BY 1")


@query("k1_csv_sink", "orders", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus || ';' || o_orderpriority AS flags FROM orders")
def _(o):
    path = _folder(o, "k1")
    sinks.write_csv(o.select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("flags")), path)
    return o.sparkSession.read.option("header", True).csv(path)


@query("k2_parquet_sink", D, "SELECT row_no, coalesce(estado, '') || '|' || coalesce(notas_jose, '') AS flags, (SELECT count(*) FROM dirty_sales) AS written FROM dirty_sales")
def _(d):
    path = _folder(d, "k2")
    written = sinks.write_parquet(d.select("row_no", F.array(F.coalesce("estado", F.lit("")), F.coalesce("notas_jose", F.lit(""))).alias("flags")), path)
    return d.sparkSession.read.parquet(path).select("row_no", F.array_join("flags", "|").alias("flags"), F.lit(written).cast("long").alias("written"))


@query("k3_partitioned_sink", "orders", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(o):
    path = _folder(o, "k3")
    sinks.write_parquet(o, path, ["o_orderstatus"])
    return o.sparkSession.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


#: So short that the files of small tables have several ranges too.
_RANGE = 2**14


@query("k4_zstd_sink", "orders", "SELECT o_orderkey, o_totalprice, true AS hashed FROM orders")
def _(o):
    """The rows read back, each beside whether its file's checksum is the one that SQL functions find, range by range."""
    path = _folder(o, "k4")
    listed = sinks.write_zstd(o, path, block=_RANGE).select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), "checksum")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(_RANGE).cast("long"))
    parts = F.transform(starts, lambda at: F.md5(F.substring("content", at.cast("int") + 1, F.lit(_RANGE))))
    own = F.when(F.col("length") <= _RANGE, F.md5("content")).otherwise(F.concat(F.md5(F.array_join(parts, "")), F.lit("-"), F.size(parts)))
    files = o.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), own.alias("own"))
    listed = listed.join(files, "name").select("name", (F.col("checksum") == F.col("own")).alias("hashed"))
    rows = o.sparkSession.read.parquet(path).select("o_orderkey", "o_totalprice", F.col("_metadata.file_name").alias("name"))
    return rows.join(listed, "name", "left").select("o_orderkey", "o_totalprice", F.coalesce("hashed", F.lit(False)).alias("hashed"))


@query("k5_quarantine_sink", "orders", "SELECT 'negative' AS reason, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'odd', count(*) FROM orders WHERE o_orderkey % 2 = 1")
def _(o):
    path = _folder(o, "k5")
    sinks.quarantine(o.where("o_orderkey % 2 = 0"), path, "negative")
    sinks.quarantine(o.where("o_orderkey % 2 = 1"), path, "odd")
    return o.sparkSession.read.parquet(path).groupBy("reason").agg(F.count("*").alias("n"))


@query("k7_run_manifest", "orders customer", "SELECT 'customer' AS name, count(*) AS n, true AS hashed FROM customer UNION ALL SELECT 'orders', count(*), true FROM orders")
def _(o, c):
    """Rows of each output, and whether its digest is that of its files as SQL functions hash them whole."""
    paths = {name: _folder(df, f"k7-{name}") for name, df in (("orders", o), ("customer", c))}
    sinks.write_parquet(o, paths["orders"])
    sinks.write_parquet(c, paths["customer"])
    outputs = F.from_json(F.get_json_object("manifest", "$.outputs"), "array<struct<table_name:string,rows:long,sha256:string>>")
    m = sinks.manifest(o.sparkSession, paths, {"threshold": "0.05"}).select(F.explode(outputs).alias("r")).select(F.col("r.table_name").alias("name"), F.col("r.rows").alias("n"), "r.sha256")
    files = o.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths.values()))
    digest = F.sha2(F.array_join(F.array_sort(F.collect_list("one")), ","), 256)
    own = files.select(F.regexp_extract("path", "k7-([a-z]+)", 1).alias("name"), F.sha2("content", 256).alias("one")).groupBy("name").agg(digest.alias("own"))
    return m.join(own, "name").select("name", "n", (F.col("sha256") == F.col("own")).alias("hashed"))


@query("k8_flat_columns", "orders", "SELECT o_orderkey, o_orderstatus || ';' || o_orderpriority AS tags, '{\"a\":' || o_custkey || '}' AS s, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END AS maybe FROM orders")
def _(o):
    return sinks.flat(o.select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("tags"), F.struct(F.col("o_custkey").alias("a")).alias("s"), F.when(F.col("o_orderkey") % 2 == 1, F.array("o_orderstatus")).alias("maybe")))


@query("k9_publish", "part lineitem", "SELECT p_brand, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS units FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def _(p, li):
    sinks.publish({"k9_part": p, "k9_lineitem": li}, _folder(p, "k9"))
    return p.sparkSession.sql("SELECT p_brand, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS units FROM k9_lineitem JOIN k9_part ON l_partkey = p_partkey GROUP BY 1")


@query("x1_streaming_clean", D, f"SELECT row_no, {C.SCORE} < 50 AS quarantined FROM dirty_sales")
def _(d):
    top = _folder(d, "x1")
    d.write.parquet(f"{top}/in")
    streams.clean_stream(d.sparkSession, f"{top}/in", d.schema, cleaning.clean_transactional, rules.split_by_score, f"{top}/out", f"{top}/checkpoint")
    read = lambda part, q: d.sparkSession.read.parquet(f"{top}/out/{part}").select("row_no", F.lit(q).alias("quarantined"))
    return read("valid", False).unionByName(read("quarantine", True))


@query("x1_streaming_enrich", D, S.MONEY_SQL)
def _(d):
    """Anchors learned and saved by a batch run, then used row by row on a stream of the same rows."""
    spark, top = d.sparkSession, _folder(d, "x1-enrich")
    rows = d.select("row_no", "monto", "producto")
    rows.write.parquet(f"{top}/in")
    semantic.learn(spark.read.parquet(f"{top}/in")).save(spark, f"{top}/anchors")
    streams.enrich_stream(spark, f"{top}/in", rows.schema, semantic.Anchors.read(spark, f"{top}/anchors"), f"{top}/out", f"{top}/checkpoint")
    out = spark.read.parquet(f"{top}/out").drop("producto_domain_flag")
    return out.withColumns({c: F.round(c, 4) for c in ("monto_monto_origen", "monto_final")})


_DAY = f"strftime({C.DATE}, '%Y-%m-%d')"


@query("x2_flag_counts", D, f"""SELECT {_DAY} AS day, CAST(NULL AS VARCHAR) AS flag, count(*) AS n, count(*) - count(producto) AS nulls_producto, CAST(sum({C.SCORE}) AS BIGINT) AS score_sum, count({C.SCORE}) AS scored FROM dirty_sales WHERE {C.DATE} IS NOT NULL GROUP BY 1
 UNION ALL SELECT day, flag, count(*), count(*) - count(producto), CAST(sum(score) AS BIGINT), count(score) FROM (SELECT {_DAY} AS day, producto, {C.SCORE} AS score, unnest({C.FLAGS}) AS flag FROM dirty_sales WHERE {C.DATE} IS NOT NULL) GROUP BY 1, 2""")
def _(d):
    """Cleaned sales arrive as a stream; their dates are the event time, so an hour is a day's first one."""
    spark, top = d.sparkSession, _folder(d, "x2-flags")
    cleaned = cleaning.clean_transactional(d).select(F.col("fecha_venta").cast("timestamp").alias("ts"), "producto", "data_quality_flags", "quality_score").where("ts is not null")
    cleaned.write.parquet(f"{top}/in")
    stream = spark.readStream.schema(cleaned.schema).parquet(f"{top}/in")
    streams.write_hourly(streams.hourly_flags(stream, "ts", ["producto"], "data_quality_flags", "quality_score"), f"{top}/out", f"{top}/checkpoint")
    out = streams.read_hourly(spark, f"{top}/out", ["flag"])
    return out.select(F.date_format("hour", "yyyy-MM-dd").alias("day"), "flag", "n", "nulls_producto", "score_sum", "scored")


@query("x2_streaming_quality", "events", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*) AS n, count(*) - count(nullif(event_type, 'error')) AS nulls_event_type FROM events GROUP BY 1")
def _(e):
    spark, top = e.sparkSession, _folder(e, "x2")
    e.select(F.col("ts").cast("timestamp").alias("ts"), F.nullif(F.col("event_type"), F.lit("error")).alias("event_type")).write.parquet(f"{top}/in")
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(f"{top}/in")
    out = streams.hourly_quality(stream, "ts", ["event_type"])
    streams.write_hourly(out, f"{top}/out", f"{top}/checkpoint")
    return streams.read_hourly(spark, f"{top}/out").select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "n", "nulls_event_type")


@query("pipeline_dirty_sales", D, f"SELECT CASE WHEN {C.SCORE} < 50 THEN 'quarantined' ELSE 'valid' END AS part, count(*) AS n FROM dirty_sales GROUP BY 1")
def _(d):
    valid, rejected, _ = pipeline.process(d, "dirty_sales")
    return valid.agg(F.count("*").alias("n")).select(F.lit("valid").alias("part"), "n").unionByName(rejected.agg(F.count("*").alias("n")).select(F.lit("quarantined").alias("part"), "n"))
