"""Queries of lake checks, keys and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.operators import lake
from tamiz.plans.catalog import query
from tamiz.plans.q_files import _folder

_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}
_TABLES = {
    "region": [("r_regionkey", "INTEGER"), ("r_name", "VARCHAR")],
    "nation": [("n_nationkey", "INTEGER"), ("n_name", "VARCHAR"), ("n_regionkey", "INTEGER")],
    "supplier": [("s_suppkey", "BIGINT"), ("s_name", "VARCHAR"), ("s_nationkey", "INTEGER"), ("s_acctbal", "DOUBLE")],
    "customer": [("c_custkey", "BIGINT"), ("c_name", "VARCHAR"), ("c_nationkey", "INTEGER"), ("c_acctbal", "DOUBLE"), ("c_mktsegment", "VARCHAR")],
    "orders": [("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "VARCHAR"), ("o_totalprice", "DOUBLE"), ("o_orderdate", "TIMESTAMP"), ("o_orderpriority", "VARCHAR")],
}
_LAKE = "region nation supplier customer orders"


def _audit_sql(t):
    out = []
    for c, k in _TABLES[t]:
        num, null = k in ("INTEGER", "BIGINT", "DOUBLE"), "CAST(NULL AS BIGINT)"
        key = c.lower().endswith(("key", "id"))
        out.append(f"""SELECT '{t}' AS table_name, count(*) AS n_rows, '{c}' AS column_name, '{_TYPES[k]}' AS kind, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS uniques,
 {f'min({c})::DOUBLE' if num else 'CAST(NULL AS DOUBLE)'} AS low, {f'max({c})::DOUBLE' if num else 'CAST(NULL AS DOUBLE)'} AS high, {f'max(length({c}))' if k == 'VARCHAR' else null} AS longest,
 {f'count(CASE WHEN {c} < 0 THEN 1 END)' if num else null} AS negatives, {f'count(CASE WHEN abs({c}) > 2147483647 THEN 1 END)' if k == 'BIGINT' else null} AS over_int,
 {f'count(CASE WHEN isnan({c}) OR isinf({c}) THEN 1 END)' if k == 'DOUBLE' else null} AS infinite, {f'count(CASE WHEN year({c}) NOT BETWEEN 1900 AND 2100 THEN 1 END)' if k == 'TIMESTAMP' else null} AS bad_dates,
 round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) AS null_pct, {f"CASE WHEN count({c}) = count(*) AND count(DISTINCT {c}) = count(*) THEN 'PK' ELSE 'FK' END" if key else 'CAST(NULL AS VARCHAR)'} AS key_role FROM {t}""")
    return " UNION ALL ".join(out)


_AUDIT = " UNION ALL ".join(_audit_sql(t) for t in _TABLES)


def _audited(*tables):
    out = None
    for name, df in zip(_TABLES, tables):
        one = lake.audit(df, name)
        out = one if out is None else out.unionByName(one)
    return out


@query("a20_table_audit", _LAKE, _AUDIT)
def _(*t):
    return _audited(*t)


@query("a20_footer_figures", _LAKE, f"SELECT table_name, column_name, n_rows, nulls, low, high, true AS from_footers FROM ({_AUDIT})")
def _(*t):
    """Rows, nulls and extremes of the audit, told by the footers of the tables' own files."""
    tables = {name: df.inputFiles() for name, df in zip(_TABLES, t)}
    return lake.footer_figures(t[0].sparkSession, tables).drop("kind")


def _dirty(o):
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 20 == 0, F.col("o_orderpriority")).alias("sparse"), F.lit(None).cast("string").alias("empty"),
                    (F.col("o_orderkey") * 1_000_000_000).alias("wide"), F.when(F.col("o_orderkey") % 9 == 0, F.lit(float("inf"))).otherwise(F.col("o_totalprice")).alias("price"),
                    F.when(F.col("o_orderkey") % 7 == 0, F.lit("1800-01-01").cast("date")).otherwise(F.col("o_orderdate").cast("date")).alias("day"), F.repeat(F.col("o_orderstatus"), 4001).alias("text"))


@query("a21_audit_issues", "orders", """SELECT 'dirty' AS table_name, column_name, severity, issue FROM (VALUES ('sparse', 'info', 'mostly null'), ('empty', 'warning', 'all null'), ('wide', 'info', 'exceeds int'), ('price', 'high', 'infinite values'), ('day', 'high', 'dates out of range'), ('text', 'warning', 'long text')) AS v(column_name, severity, issue)
 WHERE (SELECT count(*) FROM orders WHERE o_orderkey % 63 = 0) > 0""")
def _(o):
    return lake.issues(lake.audit(_dirty(o), "dirty"))


_SHAPED = ["id_venta", "fecha_venta", "monto", "producto", "estado"]
_SHAPE = """CASE WHEN trim(x) = '' OR x IS NULL THEN NULL WHEN regexp_matches(trim(x), '^[+-]?[0-9]+$') THEN 'integer' WHEN regexp_matches(trim(x), '^[+-]?([0-9]+[.,][0-9]*|[.,][0-9]+)$') THEN 'number'
 WHEN regexp_matches(trim(x), '^([0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{2,4})') THEN 'date' WHEN lower(trim(x)) IN ('true', 'false') THEN 'boolean' ELSE 'text' END"""
_MIXED = "WITH v AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS x FROM dirty_sales" for c in _SHAPED) + f"""), s AS (SELECT column_name, {_SHAPE} AS shape, count(*) AS n FROM v GROUP BY ALL)
 SELECT 'sales' AS table_name, column_name, 'high' AS severity, 'mixed types' AS issue, 'text' AS kind, string_agg(shape || ':' || n, ',' ORDER BY shape) AS counts FROM s WHERE shape IS NOT NULL GROUP BY column_name HAVING count(DISTINCT CASE WHEN shape = 'integer' THEN 'number' ELSE shape END) > 1"""


@query("a21_mixed_types", "dirty_sales", _MIXED)
def _(d):
    """Counted by halves of the table, which add up."""
    d = d.select("row_no", *_SHAPED)
    parts = [lake.value_shapes(d.where(F.col("row_no") % 2 == k), "sales") for k in (0, 1)]
    return lake.mixed_types(parts[0].unionByName(parts[1]))


@query("a22_critical_issues", "orders dirty_sales", f"""SELECT table_name, column_name, severity, issue FROM ({_MIXED}) UNION ALL SELECT 'dirty', c, 'high', i FROM (VALUES ('price', 'infinite values'), ('day', 'dates out of range')) AS t(c, i) WHERE (SELECT count(*) FROM orders WHERE o_orderkey % 63 = 0) > 0""")
def _(o, d):
    mixed = lake.mixed_types(lake.value_shapes(d.select(_SHAPED), "sales")).select("table_name", "column_name", "severity", "issue")
    return lake.critical_issues(mixed, lake.issues(lake.audit(_dirty(o), "dirty")))


@query("a22_lake_summary", _LAKE, f"WITH a AS ({_AUDIT}) SELECT table_name, max(n_rows) AS n_rows, count(*) AS n_columns, coalesce(string_agg(CASE WHEN key_role = 'PK' THEN column_name END, ',' ORDER BY column_name), '') AS pks, coalesce(string_agg(CASE WHEN key_role = 'FK' THEN column_name END, ',' ORDER BY column_name), '') AS fks, CAST(0 AS BIGINT) AS n_high, CAST(0 AS BIGINT) AS n_warning, CAST(0 AS BIGINT) AS n_info FROM a GROUP BY table_name")
def _(*t):
    return lake.lake_summary(_audited(*t))


@query("a22_shared_keys", "lineitem orders", "SELECT k AS column_name, count(*) AS n_tables FROM (VALUES ('orderkey'), ('partkey'), ('suppkey'), ('orderkey'), ('custkey')) AS v(k) WHERE (SELECT count(*) FROM lineitem) > 0 GROUP BY k")
def _(li, o):
    bare = lambda df: df.toDF(*[c[2:] for c in df.columns])
    return lake.shared_keys(lake.audit(bare(li), "lineitem").unionByName(lake.audit(bare(o), "orders")))


@query("j1_flatten_hierarchy", "nation region customer", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def _(n, r, c):
    return lake.flatten(c.withColumnRenamed("c_nationkey", "n_nationkey"), (n.withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey"), (r, "r_regionkey"))


@query("j2_duplicate_keys", "lineitem", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(li):
    return lake.duplicate_keys(li, "l_orderkey")


@query("j2_guarded_join", "orders customer", "SELECT o_custkey AS k, o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(o, c):
    return lake.guarded_left_join(o.select(F.col("o_custkey").alias("k"), "o_orderkey"), c.select(F.col("c_custkey").alias("k"), "c_name"), "k")


_ORPHANS = """WITH lost AS (SELECT l_partkey FROM lineitem_broken WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)), t AS (SELECT count(*) AS n FROM lineitem_broken)
SELECT 'l_partkey' AS fk, 'p_partkey' AS pk, n AS fact_rows, (SELECT count(*) FROM lost) AS orphan_rows, (SELECT count(DISTINCT l_partkey) FROM lost) AS orphan_keys,
 round((SELECT count(*) FROM lost) / n::DOUBLE, 6) AS orphan_ratio, round(1 - (SELECT count(*) FROM lost) / n::DOUBLE, 6) AS confidence FROM t"""


@query("j3_orphan_ratio", "lineitem_broken part", _ORPHANS)
def _(li, p):
    return lake.orphans(li, p, "l_partkey", "p_partkey")


@query("j4_fk_consistency", "lineitem_broken part supplier", _ORPHANS + """ UNION ALL SELECT 'l_suppkey', 's_suppkey', count(*), count(CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier) THEN 1 END), count(DISTINCT CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier) THEN l_suppkey END),
 round(count(CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier) THEN 1 END) / count(*)::DOUBLE, 6), round(1 - count(CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier) THEN 1 END) / count(*)::DOUBLE, 6) FROM lineitem_broken""")
def _(li, p, s):
    return lake.orphans(li, p, "l_partkey", "p_partkey").unionByName(lake.orphans(li, s, "l_suppkey", "s_suppkey"))


@query("j6_fk_inference", "nation region customer supplier", """SELECT fact, dim, fk, pk, 1.0::DOUBLE AS confidence FROM (VALUES ('nation', 'region', 'n_regionkey', 'r_regionkey'), ('customer', 'nation', 'c_nationkey', 'n_nationkey'), ('supplier', 'nation', 's_nationkey', 'n_nationkey')) AS v(fact, dim, fk, pk)
 WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation))""")
def _(n, r, c, s):
    return lake.inferred_relationships({"nation": n, "region": r, "customer": c.withColumnRenamed("c_custkey", "c_customerkey"), "supplier": s.withColumnRenamed("s_suppkey", "s_supplierkey")})


_VALUES = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"], "supplier": ["s_suppkey", "s_name", "s_nationkey"], "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"], "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]}


@query("j6_inclusions", " ".join(_VALUES), "WITH v AS (" + " UNION ALL ".join(f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL" for t, cs in _VALUES.items() for c in cs) + """),
 k AS (""" + " UNION ALL ".join(f"SELECT '{t}' AS t, '{c}' AS c, count(*) = count(DISTINCT {c}) AS is_key, count(DISTINCT {c}) AS n FROM {t}" for t, cs in _VALUES.items() for c in cs) + """)
 SELECT a.t AS fact, a.c AS fk, b.t AS dim, b.c AS pk, any_value(k.n) AS n_values, round(count(*) / any_value(k.n)::DOUBLE, 6) AS confidence
 FROM v a JOIN v b ON a.v = b.v AND a.t <> b.t JOIN k ON k.t = a.t AND k.c = a.c JOIN k kb ON kb.t = b.t AND kb.c = b.c AND kb.is_key GROUP BY 1, 2, 3, 4 HAVING count(*) = any_value(k.n)""")
def _(*t):
    """All true inclusions among columns of the given tables, by their values."""
    return lake.inclusions({name: df.select(cs) for (name, cs), df in zip(_VALUES.items(), t)})


@query("j7_key_candidates", _LAKE, f"SELECT table_name, column_name, key_role FROM ({_AUDIT}) WHERE key_role IS NOT NULL")
def _(*t):
    return _audited(*t).where("key_role is not null").select("table_name", "column_name", "key_role")


_BARE = "SELECT 'region' AS t, 'regionkey' AS c, count(*) AS n, CASE WHEN count(*) = count(DISTINCT r_regionkey) THEN 'PK' ELSE 'FK' END AS k FROM region UNION ALL SELECT 'nation', 'regionkey', count(*), CASE WHEN count(*) = count(DISTINCT n_regionkey) THEN 'PK' ELSE 'FK' END FROM nation UNION ALL SELECT 'nation', 'nationkey', count(*), CASE WHEN count(*) = count(DISTINCT n_nationkey) THEN 'PK' ELSE 'FK' END FROM nation UNION ALL SELECT 'customer', 'nationkey', count(*), CASE WHEN count(*) = count(DISTINCT c_nationkey) THEN 'PK' ELSE 'FK' END FROM customer"


def _bare_audit(r, n, c):
    bare = lambda df: df.toDF(*[x[2:] for x in df.columns])
    return lake.audit(bare(r), "region").unionByName(lake.audit(bare(n), "nation")).unionByName(lake.audit(bare(c), "customer"))


@query("j8_relationship_matrix", "region nation customer", f"WITH k AS ({_BARE}) SELECT DISTINCT d.t AS dimension, f.t AS fact, d.c AS column_name, CASE WHEN d.k = 'PK' THEN 'many-to-one' ELSE 'suspected' END AS kind FROM k d JOIN k f ON d.c = f.c AND d.n < f.n")
def _(r, n, c):
    return lake.relationships(_bare_audit(r, n, c))


_KEYS9 = [("region", "regionkey", "r_regionkey"), ("nation", "nationkey", "n_nationkey"), ("nation", "regionkey", "n_regionkey"), ("customer", "custkey", "c_custkey"), ("customer", "nationkey", "c_nationkey")]


@query("j9_snowflakes", "region nation customer", "WITH k AS (" + " UNION ALL ".join(f"SELECT '{t}' AS t, '{k}' AS k, count(*) AS n, count(DISTINCT {c}) = count(*) AS pk FROM {t}" for t, k, c in _KEYS9) + ") SELECT d.t AS dimension, f.t AS fact, d.k AS column_name, CASE WHEN d.pk THEN 'many-to-one' ELSE 'suspected' END AS kind FROM k d JOIN k f ON d.k = f.k AND d.n < f.n WHERE f.t <> 'customer'")
def _(r, n, c):
    return lake.snowflakes(lake.relationships(_bare_audit(r, n, c)), ["customer"])


@query("j10_stub_dimension", "lineitem_broken part", "SELECT DISTINCT l_partkey AS p_partkey, 'Unknown' AS p_name, 'Unknown' AS p_brand, true AS is_recovered_stub FROM lineitem_broken WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)")
def _(li, p):
    return lake.recovered_dim([(li, "l_partkey")], "p_partkey", ["p_name", "p_brand"], p)


@query("j11_recovered_checks", "lineitem_broken", "SELECT count(l_partkey) - count(DISTINCT l_partkey) AS duplicate_keys, 'mostly' AS mostly_null FROM lineitem_broken")
def _(li):
    return lake.recovered_checks(li.select("l_partkey", "l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.col("l_suppkey")).alias("mostly")), "l_partkey")


@query("j13_unify_schema", "orders", """SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) = CAST(o_totalprice AS VARCHAR) AS ok, TRY_CAST(o_orderstatus AS BIGINT) AS mixed, o_orderpriority AS extra FROM orders
 UNION ALL SELECT o_orderkey, true, o_custkey, NULL FROM orders""")
def _(o):
    a = o.select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("mixed"), F.col("o_orderpriority").alias("extra"))
    b = o.select("o_orderkey", F.col("o_custkey").alias("price"), F.col("o_custkey").alias("mixed"))
    return lake.unify([a, b]).select("o_orderkey", F.col("price").isNotNull().alias("ok"), "mixed", "extra")


@query("j13_lost_cells", "orders", """SELECT column_name, lost FROM (SELECT 'o_orderkey' AS column_name, CAST(0 AS BIGINT) AS lost UNION ALL SELECT 'price', 0 UNION ALL SELECT 'extra', 0
 UNION ALL SELECT 'mixed', (SELECT count(o_orderstatus) - count(TRY_CAST(o_orderstatus AS BIGINT)) FROM orders))""")
def _(o):
    """Two files of one table are written under one schema; the write itself counts the cells that became null."""
    a = o.select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("mixed"), F.col("o_orderpriority").alias("extra"))
    b = o.select("o_orderkey", F.col("o_custkey").alias("price"), F.col("o_custkey").alias("mixed"))
    df, lost = lake.unify_observed([a, b])
    df.write.parquet(_folder(o, "j13"))
    return o.sparkSession.createDataFrame(list(lost.get.items()), "column_name string, lost long")


@query("t20_counted_by_the_write", "orders", """SELECT 'empty_strings_nulled' AS what, count(CASE WHEN o_orderkey % 5 = 0 THEN 1 END) AS n FROM orders UNION ALL SELECT 'nan_strings_nulled', count(CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 7 = 0 THEN 1 END) FROM orders
 UNION ALL SELECT 'invalid_dates_nulled', count(CASE WHEN o_orderkey % 3 = 0 THEN 1 END) FROM orders UNION ALL SELECT 'invalid_numbers_nulled', count(CASE WHEN o_orderkey % 11 = 0 THEN 1 END) FROM orders
 UNION ALL SELECT 'texts_written', count(CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 7 > 0 THEN 1 END) FROM orders""")
def _(o):
    """A table is sanitised and written; the counts come from that write."""
    k, path = F.col("o_orderkey"), _folder(o, "t20")
    raw = o.select("o_orderkey", F.when(k % 5 == 0, " \t").when(k % 7 == 0, " NaN").otherwise(F.concat(F.lit(" "), "o_orderstatus")).alias("s"), F.when(k % 3 == 0, F.lit("1800-01-01").cast("date")).otherwise(F.col("o_orderdate").cast("date")).alias("d"), F.when(k % 11 == 0, float("inf")).otherwise(F.col("o_totalprice")).alias("x"))
    df, seen = lake.sanitized(raw)
    df.write.parquet(path)
    written = o.sparkSession.read.parquet(path).where("length(s) = 1").count()
    return o.sparkSession.createDataFrame([*seen.get.items(), ("texts_written", written)], "what string, n long")


@query("j14_schema_drift", "orders", """WITH n AS (SELECT count(o_custkey) AS k, count(o_orderdate) AS d, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f FROM orders)
 SELECT 'o_custkey' AS column_name, 'bigint' AS was, 'string' AS "is", 'type changed' AS change, k AS cells_was, k AS cells_is FROM n UNION ALL SELECT 'o_orderdate', 'timestamp', NULL, 'removed', d, NULL FROM n UNION ALL SELECT 'added', NULL, 'string', 'added', NULL, f FROM n""")
def _(o):
    """Two files of one table, written and read back: what changed between them, and how many cells that concerns."""
    spark, top = o.sparkSession, _folder(o, "j14")
    o.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")).write.parquet(f"{top}/first")
    o.drop("o_orderdate").withColumns({"o_custkey": F.col("o_custkey").cast("string"), "added": F.when(F.col("o_orderstatus") == "F", "x")}).write.parquet(f"{top}/other")
    return lake.schema_drift_cells(spark.read.parquet(f"{top}/first"), spark.read.parquet(f"{top}/other"))


@query("j14_drift_over_files", "orders", """WITH d AS (SELECT * FROM (VALUES (1, 'o_custkey', 'bigint', 'string', 'type changed'), (2, 'o_orderstatus', 'string', NULL, 'removed'), (2, 'added', NULL, 'int', 'added')) AS v(part, column_name, was, "is", change))
 SELECT part, column_name, was, "is", change, (SELECT count(*) FROM orders WHERE o_orderkey % 3 = part) AS n_rows FROM d""")
def _(o):
    """Three files of one table; the rows that a change concerns are those of its file."""
    spark, top = o.sparkSession, _folder(o, "j14-files")
    base = o.select("o_orderkey", "o_custkey", "o_orderstatus")
    part = lambda k: base.where(F.col("o_orderkey") % 3 == k).coalesce(1)
    for k, df in enumerate([part(0), part(1).withColumn("o_custkey", F.col("o_custkey").cast("string")), part(2).drop("o_orderstatus").withColumn("added", F.lit(1))]):
        df.write.parquet(f"{top}/{k}")
    number = F.regexp_extract("file", "/([0-9])/[^/]*$", 1).cast("int")
    rows = [(k, spark.read.parquet(f"{top}/{k}").count()) for k in range(3)]
    return lake.schema_drift_files(lake.file_schemas(spark, top)).withColumn("part", number).join(spark.createDataFrame(rows, "part int, n_rows long"), "part").drop("file")


@query("j12_pascal_keys", "part", "SELECT p_partkey AS \"ProductKey\", p_size AS \"DateKey\" FROM part")
def _(p):
    df = p.select(F.col("p_partkey").alias("product_key"), F.col("p_size").alias("Datekey"))
    return df.withColumnsRenamed(lake.pascal_keys(df.columns))


@query("s13_table_catalogue", _LAKE, " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES))
def _(*t):
    return lake.catalogue(dict(zip(_TABLES, t)), t[0].sparkSession)
