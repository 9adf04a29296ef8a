"""Queries of rules, quarantine, schema checks and the quality report."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.operators import cleaning, incremental, quality, rules
from tamiz.plans import q_clean as C
from tamiz.plans.catalog import query
from tamiz.plans.q_files import _folder
from tamiz.sources import schemas

D = "dirty_sales"
R = rules.Rule


def _marked(df, rule):
    df = rules.with_key_counts(df, [rule.column]) if rule.kind == "unique" else df
    return df.select("row_no", F.coalesce(rules.violation(rule), F.lit(False)).alias("bad"))


@query("r3_range", D, "SELECT row_no, monto IS NOT NULL AND NOT coalesce(TRY_CAST(monto AS DOUBLE) BETWEEN 1000 AND 200000, false) AS bad FROM dirty_sales")
def _(d):
    return _marked(d, R("r", "monto", "range", low=1000, high=200000))


@query("r4_allowed_values", D, "SELECT row_no, estado IS NOT NULL AND estado NOT IN ('Vendido', 'cambio') AS bad FROM dirty_sales")
def _(d):
    return _marked(d, R("r", "estado", "allowed_values", values=("Vendido", "cambio")))


@query("r5_regex", D, "SELECT row_no, id_venta IS NOT NULL AND NOT regexp_matches(id_venta, '^(?:TRX-[0-9]+)') AS bad FROM dirty_sales")
def _(d):
    return _marked(d, R("r", "id_venta", "regex", pattern="TRX-[0-9]+"))


@query("r6_not_null", D, "SELECT row_no, notas_jose IS NULL AS bad FROM dirty_sales")
def _(d):
    return _marked(d, R("r", "notas_jose", "not_null"))


@query("r7_unique", D, "SELECT row_no, fecha_venta IS NOT NULL AND count(*) OVER (PARTITION BY fecha_venta) > 1 AS bad FROM dirty_sales")
def _(d):
    return _marked(d, R("r", "fecha_venta", "unique"))


@query("r8_dtype", D, """SELECT row_no, monto IS NOT NULL AND (TRY_CAST(monto AS DOUBLE) IS NULL OR TRY_CAST(monto AS DOUBLE) % 1 <> 0) AS bad_int, monto IS NOT NULL AND TRY_CAST(monto AS DOUBLE) IS NULL AS bad_float,
 fecha_venta IS NOT NULL AND NOT regexp_matches(fecha_venta, '^[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}$') AS bad_date FROM dirty_sales""")
def _(d):
    one = lambda c, t: F.coalesce(rules.violation(R("r", c, "dtype", dtype=t)), F.lit(False))
    return d.select("row_no", one("monto", "int").alias("bad_int"), one("monto", "float").alias("bad_float"), one("fecha_venta", "date").alias("bad_date"))


SALES_RULES = rules.RuleSet.from_dict({
    "dataset": "dirty_sales", "required_columns": ["row_no", "monto"], "rules": [
        {"name": "amount_range", "column": "monto", "type": "range", "min": -1e6, "max": 1e6, "on_violation": "quarantine"},
        {"name": "state_known", "column": "estado", "type": "allowed_values", "values": ["Vendido", " comprado ", "PENDIENTE", "devuelto", "cambio"], "on_violation": "warn"},
        {"name": "note_present", "column": "notas_jose", "type": "not_null", "on_violation": "quarantine"},
        {"name": "absent", "column": "no_such", "type": "not_null"}, {"name": "unknown", "column": "monto", "type": "no_such_kind"},
        {"name": "row_unique", "column": "row_no", "type": "unique", "on_violation": "fail"},
    ],
})
_Q = "((monto IS NOT NULL AND NOT coalesce(TRY_CAST(monto AS DOUBLE) BETWEEN -1000000 AND 1000000, false)) OR notas_jose IS NULL)"


@query("r9_violation_counts", D, """SELECT * FROM (SELECT 'amount_range' AS rule, 'quarantine' AS action, count(CASE WHEN monto IS NOT NULL AND NOT coalesce(TRY_CAST(monto AS DOUBLE) BETWEEN -1000000 AND 1000000, false) THEN 1 END) AS n FROM dirty_sales
 UNION ALL SELECT 'state_known', 'warn', count(CASE WHEN estado NOT IN ('Vendido', ' comprado ', 'PENDIENTE', 'devuelto', 'cambio') THEN 1 END) FROM dirty_sales
 UNION ALL SELECT 'note_present', 'quarantine', count(*) - count(notas_jose) FROM dirty_sales) WHERE n > 0""")
def _(d):
    return rules.violation_counts(d, SALES_RULES)


@query("r9_valid_rows", D, f"SELECT row_no, id_venta FROM dirty_sales WHERE NOT {_Q}")
def _(d):
    return rules.validate(d, SALES_RULES).valid.select("row_no", "id_venta")


@query("r9_quarantined_rows", D, f"SELECT row_no, id_venta FROM dirty_sales WHERE {_Q}")
def _(d):
    return rules.validate(d, SALES_RULES).quarantined.select("row_no", "id_venta")


@query("q9_violation_totals", D, "SELECT 'note_present' AS rule, (count(*) - count(notas_jose)) * 2 AS n FROM dirty_sales")
def _(d):
    note = rules.RuleSet("x", (), tuple(r for r in SALES_RULES.rules if r.name == "note_present"))
    both = rules.violation_counts(d, note).unionByName(rules.violation_counts(d, note))
    return both.groupBy("rule").agg(F.sum("n").alias("n"))


@query("r10_score_quarantine", D, f"SELECT row_no, {C.SCORE} < 50 AS quarantined FROM dirty_sales")
def _(d):
    kept, out = rules.split_by_score(cleaning.clean_transactional(d))
    return kept.select("row_no", F.lit(False).alias("quarantined")).unionByName(out.select("row_no", F.lit(True).alias("quarantined")))


@query("r11_gate", D, f"""WITH m AS (SELECT {C.SCORE} < 50 AS q FROM dirty_sales) SELECT count(*) AS extracted, count(CASE WHEN NOT q THEN 1 END) AS cleaned, count(CASE WHEN q THEN 1 END) AS quarantined, CAST(0 AS BIGINT) AS dropped,
 round(count(CASE WHEN q THEN 1 END) / count(*)::DOUBLE, 6) AS ratio, round(count(CASE WHEN q THEN 1 END) / count(*)::DOUBLE, 6) <= 0.05 AS passed FROM m""")
def _(d):
    return rules.gate(d, *rules.split_by_score(cleaning.clean_transactional(d)))


@query("q1_detect_schema", D, " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS kind, round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS null_ratio, round(count(DISTINCT {c}) / count(*)::DOUBLE, 6) AS unique_ratio, count(DISTINCT {c}) = count(*) AND count({c}) = count(*) AS candidate_key FROM dirty_sales" for c, t in [("row_no", "bigint"), ("id_venta", "string"), ("monto", "string"), ("estado", "string")]))
def _(d):
    return quality.detect_schema(d.select("row_no", "id_venta", "monto", "estado"))


@query("q2_schema_drift", "orders", """WITH n AS (SELECT count(*) AS a, count(o_custkey) AS k, count(o_orderstatus) AS s, count(CASE WHEN o_orderkey % 2 = 0 THEN 1 END) AS e FROM orders)
 SELECT 'o_custkey' AS column_name, 'missing' AS change, 'fatal' AS severity, k AS cells FROM n UNION ALL SELECT 'extra', 'added', 'warn', e FROM n UNION ALL SELECT 'o_small', 'widened', 'warn', k FROM n UNION ALL SELECT 'o_orderstatus', 'incompatible', 'fatal', s FROM n""")
def _(o):
    """A frozen table and a current one, both written and read back."""
    spark, top = o.sparkSession, _folder(o, "q2")
    small = F.col("o_custkey").cast("int")
    o.withColumn("o_small", small).write.parquet(f"{top}/was")
    o.withColumns({"o_small": F.col("o_custkey"), "extra": F.when(F.col("o_orderkey") % 2 == 0, 1), "o_orderstatus": F.length("o_orderstatus")}).drop("o_custkey").write.parquet(f"{top}/now")
    return quality.drift_cells(spark.read.parquet(f"{top}/was"), spark.read.parquet(f"{top}/now"))


@query("q2_registry_runs", "orders", """SELECT run, first_time, fatal, column_name, change, severity, n AS n_rows FROM (VALUES ('r1', true, false, NULL, NULL, NULL), ('r2', false, false, 'extra', 'added', 'warn'), ('r2', false, false, 'o_small', 'widened', 'warn'),
 ('r3', false, true, 'o_custkey', 'missing', 'fatal'), ('r3', false, true, 'o_small', 'incompatible', 'fatal')) AS v(run, first_time, fatal, column_name, change, severity), (SELECT count(*) AS n FROM orders WHERE o_custkey IS NOT NULL)""")
def _(o):
    """Three runs of one table against a registry: the first freezes, the second only widens, the third breaks the schema."""
    spark, top = o.sparkSession, _folder(o, "registry")
    small = F.col("o_custkey").cast("int")
    runs = {"r1": o.withColumn("o_small", small), "r2": o.withColumns({"o_small": F.col("o_custkey"), "extra": F.lit(1)}), "r3": o.withColumn("o_small", F.col("o_orderstatus")).drop("o_custkey")}
    for run, df in runs.items():
        df.write.parquet(f"{top}/{run}")
        schemas.Registry(spark, f"{top}/schemas").evaluate("orders", spark.read.parquet(f"{top}/{run}"), run)
    n = spark.read.parquet(f"{top}/r1").agg(F.count("o_custkey").alias("n_rows"))
    log = schemas.Registry(spark, f"{top}/schemas").log()
    return log.select("run", "first_time", "fatal", F.explode_outer("changes").alias("c")).select("run", "first_time", "fatal", "c.*").crossJoin(F.broadcast(n))  # one row


@query("q4_null_profile", D, " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count({c}) AS non_null, round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS null_ratio FROM dirty_sales" for c in ["row_no", "id_venta", "fecha_venta", "monto", "producto", "estado", "notas_jose"]))
def _(d):
    return quality.null_profile(d)


@query("q5_capped_distinct", "orders", " UNION ALL ".join(f"SELECT '{c}' AS column_name, CASE WHEN count(DISTINCT {c}) > 800 THEN '>800' ELSE CAST(count(DISTINCT {c}) AS VARCHAR) END AS uniques, count(DISTINCT {c}) > 800 AS high_cardinality FROM orders" for c in ["o_orderkey", "o_orderstatus", "o_orderpriority"]))
def _(o):
    return quality.capped_distinct(o.select("o_orderkey", "o_orderstatus", "o_orderpriority"), cap=800)


@query("q6_flag_breakdown", D, f"SELECT flag, count(*) AS n FROM (SELECT unnest({C.FLAGS}) AS flag FROM dirty_sales) GROUP BY flag")
def _(d):
    return quality.flag_breakdown(cleaning.clean_transactional(d))


@query("q6_flag_breakdown_text", "orders", "SELECT o_orderstatus AS flag, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY 1")
def _(o):
    return quality.flag_breakdown(o.select(F.concat_ws("|", "o_orderstatus", "o_orderpriority").alias("data_quality_flags")))


@query("q7_score_distribution", D, f"""WITH s AS (SELECT CAST({C.SCORE} AS DOUBLE) AS x FROM dirty_sales) SELECT min(x) AS low, quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, quantile_cont(x, 0.95) AS p95, max(x) AS high,
 round(avg(x), 6) AS mean, round(count(CASE WHEN x < 50 THEN 1 END) / count(x)::DOUBLE, 6) AS share_below FROM s""")
def _(d):
    return quality.score_distribution(cleaning.clean_transactional(d))


def _batches(d):
    """The report of a cleaned table that came in three batches; one of them came twice."""
    top = _folder(d, "batches")
    cleaned = cleaning.clean_transactional(d)
    cleaned.withColumn("part", F.col("row_no") % 3).write.partitionBy("part").parquet(f"{top}/in")
    report = incremental.Report(d.sparkSession, f"{top}/report")
    for k in (0, 1, 2, 1):
        report.add("sales", f"b{k}", d.sparkSession.read.parquet(f"{top}/in/part={k}"))
    return report


@query("q4_merged_nulls", D, " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({x}) AS nulls, round((count(*) - count({x})) / count(*)::DOUBLE, 6) AS null_ratio FROM dirty_sales" for c, x in [("row_no", "row_no"), ("id_venta", C.ID), ("fecha_venta", C.DATE), ("producto", "producto"), ("estado", "estado"), ("notas_jose", "notas_jose")]))
def _(d):
    return _batches(d).columns().where(F.col("column_name").isin("row_no", "id_venta", "fecha_venta", "producto", "estado", "notas_jose")).select("column_name", "n_rows", "nulls", "null_ratio")


def _exact(d, column):
    """A column's distinct values, counted by themselves: together, each row would be copied once a column."""
    return d.agg(F.count_distinct(column).alias("exact")).select(F.lit(column).alias("column_name"), "exact")


@query("q5_merged_distinct", D, " UNION ALL ".join(f"SELECT '{c}' AS column_name, true AS near FROM dirty_sales HAVING count(DISTINCT {c}) > 1" for c in ("row_no", "producto", "estado")))
def _(d):
    """Estimates of the merged sketches beside exact counts: within four standard errors."""
    exact = functools.reduce(DataFrame.unionByName, [_exact(d, c) for c in ("row_no", "producto", "estado")])
    return _batches(d).columns().join(exact, "column_name").select("column_name", (F.abs(F.col("uniques") - F.col("exact")) <= 0.0324 * F.col("exact") + 1).alias("near"))


@query("q6_merged_flags", D, f"SELECT flag, count(*) AS n FROM (SELECT unnest({C.FLAGS}) AS flag FROM dirty_sales) GROUP BY flag")
def _(d):
    return _batches(d).flags().select("flag", "n")


@query("q7_merged_scores", D, f"""WITH s AS (SELECT CAST({C.SCORE} AS DOUBLE) AS x FROM dirty_sales) SELECT min(x) AS low, quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, quantile_cont(x, 0.95) AS p95, max(x) AS high,
 round(avg(x), 6) AS mean, round(count(CASE WHEN x < 50 THEN 1 END) / count(x)::DOUBLE, 6) AS share_below FROM s""")
def _(d):
    return _batches(d).scores().drop("table_name")


@query("q8_totals", D, f"""WITH m AS (SELECT {C.SCORE} < 50 AS q FROM dirty_sales), t AS (SELECT count(*) AS e, count(CASE WHEN NOT q THEN 1 END) AS c, count(CASE WHEN q THEN 1 END) AS x FROM m)
 SELECT 'sales' AS table_name, e AS extracted, c AS cleaned, x AS quarantined, round(x / e::DOUBLE, 6) AS ratio FROM t UNION ALL SELECT 'total', e, c, x, round(x / e::DOUBLE, 6) FROM t""")
def _(d):
    return quality.totals({"sales": (d, *rules.split_by_score(cleaning.clean_transactional(d)))})
