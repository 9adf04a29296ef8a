"""Queries of the star schema, of profiles and of business views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.operators import olap, profile, semantic, view
from tamiz.plans import q_semantic as QS
from tamiz.plans.catalog import query

S = "sales"
DIMS = {"cliente": ["cliente_codigo", "grupo_cliente"], "lugar": ["region", "comuna"], "producto": ["producto", "familia", "categoria"], "mes": ["anio", "mes"]}


@query("o1_star_build", S, "SELECT o_orderkey, l_linenumber, cliente_codigo, grupo_cliente, region, comuna, producto, familia, categoria, anio, mes, venta, unidades FROM sales")
def _(s):
    fact, dims = olap.star(s, DIMS, ["o_orderkey", "l_linenumber"], ["venta", "unidades"])
    for name, dim in dims.items():
        fact = fact.join(dim, f"{name}_key").drop(f"{name}_key")
    return fact


@query("o1_dimension_sizes", S, " UNION ALL ".join(f"SELECT '{n}' AS dim, count(*) AS n FROM (SELECT DISTINCT {', '.join(c)} FROM sales)" for n, c in DIMS.items()))
def _(s):
    out = None
    for name, dim in olap.star(s, DIMS, [], [])[1].items():
        one = dim.agg(F.count_distinct(f"{name}_key").alias("n")).select(F.lit(name).alias("dim"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("o2_measure_inference", "lineitem", "SELECT round(sum(l_quantity), 4) AS sum_l_quantity, round(sum(l_extendedprice), 4) AS sum_l_extendedprice, round(avg(l_tax), 6) AS avg_tax_rate, count(*) AS row_count FROM lineitem")
def _(li):
    return olap.inferred_measures(li.select("l_orderkey", "l_quantity", "l_extendedprice", F.col("l_tax").alias("tax_rate")), ["l_orderkey"])


@query("o3_hierarchies", "customer nation region", "SELECT hierarchy, CAST(level AS INT) AS level, column_name, n FROM (SELECT 'geo' AS hierarchy, 1 AS level, 'geo_region' AS column_name, count(DISTINCT r_name) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'geo', 2, 'geo_nation', count(DISTINCT n_name) FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'geo', 3, 'geo_customer', count(DISTINCT c_name) FROM customer)")
def _(c, n, r):
    df = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)  # fixed tables of 25 and 5 rows
    return olap.hierarchies(df.select("c_custkey", F.col("c_name").alias("geo_customer"), F.col("n_name").alias("geo_nation"), F.col("r_name").alias("geo_region"), "c_mktsegment"), ["c_custkey"])


@query("o3_calendar_and_capitals", "orders customer nation region", """WITH s AS (SELECT count(DISTINCT year(o_orderdate)) AS y, count(DISTINCT year(o_orderdate) * 10 + quarter(o_orderdate)) AS q, count(DISTINCT year(o_orderdate) * 100 + month(o_orderdate)) AS m, count(DISTINCT CAST(o_orderdate AS DATE)) AS d, count(DISTINCT r_name) AS r, count(DISTINCT n_name) AS n
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
 SELECT hierarchy, level, column_name, n FROM (SELECT 'Calendar' AS hierarchy, 1 AS level, 'CalendarYear' AS column_name, y AS n FROM s UNION ALL SELECT 'Calendar', 2, 'CalendarQuarter', q FROM s UNION ALL SELECT 'Calendar', 3, 'CalendarMonth', m FROM s UNION ALL SELECT 'Calendar', 4, 'Datekey', d FROM s
 UNION ALL SELECT 'ST', 1, 'SalesTerritory', r FROM s UNION ALL SELECT 'ST', 2, 'StateTerritory', n FROM s)""")
def _(o, c, n, r):
    df = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)  # fixed tables of 25 and 5 rows
    y, d = F.year("o_orderdate"), F.col("o_orderdate")
    return olap.hierarchies(df.select(y.alias("CalendarYear"), (y * 10 + F.quarter(d)).alias("CalendarQuarter"), (y * 100 + F.month(d)).alias("CalendarMonth"), d.cast("date").alias("Datekey"), F.col("r_name").alias("SalesTerritory"), F.col("n_name").alias("StateTerritory"), "o_orderkey"), ["o_orderkey"])


@query("o5_preaggregates", S, " UNION ALL ".join(f"SELECT '{d}' AS dim, CAST({d} AS VARCHAR) AS member, CAST(sum(venta) AS BIGINT) AS total FROM sales GROUP BY {d}" for d in ("anio", "region", "categoria", "grupo_cliente")))
def _(s):
    return olap.preaggregates(s, ["anio", "region", "categoria", "grupo_cliente"], "venta")


@query("o6_slice_by_year", S, "SELECT anio, CAST(sum(venta) AS BIGINT) AS total FROM sales GROUP BY anio")
def _(s):
    return s.groupBy("anio").agg(F.sum("venta").alias("total"))


@query("o7_cross_nonempty", S, "SELECT producto, region, CAST(sum(venta) AS BIGINT) AS total FROM sales GROUP BY CUBE (producto, region)")
def _(s):
    return s.cube("producto", "region").agg(F.sum("venta").alias("total"))


@query("o8_top_members", S, "SELECT producto, CAST(sum(venta) AS BIGINT) AS total FROM sales GROUP BY producto ORDER BY total DESC, producto LIMIT 10")
def _(s):
    return s.groupBy("producto").agg(F.sum("venta").alias("total")).orderBy(F.col("total").desc(), "producto").limit(10)


@query("o9_drill_down", S, "WITH q AS (SELECT *, (mes - 1) // 3 + 1 AS trimestre FROM sales) SELECT anio, trimestre, mes, CAST(sum(venta) AS BIGINT) AS total, CAST(CASE grouping_id(anio, trimestre, mes) WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS INT) AS depth FROM q GROUP BY ROLLUP (anio, trimestre, mes)")
def _(s):
    return olap.drill_down(s.withColumn("trimestre", (F.floor((F.col("mes") - 1) / 3) + 1).cast("long")), ["anio", "trimestre", "mes"], "venta")


@query("o10_year_to_date", S, "WITH m AS (SELECT anio, mes, CAST(sum(venta) AS BIGINT) AS total FROM sales GROUP BY ALL), y AS (SELECT *, CAST(sum(total) OVER (PARTITION BY anio ORDER BY mes) AS BIGINT) AS ytd FROM m) SELECT y.*, b.total AS prior_year FROM y LEFT JOIN m b ON b.anio = y.anio - 1 AND b.mes = y.mes WHERE y.total > 0")
def _(s):
    return olap.year_to_date(s.groupBy("anio", "mes").agg(F.sum("venta").alias("total")))


@query("o11_last_nonempty", "orders", "SELECT o_orderpriority, CAST(year(o_orderdate) AS INT) AS anio, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_value FROM orders WHERE o_orderkey % 3 > 0 GROUP BY ALL")
def _(o):
    df = o.select("o_orderpriority", F.year("o_orderdate").alias("anio"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey")).alias("v"), F.struct("o_orderdate", "o_orderkey").alias("d"))
    return olap.last_nonempty(df, ["o_orderpriority", "anio"], "v", "d")


@query("o12_self_checks", S, " UNION ALL ".join(f"SELECT '{n}' AS level, CAST(sum(venta) AS BIGINT) AS total FROM sales" for n in ("detail", "anio", "region", "producto")))
def _(s):
    return olap.self_check(s, ["anio", "region", "producto"], "venta")


# ── profiles ──
_O = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'N' END AS activo, 'x' AS fijo, CAST(year(o_orderdate) AS INT) AS anio FROM orders"
_ROLES = [("o_orderkey", "bigint", "identifier"), ("o_orderstatus", "string", "dimension"), ("o_totalprice", "double", "measure"), ("o_orderdate", "timestamp_ntz", "date"), ("o_orderpriority", "string", "dimension"), ("activo", "string", "flag"), ("fijo", "string", "constant"), ("anio", "int", "dimension")]


def _orders(o):
    return o.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", F.when(F.col("o_orderkey") % 2 == 0, "S").otherwise("N").alias("activo"), F.lit("x").alias("fijo"), F.year("o_orderdate").alias("anio"))


_F_STATS = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{k}' AS kind, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS uniques, count(DISTINCT {c}) / count({c})::DOUBLE AS ratio, min(CAST({c} AS VARCHAR)) AS low, max(CAST({c} AS VARCHAR)) AS high,
 {f'sum({c})::DOUBLE' if k in ('bigint', 'double', 'int') else 'NULL'} AS total, {str(k.startswith('timestamp')).lower()} AS is_time, {str(k in ('bigint', 'double', 'int')).lower()} AS is_number,
 {str(c == 'anio').lower()} AS date_name, {str(c.endswith('key')).lower()} AS id_name FROM d""" for c, k, _ in _ROLES)
_F_ROLE = """CASE WHEN uniques <= 1 THEN 'constant' WHEN is_time THEN 'date' WHEN uniques = 2 AND low IN ('0', '1', 'N', 'S') AND high IN ('0', '1', 'N', 'S') THEN 'flag'
 WHEN kind <> 'double' AND (ratio > 0.92 OR (id_name AND uniques > 200)) THEN 'identifier' WHEN is_number AND (date_name OR (uniques <= 12 AND ratio < 0.01)) THEN 'dimension' WHEN is_number THEN 'measure'
 WHEN uniques <= 200 AND ratio <= 0.5 THEN 'dimension' ELSE 'text' END"""


@query("f1_column_roles", "orders", f"WITH d AS ({_O}), s AS ({_F_STATS}) SELECT column_name, kind, nulls, uniques, round(ratio, 6) AS unique_ratio, {_F_ROLE} AS role FROM s")
def _(o):
    return profile.column_roles(_orders(o)).select("column_name", "kind", "nulls", "uniques", "unique_ratio", "role")


_F_PROFILE = f"""SELECT role, CAST(row_number() OVER (PARTITION BY role ORDER BY CASE role WHEN 'date' THEN nulls WHEN 'measure' THEN -abs(total) ELSE uniques END, column_name) AS INT) AS place, column_name
 FROM (SELECT *, {_F_ROLE} AS role FROM s) WHERE role IN ('date', 'measure', 'dimension')"""


@query("f3_dataset_profile", "orders", f"WITH d AS ({_O}), s AS ({_F_STATS}) {_F_PROFILE}")
def _(o):
    return profile.dataset_profile(profile.column_roles(_orders(o)))


_DIMS = ["region", "comuna", "familia", "tipo_reposicion", "empaque", "grupo_cliente", "codigo"]


@query("f4_dimension_ranking", S, "WITH u AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c if c != 'codigo' else 'region'}) AS uniques FROM sales" for c in _DIMS) + """), s AS (SELECT *, round(CASE WHEN uniques < 2 THEN -99.0 ELSE -abs(ln(uniques) - ln(10.0)) END - CASE WHEN column_name = 'codigo' THEN 0.15 ELSE 0 END, 6) AS score FROM u)
 SELECT CAST(row_number() OVER (ORDER BY score DESC, column_name) AS INT) AS place, column_name, uniques, CAST(score AS DOUBLE) AS score FROM s""")
def _(s):
    return profile.ranked_dimensions(profile.column_roles(s.withColumn("codigo", F.col("region")).select(_DIMS)))


@query("f5_chosen_charts", S, "WITH u AS (" + " UNION ALL ".join(f"SELECT '{c}' AS c, count(DISTINCT {c}) AS n FROM sales" for c in _DIMS[:-1]) + """), r AS (SELECT *, row_number() OVER (ORDER BY -abs(ln(n) - ln(10.0)) DESC, c) AS place FROM u)
 SELECT 'by_' || c AS part FROM r WHERE place <= 6 UNION ALL SELECT 'scatter by ' || arg_max(c, n) FROM r WHERE n BETWEEN 6 AND 120""")
def _(s):
    """Of equivalent dimensions one is kept: codigo is region under another name."""
    df = s.withColumn("codigo", F.col("region")).select(_DIMS)
    dims, points = profile.chart_dimensions(df, profile.column_roles(df))
    return s.sparkSession.createDataFrame([(f"by_{d}",) for d in dims[: profile.CHARTS]] + [(f"scatter by {points}",)], "part string")


@query("f5_insights", "orders", f"""WITH d AS ({_O}), s AS ({_F_STATS}), p AS ({_F_PROFILE}),
 t AS (SELECT date_diff('second', min(o_orderdate), max(o_orderdate)) / 86400.0 AS days FROM orders)
 SELECT 'roles' AS part, count(*) AS n FROM s UNION ALL SELECT 'profile', count(*) FROM p
 UNION ALL SELECT 'series', count(DISTINCT date_trunc(CASE WHEN days <= 3 THEN 'hour' WHEN days <= 120 THEN 'day' WHEN days <= 25 * 365 THEN 'month' ELSE 'year' END, o_orderdate)) FROM orders, t
 UNION ALL SELECT 'by_' || p.column_name, least(s.uniques + CASE WHEN s.nulls > 0 THEN 1 ELSE 0 END, 13) FROM p JOIN s USING (column_name) WHERE role = 'dimension' AND place <= 6
 UNION ALL SELECT 'histogram', 24 FROM p WHERE role = 'measure' AND place = 1""")
def _(o):
    out = None
    for name, df in profile.insights(_orders(o)).items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("a13_value_counts", S, "SELECT familia AS value, count(*) AS n, round(count(*) / (SELECT count(familia) FROM sales)::DOUBLE * 100, 6) AS pct FROM sales GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def _(s):
    return profile.value_counts(s, "familia")


@query("a14_numeric_stats", "customer", "SELECT min(c_acctbal) AS low, max(c_acctbal) AS high, round(avg(c_acctbal), 6) AS mean, round(sum(c_acctbal), 4) AS total, median(c_acctbal) AS median, count(CASE WHEN c_acctbal < 0 THEN 1 END) AS negatives, count(CASE WHEN c_acctbal = 0 THEN 1 END) AS zeros FROM customer")
def _(c):
    return profile.numeric_stats(c, "c_acctbal")


@query("a15_histogram", "orders", """WITH s AS (SELECT quantile_cont(o_totalprice, 0.01) AS a, quantile_cont(o_totalprice, 0.99) AS b FROM orders), w AS (SELECT a, b, (b - a) / 24 AS w FROM s), c AS (SELECT least(CAST(floor((o_totalprice - a) / w) AS INT), 23) AS bin, count(*) AS n FROM orders, w WHERE o_totalprice BETWEEN a AND b GROUP BY 1)
 SELECT CAST(g AS INT) AS bin, round(a + w * g, 2) AS low, coalesce(n, 0) AS n FROM w, generate_series(0, 23) AS t(g) LEFT JOIN c ON c.bin = g""")
def _(o):
    return profile.histogram(o, "o_totalprice")


@query("a16_time_series", "events", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS t, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1")
def _(e):
    return profile.time_series(e, "ts", ["value"]).withColumn("t", F.date_format("t", "yyyy-MM-dd"))


@query("a17_breakdown", S, """WITH m AS (SELECT coalesce(CAST(cliente_codigo AS VARCHAR), '(sin dato)') AS member, sum(venta)::DOUBLE AS value FROM sales GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY value DESC, member) AS i, sum(value) OVER () AS t FROM m)
 SELECT member, round(value, 4) AS value, round(value / t * 100, 6) AS share FROM r WHERE i <= 12 UNION ALL SELECT '(resto)', round(sum(value), 4), round(sum(value) / max(t) * 100, 6) FROM r WHERE i > 12""")
def _(s):
    return profile.breakdown(s, "cliente_codigo", "venta")


@query("a18_scatter", S, "WITH p AS (SELECT CAST(cliente_codigo AS VARCHAR) AS member, sum(unidades)::DOUBLE AS x, sum(venta)::DOUBLE AS y FROM sales WHERE cliente_codigo IS NOT NULL GROUP BY 1) SELECT member, x, y, (SELECT round(corr(x, y), 6) FROM p) AS r FROM p WHERE x > 0 AND y > 0 ORDER BY y DESC, member LIMIT 120")
def _(s):
    return profile.scatter(s, "cliente_codigo", "unidades", "venta")


_A19 = ["c_custkey", "c_name", "c_nationkey", "n_name", "c_mktsegment"]


@query("a19_redundant_dimensions", "customer nation", "WITH d AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b FROM d HAVING count(DISTINCT {a}) = count(DISTINCT {b}) AND count(DISTINCT ({a}, {b})) = count(DISTINCT {a})" for i, a in enumerate(_A19) for b in _A19[i + 1 :]))
def _(c, n):
    return profile.redundant_pairs(c.join(n, c.c_nationkey == n.n_nationkey).select(*_A19), _A19)


# ── business views ──
def _enriched(d):
    return d.select("row_no", "monto", "producto", F.lit("CLP").alias("moneda_base"), "estado").withColumns({
        "producto_domain_flag": semantic.text.classify_domain(F.col("producto")), "monto_parsed": semantic.money.parse_money_text(F.col("monto")),
        "estado_semantic": F.upper("estado"), "monto_currency": semantic.money.extract_currency(F.col("monto")), "fecha": F.lit("2024-01-05 10:00:00").cast("timestamp_ntz"), "quality_score": F.lit(100)})


@query("b1_legit_rows", "dirty_sales", f"SELECT row_no FROM dirty_sales WHERE NOT coalesce({QS.DOMAIN}, 0) < 0 AND coalesce({QS.MONEY_TEXT}, 0) > 0")
def _(d):
    return view.split_view(_enriched(d))[0].select("row_no")


@query("b1_foreign_rows", "dirty_sales", f"SELECT row_no FROM dirty_sales WHERE coalesce({QS.DOMAIN}, 0) < 0")
def _(d):
    return view.split_view(_enriched(d))[1].select("row_no")


@query("b3_drop_technical", "dirty_sales", f"SELECT row_no, monto, producto, 'CLP' AS moneda_base, estado, CAST({QS.MONEY_TEXT} AS DOUBLE) AS monto_parsed, upper(estado) AS estado_semantic, {QS.CODE} AS monto_currency, '2024-01-05' AS fecha FROM dirty_sales")
def _(d):
    return view.iso_dates(view.drop_technical(_enriched(d)))


@query("b4_best_variants", "dirty_sales", f"SELECT row_no, CAST({QS.MONEY_TEXT} AS DOUBLE) AS monto, producto, upper(estado) AS estado FROM dirty_sales")
def _(d):
    return view.best_variants(view.drop_technical(_enriched(d)).drop("moneda_base", "monto_currency", "fecha"))


@query("b5_readable_headers", "dirty_sales", "SELECT row_no AS \"Row No\", estado AS \"Estado\", monto AS \"Monto Moneda\" FROM dirty_sales")
def _(d):
    df = d.select("row_no", F.col("estado").alias("estado_estado"), F.col("monto").alias("monto_currency"))
    return df.withColumnsRenamed(view.readable(df.columns))


@query("b6_collapse_currencies", "dirty_sales", f"SELECT row_no, {QS.CODE} AS \"Moneda\" FROM dirty_sales")
def _(d):
    return view.collapse_currencies(_enriched(d).select("row_no", "moneda_base", "monto_currency"))


@query("b7_iso_dates", "orders", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders")
def _(o):
    return view.iso_dates(o.select("o_orderkey", "o_orderdate"))


@query("b8_strict_schema", "orders", "SELECT o_orderstatus, CAST(NULL AS VARCHAR) AS absent, o_orderkey FROM orders")
def _(o):
    return view.strict(o, ["o_orderstatus", "absent"], ["o_orderkey"])
