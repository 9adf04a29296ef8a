"""Queries of business aggregates, windows and set operations, and of forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.operators import bi, forecast
from tamiz.plans.catalog import query

S, M = "sales", "monthly"
_AGG = "CAST(sum(venta) AS BIGINT) AS venta, CAST(sum(unidades) AS BIGINT) AS unidades, CAST(sum(costo) AS BIGINT) AS costo, count(*) AS lineas, CAST(sum(venta) - sum(costo) AS BIGINT) AS margen, round(CASE WHEN sum(venta) <> 0 THEN CAST(sum(venta) - sum(costo) AS DOUBLE) / CAST(sum(venta) AS DOUBLE) * 100 END, 6) AS margen_pct"


@query("a1_sales_rollup", S, f"SELECT categoria, anio, {_AGG} FROM sales GROUP BY ALL")
def _(s):
    return bi.rollup(s, "categoria", "anio")


KEYS = ["grupo_cliente", "cliente_codigo", "region", "comuna", "categoria", "familia", "producto", "empaque", "tipo_reposicion"]


@query("a2_share_of_total", S, " UNION ALL ".join(f"SELECT '{k}' AS k, CAST({k} AS VARCHAR) AS v, CAST(sum(venta) AS BIGINT) AS venta, round(CAST(sum(venta) AS DOUBLE) / CAST((SELECT sum(venta) FROM sales) AS DOUBLE) * 100, 6) AS share FROM sales GROUP BY {k}" for k in KEYS))
def _(s):
    # One pass over the rows for all nine keys: grouping sets of (key, value).
    tall = s.select("venta", "unidades", "costo", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in KEYS])).alias("g")).select("venta", "unidades", "costo", "g.*")
    sums = bi.rollup(tall, "k", "v").select("k", "v", "venta")
    total = s.agg(F.sum("venta").alias("t"))
    return sums.crossJoin(F.broadcast(total)).select("k", "v", "venta", F.round(F.col("venta") / F.col("t") * 100, 6).alias("share"))


@query("a3_kpis", S, """SELECT CAST(sum(venta) AS BIGINT) AS venta, CAST(sum(unidades) AS BIGINT) AS unidades, CAST(sum(costo) AS BIGINT) AS costo, count(*) AS lineas, count(DISTINCT cliente_codigo) AS n_cliente_codigo, count(DISTINCT producto) AS n_producto, count(DISTINCT comuna) AS n_comuna,
 count(DISTINCT region) AS n_region, count(DISTINCT familia) AS n_familia, count(DISTINCT fecha) AS n_meses, CAST(sum(venta) - sum(costo) AS BIGINT) AS margen, round(CAST(sum(venta) - sum(costo) AS DOUBLE) / sum(venta)::DOUBLE * 100, 6) AS margen_pct,
 round(sum(venta)::DOUBLE / sum(unidades)::DOUBLE, 6) AS precio_medio, round(sum(costo)::DOUBLE / sum(unidades)::DOUBLE, 6) AS costo_medio, round(sum(venta)::DOUBLE / count(DISTINCT fecha), 6) AS venta_mensual, round(sum(unidades)::DOUBLE / count(DISTINCT fecha), 6) AS unidades_mensual FROM sales""")
def _(s):
    return bi.kpis(s)


_YOY = f"WITH y AS (SELECT anio, {_AGG} FROM sales GROUP BY anio) SELECT y.*, round((y.venta::DOUBLE / b.venta - 1) * 100, 6) AS venta_yoy, round((y.unidades::DOUBLE / b.unidades - 1) * 100, 6) AS unidades_yoy FROM y LEFT JOIN y b ON b.anio = y.anio - 1"


@query("a4_yearly_growth", S, _YOY)
def _(s):
    return bi.growth(s)


@query("w3_year_on_year", S, "WITH m AS (SELECT anio, mes, CAST(sum(venta) AS BIGINT) AS venta FROM sales GROUP BY ALL) SELECT m.anio, m.mes, m.venta, round((m.venta::DOUBLE / b.venta - 1) * 100, 6) AS yoy FROM m LEFT JOIN m b ON b.mes = m.mes AND b.anio = m.anio - 1")
def _(s):
    m = s.groupBy("anio", "mes").agg(F.sum("venta").alias("venta"))
    before = m.select((F.col("anio") + 1).alias("anio"), "mes", F.col("venta").alias("b"))
    return m.join(before, ["anio", "mes"], "left").select("anio", "mes", "venta", F.round((F.col("venta") / F.col("b") - 1) * 100, 6).alias("yoy"))


@query("a5_missing_months", M, "SELECT series_id, strftime(x, '%Y-%m-%d') AS month FROM (SELECT series_id, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS x FROM monthly GROUP BY series_id) WHERE (series_id, CAST(x AS DATE)) NOT IN (SELECT (series_id, month) FROM monthly)")
def _(m):
    return bi.missing_months(m, "month", "series_id").select("series_id", F.date_format("month", "yyyy-MM-dd").alias("month"))


@query("a6_canonical_labels", S, "WITH c AS (SELECT cliente_codigo, cliente_nombre, count(*) AS n FROM sales WHERE cliente_codigo IS NOT NULL GROUP BY ALL) SELECT cliente_codigo, arg_min(cliente_nombre, (-n, cliente_nombre)) AS cliente_nombre, count(*) AS n_labels FROM c GROUP BY cliente_codigo")
def _(s):
    return bi.canonical_labels(s, "cliente_codigo", "cliente_nombre")


@query("a7_inconsistent_labels", S, "SELECT count(*) AS n FROM (SELECT cliente_codigo FROM sales WHERE cliente_codigo IS NOT NULL GROUP BY 1 HAVING count(DISTINCT cliente_nombre) > 1)")
def _(s):
    return bi.canonical_labels(s, "cliente_codigo", "cliente_nombre").agg(F.count_if(F.col("n_labels") > 1).alias("n"))


@query("j15_label_mapping", S, "WITH c AS (SELECT cliente_codigo, cliente_nombre, count(*) AS n FROM sales WHERE cliente_codigo IS NOT NULL GROUP BY ALL), l AS (SELECT cliente_codigo, arg_min(cliente_nombre, (-n, cliente_nombre)) AS nombre FROM c GROUP BY 1) SELECT o_orderkey, l_linenumber, nombre FROM sales LEFT JOIN l USING (cliente_codigo)")
def _(s):
    labels = bi.canonical_labels(s, "cliente_codigo", "cliente_nombre").select("cliente_codigo", F.col("cliente_nombre").alias("nombre"))
    return s.select("o_orderkey", "l_linenumber", "cliente_codigo").join(labels, "cliente_codigo", "left").drop("cliente_codigo")


@query("a8_month_index", S, "WITH m AS (SELECT mes, sum(venta)::DOUBLE / count(DISTINCT anio) AS x FROM sales GROUP BY mes) SELECT mes, round(x / (SELECT avg(x) FROM m), 4) AS indice FROM m")
def _(s):
    return bi.month_index(s)


@query("a9_concentration", S, """WITH c AS (SELECT cliente_codigo, CAST(sum(venta) AS BIGINT) AS v FROM sales WHERE cliente_codigo IS NOT NULL GROUP BY 1), r AS (SELECT v, sum(v) OVER (ORDER BY v DESC, cliente_codigo ROWS UNBOUNDED PRECEDING) AS cum, sum(v) OVER () AS t, row_number() OVER (ORDER BY v DESC, cliente_codigo) AS i FROM c)
 SELECT count(*) AS members, count(CASE WHEN cum::DOUBLE <= CAST(0.8 AS DOUBLE) * t::DOUBLE THEN 1 END) + 1 AS n_share, round(sum(CASE WHEN i <= 10 THEN v END)::DOUBLE / max(t)::DOUBLE * 100, 6) AS top10_pct,
 round((SELECT max(v) FROM (SELECT sum(venta) AS v FROM sales GROUP BY grupo_cliente))::DOUBLE / max(t)::DOUBLE * 100, 6) AS top_group_pct FROM r""")
def _(s):
    return bi.concentration(s, "cliente_codigo", "grupo_cliente")


@query("w2_cumulative_share", S, "WITH c AS (SELECT familia, CAST(sum(venta) AS BIGINT) AS venta FROM sales GROUP BY 1) SELECT familia, venta, round(sum(venta) OVER (ORDER BY venta DESC, familia ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(venta) OVER ()::DOUBLE * 100, 6) AS cumulative FROM c".replace("sum(venta) OVER ()::DOUBLE", "(sum(venta) OVER ())::DOUBLE").replace("sum(venta) OVER (ORDER BY venta DESC, familia ROWS UNBOUNDED PRECEDING)::DOUBLE", "(sum(venta) OVER (ORDER BY venta DESC, familia ROWS UNBOUNDED PRECEDING))::DOUBLE"))
def _(s):
    from pyspark.sql import Window

    brands = s.groupBy("familia").agg(F.sum("venta").alias("venta"))  # one row a brand
    w = Window.orderBy(F.col("venta").desc(), "familia").rowsBetween(Window.unboundedPreceding, 0)
    total = brands.agg(F.sum("venta").alias("t"))
    return brands.withColumn("c", F.sum("venta").over(w)).crossJoin(F.broadcast(total)).select("familia", "venta", F.round(F.col("c") / F.col("t") * 100, 6).alias("cumulative"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("a10_units_pivot", S, "SELECT strftime(fecha, '%Y-%m-%d') AS fecha, " + ", ".join(f"CAST(coalesce(sum(CASE WHEN grupo_cliente = '{g}' THEN unidades END), 0) AS BIGINT) AS {g.lower()}" for g in _SEGMENTS) + " FROM sales GROUP BY 1")
def _(s):
    """Units by month and group of clients, which takes every row of the sales into one of its cells."""
    out = bi.units_pivot(s.select("fecha", F.col("grupo_cliente").alias("producto"), "unidades"), _SEGMENTS)
    return out.select(F.date_format("fecha", "yyyy-MM-dd").alias("fecha"), *[F.col(g).alias(g.lower()) for g in _SEGMENTS])


@query("a11_products_per_year", S, "SELECT anio, count(DISTINCT producto) AS n FROM sales WHERE anio IS NOT NULL GROUP BY anio")
def _(s):
    return s.where("anio is not null").groupBy("anio").agg(F.count_distinct("producto").alias("n"))


@query("a12_negative_margin", S, f"SELECT producto, familia, {_AGG} FROM sales GROUP BY ALL HAVING sum(venta) - sum(costo) < 0")
def _(s):
    return bi.rollup(s, "producto", "familia").where("margen < 0")


@query("w1_top_records", S, "SELECT cliente_codigo, CAST(sum(venta) AS BIGINT) AS venta FROM sales WHERE cliente_codigo IS NOT NULL GROUP BY 1 ORDER BY venta DESC, cliente_codigo LIMIT 15")
def _(s):
    return bi.top_records(bi.rollup(s.where("cliente_codigo is not null"), "cliente_codigo").select("cliente_codigo", "venta"), "venta", 15, "cliente_codigo")


@query("w7_duplicates", "lineitem", "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1")
def _(li):
    from tamiz.operators.rules import members_of_duplicates

    return members_of_duplicates(li, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("w8_sequential_ids", "dirty_sales", """WITH x AS (SELECT row_no, CASE WHEN row_no % 10 IN (2, 3) THEN NULL ELSE 'TRX-' || lpad(CAST(row_no AS VARCHAR), 9, '0') END AS id FROM dirty_sales), m AS (SELECT max(row_no) AS b FROM x WHERE id IS NOT NULL)
 SELECT row_no, coalesce(id, 'TRX-' || lpad(CAST(b + row_number() OVER (PARTITION BY id IS NULL ORDER BY row_no) AS VARCHAR), 9, '0')) AS id FROM x, m""")
def _(d):
    ids = d.select("row_no", F.when(~(F.col("row_no") % 10).isin(2, 3), F.concat(F.lit("TRX-"), F.lpad(F.col("row_no").cast("string"), 9, "0"))).alias("id"))
    return bi.sequential_ids(ids, "id", ["row_no"])


@query("u1_append_union", "orders", "SELECT 1 AS part, o_orderkey, o_orderstatus FROM orders UNION ALL SELECT 2, o_orderkey, NULL FROM orders")
def _(o):
    return o.select(F.lit(1).alias("part"), "o_orderkey", "o_orderstatus").unionByName(o.select(F.lit(2).alias("part"), "o_orderkey"), allowMissingColumns=True)


@query("u2_discontinued", S, "WITH k AS (SELECT *, producto || ' ' || cliente_codigo % 100 AS p FROM sales) SELECT p AS producto, strftime(max(fecha), '%Y-%m-%d') AS ultimo, CAST(sum(unidades) AS BIGINT) AS unidades FROM k WHERE p IS NOT NULL AND p NOT IN (SELECT p FROM k WHERE p IS NOT NULL AND anio = (SELECT max(anio) FROM sales)) GROUP BY p")
def _(s):
    return bi.discontinued(s.withColumn("producto", F.concat("producto", F.lit(" "), (F.col("cliente_codigo") % 100).cast("string")))).withColumn("ultimo", F.date_format("ultimo", "yyyy-MM-dd"))


@query("u3_introduced", S, "WITH k AS (SELECT *, producto || ' ' || cliente_codigo AS p FROM sales) SELECT p AS producto, CAST(sum(unidades) AS BIGINT) AS unidades FROM k WHERE p IS NOT NULL GROUP BY p HAVING min(anio) = (SELECT max(anio) FROM sales)")
def _(s):
    return bi.introduced(s.withColumn("producto", F.concat("producto", F.lit(" "), F.col("cliente_codigo").cast("string"))))


@query("u4_distinct_pairs", S, "SELECT DISTINCT region, comuna FROM sales")
def _(s):
    return s.select("region", "comuna").dropDuplicates()


# ── forecasts ──
_SPAN = "span AS (SELECT series_id, min(month) AS a, max(month) AS b FROM monthly GROUP BY 1), cal0 AS (SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM span), cal AS (SELECT series_id, month, y, row_number() OVER (PARTITION BY series_id ORDER BY month) AS t FROM cal0 LEFT JOIN monthly USING (series_id, month))"


def _index(src, y, name):
    """Seasonal index of a table (series_id, month, t, y) as CTEs."""
    return f"""{name}_c AS (SELECT series_id, month(month) AS m, {y} AS y, CASE WHEN count({y}) OVER w13 = 13 THEN (sum({y}) OVER w13 - 0.5::DOUBLE * lag({y}, 6) OVER w - 0.5::DOUBLE * lead({y}, 6) OVER w) / 12 END AS c FROM {src} WINDOW w AS (PARTITION BY series_id ORDER BY t), w13 AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
 {name}_f AS (SELECT s.series_id, g.m, coalesce(avg(y / c), 1.0::DOUBLE) AS f FROM (SELECT DISTINCT series_id FROM {src}) s CROSS JOIN (SELECT unnest(generate_series(1, 12)) AS m) g LEFT JOIN (SELECT * FROM {name}_c WHERE c IS NOT NULL AND c <> 0) r ON r.series_id = s.series_id AND r.m = g.m GROUP BY ALL),
 {name} AS (SELECT series_id, m, f / avg(f) OVER (PARTITION BY series_id) AS factor FROM {name}_f)"""


def _fill(src, v, name):
    return f"""{name} AS (SELECT *, coalesce({v}, CASE WHEN lt IS NOT NULL AND rt IS NOT NULL THEN lv + (rv - lv) * (t - lt) / (rt - lt) END, lv, rv) AS filled FROM (SELECT *, last_value(CASE WHEN {v} IS NOT NULL THEN t END IGNORE NULLS) OVER b AS lt, last_value({v} IGNORE NULLS) OVER b AS lv,
 first_value(CASE WHEN {v} IS NOT NULL THEN t END IGNORE NULLS) OVER f AS rt, first_value({v} IGNORE NULLS) OVER f AS rv FROM {src} WINDOW b AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))"""


_FULL = f"""{_SPAN}, {_fill('cal', 'y', 'p0')}, {_index('p0', 'filled', 'ix')}, lev AS (SELECT p0.series_id, p0.month, p0.t, p0.y, factor, p0.y / factor AS d FROM p0 JOIN ix ON ix.series_id = p0.series_id AND ix.m = month(p0.month)), {_fill('lev', 'd', 'l1')},
 fl AS (SELECT series_id, month, t, max(t) OVER (PARTITION BY series_id) AS n, coalesce(y, filled * factor) AS y, y IS NULL AS imputed FROM l1)"""


def _models(train, h, name):
    return f"""{_index(train, 'y', name + 'i')}, {name}d AS (SELECT a.series_id, a.month, a.t, a.y, a.y / factor AS d, max(a.t) OVER (PARTITION BY a.series_id) - a.t AS back FROM {train} a JOIN {name}i i ON i.series_id = a.series_id AND i.m = month(a.month)),
 {name}s AS (SELECT series_id, max(month) AS last, max(t) AS n, avg(CASE WHEN back < 12 THEN y END) AS m12, avg(CASE WHEN back < 12 THEN d END) AS l12, avg(CASE WHEN back < 6 THEN d END) AS l6, regr_slope(d, t::DOUBLE) AS s, regr_intercept(d, t::DOUBLE) AS i, regr_slope(CASE WHEN back < 24 THEN d END, t::DOUBLE) AS s24, regr_intercept(CASE WHEN back < 24 THEN d END, CASE WHEN back < 24 THEN t::DOUBLE END) AS i24 FROM {name}d GROUP BY 1),
 {name}r AS (SELECT x.series_id, CAST(last + INTERVAL (h) MONTH AS DATE) AS month, n + h AS t, x.* EXCLUDE (series_id, n) FROM {name}s x CROSS JOIN (SELECT unnest(generate_series(1, {h})) AS h) g),
 {name}q AS (SELECT r.*, factor, a.y AS ago FROM {name}r r JOIN {name}i i ON i.series_id = r.series_id AND i.m = month(r.month) LEFT JOIN {train} a ON a.series_id = r.series_id AND a.month = CAST(r.month - INTERVAL 12 MONTH AS DATE)),
 {name} AS (SELECT series_id, month, 0 AS k, 'naive_estacional' AS model, coalesce(ago, m12) AS p FROM {name}q UNION ALL SELECT series_id, month, 1, 'nivel_estacional_12m', l12 * factor FROM {name}q UNION ALL SELECT series_id, month, 2, 'nivel_estacional_6m', l6 * factor FROM {name}q
 UNION ALL SELECT series_id, month, 3, 'tendencia_total', (i + s * t) * factor FROM {name}q UNION ALL SELECT series_id, month, 4, 'tendencia_24m', (i24 + s24 * t) * factor FROM {name}q UNION ALL SELECT series_id, month, 5, 'promedio_movil_12m', m12 FROM {name}q)"""


_BACK = f"""{_FULL}, tr AS (SELECT * FROM fl WHERE n >= 25 AND t <= n - 12), {_models('tr', 12, 'bt')}, sc AS (SELECT b.series_id, k, model, round(avg(abs(f.y - p) / abs(f.y)) * 100, 2) AS mape, stddev_samp(f.y - p) AS residual_std FROM bt b JOIN fl f ON f.series_id = b.series_id AND f.month = b.month WHERE f.y <> 0 GROUP BY ALL),
 best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY mape NULLS LAST, k) AS r FROM sc) WHERE r = 1)"""


@query("w4_centred_average", M, f"WITH {_SPAN}, {_fill('cal', 'y', 'p0')}, {_index('p0', 'filled', 'ix')} SELECT series_id, round(sum(c), 4) AS total, count(c) AS n FROM ix_c GROUP BY 1")
def _(m):
    full = bi.interpolated(forecast.calendar(m), "series_id", F.col("t"), "y", "p")
    return full.withColumn("c", bi.centred_average("series_id", F.col("t"), F.col("p"))).groupBy("series_id").agg(F.round(F.sum("c"), 4).alias("total"), F.count("c").alias("n"))


@query("w5_linear_fill", M, f"WITH {_SPAN}, {_fill('cal', 'y', 'p0')} SELECT series_id, strftime(month, '%Y-%m-%d') AS month, round(filled, 4) AS y FROM p0")
def _(m):
    out = bi.interpolated(forecast.calendar(m), "series_id", F.col("t"), "y", "p")
    return out.select("series_id", F.date_format("month", "yyyy-MM-dd").alias("month"), F.round("p", 4).alias("y"))


@query("w6_last_months", M, "SELECT series_id, round(avg(CASE WHEN r <= 6 THEN y END), 4) AS m6, round(avg(CASE WHEN r <= 12 THEN y END), 4) AS m12, round(avg(CASE WHEN r <= 24 THEN y END), 4) AS m24 FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS r FROM monthly) GROUP BY 1")
def _(m):
    from pyspark.sql import Window

    r = m.withColumn("r", F.row_number().over(Window.partitionBy("series_id").orderBy(F.col("month").desc())))
    return r.groupBy("series_id").agg(*[F.round(F.avg(F.when(F.col("r") <= k, F.col("y"))), 4).alias(f"m{k}") for k in (6, 12, 24)])


@query("e1_complete_months", M, f"WITH {_FULL} SELECT series_id, strftime(month, '%Y-%m-%d') AS month, round(y, 4) AS y, imputed FROM fl")
def _(m):
    return forecast.completed(m).select("series_id", F.date_format("month", "yyyy-MM-dd").alias("month"), F.round("y", 4).alias("y"), "imputed")


@query("e2_seasonal_index", M, f"WITH {_FULL}, {_index('fl', 'y', 'fx')} SELECT series_id, CAST(m AS INT) AS m, round(factor, 6) AS factor FROM fx")
def _(m):
    return forecast.seasonal_index(forecast.completed(m)).select("series_id", "m", F.round("factor", 6).alias("factor"))


for _name, _model in (("e3_seasonal_naive", 0), ("e4_level_12", 1), ("e4_level_6", 2), ("e5_trend_all", 3), ("e5_trend_24", 4), ("e6_mean_12", 5)):

    @query(_name, M, f"WITH {_FULL}, {_models('fl', 15, 'pr')} SELECT series_id, strftime(month, '%Y-%m-%d') AS month, round(p, 3) AS p FROM pr WHERE k = {_model}")
    def _(m, k=_model):
        return forecast.predictions(forecast.completed(m), 15).where(F.col("k") == k).select("series_id", F.date_format("month", "yyyy-MM-dd").alias("month"), F.round("p", 3).alias("p"))


@query("e7_backtest_mape", M, f"WITH {_BACK} SELECT series_id, model, mape, round(residual_std, 4) AS residual_std FROM sc")
def _(m):
    return forecast.backtest(forecast.completed(m)).select("series_id", "model", "mape", F.round("residual_std", 4).alias("residual_std"))


@query("e8_model_selection", M, f"WITH {_BACK} SELECT s.series_id, coalesce(b.model, 'naive_estacional') AS model, b.mape FROM (SELECT DISTINCT series_id FROM fl) s LEFT JOIN best b USING (series_id)")
def _(m):
    return forecast.selected(forecast.completed(m)).select("series_id", "model", "mape")


@query("e8_forecast", M, f"WITH {_BACK}, {_models('fl', 12, 'pr')} SELECT p.series_id, strftime(p.month, '%Y-%m-%d') AS month, p.model, round(p.p, 3) AS p FROM pr p LEFT JOIN best b USING (series_id) WHERE p.model = coalesce(b.model, 'naive_estacional')")
def _(m):
    return forecast.forecast(forecast.completed(m)).select("series_id", F.date_format("month", "yyyy-MM-dd").alias("month"), "model", F.round("p", 3).alias("p"))


@query("e9_safety_stock", M, "SELECT series_id, round(coalesce(stddev_samp(y), 0) * 1.6449::DOUBLE, 4) AS safety_stock FROM monthly GROUP BY 1")
def _(m):
    return forecast.safety_stock(m, "y", 0.95, "series_id").select("series_id", F.round("safety_stock", 4).alias("safety_stock"))


@query("e10_purchase_plan", M, f"""WITH {_BACK}, {_models('fl', 12, 'pr')}, fc AS (SELECT p.series_id, sum(p.p) AS ahead FROM pr p LEFT JOIN best b USING (series_id) WHERE p.model = coalesce(b.model, 'naive_estacional') GROUP BY 1), ly AS (SELECT series_id, sum(y) AS last_year, count(*) AS months FROM fl WHERE n - t < 12 GROUP BY 1), ss AS (SELECT series_id, coalesce(stddev_samp(y), 0) * 1.6449::DOUBLE AS s FROM fl GROUP BY 1),
 u AS (SELECT series_id, last_year * 12 / months * (ahead / last_year) + s AS units FROM fc JOIN ly USING (series_id) JOIN ss USING (series_id)) SELECT series_id, round(units, 4) AS units, round(units / (SELECT sum(units) FROM u) * 100, 4) AS share, round(units / 12, 4) AS monthly_order FROM u""")
def _(m):
    return forecast.purchase_plan(m)


@query("e11_forced_model", M, f"WITH {_FULL}, {_models('fl', 12, 'pr')} SELECT series_id, strftime(month, '%Y-%m-%d') AS month, round(p, 3) AS p FROM pr WHERE (k = 1 AND series_id IN (SELECT series_id FROM fl WHERE n >= 25)) OR (k = 0 AND series_id IN (SELECT series_id FROM fl WHERE n < 25))")
def _(m):
    return forecast.forecast(forecast.completed(m), force="nivel_estacional_12m").select("series_id", F.date_format("month", "yyyy-MM-dd").alias("month"), F.round("p", 3).alias("p"))
