"""Queries of semantic enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.functions import dates, money, text
from tamiz.operators import semantic
from tamiz.plans.catalog import query

D = "dirty_sales"
# What the money texts of the derived table become, by their shapes.
MONEY_TEXT = r"""CASE WHEN monto IS NULL OR monto = '' THEN NULL WHEN monto = 'sesenta lucas' THEN 60000 WHEN ends_with(monto, ' mil') THEN CAST(replace(monto, ' mil', '') AS DOUBLE) * 1000 WHEN ends_with(monto, 'k') THEN CAST(rtrim(monto, 'k') AS DOUBLE) * 1000
 WHEN regexp_matches(monto, '^[^,]*\.[0-9]{3},75 EUR$') THEN CAST(replace(replace(replace(monto, ' EUR', ''), '.', ''), ',', '.') AS DOUBLE) WHEN starts_with(monto, '$') THEN CAST(CASE WHEN length(regexp_replace(monto, '[^.]', '', 'g')) > 0 THEN replace(ltrim(monto, '$'), '.', '') END AS DOUBLE)
 ELSE TRY_CAST(replace(regexp_replace(lower(monto), '[a-z $-]', '', 'g'), ',', '.') AS DOUBLE) END"""
CODE = "CASE WHEN contains(monto, 'USD') THEN 'USD' WHEN contains(monto, 'EUR') THEN 'EUR' WHEN contains(monto, '$') THEN '$' END"
_P = "lower(producto)"
DOMAIN = f"(CASE WHEN contains({_P}, 'logitech') OR contains({_P}, 'asus') THEN 5 ELSE 0 END + CASE WHEN contains({_P}, '16gb') THEN 3 ELSE 0 END + CASE WHEN contains({_P}, 'rtx 4090') THEN 3 ELSE 0 END + CASE WHEN contains({_P}, 'core i7') THEN 3 ELSE 0 END - CASE WHEN contains({_P}, 'pizza') THEN 7 ELSE 0 END)"
_DOMAIN = f"CASE WHEN coalesce({DOMAIN}, 0) < 0 THEN 'foreign' WHEN coalesce({DOMAIN}, 0) > 0 THEN 'tech_product' ELSE 'unknown' END"
_NOTE = "CASE WHEN regexp_matches(lower(notas_jose), 'prest[eéó]') THEN 'PRESTAMO' WHEN regexp_matches(lower(notas_jose), 'devol(vi|ucion)') THEN 'DEVOLUCION' WHEN regexp_matches(lower(notas_jose), 'ajust[eo]') THEN 'AJUSTE' WHEN regexp_matches(lower(notas_jose), 'vend(id[oa]|i)') THEN 'VENTA' ELSE upper(coalesce(estado, 'UNKNOWN')) END"


@query("m1_parse_money_text", D, f"SELECT row_no, CAST({MONEY_TEXT} AS DOUBLE) AS value FROM dirty_sales")
def _(d):
    return d.select("row_no", money.parse_money_text(F.col("monto")).alias("value"))


@query("m2_extract_currency", D, f"SELECT row_no, {CODE} AS code FROM dirty_sales")
def _(d):
    return d.select("row_no", money.extract_currency(F.col("monto")).alias("code"))


@query("m3_infer_currency", D, f"""WITH a AS (SELECT row_no, CAST({MONEY_TEXT} AS DOUBLE) AS amount, {CODE} AS code FROM dirty_sales), c AS (SELECT code, count(*) AS n FROM a WHERE code IS NOT NULL GROUP BY 1),
 s AS (SELECT max(n) / sum(n)::DOUBLE AS share, arg_max(code, n) AS top, (SELECT median(amount) FROM a WHERE code IS NULL) AS m FROM c)
 SELECT row_no, coalesce(code, CASE WHEN share > 0.8 AND NOT (top IN ('USD', 'EUR') AND m > 5000) THEN top ELSE 'CLP' END) AS currency FROM a, s""")
def _(d):
    df = d.select("row_no", money.parse_money_text(F.col("monto")).alias("amount"), money.extract_currency(F.col("monto")).alias("code"))
    return semantic.infer_currency(df, "code", "amount", "currency").select("row_no", "currency")


_SCALE = """u AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, coalesce(stddev_samp(x), 1.0) AS sd, median(x) AS r FROM a WHERE x BETWEEN 5000 AND 5000000),
 f AS (SELECT *, greatest(q1 - 1.5 * CASE WHEN q3 = q1 THEN CASE WHEN sd = 0 THEN 1 ELSE sd END ELSE q3 - q1 END, 5000) AS lo, least(q3 + 1.5 * CASE WHEN q3 = q1 THEN CASE WHEN sd = 0 THEN 1 ELSE sd END ELSE q3 - q1 END, 5000000) AS hi FROM u),
 k AS (SELECT coalesce(median(CASE WHEN x BETWEEN lo AND hi THEN x END), any_value(r), median(x)) AS m FROM a, f WHERE x > 0),
 t AS (SELECT row_no, x, m, x * CASE WHEN x < m / 20 THEN 1000 WHEN x > m * 20 THEN CAST(0.001 AS DOUBLE) ELSE 1 END AS y FROM a, k)"""


@query("m4_normalize_scale", "orders", f"""WITH a AS (SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 15 = 0 THEN floor(o_totalprice) / 1000 WHEN o_orderkey % 16 = 0 THEN floor(o_totalprice) * 1000 WHEN o_orderkey % 17 = 0 THEN NULL ELSE floor(o_totalprice) END AS x FROM orders), {_SCALE}
 SELECT row_no, round(CASE WHEN x > 0 AND y <> x AND abs(ln(y) - ln(m)) < abs(ln(x) - ln(m)) AND y BETWEEN m / 100 AND m * 100 THEN y ELSE x END, 4) AS amount, coalesce(x > 0 AND y <> x AND abs(ln(y) - ln(m)) < abs(ln(x) - ln(m)) AND y BETWEEN m / 100 AND m * 100, false) AS scaled FROM t""")
def _(o):
    k, p = F.col("o_orderkey"), F.floor("o_totalprice").cast("double")
    df = o.select(k.alias("row_no"), F.when(k % 15 == 0, p / 1000).when(k % 16 == 0, p * 1000).when(k % 17 == 0, F.lit(None)).otherwise(p).alias("x"))
    out = semantic.normalize_scale(df, "x", "amount", 5000.0, 5000000.0)
    return out.select("row_no", F.round("amount", 4).alias("amount"), F.col("amount_scaled").alias("scaled"))


@query("m5_fx_convert", D, f"WITH a AS (SELECT row_no, CAST({MONEY_TEXT} AS DOUBLE) AS x, {CODE} AS c FROM dirty_sales) SELECT row_no, x * CASE c WHEN 'USD' THEN 950 WHEN 'EUR' THEN 1050 ELSE 1 END AS amount, CASE WHEN x IS NOT NULL AND c IN ('USD', 'EUR') THEN 'CLP' ELSE c END AS currency FROM a")
def _(d):
    amount, code = semantic.exchange(money.parse_money_text(F.col("monto")), money.extract_currency(F.col("monto")))
    return d.select("row_no", amount.alias("amount"), code.alias("currency"))


#: The whole of M6 over the derived table.
MONEY_SQL = f"""WITH b AS (SELECT row_no, monto, producto, CAST({MONEY_TEXT} AS DOUBLE) AS x, {CODE} AS code, coalesce({DOMAIN}, 0) >= 0 AS fits FROM dirty_sales),
 c AS (SELECT code, count(*) AS n FROM b WHERE code IS NOT NULL GROUP BY 1), s AS (SELECT max(n) / sum(n)::DOUBLE AS share, arg_max(code, n) AS top, (SELECT median(x) FROM b WHERE code IS NULL) AS m FROM c),
 a AS (SELECT b.*, coalesce(code, CASE WHEN share > 0.8 AND NOT (top IN ('USD', 'EUR') AND m > 5000) THEN top ELSE 'CLP' END) AS cur FROM b, s),
 u AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, coalesce(stddev_samp(x), 1.0) AS sd, median(x) AS r FROM a WHERE fits AND x BETWEEN 5000 AND 5000000),
 f AS (SELECT *, CASE WHEN q3 = q1 THEN CASE WHEN sd = 0 THEN 1 ELSE sd END ELSE q3 - q1 END AS w FROM u),
 k AS (SELECT coalesce(median(CASE WHEN x BETWEEN greatest(q1 - 1.5 * w, 5000) AND least(q3 + 1.5 * w, 5000000) THEN x END), any_value(r), median(x)) AS m FROM a, f WHERE fits AND x > 0),
 t AS (SELECT a.*, k.m, x * CASE WHEN cur IN ('USD', 'EUR') THEN 1 WHEN x < k.m / 20 THEN 1000 WHEN x > k.m * 20 THEN CAST(0.001 AS DOUBLE) ELSE 1 END AS y FROM a, k),
 z AS (SELECT *, coalesce(fits AND x > 0 AND y <> x AND abs(ln(y) - ln(m)) < abs(ln(x) - ln(m)) AND y BETWEEN m / 100 AND m * 100, false) AS takes FROM t),
 o AS (SELECT *, CASE WHEN takes THEN y ELSE x END AS amount FROM z)
 SELECT row_no, monto, producto, x AS monto_parsed, cur AS monto_moneda_origen, round(amount, 4) AS monto_monto_origen, round(amount * CASE cur WHEN 'USD' THEN 950 WHEN 'EUR' THEN 1050 ELSE 1 END, 4) AS monto_final,
 CASE WHEN amount IS NOT NULL AND cur IN ('USD', 'EUR', 'CLP') THEN 'CLP' ELSE cur END AS monto_final_currency, takes AS monto_scale_corrected FROM o"""


@query("m6_normalize_money", D, MONEY_SQL)
def _(d):
    out = semantic.normalize_money(d.select("row_no", "monto", "producto"), "monto")
    return out.withColumns({c: F.round(c, 4) for c in ("monto_monto_origen", "monto_final")})


@query("m7_classify_domain", D, f"SELECT row_no, {_DOMAIN} AS domain FROM dirty_sales")
def _(d):
    return d.select("row_no", text.classify_domain(F.col("producto")).alias("domain"))


@query("m8_movement_from_note", D, f"SELECT row_no, {_NOTE} AS movement FROM dirty_sales")
def _(d):
    return d.select("row_no", text.movement_from_note(F.col("notas_jose"), F.col("estado")).alias("movement"))


@query("m9_annotate_movement", D, f"""SELECT row_no, {_NOTE} AS tipo_movimiento, CAST(CASE WHEN regexp_matches(lower(notas_jose), 'prest[eéó]') THEN 0.95 WHEN regexp_matches(lower(notas_jose), 'devol(vi|ucion)') THEN 0.9 WHEN regexp_matches(lower(notas_jose), 'ajust[eo]') THEN 0.85
 WHEN regexp_matches(lower(notas_jose), 'vend(id[oa]|i)') THEN 0.8 ELSE 0.5 END AS DOUBLE) AS tipo_confianza FROM dirty_sales""")
def _(d):
    return semantic.annotate_movement(d).select("row_no", "tipo_movimiento", "tipo_confianza")


@query("m10_serial_date_columns", "orders", "SELECT 'serial' AS column_name, min(45000 + o_orderkey % 700) >= 30000 AS is_serial_date FROM orders UNION ALL SELECT 'half', false FROM (SELECT count(*) FROM orders) UNION ALL SELECT 'o_orderkey', min(o_orderkey) >= 30000 FROM orders")
def _(o):
    k = F.col("o_orderkey")
    return semantic.serial_date_columns(o.select((45000 + k % 700).alias("serial"), (45000.5 + k % 2).alias("half"), "o_orderkey"))


@query("m11_serial_to_date", "orders", "SELECT o_orderkey, strftime(DATE '1899-12-30' + CAST(45000 + o_orderkey % 700 AS INT), '%Y-%m-%d') AS d FROM orders")
def _(o):
    return o.select("o_orderkey", F.date_format(dates.serial_to_date(45000 + F.col("o_orderkey") % 700), "yyyy-MM-dd").alias("d"))


@query("m12_enrich", D, f"SELECT row_no, {_DOMAIN} AS producto_domain_flag, {_NOTE} AS estado_semantic, CAST({MONEY_TEXT} AS DOUBLE) AS monto_parsed FROM dirty_sales")
def _(d):
    return semantic.enrich(d).select("row_no", "producto_domain_flag", "estado_semantic", "monto_parsed")
