"""Queries of text, date and money columns, of structure and of the cleaners."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.functions import dates, money, text
from tamiz.operators import cleaning, structure
from tamiz.plans.catalog import query

# DuckDB expressions used in several oracles.
ID = "CASE WHEN regexp_extract(id_venta, '([0-9]+)', 1) <> '' THEN 'TRX-' || CASE WHEN length(ltrim(regexp_extract(id_venta, '([0-9]+)', 1), '0')) < 4 THEN lpad(ltrim(regexp_extract(id_venta, '([0-9]+)', 1), '0'), 4, '0') ELSE ltrim(regexp_extract(id_venta, '([0-9]+)', 1), '0') END END"
PRODUCT = "nullif(trim(regexp_replace(upper(producto), '[^A-Z0-9]+', ' ', 'g')), '')"
DATE = """CAST(coalesce(CASE WHEN length(fecha_venta) = 8 THEN try_strptime(trim(fecha_venta), '%d/%m/%y') END, try_strptime(trim(fecha_venta), '%Y-%m-%d'), try_strptime(trim(fecha_venta), '%Y/%m/%d'), try_strptime(trim(fecha_venta), '%d/%m/%Y'), try_strptime(trim(fecha_venta), '%d-%m-%Y'),
 try_strptime(trim(fecha_venta), '%d-%b-%Y'), try_strptime(trim(fecha_venta), '%b %d %Y'), try_strptime(trim(fecha_venta), '%m/%d/%Y')) AS DATE)"""
BAD_DATE = f"(nullif(trim(fecha_venta), '') IS NOT NULL AND {DATE} IS NULL)"
_J = r"regexp_replace(regexp_replace(regexp_replace(monto, '[^0-9.,+\-\s]', ' ', 'g'), '([0-9])\s+([0-9])', '\1\2', 'g'), '([0-9])\s+([0-9])', '\1\2', 'g')"
_N = rf"regexp_extract({_J}, '([+-]?[0-9]+(?:[.,][0-9]+)*)', 1)"
_B = f"ltrim({_N}, '+-')"
PRICE = rf"""CASE WHEN monto = 'sesenta lucas' THEN 60000.0::DOUBLE ELSE
 (CASE WHEN starts_with({_N}, '-') THEN -1 ELSE 1 END) * TRY_CAST(CASE
  WHEN contains({_B}, '.') AND contains({_B}, ',') THEN CASE WHEN position(',' IN reverse({_B})) < position('.' IN reverse({_B})) THEN replace(replace({_B}, '.', ''), ',', '.') ELSE replace({_B}, ',', '') END
  WHEN contains({_B}, '.') THEN CASE WHEN regexp_full_match({_B}, '[0-9]{{1,3}}\.[0-9]{{3}}') OR length({_B}) - length(replace({_B}, '.', '')) > 1 THEN replace({_B}, '.', '') ELSE {_B} END
  WHEN contains({_B}, ',') THEN CASE WHEN regexp_full_match({_B}, '[0-9]{{1,3}},[0-9]{{3}}') OR length({_B}) - length(replace({_B}, ',', '')) > 1 THEN replace({_B}, ',', '') ELSE replace({_B}, ',', '.') END
  ELSE {_B} END AS DOUBLE) * CASE WHEN regexp_matches(lower(monto), '(^|[^a-z0-9_])mil([^a-z0-9_]|$)') THEN 1000 ELSE 1 END END"""
CURRENCY = """CASE WHEN monto IS NULL THEN 'DESCONOCIDA' WHEN contains(monto, '$') THEN 'CLP' WHEN contains(lower(monto), 'usd') THEN 'USD' WHEN contains(lower(monto), '€') OR contains(lower(monto), 'eur') THEN 'EUR'
 WHEN contains(lower(monto), 'clp') OR regexp_matches(lower(monto), '(^|[^a-z0-9_])(peso|pesos|lucas)([^a-z0-9_]|$)') THEN 'CLP' ELSE 'DESCONOCIDA' END"""
STATE = "CASE lower(trim(estado)) WHEN 'vendido' THEN 'VENDIDO' WHEN 'comprado' THEN 'COMPRADO' WHEN 'pendiente' THEN 'PENDIENTE' WHEN 'devuelto' THEN 'DEVUELTO' WHEN 'cambio' THEN 'CAMBIO' ELSE 'DESCONOCIDO' END"
_S = "lower(trim(coalesce(estado, '')))"
MOVEMENT = f"""CASE WHEN coalesce({PRICE}, 0) < 0 THEN CASE WHEN contains({_S}, 'devol') THEN 'DEVOLUCION' WHEN contains({_S}, 'cambio') OR contains({_S}, 'ajuste') THEN 'AJUSTE' ELSE 'REEMBOLSO' END
 WHEN contains({_S}, 'devol') THEN 'DEVOLUCION' WHEN contains({_S}, 'cambio') THEN 'CAMBIO' WHEN contains({_S}, 'ajuste') THEN 'AJUSTE' WHEN contains({_S}, 'reembol') THEN 'REEMBOLSO' ELSE 'VENTA' END"""

D = "dirty_sales"


@query("t1_restore_id", D, f"SELECT row_no, {ID} AS id_fixed FROM dirty_sales")
def _(d):
    return d.select("row_no", text.restore_id(F.col("id_venta")).alias("id_fixed"))


@query("t1_id_counts", D, f"SELECT count({ID}) AS fixed_ids, count(*) - count(id_venta) AS null_ids, count(id_venta) - count({ID}) AS invalid_ids FROM dirty_sales")
def _(d):
    fixed = text.restore_id(F.col("id_venta"))
    return d.agg(F.count(fixed).alias("fixed_ids"), F.count_if(F.col("id_venta").isNull()).alias("null_ids"), F.count_if(F.col("id_venta").isNotNull() & fixed.isNull()).alias("invalid_ids"))


@query("t2_normalize_product", D, f"SELECT row_no, {PRODUCT} AS producto_normalized FROM dirty_sales")
def _(d):
    return d.select("row_no", text.normalize_product(F.col("producto")).alias("producto_normalized"))


@query("t3_parse_dates", D, f"SELECT row_no, strftime({DATE}, '%Y-%m-%d') AS fecha, coalesce({BAD_DATE}, false) AS is_invalid FROM dirty_sales")
def _(d):
    day = dates.parse_date(F.col("fecha_venta"))
    return d.select("row_no", F.date_format(day, "yyyy-MM-dd").alias("fecha"), F.coalesce(dates.is_invalid_date(F.col("fecha_venta")), F.lit(False)).alias("is_invalid"))


_DAY = "CASE WHEN row_no % 12 IN (9, 10) THEN NULL ELSE strftime(stamp, '%Y-%m-%d') END"


@query("t3_noted_dates", "noted_dates", f"SELECT row_no, {_DAY} AS fecha, row_no % 12 IN (9, 10) AS is_invalid FROM noted_dates")
def _(d):
    """Unpadded days, times of day, names of months, years of two digits; the 31st of February and an hour of 25 are none."""
    day = dates.parse_date(F.col("fecha"))
    return d.select("row_no", F.date_format(day, "yyyy-MM-dd").alias("fecha"), F.coalesce(dates.is_invalid_date(F.col("fecha")), F.lit(False)).alias("is_invalid"))


@query("c6_typed_dates", "noted_dates", f"SELECT row_no, strftime(stamp, '%Y-%m-%d') AS fecha_alta, strftime(DATE '1899-12-30' + CAST(45000 + row_no % 700 AS INT), '%Y-%m-%d') AS fecha_serial, {_DAY} AS fecha, CASE WHEN row_no % 12 IN (9, 10) THEN 'invalid_date_fecha' ELSE '' END AS flags FROM noted_dates")
def _(d):
    """Typed columns of dates keep their days through the cleaner, serial days become dates, and only texts that are none are flagged."""
    out = cleaning.clean_transactional(d.select("row_no", F.col("stamp").alias("fecha_alta"), (45000 + F.col("row_no") % 700).alias("fecha_serial"), "fecha"))
    shown = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("fecha_alta", "fecha_serial", "fecha")]
    return out.select("row_no", *shown, F.array_join("data_quality_flags", ";").alias("flags"))


@query("t4_parse_price", D, f"SELECT row_no, {PRICE} AS monto FROM dirty_sales")
def _(d):
    return d.select("row_no", money.parse_price(F.col("monto")).alias("monto"))


# Every run of digits is a number of its own to the words' parser, and what touches letters is no word.
@query("t4b_words_to_number", D, """SELECT row_no, CASE WHEN monto = 'sesenta lucas' THEN CAST(60000 AS DOUBLE) WHEN ends_with(monto, 'k') THEN NULL WHEN ends_with(monto, ' mil') THEN CAST(replace(monto, ' mil', '') AS DOUBLE) * 1000
 ELSE nullif(list_sum(list_transform(regexp_extract_all(monto, '[0-9]+'), lambda x: CAST(x AS DOUBLE))), 0) END AS value FROM dirty_sales""")
def _(d):
    return d.select("row_no", money.words_to_number(F.col("monto")).alias("value"))


@query("t4c_impute_money", D, f"SELECT row_no, coalesce({PRICE}, 0) AS monto, monto AS monto_original, {PRICE} IS NULL AS imputed FROM dirty_sales")
def _(d):
    amount = money.parse_price(F.col("monto"))
    return d.select("row_no", F.coalesce(amount, F.lit(0.0)).alias("monto"), F.col("monto").alias("monto_original"), amount.isNull().alias("imputed"))


@query("t5_detect_currency", D, f"SELECT row_no, {CURRENCY} AS currency FROM dirty_sales")
def _(d):
    return d.select("row_no", money.detect_currency(F.col("monto")).alias("currency"))


@query("t6_normalize_state", D, f"SELECT row_no, {STATE} AS estado_normalizado FROM dirty_sales")
def _(d):
    return d.select("row_no", text.normalize_state(F.col("estado")).alias("estado_normalizado"))


@query("t7_classify_movement", D, f"SELECT row_no, {MOVEMENT} AS tipo_movimiento FROM dirty_sales")
def _(d):
    return d.select("row_no", text.classify_movement(money.parse_price(F.col("monto")), F.col("estado")).alias("tipo_movimiento"))


FLAGS = f"list_filter([CASE WHEN {ID} IS NOT NULL THEN 'id_fixed' END, CASE WHEN {BAD_DATE} THEN 'invalid_date_fecha_venta' END, CASE WHEN {PRICE} IS NULL THEN 'imputed_0_monto' END], lambda x: x IS NOT NULL)"
SCORE = f"greatest(0, 100 - CASE WHEN {ID} IS NULL THEN 20 ELSE 0 END - CASE WHEN {DATE} IS NULL THEN 20 ELSE 0 END - CASE WHEN monto IS NULL THEN 20 ELSE 0 END - CASE WHEN {STATE} = 'DESCONOCIDO' THEN 10 ELSE 0 END)"


@query("t8_flags", D, f"SELECT row_no, array_to_string({FLAGS}, ';') AS flags FROM dirty_sales")
def _(d):
    marks = [(text.restore_id(F.col("id_venta")).isNotNull(), "id_fixed"), (dates.is_invalid_date(F.col("fecha_venta")), "invalid_date_fecha_venta"), (money.parse_price(F.col("monto")).isNull(), "imputed_0_monto")]
    return d.select("row_no", F.array_join(cleaning.flags(marks), ";").alias("flags"))


@query("t9_quality_score", D, f"SELECT row_no, CAST({SCORE} AS INT) AS quality_score FROM dirty_sales")
def _(d):
    return cleaning.clean_transactional(d).select("row_no", "quality_score")


@query("c6_clean_transactional", D, f"""SELECT row_no, {ID} AS id_venta, strftime({DATE}, '%Y-%m-%d') AS fecha_venta, coalesce({PRICE}, 0) AS monto, monto AS monto_original, {CURRENCY} AS monto_currency, producto,
 {PRODUCT} AS producto_normalized, estado, {STATE} AS estado_normalizado, notas_jose, {MOVEMENT} AS tipo_movimiento, array_to_string({FLAGS}, ';') AS data_quality_flags, CAST({SCORE} AS INT) AS quality_score FROM dirty_sales""")
def _(d):
    out = cleaning.clean_transactional(d)
    return out.withColumns({"data_quality_flags": F.array_join("data_quality_flags", ";"), "fecha_venta": F.date_format("fecha_venta", "yyyy-MM-dd")})


@query("c2_clean_dispatch", "dirty_sales titles cars", "SELECT 'dirty_sales' AS t, count(*) AS n FROM dirty_sales UNION ALL SELECT 'titles', count(*) FROM titles WHERE tconst <> '\\N' UNION ALL SELECT 'cars', count(*) FROM cars WHERE transmission IS NOT NULL AND condition IS NOT NULL AND odometer IS NOT NULL")
def _(d, titles, cars):
    one = lambda name, df: cleaning.clean(df, hint=name).agg(F.count("*").alias("n")).select(F.lit(name).alias("t"), "n")
    return one("dirty_sales", d).unionByName(one("titles", titles)).unionByName(one("cars", cars))


R = "retail"
_OK = "(periodo IS NOT NULL AND periodo // 100 BETWEEN 1990 AND 2100 AND periodo % 100 BETWEEN 1 AND 12)"
_MES = f"CASE WHEN {_OK} THEN periodo % 100 END"
_MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"
PERIOD = f"""periodo, CASE WHEN {_OK} THEN periodo // 100 END AS anio, {_MES} AS mes, CASE WHEN {_OK} THEN strftime(make_date((periodo // 100)::INT, (periodo % 100)::INT, 1), '%Y-%m-%d') END AS fecha,
 {_MONTHS}[{_MES}] AS mes_nombre, 'T' || (({_MES}) - 1) // 3 + 1 AS trimestre, CASE WHEN {_MES} <= 6 THEN 'S1' WHEN {_MES} > 6 THEN 'S2' END AS semestre""".replace("'T' || (", "'T' || CAST((").replace("// 3 + 1 AS", "// 3 + 1 AS VARCHAR) AS")


def _prefix(c):
    bare = rf"regexp_replace(trim(regexp_replace({c}, '\s+', ' ', 'g')), '(?i)^(?:\s*[A-Z]{{0,2}}[0-9]{{2,5}}\s*[-–]\s*)+', '')"
    return rf"nullif(trim(regexp_replace(upper(regexp_replace({bare}, '\s*[-–]\s*', ' ', 'g')), '\s+', ' ', 'g')), '')"


_P = r"regexp_replace(regexp_replace(regexp_replace(upper(trim(regexp_replace(descripcion_producto_2, '\s+', ' ', 'g'))), '\.+$', ''), '\bMARITNI\b', 'MARTINI', 'g'), '\bMART\s+INI\b', 'MARTINI', 'g')"
_PACK = r"(?i)([0-9]{2,4})\s*(KG|GRS|GR|G)\b\.?"
_GRAMS = f"TRY_CAST(nullif(regexp_extract({_P}, '{_PACK}', 1), '') AS DOUBLE) * CASE WHEN upper(regexp_extract({_P}, '{_PACK}', 2)) = 'KG' THEN 1000 ELSE 1 END"
_BASE = rf"nullif(trim(regexp_replace(regexp_replace(upper(regexp_replace(regexp_replace({_P}, '{_PACK}', ' ', 'g'), '\bRRP\b', ' ', 'g')), '[^A-ZÁÉÍÓÚÑ0-9/ ]+', ' ', 'g'), '\s+', ' ', 'g')), '')"


def _class(table):
    whens = " ".join("WHEN " + " OR ".join(f"contains({_P}, '{t}')" for t in tokens) + f" THEN '{label}'" for label, tokens in table)
    return f"CASE WHEN descripcion_producto_2 IS NULL THEN NULL {whens} ELSE 'OTROS' END"


_COMUNA = r"CASE trim(regexp_replace(comuna, '\s+', ' ', 'g')) WHEN 'SAN PEDRO' THEN 'San Pedro' WHEN 'o''higgins' THEN 'O''Higgins' WHEN 'tal-tal' THEN 'Tal-Tal' END"
_RFLAGS = f"""list_filter([CASE WHEN NOT {_OK} THEN 'periodo_invalido' END, CASE WHEN unidades IS NULL OR venta IS NULL THEN 'metrica_no_numerica' END, CASE WHEN unidades <= 0 THEN 'unidades_no_positivas' END,
 CASE WHEN venta <= 0 THEN 'venta_no_positiva' END, CASE WHEN costo_producto <= 0 THEN 'costo_no_positivo' END, CASE WHEN costo_producto > venta AND venta > 0 THEN 'margen_negativo' END], lambda x: x IS NOT NULL)"""
_RSCORE = f"""CAST(greatest(0, 100 - CASE WHEN NOT {_OK} THEN 60 ELSE 0 END - CASE WHEN unidades IS NULL OR venta IS NULL THEN 60 ELSE 0 END - CASE WHEN unidades <= 0 THEN 60 ELSE 0 END - CASE WHEN venta <= 0 THEN 60 ELSE 0 END
 - CASE WHEN costo_producto <= 0 THEN 15 ELSE 0 END - CASE WHEN costo_producto > venta AND venta > 0 THEN 10 ELSE 0 END - CASE WHEN codigo_del_cliente IS NULL THEN 20 ELSE 0 END - CASE WHEN descripcion_producto_2 IS NULL THEN 20 ELSE 0 END) AS INT)"""


@query("t10_period_parts", R, f"SELECT row_no, {PERIOD} FROM retail")
def _(d):
    p = dates.period_parts(F.col("periodo"))
    p["fecha"] = F.date_format(p["fecha"], "yyyy-MM-dd")
    return d.select("row_no", *[p[k].alias(k) for k in ("periodo", "anio", "mes", "fecha", "mes_nombre", "trimestre", "semestre")])


@query("t11_strip_prefix", R, f"SELECT row_no, {_prefix('nombre_del_cliente')} AS cliente_nombre, {_prefix('cod_local_descripcion')} AS local_nombre FROM retail")
def _(d):
    return d.select("row_no", text.strip_code_prefix(F.col("nombre_del_cliente")).alias("cliente_nombre"), text.strip_code_prefix(F.col("cod_local_descripcion")).alias("local_nombre"))


@query("t12_local_code", R, r"SELECT row_no, upper(nullif(regexp_extract(cod_local_descripcion, '^\s*([A-Z]{0,2}[0-9]{2,5})\b', 1), '')) AS local_codigo FROM retail")
def _(d):
    return d.select("row_no", text.local_code(F.col("cod_local_descripcion")).alias("local_codigo"))


@query("t13_region_split", R, rf"SELECT row_no, nullif(regexp_extract(trim(region), '^([IVXRM]{{1,4}})\s*-', 1), '') AS region_codigo, trim(regexp_replace(trim(region), '^[IVXRM]{{1,4}}\s*-\s*', '')) AS region, {_COMUNA} AS comuna FROM retail")
def _(d):
    return d.select("row_no", text.region_code(F.col("region")).alias("region_codigo"), text.region_name(F.col("region")).alias("region"), text.title_case(text.clean_text(F.col("comuna"))).alias("comuna"))


@query("t14_product", R, f"SELECT row_no, {_P} AS producto FROM retail")
def _(d):
    return d.select("row_no", text.retail_product(F.col("descripcion_producto_2")).alias("producto"))


@query("t15_pack_size", R, f"SELECT row_no, {_GRAMS} AS gramos, CAST(CAST({_GRAMS} AS BIGINT) AS VARCHAR) || ' g' AS formato FROM retail")
def _(d):
    p = text.retail_product(F.col("descripcion_producto_2"))
    return d.select("row_no", text.pack_grams(p).alias("gramos"), text.pack_label(p).alias("formato"))


@query("t16_base_name", R, f"SELECT row_no, {_BASE} AS producto_base FROM retail")
def _(d):
    return d.select("row_no", text.product_base(text.retail_product(F.col("descripcion_producto_2"))).alias("producto_base"))


@query("t17_keyword_class", R, rf"SELECT row_no, {_class(text.CATEGORIES)} AS categoria, {_class(text.FAMILIES)} AS familia, CASE WHEN regexp_matches(coalesce({_P}, ''), '\bRRP\b') THEN 'RRP' ELSE 'ESTANDAR' END AS empaque FROM retail")
def _(d):
    p = text.retail_product(F.col("descripcion_producto_2"))
    return d.select("row_no", text.keyword_class(p, text.CATEGORIES).alias("categoria"), text.keyword_class(p, text.FAMILIES).alias("familia"), text.packaging(p).alias("empaque"))


@query("t18_derived_metrics", R, f"""SELECT row_no, venta - costo_producto AS margen, round(CASE WHEN venta <> 0 THEN (venta - costo_producto) / venta * 100 END, 6) AS margen_pct, round(CASE WHEN unidades <> 0 THEN venta / unidades END, 6) AS precio,
 round(CASE WHEN unidades <> 0 THEN costo_producto / unidades END, 6) AS costo, array_to_string({_RFLAGS}, ';') AS flags FROM retail""")
def _(d):
    out = cleaning.clean_retail(d.withColumn("hoja_origen", F.col("row_no").cast("string")))
    return out.select(F.col("hoja_origen").cast("long").alias("row_no"), F.col("margen_clp").alias("margen"), F.round("margen_pct", 6).alias("margen_pct"), F.round("precio_unitario_clp", 6).alias("precio"), F.round("costo_unitario_clp", 6).alias("costo"), F.array_join("data_quality_flags", ";").alias("flags"))


@query("t19_weighted_score", R, f"SELECT row_no, {_RSCORE} AS quality_score FROM retail")
def _(d):
    out = cleaning.clean_retail(d.withColumn("hoja_origen", F.col("row_no").cast("string")))
    return out.select(F.col("hoja_origen").cast("long").alias("row_no"), "quality_score")


@query("c7_clean_retail", R, rf"""SELECT array_to_string({_RFLAGS}, ';') AS data_quality_flags, {PERIOD}, grupo_clientes AS grupo_cliente, upper(trim(codigo_del_cliente)) AS cliente_codigo, {_prefix('nombre_del_cliente')} AS cliente_nombre,
 upper(nullif(regexp_extract(cod_local_descripcion, '^\s*([A-Z]{{0,2}}[0-9]{{2,5}})\b', 1), '')) AS local_codigo, {_prefix('cod_local_descripcion')} AS local_nombre,
 nullif(regexp_extract(trim(region), '^([IVXRM]{{1,4}})\s*-', 1), '') AS region_codigo, trim(regexp_replace(trim(region), '^[IVXRM]{{1,4}}\s*-\s*', '')) AS region, {_COMUNA} AS comuna, tipo_de_reposicion AS tipo_reposicion,
 {_P} AS producto, {_BASE} AS producto_base, {_class(text.CATEGORIES)} AS categoria, {_class(text.FAMILIES)} AS familia, CASE WHEN regexp_matches(coalesce({_P}, ''), '\bRRP\b') THEN 'RRP' ELSE 'ESTANDAR' END AS empaque,
 {_GRAMS} AS formato_gramos, CAST(CAST({_GRAMS} AS BIGINT) AS VARCHAR) || ' g' AS formato, CAST(unidades AS DOUBLE) AS unidades, venta AS venta_clp, costo_producto AS costo_clp, venta - costo_producto AS margen_clp,
 round(CASE WHEN venta <> 0 THEN (venta - costo_producto) / venta * 100 END, 6) AS margen_pct, round(CASE WHEN unidades <> 0 THEN venta / unidades END, 6) AS precio_unitario_clp, round(CASE WHEN unidades <> 0 THEN costo_producto / unidades END, 6) AS costo_unitario_clp,
 'hoja' AS hoja_origen, {_RSCORE} AS quality_score FROM retail""")
def _(d):
    out = cleaning.clean_retail(d, "hoja")
    return out.withColumns({"data_quality_flags": F.array_join("data_quality_flags", ";"), "fecha": F.date_format("fecha", "yyyy-MM-dd")} | {c: F.round(c, 6) for c in ("margen_pct", "precio_unitario_clp", "costo_unitario_clp")})


@query("t20_sanitize", "pages", r"SELECT page_id, nullif(trim(regexp_replace(url, '\s+', ' ', 'g')), '') AS url FROM pages")
def _(p):
    return p.select("page_id", text.sanitize(F.col("url")).alias("url"))


@query("t20_sanitize_counts", D, r"SELECT count(estado) AS before, count(CASE WHEN lower(trim(regexp_replace(estado, '\s+', ' ', 'g'))) NOT IN ('', 'nan') THEN 1 END) AS after, count(CASE WHEN estado <> trim(estado) THEN 1 END) AS changed FROM dirty_sales")
def _(d):
    x = text.sanitize(F.col("estado"))
    return d.agg(F.count("estado").alias("before"), F.count(x).alias("after"), F.count_if(F.col("estado") != x).alias("changed"))


@query("t21_date_bounds", "orders", "SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1996 AND 1999 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders")
def _(o):
    return o.select("o_orderkey", F.date_format(dates.in_bounds(F.col("o_orderdate"), 1996, 1999), "yyyy-MM-dd").alias("d"))


@query("t22_preload_guard", "lineitem", """SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_extendedprice END AS price, CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_suppkey END AS big, substr(l_returnflag || 'xyz', 1, 2) AS t FROM lineitem""")
def _(li):
    from tamiz.operators.lake import preload_guard

    raw = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 50 == 0, F.when(F.col("l_partkey") % 100 == 0, F.lit(float("nan"))).otherwise(F.lit(1e300))).otherwise(F.col("l_extendedprice")).alias("price"),
                    F.when(F.col("l_suppkey") % 10 == 0, F.lit("99999999999999999999")).otherwise(F.col("l_suppkey").cast("string")).alias("big"), F.concat("l_returnflag", F.lit("xyz")).alias("t"))
    return preload_guard(raw, bigints=["big"], longest=2)


# ── structure ──
@query("p1_drop_empty_rows", D, "SELECT row_no, id_venta, estado FROM (SELECT CASE WHEN row_no % 10 = 3 THEN NULL ELSE row_no END AS row_no, id_venta, CASE WHEN row_no % 10 = 3 THEN NULL ELSE estado END AS estado FROM dirty_sales) WHERE NOT (row_no IS NULL AND id_venta IS NULL AND estado IS NULL)")
def _(d):
    gone = F.col("row_no") % 10 == 3
    return d.select(F.when(~gone, F.col("row_no")).alias("row_no"), "id_venta", F.when(~gone, F.col("estado")).alias("estado")).na.drop("all")


@query("p2_drop_empty_columns", D, "SELECT row_no, estado FROM dirty_sales")
def _(d):
    return structure.drop_empty(d.select("row_no", "estado", F.lit(None).cast("string").alias("nothing")))


@query("p6_drop_listed", "cars", "SELECT row_no, year, transmission, condition, odometer, mmr, sellingprice FROM cars WHERE transmission IS NOT NULL AND condition IS NOT NULL AND odometer IS NOT NULL")
def _(c):
    return structure.drop_listed(c, cleaning.CAR_DROPS)


@query("p7_null_markers", "titles", r"SELECT nullif(tconst, '\N') AS tconst, titleType, primaryTitle, nullif(startYear, '\N') AS startYear, nullif(runtimeMinutes, '\N') AS runtimeMinutes FROM titles")
def _(t):
    return structure.null_markers(t)


@query("p8_coercing_casts", "titles", "SELECT tconst, TRY_CAST(startYear AS BIGINT) AS startYear, TRY_CAST(runtimeMinutes AS DOUBLE) AS runtimeMinutes FROM titles")
def _(t):
    return structure.coerced(t, ["startYear"], ["runtimeMinutes"]).select("tconst", "startYear", "runtimeMinutes")


@query("p9_key_filter", D, "SELECT row_no, id_venta FROM dirty_sales WHERE id_venta IS NOT NULL")
def _(d):
    return structure.with_key(d, "id_venta").select("row_no", "id_venta")


@query("p10_reorder", "customer", "SELECT c_name, CAST(NULL AS VARCHAR) AS missing, c_custkey FROM customer")
def _(c):
    return structure.reordered(c, ["c_name", "missing", "c_custkey"], strict=True)


@query("p11_clean_text", D, r"SELECT row_no, nullif(trim(regexp_replace(producto, '\s+', ' ', 'g')), '') AS producto FROM dirty_sales")
def _(d):
    return d.select("row_no", text.clean_text(F.col("producto")).alias("producto"))


@query("p12_predicates", "lineitem", "SELECT count(CASE WHEN l_quantity BETWEEN 10 AND 20 THEN 1 END) AS n_between, count(CASE WHEN l_returnflag IN ('A', 'R') THEN 1 END) AS n_in, count(CASE WHEN l_shipdate IS NULL THEN 1 END) AS n_null, count(CASE WHEN regexp_matches(l_linestatus, '^(?:O|X)') THEN 1 END) AS n_regex FROM lineitem")
def _(li):
    return li.agg(F.count_if(F.col("l_quantity").between(10, 20)).alias("n_between"), F.count_if(F.col("l_returnflag").isin("A", "R")).alias("n_in"), F.count_if(F.col("l_shipdate").isNull()).alias("n_null"), F.count_if(F.col("l_linestatus").rlike("^(?:O|X)")).alias("n_regex"))


@query("c4_clean_cars", "cars", "SELECT year, CASE WHEN lower(trim(transmission)) = 'manual' THEN 1 ELSE 0 END::INT AS transmission, condition, odometer, mmr, sellingprice, row_no FROM cars WHERE transmission IS NOT NULL AND condition IS NOT NULL AND odometer IS NOT NULL")
def _(c):
    return cleaning.clean_cars(c)


@query("c4_car_metrics", "cars", "WITH m AS (SELECT *, transmission IS NOT NULL AND condition IS NOT NULL AND odometer IS NOT NULL AS ok FROM cars) SELECT count(*) AS rows_in, count(CASE WHEN ok THEN 1 END) AS rows_out, count(CASE WHEN NOT ok THEN 1 END) AS dropped, count(CASE WHEN ok AND lower(trim(transmission)) = 'manual' THEN 1 END) AS manual FROM m")
def _(c):
    return cleaning.car_metrics(c)


@query("c5_clean_titles", "titles", r"SELECT tconst, titleType, primaryTitle, TRY_CAST(startYear AS BIGINT) AS startYear, TRY_CAST(runtimeMinutes AS BIGINT) AS runtimeMinutes FROM titles WHERE tconst <> '\N'")
def _(t):
    return cleaning.clean_titles(t)
