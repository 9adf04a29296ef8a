"""Where queries are registered, and the derived tables they read.

A derived table is one SELECT that Spark and DuckDB both accept, so operator and oracle read the same
rows. ``{table}`` stands for a given table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_K = "CAST(o_orderkey AS STRING)"
_Y, _M, _D = "CAST(year(o_orderdate) AS STRING)", "lpad(CAST(month(o_orderdate) AS STRING), 2, '0')", "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')"
_A = "CAST(floor(o_totalprice) AS BIGINT)"
_DOTTED = f"CAST(CAST(({_A} - {_A} % 1000) / 1000 AS BIGINT) AS STRING) || '.' || lpad(CAST({_A} % 1000 AS STRING), 3, '0')"
_NAME = "CASE month(o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' WHEN 9 THEN 'September' WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END"

DERIVED = {
    "dirty_sales": f"""
SELECT o_orderkey AS row_no,
  CASE o_orderkey % 10 WHEN 0 THEN {_K} WHEN 1 THEN 'TRX-' || {_K} WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN 'invalid' WHEN 5 THEN '  ' || {_K} || ' '
    WHEN 6 THEN 'A' || {_K} || 'B7' WHEN 7 THEN lpad({_K}, 9, '0') WHEN 8 THEN 'trx_' || {_K} ELSE {_K} END AS id_venta,
  CASE WHEN o_orderkey % 17 = 0 THEN 'fecha-invalida' WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN ''
    ELSE CASE o_orderkey % 7 WHEN 0 THEN {_Y} || '-' || {_M} || '-' || {_D} WHEN 1 THEN {_Y} || '/' || {_M} || '/' || {_D} WHEN 2 THEN {_D} || '/' || {_M} || '/' || {_Y}
      WHEN 3 THEN {_D} || '-' || {_M} || '-' || {_Y} WHEN 4 THEN {_D} || '/' || {_M} || '/' || substr({_Y}, 3, 2)
      WHEN 5 THEN {_D} || '-' || substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * month(o_orderdate) - 2 AS INT), 3) || '-' || {_Y}
      ELSE CASE WHEN day(o_orderdate) > 12 THEN {_M} || '/' || {_D} || '/' || {_Y} ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * month(o_orderdate) - 2 AS INT), 3) || ' ' || {_D} || ' ' || {_Y} END END
    END AS fecha_venta,
  CASE o_orderkey % 13 WHEN 0 THEN CAST({_A} AS STRING) WHEN 1 THEN '$' || {_DOTTED} WHEN 2 THEN CAST({_A} AS STRING) || ',50' WHEN 3 THEN CAST({_A} AS STRING) || '.50'
    WHEN 4 THEN 'USD ' || CAST({_A} AS STRING) WHEN 5 THEN CAST(10 + o_orderkey % 90 AS STRING) || ' mil' WHEN 6 THEN CAST(10 + o_orderkey % 900 AS STRING) || 'k'
    WHEN 7 THEN '' WHEN 8 THEN NULL WHEN 9 THEN '-' || CAST({_A} AS STRING) WHEN 10 THEN 'sesenta lucas' WHEN 11 THEN '1 ' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0') || ' pesos'
    ELSE {_DOTTED} || ',75 EUR' END AS monto,
  CASE o_orderkey % 6 WHEN 0 THEN 'Logitech  Mouse-' || CAST(o_orderkey % 40 AS STRING) WHEN 1 THEN ' notebook asus core i7 16gb ' WHEN 2 THEN 'Pizza familiar' WHEN 3 THEN 'RTX 4090' WHEN 4 THEN NULL ELSE '¡¡--!!' END AS producto,
  CASE o_orderkey % 8 WHEN 0 THEN 'Vendido' WHEN 1 THEN ' comprado ' WHEN 2 THEN 'PENDIENTE' WHEN 3 THEN 'devuelto' WHEN 4 THEN 'cambio' WHEN 5 THEN 'xyz_desconocido' WHEN 6 THEN NULL ELSE 'reembolsado' END AS estado,
  CASE o_orderkey % 5 WHEN 0 THEN 'se lo presté a un amigo' WHEN 1 THEN 'hubo devolucion parcial' WHEN 2 THEN 'vendido con ajuste' WHEN 3 THEN NULL ELSE 'sin novedad' END AS notas_jose
FROM {{orders}}""",
    "retail": """
SELECT o_orderkey AS row_no,
  CASE WHEN o_orderkey % 41 = 0 THEN 202113 WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) END AS periodo,
  c_mktsegment AS grupo_clientes,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE ' c' || CAST(o_custkey AS STRING) END AS codigo_del_cliente,
  CASE o_orderkey % 3 WHEN 0 THEN 'J501-' || c_name WHEN 1 THEN 'N678 - N678 - ' || c_name ELSE 'Jumbo  Bilbao-Norte' END AS nombre_del_cliente,
  CASE o_orderkey % 4 WHEN 0 THEN '0100 - Local ' || CAST(c_nationkey AS STRING) WHEN 1 THEN 'n12-Centro' WHEN 2 THEN 'Sin codigo' ELSE NULL END AS cod_local_descripcion,
  CASE o_orderkey % 4 WHEN 0 THEN 'VI - Region de O''Higgins' WHEN 1 THEN 'XV-Arica' WHEN 2 THEN 'RM - Metropolitana ' ELSE 'Sin region' END AS region,
  CASE o_orderkey % 3 WHEN 0 THEN 'SAN  PEDRO' WHEN 1 THEN 'o''higgins' ELSE 'tal-tal' END AS comuna,
  o_orderpriority AS tipo_de_reposicion,
  CASE o_orderkey % 9 WHEN 0 THEN 'Lentejas 5 MM 500 G' WHEN 1 THEN 'guiso lentejas 250 gr.' WHEN 2 THEN 'HARINA  TOSTADA RRP 1KG' WHEN 3 THEN 'CHUÑO 270 GRS MARITNI' WHEN 4 THEN 'sopa mart  ini, 12 unid'
    WHEN 5 THEN NULL WHEN 6 THEN 'Perlas de cebada RRP 500G..' WHEN 7 THEN 'Azucar rubia 1000 g' ELSE 'poroto' END AS descripcion_producto_2,
  CASE WHEN o_orderkey % 31 = 0 THEN -3 WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 50 AS BIGINT) END AS unidades,
  CASE WHEN o_orderkey % 47 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(floor(o_totalprice) AS DOUBLE) END AS venta,
  CASE WHEN o_orderkey % 53 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(floor(o_totalprice * (50 + o_orderkey % 70) / 100) AS DOUBLE) END AS costo_producto
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "sales": """
SELECT o_orderkey, l_linenumber, c_mktsegment AS grupo_cliente, CASE WHEN o_custkey % 211 = 0 THEN NULL ELSE o_custkey END AS cliente_codigo,
  CASE WHEN o_orderkey % 5 = 0 AND o_custkey % 3 = 0 THEN c_name || ' SPA' ELSE c_name END AS cliente_nombre,
  r_name AS region, n_name AS comuna, p_type AS categoria, p_brand AS familia, p_name AS producto, l_linestatus AS empaque, o_orderpriority AS tipo_reposicion,
  CAST(year(o_orderdate) AS BIGINT) AS anio, CAST(month(o_orderdate) AS BIGINT) AS mes, CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha,
  CAST(l_quantity AS BIGINT) AS unidades, CAST(floor(l_extendedprice) AS BIGINT) AS venta,
  CAST(floor(l_extendedprice) AS BIGINT) - CAST(floor(l_extendedprice * ((l_partkey % 7) - 1) / CAST(10 AS DOUBLE)) AS BIGINT) AS costo
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
  JOIN {region} ON n_regionkey = r_regionkey JOIN {part} ON l_partkey = p_partkey""",
    "monthly": """
SELECT p_brand AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(l_quantity) AS DOUBLE) AS y
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
WHERE NOT (p_brand LIKE '%1' AND year(o_orderdate) = 1997 AND month(o_orderdate) IN (5, 6)) AND NOT (p_brand LIKE '%2' AND o_orderdate < TIMESTAMP '2000-03-01 00:00:00')
GROUP BY p_brand, CAST(date_trunc('month', o_orderdate) AS DATE)""",
    "cars": """
SELECT p_partkey AS row_no, CAST(1990 + p_size % 30 AS BIGINT) AS year, p_brand AS make, CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN 'Manual ' ELSE 'automatic' END AS transmission,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 10 END AS condition, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_partkey * 37 % 200000 AS DOUBLE) END AS odometer,
  'V' || CAST(p_partkey AS STRING) AS vin, p_type AS body, p_retailprice AS mmr, p_retailprice * 2 AS sellingprice
FROM {part}""",
    "titles": r"""
SELECT CASE WHEN p_partkey % 23 = 0 THEN '\N' ELSE 'tt' || lpad(CAST(p_partkey AS STRING), 7, '0') END AS tconst, p_type AS "titleType", p_name AS "primaryTitle",
  CASE WHEN p_partkey % 5 = 0 THEN '\N' WHEN p_partkey % 7 = 0 THEN 'abc' ELSE CAST(1900 + p_size AS STRING) END AS "startYear",
  CASE WHEN p_partkey % 4 = 0 THEN '\N' ELSE CAST(p_size * 3 AS STRING) END AS "runtimeMinutes"
FROM {part}""",
    "lineitem_broken": """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 97 = 0 THEN -l_partkey - 1 WHEN l_partkey % 89 = 0 THEN NULL ELSE l_partkey END AS l_partkey, l_suppkey, l_quantity FROM {lineitem}""",
}
DERIVED["noted_dates"] = f"""
SELECT o_orderkey AS row_no, o_orderdate AS stamp, CASE o_orderkey % 12 WHEN 0 THEN CAST(day(o_orderdate) AS STRING) || '/' || CAST(month(o_orderdate) AS STRING) || '/' || {_Y}
  WHEN 1 THEN {_Y} || '-' || {_M} || '-' || {_D} || ' 10:30:00' WHEN 2 THEN {_Y} || '-' || {_M} || '-' || {_D} || 'T23:59:59Z' WHEN 3 THEN {_D} || '.' || {_M} || '.' || {_Y}
  WHEN 4 THEN CAST(day(o_orderdate) AS STRING) || ' ' || {_NAME} || ' ' || {_Y} WHEN 5 THEN {_NAME} || ' ' || CAST(day(o_orderdate) AS STRING) || ', ' || {_Y}
  WHEN 6 THEN {_Y} || {_M} || {_D} WHEN 7 THEN {_D} || '-' || {_M} || '-' || {_Y} || ' 7:05' WHEN 8 THEN CAST(day(o_orderdate) AS STRING) || '-' || CAST(month(o_orderdate) AS STRING) || '-' || substr({_Y}, 3, 2)
  WHEN 9 THEN {_Y} || '/' || {_M} || '/' || {_D} || ' 25:00' WHEN 10 THEN '31/02/' || {_Y} ELSE {_D} || ' ' || {_M} || ' ' || {_Y} END AS fecha
FROM {{orders}}"""
DERIVED["titles"] = DERIVED["titles"].replace('"', "")


#: Derived tables whose texts are parsed by most queries over them.
PARSED = {"dirty_sales", "retail", "noted_dates"}


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores where it has fewer splits than cores, as parsing texts takes more than
    moving them; a table of many splits stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given or derived table."""
    if name not in DERIVED:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    given = set(re.findall(r"\{(\w+)\}", DERIVED[name]))
    text = DERIVED[name].replace("\\", "\\\\") if name == "titles" else DERIVED[name]
    return spark.sql(text, **{t: spread(table(spark, sf_dir, t)) if t == "orders" and name in PARSED else table(spark, sf_dir, t) for t in given})


def oracle(views: list[str] | str, body: str) -> str:
    """``body`` for DuckDB, with derived tables before it."""
    views = [views] if isinstance(views, str) else views
    heads = [f"{v} AS ({re.sub(r'[{](\w+)[}]', r'\1', DERIVED[v])})" for v in views]
    body = body.strip()
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(heads)}, {body[15:]}"
    if body.startswith("WITH "):
        return f"WITH {', '.join(heads)}, {body[5:]}" if heads else body
    return f"WITH {', '.join(heads)} {body}" if heads else body


def query(name: str, reads: list[str] | str = "", sql: str | None = None):
    """Registers ``f(*tables)`` as a query over the tables named in ``reads``, with its SQL."""
    reads = reads.split() if isinstance(reads, str) else reads

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(*[table(spark, sf_dir, t) for t in reads])
        if sql:
            ORACLES[name] = oracle([t for t in reads if t in DERIVED], sql)
        return f

    return add
