"""Column roles, statistics, histograms, time series and breakdowns for a data set seen for the first time."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions import dates
from tamiz.operators import statistics
from tamiz.operators.stage import staged

# Limits and name tokens of roles.
IDENTIFIER_RATIO, DIMENSION_VALUES, DIMENSION_RATIO, CODE_VALUES, CODE_RATIO, DATE_SHARE = 0.92, 200, 0.5, 12, 0.01, 0.9
ID_TOKENS = ("id", "codigo", "code", "folio", "rut", "sku", "uuid", "key", "llave", "numero_documento", "nro", "guid", "hash")
DATE_TOKENS = ("fecha", "date", "periodo", "period", "mes", "month", "dia", "day", "anio", "año", "year", "timestamp", "creado", "updated")
FLAG_VALUES = ("0", "1", "True", "False", "true", "false", "S", "N", "Si", "No", "SI", "NO")
INTERNAL = ("data_quality_flags", "quality_score", "hoja_origen", "estado_normalizado", "tipo_movimiento")
DERIVED = ("_parsed", "_final", "_scale_corrected", "_monto_origen", "_moneda_origen", "_currency", "_domain_flag", "_as_date", "_normalized", "_semantic", "_original", "_confidence", "_is_serial_date", "_parse_error", "_raw")
#: Names of codes, the number of breakdowns, and the values that a scatter's dimension may have.
CODE_TOKENS = ("codigo", "code", "_id", "cod_")
CHARTS = 6
SCATTER_VALUES = (6, 120)
NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float")


def name_has(name: str, tokens: tuple[str, ...]) -> bool:
    """Short tokens must be a whole part of the name, long ones may be within it."""
    low = name.lower()
    parts = set(re.split("[^a-z0-9]+", low))
    return any(t in parts if len(t) <= 3 else t in low for t in tokens)


def is_internal(name: str) -> bool:
    return name.lower() in INTERNAL or name.lower().endswith(DERIVED)


def column_roles(df: DataFrame) -> DataFrame:
    """(column, kind, nulls, uniques, unique_ratio, role, total): one aggregate over all columns, then the exact
    distinct counts."""
    aggs = []
    for i, (c, t) in enumerate(df.dtypes):
        x = F.col(f"`{c}`")
        dated = F.count_if(dates.parse_date(x).isNotNull()) if t == "string" and name_has(c, DATE_TOKENS) else F.any_value(F.lit(0).cast("long"))
        aggs.append(F.struct(
            F.count_if(x.isNull()).alias("nulls"), F.min(x.cast("string")).alias("low"), F.max(x.cast("string")).alias("high"), dated.alias("dated"),
            (F.sum(x.cast("double")) if t in NUMERIC else F.any_value(F.lit(None).cast("double"))).alias("total")).alias(f"_{i}"))
    wide = df.agg(F.count("*").alias("rows"), *aggs)
    uniques = statistics.distinct_table(df, df.columns)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("kind"), F.lit(name_has(c, DATE_TOKENS)).alias("date_name"), F.lit(name_has(c, ID_TOKENS)).alias("id_name"), F.lit(is_internal(c)).alias("internal"), F.col(f"_{i}").alias("f")) for i, (c, t) in enumerate(df.dtypes)])
    tall = wide.select("rows", F.explode(rows).alias("r")).select("rows", "r.column_name", "r.kind", "r.date_name", "r.id_name", "r.internal", "r.f.*").join(F.broadcast(uniques), "column_name")  # one row a column
    filled, numeric = F.col("rows") - F.col("nulls"), F.col("kind").isin(*NUMERIC)
    ratio = F.when(filled > 0, F.col("uniques") / filled).otherwise(0.0)
    role = (
        F.when(F.col("uniques") <= 1, "constant")
        .when(F.col("kind").isin("date", "timestamp", "timestamp_ntz") | (F.col("date_name") & ~numeric & (F.col("dated") > DATE_SHARE * filled)), "date")
        .when((F.col("kind") == "boolean") | ((F.col("uniques") == 2) & F.col("low").isin(*FLAG_VALUES) & F.col("high").isin(*FLAG_VALUES)), "flag")
        .when(~F.col("kind").isin("double", "float") & ((ratio > IDENTIFIER_RATIO) | (F.col("id_name") & (F.col("uniques") > DIMENSION_VALUES))), "identifier")
        .when(numeric & (F.col("date_name") | ((F.col("uniques") <= CODE_VALUES) & (ratio < CODE_RATIO))), "dimension")
        .when(numeric, "measure")
        .when((F.col("uniques") <= DIMENSION_VALUES) & (ratio <= DIMENSION_RATIO), "dimension")
        .otherwise("text")
    )
    return tall.select("column_name", "kind", "nulls", "uniques", F.round(ratio, 6).alias("unique_ratio"), role.alias("role"), "total", "internal", "rows")


def dataset_profile(roles: DataFrame) -> DataFrame:
    """(role, place, column): dates by coverage, measures by absolute sum, dimensions by their values; no internal columns."""
    known = roles.where(~F.col("internal") & F.col("role").isin("date", "measure", "dimension"))
    order = F.when(F.col("role") == "date", F.col("nulls")).when(F.col("role") == "measure", -F.abs("total")).otherwise(F.col("uniques"))
    place = F.row_number().over(Window.partitionBy("role").orderBy(order, "column_name"))  # one row a column
    return known.select("role", place.alias("place"), "column_name")


def value_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = df.agg(F.count(column).alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select("value", "n", F.round(F.col("n") / F.col("_all") * 100, 6).alias("pct")).orderBy(F.col("n").desc(), "value").limit(n)


def numeric_stats(df: DataFrame, column: str) -> DataFrame:
    x = F.col(column).cast("double")
    return df.agg(F.min(x).alias("low"), F.max(x).alias("high"), F.round(F.avg(x), 6).alias("mean"), F.round(F.sum(x), 4).alias("total"), F.lit(statistics.quantiles(df, {"median": (x, 0.5)})["median"]).cast("double").alias("median"), F.count_if(x < 0).alias("negatives"), F.count_if(x == 0).alias("zeros"))


def histogram(df: DataFrame, column: str, bins: int = 24) -> DataFrame:
    """Counts of equal bins between the 1st and 99th percentile, empty ones included; no row for fewer
    than ten values or three distinct ones."""
    x = F.col(column).cast("double")
    ends = statistics.quantiles(df, {"a": (x, 0.01), "b": (x, 0.99), "lo": (x, 0.0), "hi": (x, 1.0)})
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if ends["lo"] is None:
        return frame.select("bin", F.lit(None).cast("double").alias("low"), F.lit(0).cast("long").alias("n")).limit(0)
    # Three distinct values are two ends and something between them.
    n = df.agg(F.count(x).alias("n"), F.count_if((x > ends["lo"]) & (x < ends["hi"])).alias("between")).first()
    a, b = (ends["a"], ends["b"]) if ends["a"] != ends["b"] else (ends["lo"], ends["hi"])
    w = (b - a) / bins
    inside = df.select(x.alias("_x")).where(F.col("_x").between(a, b))
    counts = inside.groupBy(F.least(F.floor((F.col("_x") - a) / w), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n")) if w else inside.groupBy(F.lit(0).alias("bin")).agg(F.count("*").alias("n"))
    out = frame.join(F.broadcast(counts), "bin", "left").select("bin", F.round(F.lit(a) + F.lit(w) * F.col("bin"), 2).alias("low"), F.coalesce("n", F.lit(0)).alias("n"))
    return out if n["n"] >= 10 and n["between"] else out.limit(0)


def grain(first, last) -> str:
    days = (last - first).total_seconds() / 86400
    return "hour" if days <= 3 else "day" if days <= 120 else "month" if days <= 25 * 365 else "year"


def time_series(df: DataFrame, date: str, measures: list[str]) -> DataFrame | None:
    """Rows and up to three sums by hour, day, month or year, as the span asks; None for fewer than two dates."""
    first, last = df.agg(F.min(date), F.max(date)).first()
    if first is None or first == last:
        return None
    unit = grain(first, last)
    return df.where(F.col(date).isNotNull()).groupBy(F.date_trunc(unit, date).alias("t")).agg(F.count("*").alias("n"), *[F.round(F.sum(m), 4).alias(m) for m in measures[:3]])


def breakdown(df: DataFrame, column: str, measure: str | None = None, n: int = 12) -> DataFrame:
    """The ``n`` largest values by sum or rows with their share, and the rest as one row."""
    value = F.sum(measure).cast("double") if measure else F.count("*").cast("double")
    sums = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("(sin dato)")).alias("member")).agg(value.alias("value"))
    total = sums.agg(F.sum("value").alias("_all"), F.count("*").alias("_members"))
    total = total.withColumn("_all", F.when(F.col("_all") == 0, 1.0).otherwise(F.col("_all")))
    top = sums.orderBy(F.col("value").desc(), "member").limit(n)
    shown = top.agg(F.sum("value").alias("_shown"), F.count("*").alias("_k"))
    rest = total.crossJoin(shown).where("_members > _k").select(F.lit("(resto)").alias("member"), (F.col("_all") - F.col("_shown")).alias("value"))
    both = top.unionByName(rest).crossJoin(F.broadcast(total))
    return both.select("member", F.round("value", 4).alias("value"), F.round(F.col("value") / F.col("_all") * 100, 6).alias("share"))


def scatter(df: DataFrame, by: str, x: str, y: str, n: int = 120) -> DataFrame:
    """Sums of two measures by a dimension, where both are positive, with their correlation over all; at least four."""
    points = df.groupBy(F.col(by).cast("string").alias("member")).agg(F.sum(x).cast("double").alias("x"), F.sum(y).cast("double").alias("y")).where("x > 0 and y > 0 and member is not null")
    r = points.agg(F.round(F.corr("x", "y"), 6).alias("r"), F.count("*").alias("_n")).where("_n >= 4").drop("_n")
    return points.crossJoin(F.broadcast(r)).orderBy(F.col("y").desc(), "member").limit(n)


def redundant_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs of columns that stand for each other: as many pairs of values as values of either; null is a value.

    Sketches leave out the pairs of columns whose numbers of values differ clearly; the rest is counted exactly.
    """
    filled = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(c) for c in columns])
    told = dict(zip(columns, filled.agg(*statistics.sketches(columns)).first()))
    far = 10 * statistics.SKETCH_ERROR
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :] if abs(told[a] - told[b]) <= far * max(told[a], told[b])]
    single = statistics.distinct_counts(filled, sorted({c for p in pairs for c in p}))
    pairs = [(a, b) for a, b in pairs if single[a] == single[b]]
    both = filled.select(*[F.struct(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    n = statistics.distinct_counts(both, both.columns) if pairs else {}
    return df.sparkSession.createDataFrame([(a, b) for i, (a, b) in enumerate(pairs) if n[f"{i}"] == single[a]], "a string, b string")


def dimension_score(uniques: Column, name: Column) -> Column:
    """Best near ten values; code-like names a little less; fewer than two values never."""
    code = F.when(F.lower(name).rlike("|".join(CODE_TOKENS)), 0.15).otherwise(0.0)
    return F.when(uniques < 2, -99.0).otherwise(-F.abs(F.ln(uniques.cast("double")) - F.ln(F.lit(10.0)))) - code


def ranked_dimensions(roles: DataFrame) -> DataFrame:
    """(place, column_name, uniques, score) of the dimensions, those that make the best chart first; no internal columns."""
    known = roles.where(~F.col("internal") & (F.col("role") == "dimension"))
    scored = known.withColumn("score", dimension_score(F.col("uniques"), F.col("column_name")))
    place = F.row_number().over(Window.orderBy(F.col("score").desc(), "column_name"))  # one row a column
    return scored.select(place.alias("place"), "column_name", "uniques", F.round("score", 6).alias("score"))


def chart_dimensions(df: DataFrame, roles: DataFrame) -> tuple[list[str], str | None]:
    """The dimensions worth a chart, best first, of equivalent ones only the better; and the one for a scatter: that of most
    values from 6 to 120 that isn't a time."""
    ranked = [(r["column_name"], r["uniques"]) for r in ranked_dimensions(roles).orderBy("place").collect()]
    names = [c for c, _ in ranked]
    same = {frozenset(p) for p in redundant_pairs(df, names).collect()} if len(names) > 1 else set()  # pairs of columns
    kept: list[str] = []
    for c in names:
        if not any(frozenset((c, k)) in same for k in kept):
            kept.append(c)
    points = [(n, c) for c, n in ranked if c in kept and SCATTER_VALUES[0] <= n <= SCATTER_VALUES[1] and not name_has(c, DATE_TOKENS)]
    return kept, max(points, key=lambda p: (p[0], -kept.index(p[1])))[1] if points else None


def insights(df: DataFrame) -> dict[str, DataFrame]:
    """Profile, series, breakdowns, histogram and scatter of a data set, each a DataFrame."""
    roles = staged(column_roles(df))
    ranked = dataset_profile(roles)
    pick = lambda role, n: [r["column_name"] for r in ranked.where((F.col("role") == role) & (F.col("place") <= n)).orderBy("place").collect()]  # noqa: E731  columns, not rows
    day, measures = pick("date", 1), pick("measure", 3)
    dims, points = chart_dimensions(df, roles)
    out = {"roles": roles, "profile": ranked}
    if day and (series := time_series(df, day[0], measures)) is not None:
        out["series"] = series
    out |= {f"by_{d}": breakdown(df, d, measures[0] if measures else None) for d in dims[:CHARTS]}
    if measures:
        out["histogram"] = histogram(df, measures[0])
    if len(measures) > 1 and points:
        out["scatter"] = scatter(df, points, measures[1], measures[0])
    return out
