"""Business aggregates: rollups, shares, growth, coverage, concentration, and what is new or gone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.operators import statistics
from tamiz.operators.stage import staged


def rollup(df: DataFrame, *keys: str) -> DataFrame:
    """Sales, units, cost, lines, margin and its share by any keys; null keys are a group."""
    out = df.groupBy(*keys).agg(
        F.coalesce(F.sum("venta"), F.lit(0)).alias("venta"), F.coalesce(F.sum("unidades"), F.lit(0)).alias("unidades"),
        F.coalesce(F.sum("costo"), F.lit(0)).alias("costo"), F.count("*").alias("lineas"))
    margin = F.col("venta") - F.col("costo")
    return out.withColumns({"margen": margin, "margen_pct": F.when(F.col("venta") != 0, F.round(margin / F.col("venta") * 100, 6))})


def with_share(df: DataFrame, value: str = "venta", name: str = "share") -> DataFrame:
    """Share of the total in %; the total is one broadcast row, so no task sees all rows."""
    total = df.agg(F.sum(value).alias("_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(name, F.when(F.col("_total") != 0, F.round(F.col(value) / F.col("_total") * 100, 6))).drop("_total")


def kpis(df: DataFrame) -> DataFrame:
    """One row of totals, averages and distinct counts, in one pass: each row gives its measures once and a narrow cell for each
    counted column, and both are combined by (column, value) before the shuffle."""
    names = {c: f"n_{c}" for c in ("cliente_codigo", "producto", "comuna", "region", "familia")} | {"fecha": "n_meses"}
    measures = ["venta", "unidades", "costo"]
    own = F.struct(F.lit(-1).alias("c"), F.lit(None).cast("string").alias("v"))
    each = df.select(*measures, F.explode(F.concat(F.array(own), statistics.cells(df, list(names)))).alias("r")).where("r.c = -1 or r.v is not null")
    is_row = F.col("r.c") == -1
    combined = each.groupBy("r.c", "r.v").agg(*[F.sum(F.when(is_row, F.col(m))).alias(m) for m in measures], F.count_if(is_row).alias("lineas"))
    one = combined.agg(*[F.sum(m).alias(m) for m in measures], F.coalesce(F.sum("lineas"), F.lit(0)).alias("lineas"), *[F.count_if(F.col("c") == i).alias(name) for i, name in enumerate(names.values())])
    per = lambda a, b: F.when(F.col(b) != 0, F.round(F.col(a) / F.col(b), 6))
    return one.withColumns({
        "margen": F.col("venta") - F.col("costo"), "margen_pct": F.when(F.col("venta") != 0, F.round((F.col("venta") - F.col("costo")) / F.col("venta") * 100, 6)),
        "precio_medio": per("venta", "unidades"), "costo_medio": per("costo", "unidades"), "venta_mensual": per("venta", "n_meses"), "unidades_mensual": per("unidades", "n_meses")})


def growth(df: DataFrame) -> DataFrame:
    """Yearly rollup with the growth of sales and units in %."""
    years = rollup(df.where("anio is not null"), "anio")
    before = years.select((F.col("anio") + 1).alias("anio"), F.col("venta").alias("_v"), F.col("unidades").alias("_u"))
    rate = lambda a, b: F.when(F.col(b) != 0, F.round((F.col(a) / F.col(b) - 1) * 100, 6))
    return years.join(before, "anio", "left").withColumns({"venta_yoy": rate("venta", "_v"), "unidades_yoy": rate("unidades", "_u")}).drop("_v", "_u")


def missing_months(df: DataFrame, month: str = "fecha", *keys: str) -> DataFrame:
    """Months between the first and the last that have no row; with ``keys``, of each of their series."""
    span = df.groupBy(*keys).agg(F.min(month).alias("a"), F.max(month).alias("b")).where("a is not null")
    calendar = span.select(*keys, F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias(month))
    return calendar.join(df.select(*keys, month).distinct(), [*keys, month], "left_anti")


def canonical_labels(df: DataFrame, key: str, label: str) -> DataFrame:
    """The most frequent label of each key, the smallest on ties. Counted by (key, label) first, so a
    frequent key is combined before the shuffle."""
    counts = df.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key, label).agg(F.count("*").alias("_n"))
    return counts.groupBy(key).agg(F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias(label), F.count("*").alias("n_labels"))


def month_index(df: DataFrame) -> DataFrame:
    """Sales a calendar month, per year that has it, over the mean of all months."""
    months = df.where("mes is not null").groupBy("mes").agg((F.sum("venta") / F.count_distinct("anio")).alias("nivel"))
    return months.withColumn("indice", F.round(F.col("nivel") / F.avg("nivel").over(Window.partitionBy(F.lit(1))), 4)).select("mes", "indice")  # twelve rows at most


def concentration(df: DataFrame, key: str, group: str, share: float = 0.8) -> DataFrame:
    """Members that make ``share`` of sales, and the share of the ten and of the group that sell most.

    The running sum goes over sales classes rather than members' rows alone: members are ranked after
    aggregation, one row each.
    """
    members = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("venta").alias("venta"))
    groups = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.sum("venta").alias("venta"))
    # Members of equal sales are one step of the curve. Steps are range-partitioned, and each partition
    # goes on from the sums before it, so no task sees them all.
    steps = members.groupBy("venta").agg(F.count("*").alias("n")).repartitionByRange(F.col("venta").desc())
    steps = staged(steps.withColumn("_part", F.spark_partition_id()))
    step_sum = F.sum(F.col("venta") * F.col("n"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    starts = steps.groupBy("_part").agg(step_sum.alias("_sum"))  # one row a partition
    starts = starts.select("_part", F.coalesce(F.sum("_sum").over(earlier(Window.orderBy("_part"))), F.lit(0)).alias("_start"))
    within = F.coalesce(step_sum.over(earlier(Window.partitionBy("_part").orderBy(F.col("venta").desc()))), F.lit(0))
    steps = steps.withColumn("_within", within).join(F.broadcast(starts), "_part").select("venta", "n", (F.col("_within") + F.col("_start")).alias("before"))
    total = members.agg(F.sum("venta").alias("total"), F.count("*").alias("members"))
    fits = F.greatest(F.lit(0), F.least(F.col("n"), F.floor((share * F.col("total") - F.col("before")) / F.col("venta"))))
    reach = steps.crossJoin(F.broadcast(total)).agg((F.sum(F.when(F.col("venta") > 0, fits).otherwise(0)) + 1).alias("n_share"))
    top = members.orderBy(F.col("venta").desc(), key).limit(10).agg(F.sum("venta").alias("ten"))
    best = groups.agg(F.max("venta").alias("best"))
    row = total.crossJoin(reach).crossJoin(top).crossJoin(best)  # one row each
    part = lambda c: F.round(F.col(c) / F.col("total") * 100, 6)
    return row.select("members", F.col("n_share").cast("long").alias("n_share"), part("ten").alias("top10_pct"), part("best").alias("top_group_pct"))


def units_pivot(df: DataFrame, products: list[str]) -> DataFrame:
    """Units by month, one column for each of ``products``, which the caller knows to be few."""
    return df.groupBy("fecha").pivot("producto", products).agg(F.sum("unidades")).na.fill(0)


def top_records(df: DataFrame, measure: str, n: int = 15, *ties: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), *ties).limit(n)


def last_year(df: DataFrame) -> DataFrame:
    latest = df.agg(F.max("anio").alias("_last"))
    return df.join(F.broadcast(latest), F.col("anio") == F.col("_last")).drop("_last")


def discontinued(df: DataFrame, key: str = "producto") -> DataFrame:
    """Sold before, not in the last year: last month and all units."""
    sold = last_year(df).select(key).distinct()
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("fecha").alias("ultimo"), F.sum("unidades").alias("unidades")).join(sold, key, "left_anti")


def introduced(df: DataFrame, key: str = "producto") -> DataFrame:
    """First sold in the last year."""
    latest = df.agg(F.max("anio").alias("_last"))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("anio").alias("_first"), F.sum("unidades").alias("unidades")).join(F.broadcast(latest), F.col("_first") == F.col("_last")).select(key, "unidades")


def sequential_ids(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Missing ids are numbered on from the largest, in its form (AUTO-0001 without one), by ``order``.

    Only rows without id are numbered. They are range-partitioned by ``order``; each partition counts
    on from the rows before it, so no task sees them all.
    """
    x = F.col(column)
    missing = x.isNull() | (F.trim(x) == "")
    digits = F.regexp_extract(x, "([0-9]+)$", 1)
    prefix = F.regexp_extract(x, "^(.*?)[0-9]+$", 1)
    found = df.where(~missing & (digits != "")).agg(F.max_by(F.struct(prefix.alias("p"), F.length(digits).alias("w"), digits.try_cast("bigint").alias("v")), digits.try_cast("bigint")).alias("m")).first()["m"]
    lead, width, base = (found["p"], found["w"], found["v"]) if found else ("AUTO-", 4, 0)
    rows = df.where(missing).repartitionByRange(*order).sortWithinPartitions(*order)
    # Partition in the high bits, place in the low ones; stored, as a second evaluation could cut the ranges elsewhere.
    rows = staged(rows.withColumn("_id", F.monotonically_increasing_id()))
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_part", part).join(F.broadcast(before), "_part")
    n = (F.lit(base) + F.col("_before") + place + 1).cast("string")
    made = F.concat(F.lit(lead), F.when(F.length(n) < width, F.lpad(n, width, "0")).otherwise(n))
    return df.where(~missing).unionByName(numbered.withColumn(column, made).select(df.columns))


def interpolated(df: DataFrame, key: str, at: Column, value: str, out: str) -> DataFrame:
    """Gaps of each series filled on the line between their neighbours, its ends with the nearest value."""
    back = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy(at).rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(at.cast("double").alias("t"), F.col(value).alias("v")))
    df = df.withColumns({"_l": F.last(known, True).over(back), "_r": F.first(known, True).over(ahead)})
    line = F.col("_l.v") + (F.col("_r.v") - F.col("_l.v")) * (at - F.col("_l.t")) / (F.col("_r.t") - F.col("_l.t"))
    return df.withColumn(out, F.coalesce(F.col(value), line, F.col("_l.v"), F.col("_r.v"))).drop("_l", "_r")


def centred_average(key: str, order: Column, y: Column) -> Column:
    """13 points, half weight on both ends, over 12; null where the window isn't full."""
    w = Window.partitionBy(key).orderBy(order)
    full = w.rowsBetween(-6, 6)
    value = (F.sum(y).over(full) - 0.5 * F.lag(y, 6).over(w) - 0.5 * F.lead(y, 6).over(w)) / 12
    return F.when(F.count(y).over(full) == 13, value)
