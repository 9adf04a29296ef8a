"""Star schema, inferred measures and hierarchies, and the queries of a cube as group-bys."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.operators import statistics

#: A level of a hierarchy has at least this many times the values of the level above.
#: The calendar's levels, from the widest.
CALENDAR = ["CalendarYear", "CalendarQuarter", "CalendarMonth", "Datekey"]
LEVEL_RATIO = 1.5


def dimension(df: DataFrame, natural: list[str], key: str) -> DataFrame:
    """Distinct natural keys with a surrogate: a 64-bit hash of the natural key, so fact and dimension
    make it on their own, no row is numbered in one task, and reloads keep it."""
    return df.select(*natural).distinct().select(F.xxhash64(*natural).alias(key), *natural)


def star(df: DataFrame, dims: dict[str, list[str]], degenerate: list[str], measures: list[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(fact, dimensions): the fact holds surrogate keys, degenerate columns and measures."""
    tables = {name: dimension(df, natural, f"{name}_key") for name, natural in dims.items()}
    return df.select(*degenerate, *[F.xxhash64(*natural).alias(f"{name}_key") for name, natural in dims.items()], *measures), tables


def inferred_measures(df: DataFrame, keys: list[str]) -> DataFrame:
    """SUM of numeric columns, AVG of those named like ratios, and the row count."""
    aggs = []
    for c, t in df.dtypes:
        if c not in keys and (t in ("int", "bigint", "double", "float") or t.startswith("decimal")):
            ratio = re.search("percent|pct|ratio|rate", c, re.I)
            aggs.append(F.round(F.avg(c), 6).alias(f"avg_{c}") if ratio else F.round(F.sum(c).cast("double"), 4).alias(f"sum_{c}"))
    return df.agg(*aggs, F.count("*").alias("row_count"))


def _family(name: str) -> str:
    """What columns of one hierarchy share: their capital letters (SalesTerritoryGroup, SalesTerritoryRegion), else their first word."""
    capitals = "".join(c for c in name if c.isupper())
    return capitals if capitals and not name.isupper() else name.split("_")[0]


def hierarchies(df: DataFrame, keys: list[str]) -> DataFrame:
    """(hierarchy, level, column, n): columns of one family, from few values to many, each at least LEVEL_RATIO times the one
    above; two levels at least. A table of dates has the calendar's levels, whatever their numbers."""
    calendar = [c for c in CALENDAR if c in df.columns]
    families: dict[str, list[str]] = {}
    for c in df.columns:
        if c not in keys and not (len(calendar) > 1 and c in calendar):
            families.setdefault(_family(c), []).append(c)
    columns = [c for group in families.values() if len(group) > 1 for c in group]
    counts = statistics.distinct_counts(df, [*columns, *(calendar if len(calendar) > 1 else [])])
    rows = [("Calendar", i, c, counts[c]) for i, c in enumerate(calendar, 1) if len(calendar) > 1]
    for family, group in families.items():
        levels: list[str] = []
        for c in sorted((c for c in group if counts.get(c)), key=lambda c: (counts[c], c)):
            if not levels or counts[c] >= LEVEL_RATIO * counts[levels[-1]]:
                levels.append(c)
        rows += [(family, i, c, counts[c]) for i, c in enumerate(levels, 1) if len(levels) > 1]
    return df.sparkSession.createDataFrame(rows, "hierarchy string, level int, column_name string, n long")


def preaggregates(df: DataFrame, dims: list[str], measure: str) -> DataFrame:
    """One rollup a dimension, all by grouping sets in one pass over the rows."""
    view = df.select(*dims, F.col(measure).alias("_m"))
    sets = ", ".join(f"({d})" for d in dims)
    out = df.sparkSession.sql(f"SELECT {', '.join(dims)}, grouping_id({', '.join(dims)}) AS _g, sum(_m) AS total FROM {{view}} GROUP BY GROUPING SETS ({sets})", view=view)
    name, value, all_ones = F.lit(None), F.lit(None), 2 ** len(dims) - 1
    for i, d in enumerate(dims):
        here = F.col("_g") == all_ones - 2 ** (len(dims) - 1 - i)
        name, value = F.when(here, d).otherwise(name), F.when(here, F.col(d).cast("string")).otherwise(value)
    return out.select(name.alias("dim"), value.alias("member"), "total")


def drill_down(df: DataFrame, levels: list[str], measure: str) -> DataFrame:
    """Totals of each level under the ones above, with the grand total; ``depth`` counts the open levels."""
    out = df.rollup(*levels).agg(F.sum(measure).alias("total"), F.grouping_id().alias("_g"))
    depth = F.lit(0)
    for i in range(len(levels)):
        depth = F.when(F.col("_g") == 2**i - 1, len(levels) - i).otherwise(depth)
    return out.withColumn("depth", depth).drop("_g")


def year_to_date(monthly: DataFrame) -> DataFrame:
    """(anio, mes, total) → with the sum since January and the same month of the year before."""
    w = Window.partitionBy("anio").orderBy("mes").rowsBetween(Window.unboundedPreceding, 0)
    before = monthly.select((F.col("anio") + 1).alias("anio"), "mes", F.col("total").alias("prior_year"))
    return monthly.withColumn("ytd", F.sum("total").over(w)).join(before, ["anio", "mes"], "left").where("total > 0")


def last_nonempty(df: DataFrame, by: list[str], value: str, when: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.max_by(value, when).alias("last_value"))


def self_check(df: DataFrame, levels: list[str], measure: str) -> DataFrame:
    """The detail's total against the total of each level's rollup, by grouping sets in one pass over the rows."""
    view = df.select(*levels, F.col(measure).alias("_m"))
    names, sets = ", ".join(levels), ", ".join(["()", *[f"({c})" for c in levels]])
    groups = df.sparkSession.sql(f"SELECT grouping_id({names}) AS _g, sum(_m) AS t FROM {{view}} GROUP BY {names} GROUPING SETS ({sets})", view=view)
    all_ones = 2 ** len(levels) - 1
    level = F.when(F.col("_g") == all_ones, "detail")
    for i, c in enumerate(levels):
        level = level.when(F.col("_g") == all_ones - 2 ** (len(levels) - 1 - i), c)
    return groups.groupBy(level.alias("level")).agg(F.sum("t").alias("total"))
