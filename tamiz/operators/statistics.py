"""Exact order statistics and distinct counts of whole columns, without one task that holds a column.

``F.percentile`` and ``F.median`` keep every distinct value in one aggregation buffer, so here a sketch bounds a quantile and
only what lies between the bounds is counted. Several ``count_distinct`` in one aggregate copy each row once a column; here
narrow cells are combined instead, in one plan at every size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that may lie between two bounds when their values are fetched.
GATHERED = 50_000
#: Ranks told by a sketch are off by at most one in so many.
ACCURACY = 10_000
#: Relative standard deviation of the distinct sketch.
SKETCH_ERROR = 0.02


def quantiles(df: DataFrame, wanted: dict[str, tuple[Column, float]]) -> dict[str, float | None]:
    """name → (column, share) gives name → quantile, interpolated between neighbours, nulls left out; None for no values.
    NaN is greater than all other values, as Spark sorts it; a quantile that would touch one is NaN.

    A sketch tells two bounds around each rank. One aggregate counts what lies below and between them; once
    that is few rows, their values are fetched by count. Each round narrows the bounds by ACCURACY / 4 or so.
    """
    given = list(wanted)
    wanted = {f"_{i}": wanted[name] for i, name in enumerate(given)}  # names that need no quotes
    # Quantiles of one and the same column share its figures.
    columns = {id(column): f"_c{i}" for i, (column, _) in enumerate(wanted.values())}
    of = {n: columns[id(column)] for n, (column, _) in wanted.items()}
    named_columns = {columns[id(column)]: column for column, _ in wanted.values()}
    margin = dict.fromkeys(wanted, 2 / ACCURACY)
    around = lambda n, share: [min(1.0, max(0.0, share + d)) for d in (-margin[n], margin[n])]
    given_rows = df.select(*[column.cast("double").alias(c) for c, column in named_columns.items()])
    real = {c: F.when(~F.isnan(c), F.col(c)) for c in named_columns}
    rows = given_rows.select(*[x.alias(c) for c, x in real.items()])
    first = given_rows.agg(*[F.struct(
        F.count(x).alias("n"), F.count(c).alias("all"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.approx_percentile(x, [p for n in wanted if of[n] == c for p in around(n, wanted[n][1])], ACCURACY).alias("told")).alias(c) for c, x in real.items()]).first()
    out: dict[str, float | None] = {n: None for n in wanted if not first[of[n]]["all"]}
    rank = {n: wanted[n][1] * (first[of[n]]["all"] - 1) for n in wanted if n not in out}
    out |= {n: math.nan for n, r in rank.items() if math.ceil(r) >= first[of[n]]["n"]}
    rank = {n: r for n, r in rank.items() if n not in out}
    bounds = {n: (first[of[n]]["low"], first[of[n]]["high"]) for n in rank}
    below, inside = dict.fromkeys(rank, 0), {n: first[of[n]]["n"] for n in rank}
    told = {n: first[of[n]]["told"][2 * i : 2 * i + 2] for c in named_columns for i, n in enumerate([n for n in wanted if of[n] == c]) if n in rank}
    shares = {n: around(n, wanted[n][1]) for n in rank}
    while wide := [n for n in rank if n not in out and (inside[n] > GATHERED or n in told) and bounds[n][0] < bounds[n][1]]:
        if again := [n for n in wide if n not in told]:
            between = {n: F.when(F.col(of[n]).between(*bounds[n]), F.col(of[n])) for n in again}
            shares |= {n: around(n, (rank[n] - below[n]) / inside[n]) for n in again}
            told |= rows.agg(*[F.approx_percentile(between[n], shares[n], ACCURACY).alias(n) for n in again]).first().asDict()
        new = {n: (bounds[n][0] if shares[n][0] == 0 else told[n][0], bounds[n][1] if shares[n][1] == 1 else told[n][1]) for n in wide}
        told = {}
        counts = rows.agg(*[_around(F.col(of[n]), *new[n]).alias(n) for n in wide]).first()
        for n in wide:
            c, (low, high) = counts[n], new[n]
            ranks = (int(rank[n]), int(rank[n]) + (rank[n] > int(rank[n])))
            if not c["below"] <= ranks[0] or not ranks[1] < c["below"] + c["low"] + c["between"] + c["high"]:
                margin[n] *= 4  # the merged sketch was further off; with wide margins the bounds stay as they are
                continue
            # What lies on a bound, or next to it, is known; the bounds move inwards past it.
            first_in, last_in = c["below"] + c["low"], c["below"] + c["low"] + c["between"] - 1
            known = [low if k < first_in else high if k > last_in else c["least"] if k == first_in else c["most"] if k == last_in else None for k in ranks]
            if None not in known:
                out[n] = _part(*known, rank[n] - ranks[0])
            bounds[n], below[n], inside[n] = (c["least"], c["most"]), first_in, c["between"]
    for n in rank:
        if n not in out and bounds[n][0] == bounds[n][1]:
            out[n] = bounds[n][0]
    open_ = [n for n in rank if n not in out]
    if open_:
        # At most GATHERED rows a name lie between its bounds.
        pairs = F.array_compact(F.array(*[F.when(F.col(of[n]).between(*bounds[n]), F.struct(F.lit(n).alias("name"), F.col(of[n]).alias("x"))) for n in open_]))
        found = rows.select(F.explode(pairs).alias("p")).groupBy("p.name", "p.x").agg(F.count("*").alias("k")).collect()
        for n in open_:
            at, values, want = below[n], sorted((r["x"], r["k"]) for r in found if r["name"] == n), rank[n]
            low = high = None
            for value, k in values:
                low = value if low is None and at + k > int(want) else low
                high = value if high is None and at + k > int(want) + (want > int(want)) else high
                at += k
            out[n] = _part(low, high, want - int(want))
    return {name: out[f"_{i}"] for i, name in enumerate(given)}


def _part(low: float, high: float, share: float) -> float:
    """Between two neighbours; equal ones may be infinite."""
    return low if low == high or not share else low + (high - low) * share


def _around(x: Column, low: float, high: float) -> Column:
    inner = F.when((x > low) & (x < high), x)
    return F.struct(
        F.count_if(x < low).alias("below"), F.count_if(x == low).alias("low"), F.count(inner).alias("between"), F.count_if((x == high) & (x > low)).alias("high"),
        F.min(inner).alias("least"), F.max(inner).alias("most"))


def sketches(columns: list[str]) -> list[Column]:
    return [F.approx_count_distinct(F.col(f"`{c}`"), SKETCH_ERROR).alias(f"_{i}") for i, c in enumerate(columns)]


def told_apart(column: str, kind: str) -> Column:
    """A text for each value of a column, the same for equal values only; nulls stay."""
    x = F.col(f"`{column}`")
    if kind in ("double", "float"):
        return (x.cast("double") + 0.0).cast("string")  # one zero
    if kind == "timestamp":
        return F.unix_micros(x).cast("string")  # a clock shows some hours twice
    if kind == "binary":
        return F.base64(x)
    return F.to_json(x, {"ignoreNullFields": "false"}) if kind.startswith(("array", "struct", "map")) else x.cast("string")


def cells(df: DataFrame, columns: list[str]) -> Column:
    """An array of (c, v), one for each column: its place in ``columns`` and its value as text."""
    kinds = dict(df.dtypes)
    return F.array(*[F.struct(F.lit(i).alias("c"), told_apart(c, kinds[c]).alias("v")) for i, c in enumerate(columns)])


def distinct_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, uniques): the exact number of values of each column, nulls left out.

    One scan gives a narrow row a cell; these are combined by (column, value) before the only shuffle that grows with
    the data, so neither a frequent value nor a column of many values meets in one task or buffer.
    """
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(columns)], "_c int, column_name string")
    values = df.select(F.explode(cells(df, columns)).alias("r")).where("r.v is not null").groupBy("r.c", "r.v").agg(F.lit(1).alias("one")) if columns else None
    if values is None:
        return names.select("column_name", F.lit(0).cast("long").alias("uniques"))
    counts = values.groupBy("c").agg(F.count("*").alias("uniques"))
    return names.join(F.broadcast(counts), F.col("_c") == F.col("c"), "left").select("column_name", F.coalesce("uniques", F.lit(0)).alias("uniques"))  # one row a column


def distinct_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    return {r["column_name"]: r["uniques"] for r in distinct_table(df, columns).collect()}  # one row a column
