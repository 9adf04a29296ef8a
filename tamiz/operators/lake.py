"""Checks over a lake of fact and dimension tables: audit, keys, orphans, schemas over files."""

from __future__ import annotations

import datetime
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tamiz.functions import dates, text
from tamiz.operators import statistics

#: The widest integers that an INT and a BIGINT hold.
INT_MAX, BIGINT_MAX = 2**31 - 1, 2**63 - 1


def preload_guard(df: DataFrame, bigints: list[str] = (), longest: int = 1_000_000, largest: float = 1e28) -> DataFrame:
    """Infinite, not-a-number and too large values become null, integers out of range too.

    Texts are cut at ``longest`` characters, as a fixed-width load asks; a caller who loads elsewhere sets it.
    """
    out = []
    for c, t in df.dtypes:
        x = F.col(c)
        if c in bigints:
            x = x.try_cast("bigint")
        elif t in ("double", "float"):
            x = F.when(~F.isnan(x) & (F.abs(x) <= largest), x)
        elif t == "string":
            x = F.substring(x, 1, longest)
        out.append(x.alias(c))
    return df.select(*out)


def sanitized(df: DataFrame, first: int = 1900, last: int = 2100) -> tuple[DataFrame, Observation]:
    """Clean texts, dates within bounds and finite numbers, and what that made null, counted by the pass that writes the result: empty_strings_nulled,
    nan_strings_nulled, invalid_dates_nulled and invalid_numbers_nulled, over all columns."""
    out, counts = [], {"empty_strings": [], "nan_strings": [], "invalid_dates": [], "invalid_numbers": []}
    for c, t in df.dtypes:
        x, made = F.col(f"`{c}`"), F.col(f"`{c}`")
        if t == "string":
            made = text.sanitize(x)
            is_nan = F.lower(F.trim(x)) == "nan"
            counts["nan_strings"].append(is_nan)
            counts["empty_strings"].append(x.isNotNull() & made.isNull() & ~is_nan)
        elif t in ("date", "timestamp", "timestamp_ntz"):
            made = dates.in_bounds(x, first, last)
            counts["invalid_dates"].append(x.isNotNull() & made.isNull())
        elif t in ("double", "float"):
            made = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
            counts["invalid_numbers"].append(x.isNotNull() & made.isNull())
        out.append(made.alias(c))
    marks = [sum((F.coalesce(m, F.lit(False)).cast("int") for m in found), F.lit(0)).alias(f"_{what}") for what, found in counts.items()]
    seen = Observation()
    marked = df.select(*out, *marks).observe(seen, *[F.coalesce(F.sum(f"_{what}"), F.lit(0)).alias(f"{what}_nulled") for what in counts])
    return marked.select(*[F.col(f"`{c}`") for c in df.columns]), seen


def _is_key_name(name: str) -> bool:
    return bool(re.search(r"(key|_id|id)$", name, re.I))


def audit(df: DataFrame, name: str) -> DataFrame:
    """One row a column: nulls, distinct values and the figures that fit its type, from one aggregate and the
    exact distinct counts."""
    aggs, kinds = [F.count("*").alias("_rows")], {}
    for c, t in df.dtypes:
        x = F.col(f"`{c}`")
        numeric, dated = t in ("int", "bigint", "smallint", "double", "float") or t.startswith("decimal"), t in ("date", "timestamp", "timestamp_ntz")
        none = F.lit(None)
        figures = {
            "nulls": F.count_if(x.isNull()),
            "low": F.min(x.cast("double")) if numeric else F.any_value(none.cast("double")), "high": F.max(x.cast("double")) if numeric else F.any_value(none.cast("double")),
            "longest": F.max(F.length(x)).cast("long") if t == "string" else F.any_value(none.cast("long")),
            "negatives": F.count_if(x < 0) if numeric else F.any_value(none.cast("long")),
            "over_int": F.count_if(F.abs(x) > INT_MAX) if t == "bigint" else F.any_value(none.cast("long")),
            "infinite": F.count_if(F.isnan(x) | (F.abs(x) == float("inf"))) if t in ("double", "float") else F.any_value(none.cast("long")),
            "bad_dates": F.count_if(~F.year(x).between(1900, 2100)) if dated else F.any_value(none.cast("long")),
        }
        kinds[c] = t
        aggs.append(F.struct(*[v.alias(k) for k, v in figures.items()]).alias(f"_{len(kinds)}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("kind"), F.col(f"_{i}").alias("f")) for i, (c, t) in enumerate(kinds.items(), 1)])
    tall = wide.select(F.col("_rows").alias("n_rows"), F.explode(rows).alias("r")).select(F.lit(name).alias("table_name"), "n_rows", "r.column_name", "r.kind", "r.f.*")
    tall = tall.join(F.broadcast(statistics.distinct_table(df, df.columns)), "column_name")  # one row a column
    tall = tall.withColumn("null_pct", F.when(F.col("n_rows") > 0, F.round(F.col("nulls") * 100 / F.col("n_rows"), 4)).otherwise(0.0))
    named = F.lower("column_name").rlike("(key|_id|id)$")
    whole = named & (F.col("nulls") == 0)
    return tall.withColumn("key_role", F.when(whole & (F.col("uniques") == F.col("n_rows")), "PK").when(named, "FK"))


#: Types whose least and greatest values Parquet footers tell for sure.
FOOTED = ("tinyint", "smallint", "int", "bigint", "float", "double", "date")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session over the same context whose Parquet reader answers counts and extremes from footers, in the tasks that read them."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def footer_aggregate(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row of the rows, filled cells and extremes of all columns of Parquet files."""
    df = spark.read.parquet(*paths)
    aggs = [F.count("*").alias("rows")]
    for i, (c, t) in enumerate(df.dtypes):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"n{i}"), *([F.min(x).alias(f"low{i}"), F.max(x).alias(f"high{i}")] if t in FOOTED else [])]
    return df.agg(*aggs)


def footer_figures(spark: SparkSession, tables: dict[str, list[str]]) -> DataFrame:
    """(table_name, column_name, kind, n_rows, nulls, low, high, from_footers) of the files of each table, without reading their data: each
    task reads footers and gives one row. Only where footers lack a figure, as for columns with NaN, is the table scanned."""
    own, out = footer_session(spark), []
    number = lambda v: None if v is None or isinstance(v, datetime.date) else float(v)
    for name, paths in tables.items():
        told = True
        try:
            row = footer_aggregate(own, paths).first()
        except Exception as error:  # noqa: BLE001  a store's error comes again below
            if "aggregate" not in str(error).lower() and "statistics" not in str(error).lower() and "No min/max" not in str(error):
                raise
            row, told = footer_aggregate(spark, paths).first(), False
        for i, (c, t) in enumerate(spark.read.parquet(*paths).dtypes):
            ends = [number(row[f"{e}{i}"]) if t in FOOTED else None for e in ("low", "high")]
            out.append((name, c, t, row["rows"], row["rows"] - row[f"n{i}"], *ends, told))
    return spark.createDataFrame(out, "table_name string, column_name string, kind string, n_rows long, nulls long, low double, high double, from_footers boolean")  # one row a column


def issues(audited: DataFrame) -> DataFrame:
    """(table, column, severity, issue) of an audit, one row each."""
    def issue(mark: Column, severity: str, what: str) -> Column:
        return F.when(mark, F.struct(F.lit(severity).alias("severity"), F.lit(what).alias("issue")))

    found = F.array_compact(F.array(
        issue(F.col("null_pct") == 100, "warning", "all null"), issue((F.col("null_pct") > 90) & (F.col("null_pct") < 100), "info", "mostly null"),
        issue(F.col("over_int") > 0, "info", "exceeds int"), issue(F.col("infinite") > 0, "high", "infinite values"),
        issue(F.col("bad_dates") > 0, "high", "dates out of range"), issue(F.col("longest") > 4000, "warning", "long text"),
    ))
    return audited.select("table_name", "column_name", F.explode(found).alias("i")).select("table_name", "column_name", "i.*")


def lake_summary(audited: DataFrame) -> DataFrame:
    bad = issues(audited).groupBy("table_name").agg(*[F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in ("high", "warning", "info")])
    keys = lambda role: F.array_join(F.array_sort(F.collect_list(F.when(F.col("key_role") == role, F.col("column_name")))), ",")
    tables = audited.groupBy("table_name").agg(F.max("n_rows").alias("n_rows"), F.count("*").alias("n_columns"), keys("PK").alias("pks"), keys("FK").alias("fks"))
    return tables.join(bad, "table_name", "left").na.fill(0, ["n_high", "n_warning", "n_info"]).orderBy(F.col("n_rows").desc(), "table_name")


def critical_issues(*found: DataFrame) -> DataFrame:
    """The critical and high ones of all issues, by table and column."""
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.where(F.col("severity").isin("critical", "high")).orderBy("table_name", "column_name", "issue")


#: What a text looks like, tried in this order; whole numbers are numbers too.
SHAPES = {"integer": "^[+-]?[0-9]+$", "number": "^[+-]?([0-9]+[.,][0-9]*|[.,][0-9]+)$", "date": "^([0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{2,4})", "boolean": "^(?i:true|false)$"}


def value_shapes(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, shape, n): how many values of each text column look like what; blanks and nulls left out. One pass; counts
    of several parts of a table add up."""
    columns = [c for c, t in df.dtypes if t == "string"]
    aggs = []
    for i, c in enumerate(columns):
        x = F.trim(F.col(f"`{c}`"))
        shape = F.lit("text")
        for what, pattern in reversed(SHAPES.items()):
            shape = F.when(x.rlike(pattern), what).otherwise(shape)
        shape = F.when(x != "", shape)
        aggs.append(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(what).alias("shape"), F.count_if(shape == what).alias("n")) for what in [*SHAPES, "text"]]).alias(f"_{i}"))
    if not aggs:
        return df.sparkSession.createDataFrame([], "table_name string, column_name string, shape string, n long")
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.flatten(F.array(*[f"_{i}" for i in range(len(columns))]))).alias("r")).select(F.lit(name).alias("table_name"), "r.*").where("n > 0")


def mixed_types(shapes: DataFrame) -> DataFrame:
    """(table_name, column_name, severity, issue, kind, counts) of text columns whose values have several types. Whole numbers
    among numbers are numbers; any other two types have no common one but text."""
    joined = F.when(F.col("shape") == "integer", "number").otherwise(F.col("shape"))
    counts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("shape", "n"))), lambda r: F.concat_ws(":", r["shape"], r["n"].cast("string"))), ",")
    summed = shapes.groupBy("table_name", "column_name", "shape").agg(F.sum("n").alias("n"))
    told = summed.groupBy("table_name", "column_name").agg(F.count_distinct(joined).alias("types"), counts.alias("counts"))
    return told.where("types > 1").select("table_name", "column_name", F.lit("high").alias("severity"), F.lit("mixed types").alias("issue"), F.lit("text").alias("kind"), "counts")


def shared_keys(audited: DataFrame) -> DataFrame:
    return audited.where("key_role is not null").groupBy("column_name").agg(F.count_distinct("table_name").alias("n_tables"))


def relationships(audited: DataFrame) -> DataFrame:
    """Tables that share a key column: the smaller is the dimension; many-to-one where it is the dimension's key."""
    keys = audited.where("key_role is not null").select("table_name", "column_name", "n_rows", "key_role")
    dim, fact = (keys.select("column_name", *[F.col(c).alias(f"{s}_{c}") for c in ("table_name", "n_rows", "key_role")]) for s in ("dim", "fact"))
    both = dim.join(fact, "column_name").where("dim_n_rows < fact_n_rows")
    kind = F.when(F.col("dim_key_role") == "PK", "many-to-one").otherwise("suspected")
    return both.select(F.col("dim_table_name").alias("dimension"), F.col("fact_table_name").alias("fact"), "column_name", kind.alias("kind")).distinct()


def snowflakes(found: DataFrame, facts: list[str]) -> DataFrame:
    """Relationships between two dimensions."""
    return found.where(~F.col("fact").isin(facts))


def flatten(product: DataFrame, *levels: tuple[DataFrame, str]) -> DataFrame:
    """Left joins of a hierarchy, level by level; the keys between levels go. Spark broadcasts small levels by their size."""
    out = product
    for level, key in levels:
        clash = [c for c in level.columns if c != key and c in out.columns]
        out = out.join(level.withColumnsRenamed({c: f"{c}_{key}" for c in clash}), key, "left")
    return out.drop(*[key for _, key in levels])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


class JoinGuardError(ValueError):
    """A join would change, or has changed, the number of rows."""


def guarded_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A left join that stops on a duplicate key of ``right``, before any row is made twice."""
    if not duplicate_keys(right, key).isEmpty():
        raise JoinGuardError(f"{key} isn't unique")
    return left.join(right, key, "left")


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Orphan rows and keys of one foreign key, with their share and the confidence 1 − share."""
    keys = dim.select(F.col(pk).alias("_pk")).where("_pk is not null").distinct()
    per_key = fact.groupBy(fk).agg(F.count("*").alias("n"))
    joined = per_key.join(keys, per_key[fk] == F.col("_pk"), "left")
    lost = F.col(fk).isNotNull() & F.col("_pk").isNull()
    sums = joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"), F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("orphan_rows"), F.count_if(lost).alias("orphan_keys"))
    share = F.when(F.col("fact_rows") > 0, F.col("orphan_rows") / F.col("fact_rows")).otherwise(0.0)
    return sums.select(F.lit(fk).alias("fk"), F.lit(pk).alias("pk"), "*", F.round(share, 6).alias("orphan_ratio"), F.round(1 - share, 6).alias("confidence"))


def infer_pk(table: str, columns: list[str]) -> str | None:
    """``<table>key`` by any spelling, else the only column that ends so."""
    plain = {re.sub("[^a-z0-9]", "", c.lower()): c for c in columns}
    bare = re.sub("^(dim|fact)", "", table.lower())
    keys = [c for p, c in plain.items() if p.endswith("key")]
    return plain.get(f"{bare}key") or next((c for p, c in plain.items() if p.endswith(f"{bare}key")), None) or (keys[0] if len(keys) == 1 else None)


#: Columns that one number tells apart.
MASK = 62


def _comparable(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "string", "date")]


def value_index(tables: dict[str, DataFrame]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """An inverted index: each value of all whole-number, text and date columns, with masks of the columns that hold it, and these columns.

    Every table is read once. Values are combined in masks before their one shuffle, so a hot value
    crosses it once a task, and a value's row is as wide as the number of columns asks, whatever holds it.
    """
    columns = [(t, c) for t, df in tables.items() for c in _comparable(df)]
    words, out = -(-len(columns) // MASK), None
    for t, df in tables.items():
        own = [i for i, (name, _) in enumerate(columns) if name == t]
        if own:
            cells = F.explode(statistics.cells(df, [columns[i][1] for i in own]))
            one = df.select(cells.alias("r")).where("r.v is not null").select("r.v", (F.col("r.c") + own[0]).alias("c"))  # a table's columns follow each other
            out = one if out is None else out.unionByName(one)
    bit = lambda k: F.expr(f"CASE WHEN c BETWEEN {k * MASK} AND {(k + 1) * MASK - 1} THEN shiftleft(1L, c - {k * MASK}) ELSE 0L END")
    return out.groupBy("v").agg(*[F.bit_or(bit(k)).alias(f"m{k}") for k in range(words)]), columns


def inclusions(tables: dict[str, DataFrame], least: float = 1.0) -> DataFrame:
    """(fact, fk, dim, pk, n_values, confidence): columns whose values a key column of another table holds, as told by the values themselves.

    A key column has a value in each row and none twice. The confidence is the share of the column's distinct values
    that the key holds; columns without values are left out. Values of different types are equal if they are written alike.
    """
    index, columns = value_index(tables)
    masks = [c for c in index.columns if c != "v"]
    # Few sets of columns occur; what follows works on one row a set.
    sets = index.groupBy(*masks).agg(F.count("*").alias("n"))
    has = F.array(*[F.getbit(F.col(f"m{i // MASK}"), F.lit(i % MASK)) == 1 for i in range(len(columns))])
    held = sets.select("n", F.filter(F.transform(has, lambda x, i: F.when(x, i)), lambda i: i.isNotNull()).alias("held"))
    both = held.select("n", F.explode("held").alias("a"), "held").select("n", "a", F.explode("held").alias("b")).groupBy("a", "b").agg(F.sum("n").alias("n"))
    spark = index.sparkSession
    counts = None
    for t, df in tables.items():
        if own := [i for i, (name, _) in enumerate(columns) if name == t]:
            wide = df.agg(F.count("*").alias("rows"), *[F.count(F.col(f"`{columns[i][1]}`")).alias(f"_{i}") for i in own])
            one = wide.select("rows", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_{i}").alias("filled")) for i in own])).alias("r")).select("r.i", "rows", "r.filled")
            counts = one if counts is None else counts.unionByName(one)
    single = both.where("a = b").select(F.col("a").alias("i"), F.col("n").alias("uniques"))
    told = single.join(counts, "i").join(spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(columns)], "i int, t string, c string"), "i")
    fact = told.select(F.col("i").alias("a"), F.col("t").alias("fact"), F.col("c").alias("fk"), F.col("uniques").alias("n_values"))
    dim = told.where("uniques = rows").select(F.col("i").alias("b"), F.col("t").alias("dim"), F.col("c").alias("pk"))
    share = F.col("n") / F.col("n_values")
    return both.join(fact, "a").join(dim, "b").where("fact <> dim").select("fact", "fk", "dim", "pk", "n_values", F.round(share, 6).alias("confidence")).where(share >= least)


def inferred_relationships(tables: dict[str, DataFrame], least: float = 0.9) -> DataFrame:
    """Foreign keys that share a dimension's key name (after the table prefix), accepted by the share of rows that
    find their key. Rows of all candidates are counted by value in one shuffle, and all pairs are judged in one aggregate."""
    bare = lambda c: c.split("_", 1)[-1]
    pks = {t: infer_pk(t, df.columns) for t, df in tables.items()}
    pairs = [(t, c, d, pk) for t, df in tables.items() for c in df.columns for d, pk in pks.items() if pk and d != t and bare(c) == bare(pk) and c != pks[t]]
    spark = next(iter(tables.values())).sparkSession
    if not pairs:
        return spark.createDataFrame([], "fact string, dim string, fk string, pk string, confidence double")
    used = list(dict.fromkeys([x for t, c, d, pk in pairs for x in ((t, c), (d, pk))]))
    cells = None
    for t, df in tables.items():
        if own := [c for name, c in used if name == t]:
            which = F.element_at(F.array(*[F.lit(used.index((t, c))) for c in own]), F.col("r.c") + 1)
            one = df.select(F.explode(statistics.cells(df, own)).alias("r")).select("r.v", which.alias("c"))
            cells = one if cells is None else cells.unionByName(one)
    by_value = cells.groupBy("v").agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(len(used))])
    figures = []
    for k, (t, c, d, pk) in enumerate(pairs):
        n, key = F.col(f"n{used.index((t, c))}"), F.col(f"n{used.index((d, pk))}")
        lost = F.coalesce(F.sum(F.when(F.col("v").isNotNull() & (key == 0), n)), F.lit(0)) / F.greatest(F.sum(n), F.lit(1))
        figures.append(F.struct(*[F.lit(x).alias(name) for name, x in (("fact", t), ("dim", d), ("fk", c), ("pk", pk))], F.round(1 - lost, 6).alias("confidence")))
    return by_value.agg(F.array(*figures).alias("r")).select(F.explode("r").alias("r")).select("r.*").where(F.col("confidence") >= least)


def recovered_dim(facts: list[tuple[DataFrame, str]], key: str, labels: list[str], dim: DataFrame | None = None) -> DataFrame:
    """Stub rows for keys that facts use and the dimension lacks."""
    keys = None
    for fact, fk in facts:
        one = fact.select(F.col(fk).alias(key)).where(F.col(key).isNotNull())
        keys = one if keys is None else keys.unionByName(one)
    keys = keys.distinct()
    if dim is not None:
        keys = keys.join(dim.select(key), key, "left_anti")
    return keys.select(key, *[F.lit("Unknown").alias(c) for c in labels], F.lit(True).alias("is_recovered_stub"))


def recovered_checks(df: DataFrame, key: str) -> DataFrame:
    share = lambda c: F.count_if(F.col(c).isNull()) * 2 > F.count("*")
    mostly = F.array_compact(F.array(*[F.when(share(c), F.lit(c)) for c in df.columns if c != key]))
    return df.agg((F.count(key) - F.count_distinct(key)).alias("duplicate_keys"), F.array_join(mostly, ",").alias("mostly_null"))


def unified_type(types: list[str]) -> str:
    """Any float makes a decimal, else any integer a bigint, else any text a string, else the first."""
    if any(t in ("double", "float") or t.startswith("decimal") for t in types):
        return "decimal(38,10)"
    if any(t in ("int", "bigint", "smallint", "tinyint") for t in types):
        return "bigint"
    return "string" if "string" in types else types[0]


def unify(parts: list[DataFrame]) -> DataFrame:
    """Parts of one table under one schema; cells that don't fit become null, missing columns too."""
    types: dict[str, list[str]] = {}
    for p in parts:
        for c, t in p.dtypes:
            types.setdefault(c, []).append(t)
    out = None
    for p in parts:
        cast = p.select(*[F.col(c).try_cast(unified_type(types[c])).alias(c) for c in p.columns])
        out = cast if out is None else out.unionByName(cast, allowMissingColumns=True)
    return out.select(list(types))


def unify_observed(parts: list[DataFrame]) -> tuple[DataFrame, Observation]:
    """``unify``, and the cells of each column that a cast made null, counted by the pass that first reads the result to its end, so by its write."""
    marked = []
    types: dict[str, list[str]] = {}
    for p in parts:
        for c, t in p.dtypes:
            types.setdefault(c, []).append(t)
    for p in parts:
        lost = [(F.col(c).isNotNull() & F.col(c).try_cast(unified_type(types[c])).isNull() if c in p.columns else F.lit(False)).alias(c) for c in types]
        marked.append(p.select(*[F.col(c).try_cast(unified_type(types[c])).alias(c) for c in p.columns], F.struct(*lost).alias("_lost")))
    out = marked[0]
    for m in marked[1:]:
        out = out.unionByName(m, allowMissingColumns=True)
    seen = Observation()
    return out.observe(seen, *[F.count_if(F.col("_lost")[c]).alias(c) for c in types]).select(list(types)), seen


def schema_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(c, t) for c, t in df.dtypes], "column_name string, kind string")


def schema_drift(first: DataFrame, other: DataFrame) -> DataFrame:
    """Columns added, removed or changed against the first file, as an outer join of two schemas."""
    a, b = (schema_table(x).withColumnRenamed("kind", k) for x, k in ((first, "was"), (other, "is")))
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(F.col("was") != F.col("is"), "type changed")
    return a.join(b, "column_name", "full").withColumn("change", change).where("change is not null")


def schema_drift_cells(first: DataFrame, other: DataFrame) -> DataFrame:
    """``schema_drift`` with the filled cells of each column in either file, null where it has none."""
    count = lambda df, name: df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias(name)) for c in df.columns])).alias("r")).select("r.*")
    found = schema_drift(first, other)
    return found.join(count(first, "cells_was"), "column_name", "left").join(count(other, "cells_is"), "column_name", "left")


def file_schemas(spark: SparkSession, path: str, at_once: int = 16) -> DataFrame:
    """(file, column_name, kind) of each Parquet file of a table. Footers are read by tasks, some files at once; the driver sees schemas only."""
    files = [r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path).select("path").collect()]
    with ThreadPoolExecutor(at_once) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(f).dtypes, files))
    rows = [(f, c, t) for f, columns in zip(files, schemas) for c, t in columns]
    return spark.createDataFrame(rows, "file string, column_name string, kind string")


def schema_drift_files(schemas: DataFrame) -> DataFrame:
    """(file, column_name, was, is, change): what each file adds, lacks or types otherwise against the first one by name."""
    first = schemas.agg(F.min("file").alias("_first"))
    whole = schemas.crossJoin(F.broadcast(first))  # one row
    was = whole.where("file = _first").select("column_name", F.col("kind").alias("was"))
    files = schemas.select("file").distinct()
    wanted = files.crossJoin(F.broadcast(was))  # as many rows as the first file has columns
    both = wanted.join(schemas.withColumnRenamed("kind", "is"), ["file", "column_name"], "full")
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(F.col("was") != F.col("is"), "type changed")
    return both.withColumn("change", change).where("change is not null")


def pascal_keys(columns: list[str]) -> dict[str, str]:
    """product_key, Datekey → ProductKey, DateKey."""
    return {c: "".join(w.capitalize() for w in re.sub("(?i)_?key$", "", c).split("_")) + "Key" for c in columns if re.search("key$", c, re.I)}


def catalogue(tables: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    """Tables that have rows, the largest first."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out.where("n_rows > 0").orderBy(F.col("n_rows").desc(), "table_name")
