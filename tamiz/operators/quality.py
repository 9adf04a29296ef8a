"""Quality report: nulls, distinct values, flags, scores and totals, each table in one pass."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.operators import statistics

#: Above this many distinct values a column is high-cardinality and counted no further.
DISTINCT_CAP = 50_000
# Type changes that only widen.
WIDENINGS = {("int", "bigint"), ("int", "double"), ("bigint", "double"), ("float", "double"), ("date", "timestamp")}


def _tall(df: DataFrame, figures) -> DataFrame:
    """One row a column from one aggregate; ``figures(column)`` names the aggregates."""
    aggs = [F.struct(*[v.alias(k) for k, v in figures(F.col(f"`{c}`")).items()]).alias(f"_{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(F.count("*").alias("n_rows"), *aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("kind"), F.col(f"_{i}").alias("f")) for i, (c, t) in enumerate(df.dtypes)])
    return wide.select("n_rows", F.explode(rows).alias("r")).select("n_rows", "r.column_name", "r.kind", "r.f.*")


def detect_schema(df: DataFrame) -> DataFrame:
    out = _tall(df, lambda x: {"nulls": F.count_if(x.isNull())}).join(F.broadcast(statistics.distinct_table(df, df.columns)), "column_name")  # one row a column
    ratio = lambda a: F.when(F.col("n_rows") > 0, F.round(a / F.col("n_rows"), 6)).otherwise(0.0)
    key = (F.col("uniques") == F.col("n_rows")) & (F.col("nulls") == 0)
    return out.select("column_name", "kind", ratio(F.col("nulls")).alias("null_ratio"), ratio(F.col("uniques")).alias("unique_ratio"), key.alias("candidate_key"))


def null_profile(df: DataFrame) -> DataFrame:
    out = _tall(df, lambda x: {"nulls": F.count_if(x.isNull())})
    ratio = F.when(F.col("n_rows") > 0, F.round(F.col("nulls") / F.col("n_rows"), 6)).otherwise(0.0)
    return out.select("column_name", "nulls", (F.col("n_rows") - F.col("nulls")).alias("non_null"), ratio.alias("null_ratio"))


def capped_distinct(df: DataFrame, cap: int = DISTINCT_CAP) -> DataFrame:
    """Distinct values, exact up to ``cap``. A sketch first tells the columns that are far above, which
    the exact count then leaves out."""
    sketch = dict(zip(df.columns, df.agg(*statistics.sketches(df.columns)).first()))
    exact = statistics.distinct_counts(df, [c for c in df.columns if sketch[c] <= 1.2 * cap])
    rows = [(c, str(exact[c]) if exact.get(c, cap + 1) <= cap else f">{cap}", exact.get(c, cap + 1) > cap) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, uniques string, high_cardinality boolean")


def flag_breakdown(df: DataFrame, flags: str = "data_quality_flags") -> DataFrame:
    """Rows by tag; tags in an array or in text such as ``a|b``."""
    tags = F.col(flags) if dict(df.dtypes)[flags].startswith("array") else F.filter(F.split(flags, r"[|;]"), lambda t: t != "")
    return df.select(F.explode(tags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def score_distribution(df: DataFrame, score: str = "quality_score", least: int = 50) -> DataFrame:
    """Scores are whole numbers from 0 to 100, so a percentile's buffer holds as many values at most."""
    x = F.col(score)
    at = lambda p: F.percentile(x, p).cast("double")
    return df.agg(
        F.min(x).cast("double").alias("low"), at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"), at(0.95).alias("p95"), F.max(x).cast("double").alias("high"),
        F.round(F.avg(x), 6).alias("mean"), F.round(F.count_if(x < least) / F.count(x), 6).alias("share_below"),
    )


def totals(tables: dict[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Extracted, cleaned and quarantined rows by table, and their sum under the name ``total``."""
    out = None
    for name, frames in tables.items():
        for what, df in zip(("extracted", "cleaned", "quarantined"), frames):
            one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit(what).alias("what"), "n")
            out = one if out is None else out.unionByName(one)
    wide = out.rollup("table_name").agg(*[F.coalesce(F.sum(F.when(F.col("what") == w, F.col("n"))), F.lit(0)).alias(w) for w in ("extracted", "cleaned", "quarantined")])
    ratio = F.when(F.col("extracted") > 0, F.round(F.col("quarantined") / F.col("extracted"), 6)).otherwise(0.0)
    return wide.select(F.coalesce("table_name", F.lit("total")).alias("table_name"), "extracted", "cleaned", "quarantined", ratio.alias("ratio"))


def fingerprint(df: DataFrame) -> str:
    """16 hex characters over the sorted (column, type) pairs."""
    return hashlib.sha256(json.dumps(sorted(df.dtypes)).encode()).hexdigest()[:16]


def drift_cells(frozen: DataFrame, current: DataFrame) -> DataFrame:
    """``drift`` with ``cells``: how many filled cells a change concerns, of the frozen table where the column
    is missing now, else of the current one."""
    filled = lambda df, gone: null_profile(df).select("column_name", F.col("non_null").alias("cells"), F.lit(gone).alias("gone"))
    both = filled(frozen, True).unionByName(filled(current, False))
    found = drift(frozen, current).withColumn("gone", F.col("change") == "missing")
    return found.join(both, ["column_name", "gone"]).drop("gone")


def freeze(df: DataFrame) -> str:
    return df.schema.json()


def drift(frozen: DataFrame, current: DataFrame) -> DataFrame:
    """(column, change, severity): added warns, missing is fatal, a type that widens warns, another is fatal."""
    spark = frozen.sparkSession
    table = lambda df, kind: spark.createDataFrame(df.dtypes, f"column_name string, {kind} string")
    widens = F.concat_ws(">", "was", "is").isin([">".join(w) for w in WIDENINGS])
    both = table(frozen, "was").join(table(current, "is"), "column_name", "full").where("was is null or is is null or was <> is")
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "missing").when(widens, "widened").otherwise("incompatible")
    return both.select("column_name", change.alias("change"), F.when(change.isin("added", "widened"), "warn").otherwise("fatal").alias("severity"))
