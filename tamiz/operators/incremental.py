"""A quality report that grows batch by batch.

Each batch leaves a small state: counts, distinct sketches (HyperLogLog), quantile sketches (KLL), counts by flag and by score. States add
up, so the report of all batches is merged from their states, without reading a row again. Counts, nulls, flags and scores are
exact; distinct values and quantiles are within the sketches' bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.operators import statistics
from tamiz.sources.files import exists

#: HyperLogLog registers are 2 to this power: a standard error of 0.81 %.
LG_CONFIG = 14
#: KLL's size: ranks are off by less than 0.7 % with a confidence of 99 %.
KLL_SIZE = 400
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
STATE = "batch string, table_name string, column_name string, kind string, n_rows long, nulls long, sketch binary, quantiles binary, least double, most double, total double"
COUNTS = "batch string, table_name string, what string, value string, n long"


class Report:
    """The states of all batches, in a folder. A batch that is added again overwrites itself."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def add(self, table: str, batch: str, df: DataFrame, flags: str = "data_quality_flags", score: str = "quality_score") -> None:
        """The state of one batch: one pass over its columns, one over its flags and scores."""
        aggs = []
        for i, (c, t) in enumerate(df.dtypes):
            x = F.col(f"`{c}`")
            number = F.when(~F.isnan(x.cast("double")), x.cast("double")) if t in NUMERIC else F.lit(None).cast("double")
            aggs.append(F.struct(
                F.count_if(x.isNull()).alias("nulls"), F.hll_sketch_agg(statistics.told_apart(c, t), LG_CONFIG).alias("sketch"),
                (F.kll_sketch_agg_double(number, KLL_SIZE) if t in NUMERIC else F.any_value(F.lit(None).cast("binary"))).alias("quantiles"),
                F.min(number).alias("least"), F.max(number).alias("most"), F.sum(number).alias("total")).alias(f"_{i}"))
        wide = df.agg(F.count("*").alias("n_rows"), *aggs)
        each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("kind"), F.col(f"_{i}").alias("f")) for i, (c, t) in enumerate(df.dtypes)])
        state = wide.select("n_rows", F.explode(each).alias("r")).select("r.column_name", "r.kind", "n_rows", "r.f.*")
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/state/table_name={table}/batch={batch}")
        marks = []
        if flags in df.columns:
            tags = F.col(flags) if dict(df.dtypes)[flags].startswith("array") else F.filter(F.split(flags, r"[|;]"), lambda t: F.trim(t) != "")
            marks.append(F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.struct(F.lit("flag").alias("what"), F.trim(t).alias("value"))))
        if score in df.columns:
            marks.append(F.array(F.struct(F.lit("score").alias("what"), F.col(score).cast("string").alias("value"))))
        counts = df.select(F.explode(F.concat(*marks)).alias("m")).where("m.value is not null").groupBy("m.what", "m.value").agg(F.count("*").alias("n")) if marks else self.spark.createDataFrame([], "what string, value string, n long")
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/counts/table_name={table}/batch={batch}")

    def _read(self, what: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{what}") if exists(self.spark, f"{self.root}/{what}") else self.spark.createDataFrame([], schema)

    def columns(self) -> DataFrame:
        """By table and column: rows, nulls and their share, distinct values by the merged sketches, least, most, total, and quartiles of numbers.
        A column that some batches lack counts as null in their rows."""
        state = self._read("state", STATE)
        rows = state.groupBy("table_name", "batch").agg(F.max("n_rows").alias("n")).groupBy(F.col("table_name").alias("_t")).agg(F.sum("n").alias("n_rows"))
        merged = state.groupBy("table_name", "column_name").agg(
            F.sum("n_rows").alias("_seen"), F.sum("nulls").alias("_nulls"), F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("uniques"),
            F.kll_merge_agg_double("quantiles").alias("_q"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("total").alias("total"))
        out = merged.join(F.broadcast(rows), F.col("table_name") == F.col("_t"))  # one row a table
        nulls = F.col("n_rows") - F.col("_seen") + F.col("_nulls")
        has = F.coalesce(F.col("least").isNotNull(), F.lit(False))
        at = [F.when(has, F.kll_sketch_get_quantile_double("_q", F.lit(p))).alias(f"p{round(100 * p)}") for p in (0.25, 0.5, 0.75)]
        return out.select("table_name", "column_name", "n_rows", nulls.alias("nulls"), F.when(F.col("n_rows") > 0, F.round(nulls / F.col("n_rows"), 6)).otherwise(0.0).alias("null_ratio"), "uniques", "least", "most", "total", *at)

    def flags(self) -> DataFrame:
        return self._read("counts", COUNTS).where("what = 'flag'").groupBy("table_name", F.col("value").alias("flag")).agg(F.sum("n").alias("n"))

    def scores(self, least: int = 50) -> DataFrame:
        """Scores are whole numbers from 0 to 100, so their counts hold all of the distribution: its figures are exact."""
        counts = self._read("counts", COUNTS).where("what = 'score'").groupBy("table_name", F.col("value").cast("int").alias("x")).agg(F.sum("n").alias("n"))
        at = lambda p: F.percentile(F.col("x"), p, F.col("n")).cast("double")
        return counts.groupBy("table_name").agg(
            F.min("x").cast("double").alias("low"), at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"), at(0.95).alias("p95"), F.max("x").cast("double").alias("high"),
            F.round(F.sum(F.col("x") * F.col("n")) / F.sum("n"), 6).alias("mean"), F.round(F.coalesce(F.sum(F.when(F.col("x") < least, F.col("n"))), F.lit(0)) / F.sum("n"), 6).alias("share_below"))
