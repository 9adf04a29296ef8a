"""Helpers shared by the corpus operators: word splitting, shared tables, distributed ranks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tamiz.operators.stage import shared_home as shared_dir

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast only after its rows were counted and are at most this many.
BROADCAST_ROWS = 100_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again. It cuts the lineage, survives lost
    executors, and lets the planner see the table's true size. The write's shuffle files go when it ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tamiz-tables/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``BROADCAST_ROWS`` rows of fixed width. A table with
    texts or arrays is left as it is: Spark then goes by the size of its stored files."""
    fixed = all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) for f in df.schema.fields)
    return F.broadcast(df) if fixed and rows <= BROADCAST_ROWS else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked for a sort-merge join: a side that grows with the data meets the other by a shuffle at
    every size, and Spark can split what one key has too much of."""
    return df.hint("merge")


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the 0-based place of each row in a total order, without one task that sees all rows:
    rows are range-partitioned and stored, and each partition starts at the number of rows before it."""
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    held = stored(ranged)
    counts = held.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)).cast("long")
    return (
        held.withColumn("_within", within)
        .join(F.broadcast(before.select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))), "_part")
        .withColumn(name, F.col("_within") - 1 + F.col("_before"))
        .drop("_part", "_within", "_before")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


DOCUMENT_COLUMNS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])
