"""Streams: the stateless operators over arriving files, and quality figures by hour."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tamiz.operators import semantic
from tamiz.operators.stage import staged


def clean_stream(spark: SparkSession, source: str, schema: T.StructType, clean: Callable[[DataFrame], DataFrame], split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], out: str, checkpoint: str) -> None:
    """Cleans what has arrived and writes valid and quarantined rows. A batch is written under its id, so
    one that runs twice after a failure overwrites itself."""
    def write(batch: DataFrame, epoch: int) -> None:
        kept, rejected = split(staged(clean(batch)))  # cleaned once for both
        kept.write.mode("overwrite").parquet(f"{out}/valid/epoch={epoch}")
        rejected.write.mode("overwrite").parquet(f"{out}/quarantine/epoch={epoch}")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def hourly_quality(stream: DataFrame, time: str, columns: list[str], late: str = "10 minutes") -> DataFrame:
    """Rows and nulls by hour of event time; rows later than ``late`` are left out."""
    seen = stream.withWatermark(time, late).groupBy(F.window(time, "1 hour").alias("w"))
    figures = seen.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])
    return figures.select(F.col("w.start").alias("hour"), "n", *[f"nulls_{c}" for c in columns])


def hourly_flags(stream: DataFrame, time: str, columns: list[str], flags: str, score: str, late: str = "10 minutes") -> DataFrame:
    """Rows, nulls, and sum and number of scores, by hour of event time: of all rows under a null flag, and of the rows with
    each flag; a flag that a row has twice counts twice, as in the batch report.

    Each row is counted once for its hour and once a flag within one stateful aggregate, which combines before its
    shuffle. Its state holds the open hours times the flags seen in them.
    """
    tags = F.coalesce(F.col(flags), F.array().cast("array<string>"))
    each = F.explode(F.concat(F.array(F.lit(None).cast("string")), tags))
    rows = stream.withWatermark(time, late).select(time, *columns, F.col(score).alias("_score"), each.alias("flag"))
    figures = rows.groupBy(F.window(time, "1 hour").alias("w"), "flag").agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns], F.sum("_score").alias("score_sum"), F.count("_score").alias("scored"))
    return figures.select(F.col("w.start").alias("hour"), "flag", "n", *[f"nulls_{c}" for c in columns], "score_sum", "scored")


def enrich_stream(spark: SparkSession, source: str, schema: T.StructType, anchors: semantic.Anchors, out: str, checkpoint: str) -> None:
    """Rows enriched as they arrive, under statistics that a batch run learned and saved. The anchors are the static side of the join."""
    enriched = semantic.enrich(spark.readStream.schema(schema).parquet(source), anchors)
    enriched.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def write_hourly(figures: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes the hours that each batch changed, under the batch's id. The watermark lets old hours leave the
    state, which therefore holds only the hours that may still change."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    started = figures.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
    return started


def read_hourly(spark: SparkSession, out: str, keys: list[str] = ()) -> DataFrame:
    """The latest figures of each hour, and of each of ``keys`` in it."""
    rows = spark.read.parquet(out)
    others = [c for c in rows.columns if c not in ("hour", "epoch", *keys)]
    return rows.groupBy("hour", *keys).agg(F.max_by(F.struct(*others), "epoch").alias("r")).select("hour", *keys, "r.*")
