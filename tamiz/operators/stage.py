"""Intermediate tables that several consumers read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_home(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, a local session (tests) gets a
    temporary one, and a cluster an error, as its executors could not see each other's files."""
    context = spark.sparkContext
    if not (home := spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tamiz-"))
        home = context.getCheckpointDir()
    return home.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the folder that driver and executors share, and read again.

    The lineage ends there, so a lost executor costs no more than the tasks it ran. The tables belong
    to the run and go with the checkpoint folder, which is a temporary one only where none is set.
    """
    spark = df.sparkSession
    path = f"{shared_home(spark)}/tamiz-stages/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
