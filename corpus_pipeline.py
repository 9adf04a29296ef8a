"""A training corpus from raw documents: toxicity, line dedup, near-duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet
and read again as the next stage's docs. All stages take null texts, sources and doc_ids, texts of any
length, repeated rows and empty tables, and leave out columns beyond those of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import documents, shared_dir
from tamiz.llm.linededup import deduplicated
from tamiz.llm.minhash import near_duplicates
from tamiz.llm.mixing import mixed_documents
from tamiz.llm.packing import packed, tokenizer_path
from tamiz.llm.toxicity import scored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. A null text scores as an empty one; a row without doc_id is scored too; repeated rows go or stay together."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(docs.select(COLUMNS), labels).where("predicted = 0").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines seen before in the corpus go; n_chars follows the text that is left. A null text stays null; no document goes, though its text may end up empty."""
    kept = deduplicated(docs.select(COLUMNS))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id. Documents without words, or without doc_id, stay; rows that repeat a doc_id go or stay together."""
    docs = docs.select(COLUMNS)
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs.doc_id == F.col("_gone"), "left_anti")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, as the weights 1, 2, 3 of their sources ask. A null source is one of its own; documents without words are left out, as they have no mass."""
    return mixed_documents(docs.select(COLUMNS), [1, 2, 3])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their place in a sequence; each repetition is packed. A null text is its end token alone."""
    return packed(docs.select(COLUMNS), tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: The stages are learned, sketched and drawn at random, which SQL doesn't express; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/tamiz-pipeline/{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
