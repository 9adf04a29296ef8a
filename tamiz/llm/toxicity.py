"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import bytesnp as B
from tamiz.llm.common import documents, stored

#: Hashed features; the weights sent to executors are at most this many, most of them absent.
DIMENSIONS = 1 << 20
#: The classifier is fitted on at most this many labelled documents, chosen by the hash of doc_id.
MOST_LABELLED = 20_000
#: Rows that one model is fitted on; larger samples are fitted in shards whose weights are averaged.
SHARD_ROWS = 4_000
#: Bytes of features, 4 each, that one model is fitted on or so; a sample of long texts is dealt to more shards.
SHARD_BYTES = 256 * 2**20
EPOCHS = 6
ALPHA, BETA, L2 = 1.0, 1.0, 0.1
#: L1 follows the positive rows of a shard, within these bounds: a feature of few rows gets no weight.
LEAST_L1, MOST_L1, POSITIVES_PER_L1 = 2.0, 10.0, 20
FOLDS = 5


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def features(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs of unigrams, bigrams and skip-grams over one and two words; feature 0 is the bias's."""
    hashes, _, _, bounds = B.hashed_words(raw, at, lower=True, separators=B.NOT_ALNUM)
    of = np.repeat(np.arange(len(at) - 1), np.diff(bounds))
    docs, found = [of], [B.mix(hashes)]
    for gap in (1, 2, 3):
        if len(hashes) > gap:
            same = of[gap:] == of[:-gap]
            pair = B.mix(hashes[:-gap] * B.U(0x9E3779B97F4A7C15) + hashes[gap:] + B.U(gap))
            docs.append(of[gap:][same])
            found.append(pair[same])
    return np.concatenate(docs), (np.concatenate(found) % B.U(DIMENSIONS - 1)).astype(np.int64) + 1


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = B.texts(batch.column("text"))
        out = []
        for i, j in B.groups(at):
            doc, feature = features(raw, at[i : j + 1])
            keys = np.unique(doc * DIMENSIONS + feature)
            cuts = np.searchsorted(keys, np.arange(1, j - i) * DIMENSIONS)
            out += [(x % DIMENSIONS).astype("<i4").tobytes() for x in np.split(keys, cuts)]
        yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("toxic"), pa.array(out, pa.binary())], ["place", "toxic", "features"])


def _ftrl(frame: pd.DataFrame) -> pd.DataFrame:
    """Weights of one shard after EPOCHS passes, rows in the order of their hash."""
    frame = frame.sort_values("place", kind="stable")
    rows = [(np.append(0, np.frombuffer(f, "<i4")).astype(np.int64), float(y)) for f, y in zip(frame["features"], frame["toxic"])]
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    l1 = min(MOST_L1, max(LEAST_L1, sum(y for _, y in rows) / POSITIVES_PER_L1))

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i, y in rows:
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / ALPHA * w
    all_weights = weights(np.arange(DIMENSIONS))
    kept = np.flatnonzero(all_weights)
    return pd.DataFrame({"feature": kept, "weight": all_weights[kept]})


def fitted(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features with weight and their weights, the mean over the shards' models.

    Held-out rows, null labels and null doc_ids are never used; a doc_id with several labels takes
    the largest. Without labelled rows only the bias is there, and every score is near 0.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    place = F.xxhash64("doc_id")
    sample = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(place, "doc_id").limit(MOST_LABELLED)
    sample = stored(sample.withColumn("place", place)).withColumnRenamed("doc_id", "_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))  # at most MOST_LABELLED rows
    drawn = stored(rows.select("text", "toxic", "place").mapInArrow(_feature_rows, "place long, toxic int, features binary"))
    told = drawn.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("features")), F.lit(0)).alias("bytes")).first()
    shards = max(1, told["rows"] // SHARD_ROWS, -(-told["bytes"] // SHARD_BYTES))
    drawn = drawn.withColumn("shard", F.pmod(F.col("place"), F.lit(shards)).cast("int"))
    # Dealt by range, so that no two shards meet in one task.
    models = drawn.repartitionByRange(shards, "shard").groupBy("shard").applyInPandas(_ftrl, "feature long, weight double")
    mean = models.groupBy("feature").agg((F.sum("weight") / shards).alias("weight")).toPandas().sort_values("feature")
    if mean.empty:
        return np.zeros(1, np.int64), np.full(1, -20.0)
    return mean["feature"].to_numpy(np.int64), mean["weight"].to_numpy(float)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``.

    A null or empty text scores the bias; a null doc_id counts as not held out; repeated rows are
    scored each; an empty table gives an empty result; columns that have the result's names are replaced.
    """
    indices, values = fitted(docs, labels)
    model = docs.sparkSession.sparkContext.broadcast((indices, values))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, given = model.value
        dense = np.zeros(DIMENSIONS, np.float32)
        dense[kept] = given
        for batch in batches:
            raw, at = B.texts(batch.column("text"))
            total = np.full(len(batch), float(dense[0]))
            for i, j in B.groups(at):
                doc, feature = features(raw, at[i : j + 1])
                hit = dense[feature] != 0
                keys = np.unique(doc[hit] * DIMENSIONS + feature[hit])
                total[i:j] += np.bincount(keys // DIMENSIONS, dense[keys % DIMENSIONS], j - i)
            scores = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names), pa.array(scores)], [*batch.schema.names, "score"])

    docs = docs.drop("score", "held_out", "predicted")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = docs.mapInArrow(score, f"{fields}, score double")
    return out.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op4_ftrl_toxicity": op4_ftrl_toxicity}
ORACLES: dict[str, str] = {}
