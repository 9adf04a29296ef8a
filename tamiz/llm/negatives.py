"""Hard negatives by a secondary sort.

An anchor's positives are its best rows of the same label; its hard negatives are rows of other labels
whose score lies in a window below a positive's. Pairs travel under one packed key (anchor, descending
score, other label, id), which repartitionAndSortWithinPartitions deals by anchor and sorts, so a stream over
a partition meets an anchor's positives first, opens a window at each, and emits the negatives that fall
into open windows. It keeps POSITIVES counters, whatever an anchor's number of pairs.

So that not all pairs are shuffled, each block of rows sends only what can be in the result: its own best
rows of the anchor's label, and the first NEGATIVES rows of each window. For that the positives' scores are
found first, in the same blocks, by a top-k that combines before its shuffle.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.llm.blocks import arrays, block_pairs
from tamiz.llm.common import stored

POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score that a hard negative has at least and at most.
LEAST_PERCENT, MOST_PERCENT = 30, 90
#: Rows of a block of anchors, and of the block of rows that it meets.
ANCHORS, ROWS = 1024, 2048
#: Scores beyond it count as it, so that percents of them are 64-bit integers.
LIMIT = (2**63 - 1) // 100
_KEY = struct.Struct(">QQBQ")
#: Added to a signed 64-bit integer, it leaves an unsigned one of the same order.
_SIGN = 2**63


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer matrices."""
    out = np.zeros((len(x), len(y)), np.int64)
    if not out.size or not x.shape[1]:
        return out
    most = 2.0**26 / np.sqrt(x.shape[1])  # products of such components sum up exactly in doubles
    small_x, small_y = (np.abs(m.astype(np.float64)).max(axis=1) <= most for m in (x, y))
    out[np.ix_(small_x, small_y)] = x[small_x].astype(np.float64) @ y[small_y].astype(np.float64).T
    for few, many, large, put in ((x, y, ~small_x, lambda i, v: out.__setitem__(i, v)), (y, x, ~small_y, lambda i, v: out.__setitem__((slice(None), i), v))):
        for i in np.flatnonzero(large):
            product = many.astype(object) @ few[i].astype(object)
            put(i, np.array([min(max(p, -LIMIT), LIMIT) for p in product], np.int64))
    return out


def scores(left: pa.ChunkedArray, right: pa.ChunkedArray) -> np.ndarray:
    """Inner products of two columns of integer lists; a shorter list goes on with zeros."""
    sides = []
    for column in (left, right):
        flat, lengths = arrays(column, np.int64)
        start = np.cumsum(lengths) - lengths
        sides.append([(int(d), np.flatnonzero(lengths == d), flat[(start[lengths == d][:, None] + np.arange(d)).astype(np.int64)]) for d in np.unique(lengths)])
    out = np.zeros((len(left), len(right)), np.int64)
    for d, i, x in sides[0]:
        for e, j, y in sides[1]:
            out[np.ix_(i, j)] = _exact(x[:, : min(d, e)], y[:, : min(d, e)])
    return out


def _of_block(anchors: pa.Table, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of a block; where a row has the anchor's label, the anchor itself left out; where it has another."""
    label, other = anchors["label"].to_numpy(), rows["label"].to_numpy()
    same = label[:, None] == other[None, :]
    itself = anchors["row"].to_numpy()[:, None] == rows["row"].to_numpy()[None, :]
    return scores(anchors["q"], rows["q"]), same & ~itself, ~same


def _best_scores(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    found, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(anchors) and len(rows):
        s, same, _ = _of_block(anchors, rows)
        for row, values, mask in zip(anchors["row"].to_numpy(), s, same):
            values = values[mask]
            best = np.partition(values, len(values) - POSITIVES)[-POSITIVES:] if len(values) > POSITIVES else values
            found.append(np.full(len(best), row))
            score.append(best)
    return pa.table({"row": np.concatenate(found), "score": np.concatenate(score)})


def _first(where: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``where``, the k of highest score, ties by smaller id."""
    if len(where) > k:
        least = np.partition(score[where], len(where) - k)[-k]
        where = where[score[where] >= least]
        where = where[np.lexsort((ids[where], -score[where]))[:k]]
    return where


def packed(anchor: int, score: int, negative: bool, vec_id: int) -> bytes:
    """A key whose bytes sort by anchor, descending score, rows of the anchor's label before others, and id."""
    return _KEY.pack(anchor, _SIGN - score, negative, vec_id + _SIGN)


def _candidates(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """The pairs of a block that may be in the result, packed."""
    keys: list[bytes] = []
    owners: list[int] = []
    if len(anchors) and len(rows):
        s, same, other = _of_block(anchors, rows)
        ids = rows["vec_id"].to_numpy()
        for k, (row, anchor_id, positives) in enumerate(zip(anchors["row"].to_pylist(), anchors["vec_id"].to_pylist(), anchors["positives"].to_pylist())):
            score = s[k]
            mine = _first(np.flatnonzero(same[k] & (score >= min(positives))), score, ids, POSITIVES)
            theirs = [np.zeros(0, np.int64)]
            for p in {p for p in positives if p >= 0}:
                low, high = -((-LEAST_PERCENT * p) // 100), (MOST_PERCENT * p) // 100
                theirs.append(_first(np.flatnonzero(other[k] & (score >= low) & (score <= high)), score, ids, NEGATIVES))
            for negative, places in ((False, mine), (True, np.unique(np.concatenate(theirs)))):
                keys += [packed(row, int(score[i]), negative, int(ids[i])) for i in places]
                owners += [anchor_id] * len(places)
    return pa.table({"key": pa.array(keys, pa.binary()), "anchor_id": pa.array(owners, pa.int64())})


def mined(pairs: Iterable[tuple[bytes, int]]) -> Iterator[tuple]:
    """Result rows of a sorted stream of (packed key, anchor_id)."""
    anchor, windows = None, []
    for key, anchor_id in pairs:
        row, descending, negative, vec_id = _KEY.unpack(key)
        score, vec_id = _SIGN - descending, vec_id - _SIGN
        if row != anchor:
            anchor, windows = row, []
        if not negative:
            if len(windows) < POSITIVES:
                windows.append([vec_id, score, 0])
            continue
        for window in windows:
            positive_id, positive, n = window
            if n < NEGATIVES and LEAST_PERCENT * positive <= 100 * score <= MOST_PERCENT * positive:
                window[2] = n + 1
                yield anchor_id, positive_id, n + 1, vec_id, positive, score


def usable(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, q) of the rows that take part, with whole-numbered components."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.where("vec_id is not null and label is not null and embedding is not null").where(~bad)
    q = F.transform(numbers, lambda x: F.floor(x * 256).cast("long"))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), q.alias("q"))


def hard_negatives(vectors: DataFrame, every: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); anchors are rows whose vec_id is divisible by ``every``.

    Rows without vec_id, label or vector, or with a null or non-finite component, take no part. A vector
    shorter than the other goes on with zeros, so an empty one scores 0. Repeated rows are rows of their own:
    each repeats as an anchor, and is a positive of its repetition. Scores beyond LIMIT count as it. An empty
    table, or one without anchors, gives an empty result; further columns are ignored.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors))
    anchors = rows.where(F.col("vec_id") % every == 0)
    counts = anchors.count(), rows.count()
    best = block_pairs(anchors, rows, (ANCHORS, ROWS), counts, _best_scores, "row long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc())
    best = best.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= POSITIVES)
    positives = stored(best.groupBy(F.col("row").alias("_row")).agg(F.collect_list("score").alias("positives")))  # POSITIVES values at most
    wanted = stored(anchors.join(positives, F.col("row") == F.col("_row")).drop("_row"))
    found = block_pairs(wanted, rows, (ANCHORS, ROWS), counts, _candidates, "key binary, anchor_id long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = found.rdd.map(lambda r: (bytes(r[0]), r[1])).repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8])).mapPartitions(mined)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame(stream, schema, verifySchema=False)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op11_hard_negatives": op11_hard_negatives}

ORACLES = {
    "op11_hard_negatives": r"""
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_sum(list_transform(list_zip(a.q, r.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM good a JOIN good r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
""",
}
