"""Mixing sources to target weights by pivotal dependent rounding.

Every document has an expected number of copies: its source's target over its source's size. The
whole part is taken as it is; the fraction is a mass of words that pairs of documents exchange at
random until one of the two is full or empty. The exchange keeps each document's expectation and
the source's sum of words. Chunks of a source are rounded on their own; each leaves at most one
document with a fraction, and these residuals meet in the next level of a reduction tree.

Only the last residual of a source is drawn by itself, so a source misses its target by part of one
document. Large documents, by their share of the target, are therefore settled first, and what they miss
is spread over the masses of all smaller ones, which keeps the expectations as a miss is 0 on average.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tamiz.llm.common import WORD, documents, global_rank, shuffled, small_or_shuffled, stored

CHUNK = 256
FAN_IN = 64
#: No document is taken more often than this, so no source's target exceeds this many times its size.
MOST_COPIES = 3
SEED = 20240229
#: Documents are settled in classes of their share of the source's target, from above the first limit down.
CLASSES = (0.2, 0.02, 0.002)


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size, weight) → with ``target``.

    All sizes are shared by weight; a target stops at MOST_COPIES times its source's size and the
    excess is shared anew among the others until none is above. Each round is one aggregate.
    """
    current = stored(sources.withColumn("capped", F.col("source_size") == 0).withColumn("cap", MOST_COPIES * F.col("source_size").cast("double")))
    while True:
        sums = current.agg(
            F.sum("source_size").alias("total"),
            F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))), F.lit(0.0)).alias("fixed"),
            F.sum(F.when(~F.col("capped"), F.col("weight"))).alias("open_weight"),
        ).first()
        if not sums["open_weight"]:
            return current.withColumn("target", F.col("cap")).drop("capped", "cap")
        rate = (sums["total"] - sums["fixed"]) / sums["open_weight"]
        over = ~F.col("capped") & (F.col("weight") * F.lit(rate) > F.col("cap"))
        if current.where(over).isEmpty():
            share = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.lit(rate))
            return current.withColumn("target", share).drop("capped", "cap")
        current = stored(current.withColumn("capped", F.col("capped") | over))


def cyclic_weights(sizes: DataFrame, weights: list[int]) -> DataFrame:
    """Weights dealt in turn to the sources by code point, null last."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(sources, [F.col("source").isNull().asc(), F.col("source").asc()])
    dealt = F.array(*[F.lit(float(w)) for w in weights])
    return ranked.withColumn("weight", F.get(dealt, (F.col("rank") % len(weights)).cast("int"))).drop("rank")


def _unit(keys: np.ndarray, level: int) -> np.ndarray:
    """A uniform number for each document and level, the same in every run."""
    x = keys.astype(np.uint64) ^ np.uint64((SEED + level * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53


def pivot(size: np.ndarray, mass: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Masses after pairwise exchange in the given order: all but one are 0 or the whole size."""
    out = mass.astype(float).copy()
    held = -1
    for i in range(len(out)):
        if not 0 < out[i] < size[i]:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        both = out[a] + out[b]
        give, take = min(out[a], size[b] - out[b]), min(out[b], size[a] - out[a])
        if draws[i] * (give + take) < take:  # a gives
            full = out[a] >= size[b] - out[b]
            out[a], out[b] = (both - size[b], size[b]) if full else (0.0, both)
        else:
            full = out[b] >= size[a] - out[a]
            out[b], out[a] = (both - size[a], size[a]) if full else (0.0, both)
        open_ = [x for x in (a, b) if 1e-9 * size[x] < out[x] < size[x] * (1 - 1e-9)]
        for x in (a, b):
            if x not in open_:
                out[x] = 0.0 if out[x] < size[x] / 2 else size[x]
        held = open_[0] if open_ else -1
    return out


def _level(rows: DataFrame, level: int, last: bool) -> DataFrame:
    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        # Large documents meet first, so that what is left open is small.
        frame = frame.sort_values(["size", "place", "doc_id", "mark"], ascending=[False, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
        size, draws = frame["size"].to_numpy(float), _unit(frame["place"].to_numpy(), level)
        mass = pivot(size, frame["mass"].to_numpy(float), draws)
        if last:  # at most one is left: it is taken with its own probability
            left = (mass > 0) & (mass < size)
            mass[left] = np.where(draws[left] * size[left] < mass[left], size[left], 0.0)
        return frame.assign(mass=mass)

    return rows.groupBy("source_key", "chunk").applyInPandas(settle, rows.schema)


def _settled(rows: DataFrame) -> DataFrame:
    """``rows`` (source_key, place, doc_id, size, mass, ...) with each mass at 0 or the whole size, by the reduction tree."""
    counted = stored(rows.groupBy("source_key").agg(F.count("*").alias("source_rows")))
    most = counted.agg(F.max("source_rows")).first()[0] or 0
    rows = rows.join(small_or_shuffled(counted, counted.count()), "source_key")
    rows = rows.withColumn("chunk", F.pmod(F.col("place"), F.ceil(F.col("source_rows") / CHUNK).cast("long"))).drop("source_rows")
    done, level, chunks = None, 0, max(1, -(-most // CHUNK))
    while True:
        last = chunks == 1
        rows = stored(_level(rows, level, last))
        is_open = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
        settled = rows.where(~is_open)
        done = settled if done is None else done.unionByName(settled)
        if last:
            return done.drop("chunk")
        rows = rows.where(is_open).withColumn("chunk", F.floor(F.col("chunk") / FAN_IN))
        chunks, level = -(-chunks // FAN_IN), level + 1


def taken_copies(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sizes`` (row, doc_id, source, mark, size) and ``sources`` (source, source_size, target) → one row a row of
    ``sizes`` with ``copies``. Documents without words are never taken."""
    same = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    parts = stored(sources.withColumn("source_key", F.xxhash64(same)).withColumnRenamed("source", "_source"))
    rows = sizes.join(small_or_shuffled(parts, parts.count()), sizes.source.eqNullSafe(F.col("_source"))).drop("_source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("whole", F.least(F.floor(expected), F.lit(MOST_COPIES)).cast("long"))
    rows = rows.withColumn("mass", (expected - F.col("whole")) * F.col("size"))
    # Rows equal in document, source and size share their draw; the hash of the text, ``mark``, tells which goes first.
    rows = stored(rows.withColumn("place", F.xxhash64("doc_id", "source", F.lit(SEED))))

    share = F.when(F.col("target") > 0, F.col("size") / F.col("target")).otherwise(F.lit(0.0))
    order = F.lit(len(CLASSES))
    for k, limit in reversed(list(enumerate(CLASSES))):
        order = F.when(share > limit, k).otherwise(order)
    rows = stored(rows.withColumn("class", order))
    there = sorted(r["class"] for r in rows.select("class").distinct().collect())  # at most len(CLASSES) + 1 rows
    done = None
    for k in there:
        ours = rows.where(F.col("class") == k)
        settled = _settled(ours)
        done = settled if done is None else done.unionByName(settled)
        if k != there[-1]:
            rows = _shifted(rows.where(F.col("class") > k), ours, settled)
    if done is None:
        done = _settled(rows)
    return done.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + (F.col("mass") > 0).cast("long")).otherwise(F.lit(0).cast("long")))


def _shifted(rest: DataFrame, wanted: DataFrame, taken: DataFrame) -> DataFrame:
    """``rest`` with its masses lowered or raised, in proportion to what each has or lacks, by the words
    that ``taken`` has more or less of each source than ``wanted``."""
    both = taken.select("source_key", "mass").unionByName(wanted.select("source_key", (-F.col("mass")).alias("mass")))
    missed = both.groupBy("source_key").agg(F.sum("mass").alias("miss"))
    room = rest.where(F.col("whole") < MOST_COPIES).groupBy("source_key").agg(F.sum("mass").alias("masses"), F.sum(F.col("size") - F.col("mass")).alias("lacks"))
    part = lambda words, of: F.when((words > 0) & (of > 0), F.least(words / of, F.lit(1.0))).otherwise(F.lit(0.0))
    shift = stored(room.join(missed, "source_key").select(
        F.col("source_key").alias("_key"), part(F.col("miss"), F.col("masses")).alias("_less"), part(-F.col("miss"), F.col("lacks")).alias("_more")))
    told = rest.join(small_or_shuffled(shift, shift.count()), F.col("source_key") == F.col("_key"), "left")
    moved = F.col("mass") * (1 - F.coalesce("_less", F.lit(0.0))) + (F.col("size") - F.col("mass")) * F.coalesce("_more", F.lit(0.0))
    return stored(told.withColumn("mass", F.when(F.col("whole") < MOST_COPIES, moved).otherwise(F.col("mass"))).drop("_key", "_less", "_more"))


def _decided(sizes: DataFrame, weights: list[int]) -> DataFrame:
    return taken_copies(sizes, source_targets(cyclic_weights(sizes, weights)))


def mixed(docs: DataFrame, weights: list[int]) -> DataFrame:
    """Copies to take of each document (doc_id, size, source_size, target, copies, taken).

    Size is the number of words. A null text has size 0 and is never taken; a null source is a
    source of its own, sorted last; repeated rows are documents of their own; an empty table gives
    an empty result; further columns are ignored.
    """
    sizes = stored(docs.select("doc_id", "source", F.xxhash64("text").alias("mark"), text_size(F.col("text")).alias("size")))
    return _decided(sizes.withColumn("row", F.lit(0).cast("long")), weights).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: list[int]) -> DataFrame:
    """The mix itself: each document repeated as often as it is taken, with the columns of ``docs``.

    Rows are numbered in a stored copy and meet their decisions by that number, so each row keeps its own,
    also where rows share a doc_id; which of their texts are taken rests on the texts, not on the order of arrival. Columns of ``docs`` may have any names; nulls and empty tables as in ``mixed``.
    """
    held = stored(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("mark"), text_size(F.col("text")).alias("size")))
    chosen = stored(_decided(held.select("row", "doc.doc_id", "doc.source", "mark", "size"), weights).where("copies > 0").select(F.col("row").alias("_row"), "copies"))
    # By a shuffle at every size: the decisions grow with the documents.
    joined = held.select("doc", "row").join(shuffled(chosen), F.col("row") == F.col("_row"))
    return joined.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def op1_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir), [1, 2, 3]).drop("copies")


QUERIES = {"op1_pivotal_mix": op1_pivotal_mix}
ORACLES: dict[str, str] = {}
