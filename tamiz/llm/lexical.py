"""Ranked lexical search: all documents for each item of a query set, by buckets of vector length.

A document is a sparse vector of whole-numbered impacts over the items' terms, an item one of weights, and
a score their inner product. Vectors are ordered by length and cut into buckets of similar length. An
item's threshold is the score of its last result so far. Buckets whose greatest length times the item's own
stays below it (Cauchy-Schwarz) are not read; inside the others the item's largest coordinates bound what a
vector can still reach, one after the other. What survives is scored in 64-bit integers, so lengths
and bounds, which are doubles with a margin, never decide a score.

Buckets are taken in three rounds, longest vectors first, so that thresholds are high when most of the
vectors are met. Blocks of items meet buckets inside tasks, as in ``blocks``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.llm.blocks import arrays, block_count, block_of, every_block
from tamiz.llm.common import documents, stored

TOP = 20
#: Lengths of one bucket differ by this factor at most.
RATIO = 1.05
#: Coordinates that a bucket's vectors hold together, or so, and items of a block.
BUCKET, ITEMS = 1 << 18, 512
#: Shares of all coordinates that are met after each round.
ROUNDS = (1 / 16, 1 / 4, 1.0)
#: Largest coordinates of an item that bound a score before it is computed.
FOCUS = 6
#: Texts whose terms are counted and handed on at once.
COUNTED = 256
#: By so much a bound is raised before a threshold is held against it, as it is computed in doubles.
MARGIN = 1 + 1e-9
#: Bytes outside terms become spaces, and A-Z small letters. Bytes of 128 and above are parts of characters that terms may hold.
_TERMS = bytes((c | 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(i, COUNTED) for b in batches for i in range(0, b.num_rows, COUNTED)):
        found = [Counter(terms(t)) for t in batch.column("text").to_pylist()]
        words = pa.array([list(c) for c in found], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
        times = pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))
        n = pa.array([sum(c.values()) for c in found], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), n, words, times], ["row", "id", "n", "terms", "times"])


def counted(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(row, id, n, terms, times): the terms of each whole text and how often it holds each."""
    kind = dict(rows.dtypes)[key]
    named = rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    return stored(named.mapInArrow(_counts, f"row long, id {kind}, n long, terms array<string>, times array<long>"))


def _postings(rows: DataFrame) -> DataFrame:
    return rows.select("row", "id", "n", F.explode(F.arrays_zip("terms", "times")).alias("t")).select("row", "id", "n", F.col("t.terms").alias("term"), F.col("t.times").alias("tf"))


def impact_vectors(docs: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vectors of documents (row, id, coordinates, impacts, length) and of items (item, id, coordinates, weights, length), over the items' terms."""
    spark = docs.sparkSession
    n_docs, n_terms = docs.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    words = stored(_postings(asked).select("term").distinct().select("term", F.monotonically_increasing_id().alias("coordinate")))
    held = stored(_postings(docs).join(words, "term").select("row", "id", "n", "coordinate", "tf"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.count("*") + 1).cast("double"))).cast("long")
    weights = stored(held.groupBy("coordinate").agg(weight.alias("w")))
    m = F.lit(75) + F.expr(f"(25 * n * {n_docs}L) div {max(n_terms, 1)}L")
    impact = held.withColumn("m", m).withColumn("impact", F.expr("(1000000000 * tf) div (1000 * tf + 12 * m)")).where("impact > 0")

    def gathered(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
        """A vector of each row. It has a coordinate for each of the items' terms at most, and comes from one text."""
        length = F.sqrt(F.sum(F.col(value).cast("double") * F.col(value).cast("double")))
        both = F.array_sort(F.collect_list(F.struct("coordinate", value)))
        v = rows.groupBy(*keys).agg(both.alias("v"), length.alias("length")).where("length > 0")
        return stored(v.select(*keys, F.col("v.coordinate").alias("coordinates"), F.col(f"v.{value}").alias("values"), "length"))

    items = _postings(asked).join(words, "term").join(weights, "coordinate").withColumn("weight", F.col("tf") * F.col("w")).where("weight > 0")
    return gathered(impact, ["row", "id"], "impact"), gathered(items, ["row", "id"], "weight")


def _search(items: pa.Table, bucket: pa.Table) -> pa.Table:
    """The results of each item within one bucket, TOP at most, that reach its threshold."""
    found, places, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(items) and len(bucket):
        item_terms, item_sizes = arrays(items["coordinates"], np.int64)
        item_weights, _ = arrays(items["values"], np.int64)
        known = np.unique(item_terms)
        doc_terms, sizes = arrays(bucket["coordinates"], np.int64)
        impacts, _ = arrays(bucket["values"], np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        at = np.searchsorted(known, doc_terms)
        mine = known[np.minimum(at, len(known) - 1)] == doc_terms  # what no item of this block asks for counts for nothing
        doc, at, impacts = doc[mine], at[mine], impacts[mine]
        squares = np.bincount(doc, impacts.astype(np.float64) ** 2, len(sizes))
        longest = np.sqrt(squares.max())
        ends = np.cumsum(np.bincount(doc, minlength=len(sizes)))
        # The same entries by coordinate.
        order = np.argsort(at, kind="stable")
        by_doc, by_impact = doc[order], impacts[order].astype(np.float64)
        columns = np.searchsorted(at[order], np.arange(len(known) + 1))
        stop = np.cumsum(item_sizes)
        weights = np.zeros(len(known), np.int64)
        tie = _id_ranks(bucket["id"])
        for row, begin, end, least in zip(items["row"].to_numpy(), stop - item_sizes, stop, items["least"].to_numpy()):
            where, w = np.searchsorted(known, item_terms[begin:end]), item_weights[begin:end]
            rest = float((w.astype(np.float64) ** 2).sum())
            if np.sqrt(rest) * longest * MARGIN < least:
                continue
            alive, partial, left = np.arange(len(sizes)), np.zeros(len(sizes)), squares.copy()
            for k in np.argsort(-w, kind="stable")[:FOCUS]:
                column = slice(columns[where[k]], columns[where[k] + 1])
                x = np.zeros(len(sizes))
                x[by_doc[column]] = by_impact[column]
                rest, left, partial = rest - float(w[k]) ** 2, left - x * x, partial + w[k] * x
                bound = partial[alive] + np.sqrt(max(rest, 0.0) * np.maximum(left[alive], 0.0))
                alive = alive[bound * MARGIN >= least]
            weights[where] = w
            n = ends[alive] - np.concatenate([[0], ends])[alive]
            entry = np.repeat(ends[alive] - np.cumsum(n), n) + np.arange(n.sum())
            exact = np.concatenate([[0], np.cumsum(weights[at[entry]] * impacts[entry])])
            weights[where] = 0
            total = np.diff(exact[np.concatenate([[0], np.cumsum(n)])])
            good = total >= least
            alive, total = alive[good], total[good]
            best = np.lexsort((tie[alive], -total))[:TOP]
            found.append(np.full(len(best), row))
            places.append(alive[best])
            score.append(total[best])
    place = np.concatenate(places)
    return pa.table({"row": np.concatenate(found), "id": bucket["id"].take(pa.array(place)).combine_chunks(), "score": np.concatenate(score)})


def _id_ranks(ids: pa.ChunkedArray) -> np.ndarray:
    """The place of each id in ascending order, nulls last."""
    ranks = np.zeros(len(ids), np.int64)
    ranks[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    return ranks


def _best(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def ranked(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the TOP documents of each item with a score above 0.

    A null text has no terms and is no document of the counts. Equal scores go by ascending doc_id, a null
    one last; repeated documents rank one behind the other, repeated items have results of their own, and a
    null item_id stays null. Items without terms, or whose terms no document holds, have no results; empty
    tables give an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    asked = counted(items, "item_id", text)
    vectors, queries = impact_vectors(counted(docs, "doc_id", text), asked)
    vectors = vectors.withColumn("level", F.floor(F.ln("length") / F.lit(float(np.log(RATIO)))).cast("int"))
    # One row a level: lengths are between 1 and 1e6 times the root of the number of terms, so these are some hundreds.
    levels = vectors.groupBy("level").agg(F.sum(F.size("coordinates")).alias("n"), F.max("length").alias("longest")).collect()
    levels, total, met, rounds = sorted(levels, reverse=True), sum(r["n"] for r in levels), 0, [[] for _ in ROUNDS]
    for r in levels:
        rounds[next(k for k, share in enumerate(ROUNDS) if met < share * total)].append(r)
        met += r["n"]
    blocks = block_count(queries.count(), ITEMS)
    kind = dict(vectors.dtypes)["id"]
    results = spark.createDataFrame([], f"row long, id {kind}, score long, rank int")
    for these in filter(None, rounds):
        last = results.where(F.col("rank") == TOP).select(F.col("row").alias("_row"), F.col("score").alias("_least"))
        told = stored(queries.join(last, F.col("row") == F.col("_row"), "left").select("row", "coordinates", "values", "length", F.coalesce("_least", F.lit(1).cast("long")).alias("least"), block_of("row", blocks).alias("block")))
        # Cauchy-Schwarz on whole levels: what no item can reach is neither read nor sent.
        reach = told.agg(F.min(F.col("least") / F.col("length"))).first()[0]
        these = [r for r in these if reach is not None and r["longest"] * MARGIN >= reach]
        if not these:
            continue
        plan = F.array(*[F.struct(F.lit(r["level"]).alias("level"), F.lit(block_count(r["n"], BUCKET)).alias("chunks"), F.lit(r["longest"]).alias("longest")) for r in these])
        chunk = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        left = told.select("*", F.explode(F.filter(plan, lambda p: p["longest"] * F.col("length") * MARGIN >= F.col("least"))).alias("p"))
        left = left.select("row", "coordinates", "values", "least", "block", F.col("p.level").alias("level"), chunk(F.col("p.chunks")).alias("chunk"))
        chunks = F.element_at(F.map_from_entries(F.transform(plan, lambda p: F.struct(p["level"], p["chunks"]))), F.col("level"))
        right = vectors.where(F.col("level").isin([r["level"] for r in these])).select("row", "id", "coordinates", "values", "level", F.pmod(F.xxhash64("row"), chunks).cast("int").alias("chunk"), every_block(blocks).alias("block"))
        keys = ["block", "level", "chunk"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search, f"row long, id {kind}, score long")
        results = stored(_best(results.drop("rank").unionByName(found)))
    names = asked.select(F.col("row").alias("_row"), F.col("id").alias("item_id"))
    return results.join(names, F.col("row") == F.col("_row")).select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def op12_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op12_norm_buckets": op12_norm_buckets}

ORACLES = {
    "op12_norm_buckets": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
totals AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM sizes),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM dfs, totals),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
scored AS (
  SELECT item_id, t.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * nd) // l)))))::BIGINT AS score
  FROM asked a JOIN tfs t USING (term) JOIN weights USING (term) JOIN sizes s ON s.doc_id = t.doc_id, totals GROUP BY item_id, t.doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
""",
}
