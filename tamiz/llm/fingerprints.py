"""Order MinHash fingerprints, in SQL functions only.

The k-mers of a text (K words each) are numbered by occurrence, so the second copy of a k-mer is an
element of its own, and hashed onto a ring. Each of SIGNATURES equally spaced points of the ring
selects the TUPLE elements that follow it, which is a minimum under that rotation of the hash order;
their order in the text is restored and the tuple of their hashes is one entry of the fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.llm.common import documents, global_rank, let, small_or_shuffled, stored, words

K = 3
TUPLE = 2
SIGNATURES = 64
#: Documents meet their successors in buckets of so many neighbouring ids (a power of two).
BUCKET_BITS = 8
#: Buckets that a task takes.
BUCKETS_PER_TASK = 8
_POINTS = [-(2**63) + s * (2**64 // SIGNATURES) for s in range(SIGNATURES)]


def _elements(w: Column) -> Column:
    """Array of (h, i): hash of each occurrence-numbered k-mer and its place; fewer than K words are one k-mer."""
    keys = F.when(F.size(w) < K, F.array(F.xxhash64(w))).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (K - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, K))))

    def numbered(s: Column) -> Column:
        # In sorted order, a run of equal k-mers is numbered 0, 1, ... from its head.
        heads = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (j == 0) | (F.get(s, j)["k"] != F.get(s, F.greatest(j - 1, F.lit(0)))["k"]))
        turn = let(heads, lambda h: F.flatten(F.transform(h, lambda x, r: F.sequence(F.lit(0), F.coalesce(F.get(h, r + 1), F.size(s)) - x - 1))))
        return F.zip_with(s, turn, lambda x, t: F.struct(F.xxhash64(x["k"], t).alias("h"), x["i"].alias("i")))

    def all_elements(k: Column) -> Column:
        once = F.transform(k, lambda x, i: F.struct(F.xxhash64(x, F.lit(0)).alias("h"), i.alias("i")))
        placed = F.transform(k, lambda x, i: F.struct(x.alias("k"), i.alias("i")))
        return F.when(F.size(F.array_distinct(k)) == F.size(k), once).otherwise(let(F.array_sort(placed), numbered))

    return let(keys, all_elements)


def fingerprint(text: Column) -> Column:
    """array<int> of SIGNATURES entries; empty for a text without words."""
    points = F.array(*[F.struct(F.lit(p).cast("long").alias("h"), F.lit(-1 - s).alias("i")) for s, p in enumerate(_POINTS)])

    def entries(both: Column, real: Column) -> Column:
        # The s-th point stands behind s other points, so its place less s is the first element at or after it.
        at = F.filter(F.transform(both, lambda x, j: F.when(x["i"] < 0, j)), lambda j: j.isNotNull())

        def entry(j: Column, s: Column) -> Column:
            picks = F.transform(F.sequence(F.lit(0), F.least(F.lit(TUPLE), F.size(real)) - 1),
                                lambda q: let(F.get(real, (j - s + q) % F.size(real)), lambda x: F.struct(x["i"].alias("i"), x["h"].alias("h"))))
            return F.xxhash64(F.transform(F.array_sort(picks), lambda x: x["h"])).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")

        return F.transform(at, entry)

    def signed(w: Column) -> Column:
        sorted_ = F.array_sort(F.concat(_elements(w), points))
        return let(sorted_, lambda both: let(F.filter(both, lambda x: x["i"] >= 0), lambda real: entries(both, real)))

    return let(words(text), lambda w: F.when(F.size(w) == 0, F.array().cast("array<int>")).otherwise(signed(w)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries; two empty fingerprints are alike, an empty and another are not."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(SIGNATURES))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(equal)


def printed(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def with_next(docs: DataFrame, made: dict[str, Column]) -> DataFrame:
    """``docs`` (doc_id, text) with the columns ``made`` of the text, and ``next_<c>`` of text and each of
    these, from the next row by descending doc_id, ties by text; after the last comes the first.

    ``made`` is computed once a row, and once more only for the few that are copied. Rows meet in buckets of neighbouring ids. The first row of each bucket is copied to the bucket
    before it, the very first one to the last bucket, so no task sees more than a bucket.
    """
    bucket = F.shiftright(F.col("doc_id"), BUCKET_BITS)
    heads = docs.where("doc_id is not null").groupBy(bucket.alias("bucket")).agg(F.max("doc_id").alias("head"))
    ranked = stored(global_rank(heads, [F.col("bucket").desc()]))
    n = ranked.count()
    into = ranked.select(((F.col("rank") + 1) % F.lit(max(n, 1))).alias("_rank"), F.col("bucket").alias("_bucket"))
    moves = stored(ranked.join(into, F.col("rank") == F.col("_rank")).select(F.col("head").alias("_head"), "_bucket"))
    names = ["doc_id", "text", *[c.alias(name) for name, c in made.items()]]
    own = docs.where("doc_id is not null").select(*names, bucket.alias("_bucket"), F.lit(0).alias("_copied"))
    copied = docs.join(small_or_shuffled(moves, n), F.col("doc_id") == F.col("_head")).select(*names, "_bucket", F.lit(1).alias("_copied"))
    # As many tasks as the buckets call for, so that a task's share of the texts doesn't grow with the corpus.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // BUCKETS_PER_TASK)
    order = Window.partitionBy("_bucket").orderBy(F.col("_copied"), F.col("doc_id").desc(), F.col("text"))
    found = own.unionByName(copied).repartition(tasks, "_bucket").select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ["text", *made]])
    found = found.where("_copied = 0").drop("_bucket", "_copied")
    nowhere = docs.where("doc_id is null").select(*names)
    nowhere = nowhere.select("*", *[F.lit(None).cast(nowhere.schema[c].dataType).alias(f"next_{c}") for c in ["text", *made]])
    return found.unionByName(nowhere)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited text.

    A null text is empty, and its fingerprint is an empty string. A row without doc_id has no place
    in the order, and its next document is the empty text; rows with equal doc_id follow by text; a
    single document is its own next; an empty table gives an empty result; further columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select("doc_id", text.alias("text"))
    rows = with_next(own, {"prints": fingerprint(F.col("text"))})
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - half).cast("int")), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = rows.select("doc_id", n.alias("n_chars"), edited.alias("edited"), "prints", F.coalesce("next_prints", F.array().cast("array<int>")).alias("next_prints"))
    rows = rows.withColumn("edited_prints", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed(F.col("prints")).alias("fingerprint"),
        printed(F.col("edited_prints")).alias("edited_fingerprint"), likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
    )


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(documents(spark, sf_dir))


QUERIES = {"op10_order_minhash": op10_order_minhash}
ORACLES: dict[str, str] = {}
