"""Near-duplicate groups: fast similarity sketches, banding, and exact verification.

A sketch has SKETCH coordinates. In round r every shingle is thrown into one coordinate, where the
least (round, value) stays; after SKETCH random rounds as many more send all shingles to one
coordinate each, so that every coordinate is filled. Rounds end when all are.

Documents of equal sets are one class from the start. Classes that share a band are compared first
with the band's centre (the member that shares most bands with others), which joins the copies of one
text in as many comparisons as there are copies. Only bands whose members are still in several groups
are then compared further, group against group. Every link that is used was confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import bytesnp as B
from tamiz.llm.common import documents, shuffled, small_or_shuffled, stored
from tamiz.llm.components import components

SHINGLE = 5
LEAST_PERCENT = 75
#: Bands of more members than this are compared in blocks, of which only links between groups come out.
SMALL_BAND = 8
PROBES, MEMBERS = 256, 1024
SKETCH = 128
ROWS = 4
BANDS = SKETCH // ROWS
#: A pair of similarity 0.75 shares none of the bands with a probability of (1 - 0.75**4)**32 < 6e-6.
_SEED = B.mix(np.arange(2 * SKETCH, dtype=B.U) + B.U(0xA5A5))


def shingle_sets(raw: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    hashes, _, _, bounds = B.hashed_words(raw, at, lower=True)
    whole = B.windows(hashes, SHINGLE)
    sets = []
    for s, e in zip(bounds[:-1], bounds[1:]):
        if e - s >= SHINGLE:
            sets.append(np.unique(whole[s : e - SHINGLE + 1]))
        elif e > s:
            sets.append(B.windows(hashes[s:e], int(e - s), base=0x9E3779B97F4A7C17))
        else:
            sets.append(np.zeros(0, B.U))
    return sets


def sketch(shingles: np.ndarray) -> np.ndarray:
    """SKETCH coordinates of a set that isn't empty: (round, value) of the least shingle of each bin."""
    out = np.full(SKETCH, np.iinfo(np.uint64).max, B.U)
    step = max(1, 512 // len(shingles))
    r = 0
    while r < 2 * SKETCH and (out == np.iinfo(np.uint64).max).any():
        rounds = np.arange(r, min(r + step, 2 * SKETCH))
        value = B.mix(shingles[None, :] ^ _SEED[rounds, None])
        bins = np.where(rounds[:, None] < SKETCH, value % B.U(SKETCH), (rounds[:, None] - SKETCH).astype(B.U))
        keys = np.sort(((bins << B.U(57)) | (rounds[:, None].astype(B.U) << B.U(48)) | (value >> B.U(16))).ravel())
        at = keys >> B.U(57)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        where = at[first].astype(np.int64)
        out[where] = np.minimum(out[where], keys[first])
        r += step
    return out


_ODD = B.mix(np.arange(ROWS, dtype=B.U) + B.U(77)) | B.U(1)


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, ROWS) * _ODD
    return B.mix(rows.sum(axis=1, dtype=B.U) + np.arange(BANDS, dtype=B.U) * B.U(0x9E3779B97F4A7C15)).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = B.texts(batch.column("text"))
        counts, keys, bands = [], [], []
        for i, j in B.groups(at):
            for s in shingle_sets(raw, at[i : j + 1]):
                counts.append(len(s))
                ranks = np.arange(1, len(s) + 1, dtype=B.U)
                keys.append(np.array([B.mix(s + ranks * B.U(0x9E3779B97F4A7C15)).sum(dtype=B.U), B.mix(s ^ B.U(0xD1B54A32D192ED03)).sum(dtype=B.U) + B.U(len(s))]).tobytes())
                bands.append(band_keys(sketch(s)) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "set_key", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = B.texts(batch.column("text"))
        out = [s.tobytes() for i, j in B.groups(at) for s in shingle_sets(raw, at[i : j + 1])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["node", "shingles"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for left, right in zip(batch.column("left"), batch.column("right")):
            x, y = (np.frombuffer(v.as_py(), B.U) for v in (left, right))
            if len(x) > len(y):
                x, y = y, x
            place = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[place] == x).sum())
            linked.append(100 * both >= LEAST_PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def confirmed(pairs: DataFrame, sets: DataFrame, kind: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(_confirmed, f"a {kind}, b {kind}")


def _links_of_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Links between the groups of a block, as many as join them: each probe against each member.

    The probes' shingles are a sorted list with the probes that hold each, so the work arrays grow with
    the shingles of the block's probes and of one member, never with probes times shingles.
    """
    probes, members = frame[frame["is_probe"]], frame[~frame["is_probe"]]
    out: list[tuple] = []
    if len(probes) and len(members):
        sets = [np.frombuffer(x, B.U) for x in probes["shingles"]]
        sizes = np.array([len(x) for x in sets])
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        nodes, groups = probes["node"].to_numpy(), probes["label"].to_numpy()
        parent: dict = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for node, label, text in zip(members["node"], members["label"], members["shingles"]):
            y = np.frombuffer(text, B.U)
            low, high = np.searchsorted(every, y, "left"), np.searchsorted(every, y, "right")
            n = high - low
            at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            both = np.bincount(owner[at], minlength=len(sets))
            for k in np.flatnonzero(100 * both >= LEAST_PERCENT * (sizes + len(y) - both)):
                r, t = root(label), root(groups[k])
                if r != t:
                    parent[max(r, t)] = min(r, t)
                    out.append((node, nodes[k]))
    return pd.DataFrame(out, columns=["a", "b"])


def _across_blocks(rows: DataFrame, sets: DataFrame, kind: str) -> DataFrame:
    """Links between different groups within large bands. Members outside a band's main group are probes.

    Sets that are similar enough differ in size by a factor of 3/4 at most, so a probe meets only the
    members of its own class of sizes and the next ones. Blocks of probes meet blocks of members, so a
    task holds PROBES + MEMBERS sets or so, and no pair is a row unless it joins two groups.
    """
    by_group = rows.groupBy("band", "label").agg(F.count("*").alias("k"))
    main = stored(by_group.groupBy("band").agg(F.max(F.struct("k", "label")).alias("main")).select(F.col("band").alias("_band"), F.col("main.label").alias("main")))
    size_class = F.floor(F.ln(F.col("n").cast("double")) / F.ln(F.lit(100 / LEAST_PERCENT))).cast("int")
    told = stored(rows.join(shuffled(main), rows.band == F.col("_band")).select("band", "node", "label", (F.col("label") != F.col("main")).alias("open"), size_class.alias("size")))
    probes = told.where("open").select("band", "node", "label", "size")
    members = told.select("band", "node", "label", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("size"))
    blocks = lambda df, least, name: df.groupBy("band", "size").agg(F.ceil(F.count("*") / least).alias(name))
    plan = stored(blocks(probes, PROBES, "p_blocks").join(blocks(members, MEMBERS, "m_blocks"), ["band", "size"]).select(F.col("band").alias("_band"), F.col("size").alias("_size"), "p_blocks", "m_blocks"))
    plan = shuffled(plan)
    planned = lambda df: df.join(plan, (F.col("band") == F.col("_band")) & (F.col("size") == F.col("_size")))
    block = lambda seed, blocks: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    probes = planned(probes).select("band", "size", "node", "label", block(1, "p_blocks").alias("p"), every("m_blocks").alias("m"), F.lit(True).alias("is_probe"))
    members = planned(members).select("band", "size", "node", "label", every("p_blocks").alias("p"), block(2, "m_blocks").alias("m"), F.lit(False).alias("is_probe"))
    return probes.unionByName(members).join(sets, "node").groupBy("band", "size", "p", "m").applyInPandas(_links_of_block, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept.

    A document without words, or without text, has an empty set and is linked with nothing; a null
    doc_id is linked with nothing, has no component and is kept; rows that repeat a doc_id are the
    same document; an empty table gives an empty result; further columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    source = docs.select("doc_id", F.col(text).alias("text"))
    signed = stored(source.mapInArrow(_signatures, f"doc_id {kind}, n_shingles long, set_key binary, bands array<long>"))
    named = signed.where("doc_id is not null and n_shingles > 0")
    classes = stored(named.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n")))
    heads = named.join(classes.select("node", F.col("set_key").alias("_key")), (F.col("doc_id") == F.col("node")) & (F.col("set_key") == F.col("_key")))
    rows = stored(heads.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("band")).distinct())
    # Counts by band are stored before they are joined, so that a band with very many members is split.
    shared = stored(rows.groupBy("band").agg(F.count("*").alias("members")).where("members > 1"))
    rows = stored(rows.join(shuffled(shared), "band"))
    scores = rows.groupBy("node").agg(F.sum("members").alias("score"))
    scored = rows.join(scores, "node")
    centres = stored(scored.groupBy("band").agg(F.max(F.struct("score", "node")).alias("c")).select(F.col("band").alias("_band"), F.col("c.node").alias("centre")))
    n_of = classes.groupBy("node").agg(F.max("n").alias("n"))
    pairs = stored(
        rows.join(shuffled(centres), rows.band == F.col("_band")).where("node <> centre")
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
        .join(n_of.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a").join(n_of.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b")
        .where(F.lit(100) * F.least("n_a", "n_b") >= F.lit(LEAST_PERCENT) * F.greatest("n_a", "n_b")).select("a", "b")
    )
    # Only documents that share a band need their sets again.
    members = stored(rows.select(F.col("node").alias("_node")).distinct())
    sets = stored(source.join(small_or_shuffled(members, members.count()), F.col("doc_id") == F.col("_node")).select("doc_id", "text").mapInArrow(_sets, f"node {kind}, shingles binary"))
    edges = stored(confirmed(pairs, sets, kind))
    labels = components(edges)

    # Bands whose members are still in several groups: pairs of different groups where the band is small,
    # and blocks of members where it is large.
    grouped = rows.join(labels, "node", "left").select("band", "node", "n", "members", F.coalesce("label", "node").alias("label"))
    grouped = stored(grouped)
    open_bands = stored(grouped.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("band"))
    left = stored(grouped.join(shuffled(open_bands), "band"))
    small = left.where(F.col("members") <= SMALL_BAND)
    one, two = (small.select("band", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "label"))) for s in "ab")
    more = (
        one.join(two, "band").where((F.col("label_a") < F.col("label_b")) & (F.lit(100) * F.least("n_a", "n_b") >= F.lit(LEAST_PERCENT) * F.greatest("n_a", "n_b")))
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
        .join(pairs, ["a", "b"], "left_anti")
    )
    edges = edges.unionByName(confirmed(more, sets, kind)).unionByName(_across_blocks(left.where(F.col("members") > SMALL_BAND), sets, kind))
    edges = stored(edges)
    labels = components(edges)

    named_classes = classes.join(labels, "node", "left").select(F.col("set_key").alias("_key"), F.coalesce("label", "node").alias("component_id"))
    found = signed.drop("bands").join(named_classes, (F.col("set_key") == F.col("_key")) & F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op9_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


QUERIES = {"op9_similarity_sketch": op9_similarity_sketch}

ORACLES = {
    "op9_similarity_sketch": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * p.n >= 75 * (x.n + y.n - p.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id, w.doc_id = min(r.b) AS kept
FROM w JOIN reach r ON r.a = w.doc_id LEFT JOIN sizes s USING (doc_id) GROUP BY w.doc_id, s.n
""",
}
