"""Substring dedup with compressed FM-indexes, one per shard of the text that can repeat.

Every window of WINDOW words has an anchor: the least of its runs of ANCHOR words, by hash. Equal
windows have equal anchors, so windows are compared only where an anchor stands in several documents.
The consecutive windows of one anchor are a segment; equal segments are one, with the smallest doc_id
that has it. Segments are dealt to shards by anchor; a shard indexes its segments (suffix order,
Burrows-Wheeler transform, wavelet matrix, sampled suffixes) and streams them through backward search.
The matching statistics say how far each word's left context occurs elsewhere, up to WINDOW; where they
reach it, the interval of suffixes tells which document is first. Words are compared by 64-bit hash.
An anchor with very many segments is dealt by window instead, after equal windows became one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm import bytesnp as B
from tamiz.llm.common import documents, global_rank, stored

WINDOW = 13
ANCHOR = 5
SPREAD = WINDOW - ANCHOR + 1
#: An anchor with more segments than this is dealt by window.
HOT_SEGMENTS = 500
#: Suffixes of a sequence between those that keep its number.
SAMPLE = 4
#: Words indexed by one shard, about.
SHARD_WORDS = 300_000
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, B.U), np.full(max(n - 1, 0), base, B.U)]), dtype=B.U)


def segments(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """word hashes, bounds of texts, and of each segment: text, first window, last window, anchor, content."""
    hashes, _, _, bounds = B.hashed_words(raw, at, lower=False)
    none = np.zeros(0, np.int64)
    if len(hashes) < WINDOW:
        return hashes, bounds, none, none, none, none.view(B.U), none.view(B.U)
    text = np.repeat(np.arange(len(at) - 1), np.diff(bounds))
    grams = B.windows(hashes, ANCHOR)
    place = np.lib.stride_tricks.sliding_window_view(grams, SPREAD).argmin(axis=1)
    place = place + np.arange(len(place))
    windows = np.flatnonzero(text[: len(place)] == text[WINDOW - 1 :])
    if not len(windows):
        return hashes, bounds, none, none, none, none.view(B.U), none.view(B.U)
    place, of = place[windows], text[windows]
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (of[1:] != of[:-1])])
    heads = np.flatnonzero(new)
    first, last = windows[heads], windows[np.append(heads[1:], len(windows)) - 1]
    sums = np.concatenate([np.zeros(1, B.U), np.cumsum(hashes * _powers(_STEP, len(hashes)), dtype=B.U)])
    content = B.mix((sums[last + WINDOW] - sums[first]) * _powers(_BACK, len(hashes))[first] + (last - first).astype(B.U))
    return hashes, bounds, of[heads], first, last, grams[place[heads]], content


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = B.texts(batch.column("text"))
        for i, j in B.groups(at):
            _, _, of, _, _, anchor, content = segments(raw, at[i : j + 1])
            order = np.lexsort((content, of))
            of, anchor, content = of[order], anchor[order], content[order]
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (content[1:] != content[:-1])
            ids = batch.column("doc_id").take(pa.array(of[new] + i))
            yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), pa.array(content[new].view(np.int64)), ids], ["anchor", "content", "doc_id"])


def _texts_of_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words' hashes of wanted segments; those of hot anchors are cut into windows."""
    for batch in batches:
        raw, at = B.texts(batch.column("text"))
        wanted = batch.column("wanted")
        bounds_w, flat = wanted.offsets.to_numpy(), wanted.values
        want = {name: flat.field(name).to_numpy(zero_copy_only=False) for name in ("content", "least", "most", "hot")}
        for i, j in B.groups(at):
            hashes, _, of, first, last, anchor, content = segments(raw, at[i : j + 1])
            rows: list[tuple] = []
            for k in range(i, j):
                ours = slice(bounds_w[k], bounds_w[k + 1])
                lo, hi = np.searchsorted(of, [k - i, k - i + 1])
                at_content = {c: s for s, c in zip(range(lo, hi), content[lo:hi].view(np.int64).tolist())}
                for c, least, most, hot in zip(*(want[name][ours].tolist() for name in ("content", "least", "most", "hot"))):
                    s = at_content.get(c)
                    if s is None:  # another row has this doc_id too, and the segment is there
                        continue
                    a, b = int(first[s]), int(last[s])
                    if not hot:
                        rows.append((c, int(anchor[s].view(np.int64)), least, most, hashes[a : b + WINDOW].tobytes(), None, 0))
                        continue
                    for place in range(a, b + 1):
                        own = hashes[place : place + WINDOW]
                        key = int(B.windows(own, WINDOW, base=0xD6E8FEB86659FD93)[0].view(np.int64))
                        rows.append((key, key, least, most, own.tobytes(), c, place - a))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in cols[:4]), pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.int32())],
                    ["key", "route", "least", "most", "words", "parent", "place"])


class FMIndex:
    """Word sequences, each ended by a 0, as Burrows-Wheeler transform in a wavelet matrix with packed bits
    and block counts. Of the suffix order, only every SAMPLE-th suffix of a sequence and its first one keep
    their sequence's number; the others are found by walking back to one of these."""

    def __init__(self, sequence: np.ndarray, longest: int):
        """``longest`` words, at least as many as the longest sequence has, make the order of suffixes total:
        equal ends of sequences are ordered by the sequences' numbers."""
        ends = sequence == 0
        number = np.cumsum(ends) - ends
        rank = np.where(ends, number, sequence.astype(np.int64) + int(ends.sum()))
        step = 1
        while True:
            ahead = np.zeros_like(rank)
            ahead[:-step] = rank[step:] + 1
            key = rank * (int(rank.max()) + 2) + ahead
            order = np.argsort(key, kind="stable")
            sorted_ = key[order]
            rank = np.empty_like(rank)
            rank[order] = np.cumsum(np.concatenate([[0], (sorted_[1:] != sorted_[:-1]).astype(np.int64)]))
            step *= 2
            if step > longest or int(rank.max()) + 1 == len(rank) or step >= len(rank):
                break
        bwt = sequence[order - 1].astype(np.int64)
        first = np.flatnonzero(ends) + 1
        place = np.arange(len(sequence)) - np.concatenate([[0], first])[number]
        sampled = (place % SAMPLE == 0)[order]
        self.sampled, self.sampled_counts = self._packed(sampled)
        self.numbers = number[order][sampled].astype(np.int32)
        symbols = int(sequence.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols))])
        self.levels = []
        for shift in reversed(range(max(1, int(symbols - 1).bit_length()))):
            bits = ((bwt >> shift) & 1).astype(bool)
            self.levels.append((shift, *self._packed(bits), int(len(bits) - bits.sum())))
            bwt = np.concatenate([bwt[~bits], bwt[bits]])
        self.start = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    @staticmethod
    def _packed(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        packed = np.packbits(np.concatenate([bits, np.zeros(-len(bits) % 64 + 64, bool)]), bitorder="little").view("<u8")
        return packed, np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)])

    @staticmethod
    def _ones(packed: np.ndarray, counts: np.ndarray, place: np.ndarray) -> np.ndarray:
        block = place >> 6
        low = (B.U(1) << (place & 63).astype(B.U)) - B.U(1)
        return counts[block].astype(np.int64) + np.bitwise_count(packed[block] & low)

    @staticmethod
    def _bit(packed: np.ndarray, place: np.ndarray) -> np.ndarray:
        return (packed[place >> 6] >> (place & 63).astype(B.U) & B.U(1)).astype(np.int64)

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for shift, packed, counts, zeros in self.levels:
            ones = self._ones(packed, counts, place)
            place = np.where((symbol >> shift) & 1, zeros + ones, place - ones)
        return place

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put before them."""
        base = self.before[symbol] - self.start[symbol]
        return base + self._down(symbol, low), base + self._down(symbol, high)

    def back(self, row: np.ndarray) -> np.ndarray:
        """The suffixes one word longer, to the left; none may be the first of its sequence."""
        place, symbol = row, np.zeros(len(row), np.int64)
        for shift, packed, counts, zeros in self.levels:
            bit, ones = self._bit(packed, place), self._ones(packed, counts, place)
            symbol |= bit << shift
            place = np.where(bit, zeros + ones, place - ones)
        return self.before[symbol] + place - self.start[symbol]

    def sequence_of(self, rows: np.ndarray) -> np.ndarray:
        """Number of the sequence of each suffix."""
        out, rows, at = np.empty(len(rows), np.int64), rows.copy(), np.arange(len(rows))
        while len(rows):
            known = self._bit(self.sampled, rows).astype(bool)
            out[at[known]] = self.numbers[self._ones(self.sampled, self.sampled_counts, rows[known])]
            rows, at = self.back(rows[~known]), at[~known]
        return out


def matched(texts: list[np.ndarray], least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every window: its segment and place, the matching statistic of its last word (how many words up to
    it occur elsewhere in the shard, WINDOW at most), and the smallest ``least`` among the segments that have the window."""
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths + 1)
    sequence = np.zeros(ends[-1], np.int64)
    inside = np.ones(ends[-1], bool)
    inside[ends - 1] = False
    _, ids = np.unique(np.concatenate(texts), return_inverse=True)
    sequence[inside] = ids + 1
    index = FMIndex(sequence, int(lengths.max()) + 1)
    starts = ends - lengths - 1
    counts = lengths - WINDOW + 1
    segment = np.repeat(np.arange(len(texts)), counts)
    window = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    best = least[segment].copy()
    at = starts[segment] + window
    symbol = sequence[at + WINDOW - 1]
    low, high = index.before[symbol], index.before[symbol + 1]
    statistic = np.zeros(len(at), np.int64)
    alive = np.arange(len(at))
    for reached in range(1, WINDOW + 1):
        going = high - low > 1  # an interval of one is the window itself
        alive, low, high = alive[going], low[going], high[going]
        statistic[alive] = reached
        if reached < WINDOW:
            low, high = index.extend(sequence[at[alive] + WINDOW - 1 - reached], low, high)
    if len(alive):
        cut, inverse = np.unique(low, return_inverse=True)
        until = np.zeros(len(cut), np.int64)
        until[inverse] = high
        n = until - cut
        offset = np.cumsum(n) - n
        rows = np.arange(int(n.sum())) + np.repeat(cut - offset, n)
        best[alive] = np.minimum.reduceat(least[index.sequence_of(rows)], offset)[inverse]
    return segment, window, statistic, best


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if len(b)]
    if not held:
        return
    shard = pa.Table.from_batches(held)
    least, most = shard["least"].to_numpy(), shard["most"].to_numpy()
    texts = [np.frombuffer(w.as_py(), B.U) for w in shard["words"]]
    segment, window, statistic, best = matched(texts, least)
    # Windows that a smaller document has: found elsewhere in full length, or in another copy of the segment.
    said = np.where(statistic >= WINDOW, best, least[segment]) < most[segment]
    segment, window, best = segment[said], window[said], best[said]
    for cut in range(0, len(segment), 100_000):
        part = slice(cut, cut + 100_000)
        rows = pa.array(segment[part])
        yield pa.RecordBatch.from_arrays(
            [shard["key"].combine_chunks().take(rows), shard["is_hot"].combine_chunks().take(rows), pa.array(window[part].astype(np.int32)), pa.array(best[part])],
            ["key", "is_hot", "place", "first_doc"])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, removed: array of (content, mask)): the segments of each document and, bit by bit, which
    of their windows start in a document with a smaller doc_id too."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    seen = stored(whole.mapInArrow(_occurrences, "anchor long, content long, doc_id long"))
    shared = seen.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.count("*").alias("n")).where("x < y")
    shared = stored(shared.select("anchor", (F.col("n") > HOT_SEGMENTS).alias("hot")))
    places = stored(seen.join(shared, "anchor").select("content", "doc_id", "hot"))
    contents = places.groupBy("content").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.max("hot").alias("hot"))
    wanted = contents.groupBy(F.col("least").alias("_id")).agg(F.collect_list(F.struct("content", "least", "most", "hot")).alias("wanted"))
    own = whole.join(wanted, F.col("doc_id") == F.col("_id")).select("text", "wanted")
    texts = stored(own.mapInArrow(_texts_of_segments, "key long, route long, least long, most long, words binary, parent long, place int"))

    cold = texts.where("parent is null").select("key", "route", "least", "most", "words", F.lit(False).alias("is_hot"))
    hot = texts.where("parent is not null").groupBy("key").agg(
        F.first("route").alias("route"), F.min("least").alias("least"), F.max("most").alias("most"), F.first("words").alias("words"), F.lit(True).alias("is_hot"))
    words = texts.agg(F.sum(F.octet_length("words") / 8).alias("n")).first()["n"] or 0
    shards = max(int(words // SHARD_WORDS) + 1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cold.unionByName(hot.select(*cold.columns)).repartition(shards, "route")
    found = stored(dealt.mapInArrow(_searched, "key long, is_hot boolean, place int, first_doc long"))
    by_window = texts.where("parent is not null").select(F.col("key").alias("_key"), "parent", F.col("place").alias("at"), "most")
    hot_found = found.where("is_hot").join(by_window, F.col("key") == F.col("_key")).where(F.col("first_doc") < F.col("most"))
    verdicts = found.where("not is_hot").select(F.col("key").alias("_content"), "place", "first_doc").unionByName(
        hot_found.select(F.col("parent").alias("_content"), F.col("at").alias("place"), "first_doc"))
    verdicts = verdicts.groupBy("_content").agg(F.collect_list(F.struct("place", "first_doc")).alias("windows"))
    mask = F.aggregate("windows", F.lit(0), lambda a, w: F.when(w["first_doc"] < F.col("doc_id"), a.bitwiseOR(F.call_function("shiftleft", F.lit(1), w["place"]))).otherwise(a))
    hits = places.join(verdicts, F.col("content") == F.col("_content")).select("doc_id", "content", mask.alias("mask")).where("mask <> 0")
    return stored(hits.groupBy("doc_id").agg(F.collect_list(F.struct("content", "mask")).alias("removed")))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = B.texts(batch.column("text"))
        removed = batch.column("removed")
        bounds_r, flat = removed.offsets.to_numpy(), removed.values
        contents, masks = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("content", "mask"))
        lengths, gone, kept = [], [], []
        for i, j in B.groups(at):
            hit = any(removed[k].is_valid for k in range(i, j))
            _, bounds, of, first, last, _, content = segments(raw, at[i : j + 1]) if hit else (None,) * 7
            for k in range(i, j):
                words = raw[at[k] : at[k + 1]].tobytes().split()
                out = np.zeros(len(words) + 1, np.int64)
                if removed[k].is_valid:
                    ours = slice(bounds_r[k], bounds_r[k + 1])
                    verdict = dict(zip(contents[ours].tolist(), masks[ours].tolist()))
                    lo, hi = np.searchsorted(of, [k - i, k - i + 1])
                    for s, c in zip(range(lo, hi), content[lo:hi].view(np.int64).tolist()):
                        bits = verdict.get(c, 0)
                        for place in range(int(last[s] - first[s]) + 1 if bits else 0):
                            if bits >> place & 1:
                                start = first[s] + place - bounds[k - i]
                                out[start] += 1
                                out[start + WINDOW] -= 1
                stays = np.cumsum(out[:-1]) == 0
                lengths.append(len(words))
                gone.append(len(words) - int(stays.sum()))
                kept.append(b" ".join(compress(words, stays.tolist()) if gone[-1] else words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by spaces.

    A null text has no words. A row without doc_id is never compared and keeps all its words; rows
    that repeat a doc_id are one document, so they remove nothing from each other; a doc_id of another
    type than integers is ordered as Spark orders it; an empty table gives an empty result; further columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    if isinstance(rows.schema["doc_id"].dataType, T.IntegralType):
        removed = repeated_windows(rows).withColumnRenamed("doc_id", "_id")
        rows = rows.join(removed, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "removed")
    else:
        places = stored(global_rank(rows.where("doc_id is not null").select(F.col("doc_id").alias("_given")).distinct(), [F.col("_given")], "_place"))
        rows = stored(rows.join(places, F.col("doc_id") == F.col("_given"), "left").select("doc_id", "text", "_place"))
        removed = repeated_windows(rows.select(F.col("_place").alias("doc_id"), "text")).withColumnRenamed("doc_id", "_id")
        rows = rows.join(removed, F.col("_place") == F.col("_id"), "left").select("doc_id", "text", "removed")
    return rows.mapInArrow(_kept, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept string")


def op3_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op3_fm_index": op3_fm_index}

ORACLES = {
    "op3_fm_index": r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
places AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 12), ' ')) AS k
  FROM w, unnest(generate_series(1, len(w) - 12)) AS t(i) WHERE len(w) >= 13),
firsts AS (SELECT k, min(doc_id) AS first_doc FROM places GROUP BY k),
hits AS (SELECT doc_id, list(i) AS starts FROM places JOIN firsts USING (k) WHERE first_doc < doc_id GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, s + j AS p FROM hits, unnest(starts) AS t(s), generate_series(0, 12) AS g(j)),
gone_lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, list(x ORDER BY n) AS kept
  FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS n FROM w) a
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = a.doc_id AND g.p = a.n) GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(len(g.ps), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(k.kept, ' '), '')) AS kept_sha256
FROM w LEFT JOIN gone_lists g USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
}
