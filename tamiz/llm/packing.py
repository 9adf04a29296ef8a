"""Best-fit packing of documents into sequences by bulk-synchronous rounds.

Pieces of one length are interchangeable, and so are sequences with the same gap, so documents and gaps
are sorted ranges: (length, pieces left, next rank) and (gap, first sequence, sequences). Lengths are
taken in phases from the longest down. A round is one sweep over both, sorted by size: the longest
length ranks first, and takes the least gaps that hold it and that no longer one has taken. In the sweep
this is the matching of brackets, gaps opening and lengths closing, so running sums tell every pair at
once. What the pieces fill is cut from the ranges of gaps, and the next round begins. When a round
matches nothing, what is left of the phase opens new sequences.

There are at most CAPACITY lengths and gaps whatever the corpus holds, so a round works on a few
thousand rows at most, kept in one partition so that it needs no shuffle. Tokens, ranks and places of
the pieces are made over the whole corpus in parallel.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.llm import bytesnp as B
from tamiz.llm.common import documents, stored

CAPACITY = 1024
END_ID = 2
#: Texts are tokenized in groups of about this many bytes.
UNIT_BYTES = 8 << 20
#: Units are joined to strings of about this many bytes.
STRING_BYTES = 1 << 14
#: White space in any sense of the word, but for tabs, blanks and line ends.
WHITE = r"[\x{b}\x{c}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


class Ids:
    """Ids of whole texts by the tokenizer's own file.

    The tokenizer never joins a character that isn't white space with white space after it, so a text is
    the sequence of its units: a blank or line feed that follows such a character begins one. The distinct
    units of a group of texts are tokenized once, one after the other in long strings; as tokens are
    pieces of bytes, their lengths tell which token belongs to which unit. Texts with an added token's
    string, or with white space beyond ASCII, are tokenized whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # In the vocabulary of a byte-level tokenizer, a token has one character for each of its bytes.
        self.n_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.n_bytes[i] = len(token)

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of_units(self, units: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in order, and how many each has."""
        raw, at = B.texts(units)
        first, last = raw[np.minimum(at[:-1], len(raw) - 1)], raw[at[1:] - 1]
        second = raw[np.minimum(at[:-1] + 1, len(raw) - 1)]
        plain = (np.diff(at) > 1) & ((first == 0x20) | (first == 0x0A)) & (second > 0x20) & (last > 0x20)
        lengths = np.zeros(len(units), np.int64)
        parts, owners = [], []
        for some in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            if not len(some):
                continue
            chosen = units.take(pa.array(some))
            if plain[some[0]]:
                data, cuts = B.texts(chosen)
                runs = [0, *np.unique(np.searchsorted(cuts, np.arange(cuts[0] + STRING_BYTES, cuts[-1], STRING_BYTES))).tolist(), len(some)]
                ids = np.concatenate(self.encoded([data[cuts[x] : cuts[y]].tobytes().decode() for x, y in zip(runs, runs[1:]) if x < y]))
                ends = np.cumsum(self.n_bytes[ids])
                n = np.diff(np.append(0, np.searchsorted(ends, cuts[1:] - cuts[0], "right")))
            else:
                each = self.encoded(chosen.to_pylist())
                n, ids = np.array([len(x) for x in each], np.int64), np.concatenate(each)
            lengths[some] = n
            parts.append(ids)
            owners.append(np.repeat(some, n))
        if not parts:
            return np.zeros(0, "<u4"), lengths
        ids, owner = np.concatenate(parts), np.concatenate(owners)
        return ids[np.argsort(owner, kind="stable")], lengths

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, END_ID after each text, and the n+1 bounds of the texts among them."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(column, WHITE)
        for token in self.added:
            whole = pc.or_(whole, pc.match_substring(column, token))
        whole = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if len(whole):
            kept = np.ones(len(column), bool)
            kept[whole] = False
            given = self.encoded(column.take(pa.array(whole)).to_pylist())
            column = pc.if_else(pa.array(kept), column, "")
        raw, at = B.texts(column)
        b, at = np.ascontiguousarray(raw[int(at[0]) : int(at[-1])]), at - at[0]
        cut = np.zeros(len(b), bool)
        cut[1:] = ((b[1:] == 0x20) | (b[1:] == 0x0A)) & (b[:-1] > 0x20)
        cut[at[:-1][at[:-1] < at[1:]]] = True
        begin = np.flatnonzero(cut)
        coded = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(b)).astype(np.int64)), pa.py_buffer(b)).dictionary_encode()
        flat, lengths = self.of_units(coded.dictionary)
        first = np.cumsum(lengths) - lengths
        codes = coded.indices.to_numpy()
        n = lengths[codes]
        ends = np.cumsum(n)
        totals = np.append(0, ends)[np.searchsorted(begin, at)]
        ids = flat[np.arange(int(totals[-1])) + np.repeat(first[codes] - (ends - n), n)]
        if len(whole):
            ids = np.insert(ids, np.repeat(totals[whole], [len(x) for x in given]), np.concatenate(given))
            more = np.zeros(len(totals), np.int64)
            more[whole + 1] = [len(x) for x in given]
            totals = totals + np.cumsum(more)
        out = np.full(len(ids) + len(column), END_ID, "<u4")
        out[np.arange(len(ids)) + np.repeat(np.arange(len(column)), np.diff(totals))] = ids
        return out, totals + np.arange(len(totals))


def pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32; and part, nth: the task and the place among its pieces of that length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core only
        ids_of, seen, part = Ids(tokenizer), np.zeros(CAPACITY + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            _, at = B.texts(batch.column("text"))
            for i, j in B.groups(at, UNIT_BYTES):
                ids, bounds = ids_of.batch(batch.column("text").slice(i, j - i))
                n = np.diff(bounds)
                count = -(-n // CAPACITY)
                row = np.repeat(np.arange(j - i), count)
                k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = (n - 1) % CAPACITY + 1
                start = np.where(k == 0, 0, head[row] + (k - 1) * CAPACITY)
                length = np.where(k == 0, head[row], CAPACITY)
                begin = bounds[row] + start
                crc = [zlib.crc32(ids[x:y]) for x, y in zip(begin.tolist(), (begin + length).tolist())]
                order = np.argsort(length, kind="stable")
                sizes, first, counts = np.unique(length[order], return_index=True, return_counts=True)
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - np.repeat(first, counts) + np.repeat(seen[sizes], counts)
                seen[sizes] += counts
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column("doc_id"), pa.array(row + i)), pa.array(k, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc)), pa.array(np.full(len(row), part), pa.int32()), pa.array(nth)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long, part int, nth long")


#: Lengths of a phase are at most CAPACITY // k, and more than CAPACITY // the next k.
PHASES = (1, 2, 3, 4, 8, 64)
_RUNNING = (Window.unboundedPreceding, Window.currentRow)
_EARLIER = (Window.unboundedPreceding, -1)


def _sum(x: str, by: str | None, *order: Column, rows=_EARLIER) -> Column:
    """Running sum; without ``by`` over all rows, which are at most the ranges of a round."""
    return F.coalesce(F.sum(x).over(Window.partitionBy(by if by else F.lit(1)).orderBy(*order).rowsBetween(*rows)), F.lit(0))


def _matched(items: DataFrame, gaps: DataFrame) -> DataFrame:
    """One round: (gap, length, first, last, sequence, sequences, per): pieces of rank first to last go to
    that many sequences from ``sequence`` on, ``per`` to each and fewer to the last."""
    sizes = gaps.agg(F.sort_array(F.collect_set("gap")).alias("gaps"))  # one row of at most CAPACITY numbers
    wants = items.crossJoin(F.broadcast(sizes)).withColumn("least", F.array_min(F.filter("gaps", lambda g: g >= F.col("length")))).where("least is not null")
    # A length asks for as many sequences as it would need if all had its successor's gap.
    need = F.ceil(F.col("left") / F.floor(F.col("least") / F.col("length")))
    runs = wants.select(F.col("length").alias("size"), (-need).alias("step"), F.lit(1).alias("closes"), F.col("rank").alias("at"), "left").unionByName(
        gaps.select(F.col("gap").alias("size"), F.col("sequences").alias("step"), F.lit(0).alias("closes"), F.col("sequence").alias("at"), F.lit(0).cast("long").alias("left")))
    runs = runs.withColumn("height", _sum("step", None, F.col("size").desc(), "closes", "at", rows=_RUNNING))
    runs = runs.withColumn("low", F.least("height", F.col("height") - F.col("step"))).withColumn("high", F.greatest("height", F.col("height") - F.col("step")))
    cuts = runs.select(F.explode(F.array("low", "high")).alias("cut")).distinct()
    cuts = cuts.withColumn("until", F.lead("cut").over(Window.partitionBy(F.lit(1)).orderBy("cut")))
    levels = runs.join(cuts, (F.col("cut") >= F.col("low")) & (F.col("cut") < F.col("high")))
    # At each level, what a length closes is what was opened last.
    order = Window.partitionBy("cut").orderBy(F.col("size").desc(), "closes", "at")
    opened = F.lag(F.struct("closes", F.col("size").alias("gap"), (F.col("at") + F.col("cut") - F.col("low")).alias("sequence"))).over(order)
    met = levels.withColumn("opened", opened).where("closes = 1 and opened.closes = 0")
    met = met.select(F.col("size").alias("length"), "at", "left", "opened.gap", "opened.sequence", (F.col("until") - F.col("cut")).alias("sequences"))
    met = met.withColumn("per", F.floor(F.col("gap") / F.col("length"))).withColumn("room", F.col("sequences") * F.col("per"))
    met = met.withColumn("done", _sum("room", "length", F.col("gap"), F.col("sequence")))
    takes = F.least("room", F.col("left") - F.col("done"))
    met = met.where("done < left").withColumn("takes", takes)
    return met.select("gap", "length", (F.col("at") + F.col("done")).alias("first"), (F.col("at") + F.col("done") + F.col("takes")).alias("last"), "sequence", F.ceil(F.col("takes") / F.col("per")).alias("sequences"), "per")


def _gaps_after(placed: DataFrame) -> DataFrame:
    """Ranges of gaps that placed ranges leave: the full sequences, and the last one if it holds fewer pieces."""
    pieces = F.col("last") - F.col("first")
    full = F.floor(pieces / F.col("per"))
    left = F.array(
        F.struct((F.col("gap") - F.col("per") * F.col("length")).alias("gap"), F.col("sequence"), full.alias("sequences")),
        F.struct((F.col("gap") - (pieces - full * F.col("per")) * F.col("length")).alias("gap"), (F.col("sequence") + full).alias("sequence"), (F.col("sequences") - full).alias("sequences")),
    )
    return placed.select(F.explode(left).alias("g")).select("g.*").where("gap > 0 and sequences > 0")


def _untouched(gaps: DataFrame, placed: DataFrame) -> DataFrame:
    """Ranges of gaps less the sequences that got pieces."""
    end = F.col("sequence") + F.col("sequences")
    took = placed.select(F.col("sequence").alias("from"), end.alias("to"))
    inside = gaps.withColumn("end", end).join(took, (F.col("from") >= F.col("sequence")) & (F.col("from") < F.col("end")), "left")
    order = Window.partitionBy("sequence").orderBy("from")
    # What lies before each taken part, and behind the last.
    begin = F.coalesce(F.lag("to").over(order), F.col("sequence"))
    last = F.lead("from").over(order).isNull()
    parts = inside.select("gap", F.array(
        F.struct(begin.alias("sequence"), (F.coalesce("from", "end") - begin).alias("sequences")),
        F.struct(F.coalesce("to", "end").alias("sequence"), F.when(last, F.col("end") - F.coalesce("to", "end")).otherwise(0).alias("sequences"))).alias("parts"))
    return parts.select("gap", F.explode("parts").alias("g")).select("gap", "g.*").where("sequences > 0")


def _items_after(items: DataFrame, placed: DataFrame) -> DataFrame:
    done = placed.groupBy(F.col("length").alias("_length")).agg(F.sum(F.col("last") - F.col("first")).alias("done"))
    rows = items.join(done, F.col("length") == F.col("_length"), "left").withColumn("done", F.coalesce("done", F.lit(0)))
    return rows.select("length", (F.col("left") - F.col("done")).alias("left"), (F.col("rank") + F.col("done")).alias("rank")).where("left > 0")


def _opened(items: DataFrame, k: int, next_sequence: int, capacity: int) -> DataFrame:
    """New sequences for lengths without a gap, as placed ranges with their offset.

    Each length fills sequences of its own; its last pieces that fill none are dealt, the longest first:
    k to a sequence where k is small, else as many as begin within the tokens that leave room for one more.
    """
    longest = F.col("length").desc()
    rows = items.withColumn("per", F.floor(F.lit(capacity) / F.col("length"))).withColumn("full", F.floor(F.col("left") / F.col("per")))
    rows = rows.withColumn("rest", F.col("left") - F.col("full") * F.col("per")).withColumn("before", _sum("full", None, longest))
    rows = rows.withColumn("all_full", F.sum("full").over(Window.partitionBy(F.lit(1)))).withColumn("next", F.col("rank") + F.col("full") * F.col("per"))
    ranges = rows.where("full > 0").select(
        F.lit(capacity).cast("long").alias("gap"), "length", F.col("rank").alias("first"), F.col("next").alias("last"), (F.lit(next_sequence) + F.col("before")).alias("sequence"), F.col("full").alias("sequences"), "per")
    ones = rows.where("rest > 0").select("length", "all_full", "next", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest") - 1)).alias("j"))
    ones = ones.select("length", "all_full", (F.col("next") + F.col("j")).alias("first"))
    dealt = F.floor((F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(longest, "first")) - 1) / k) if k < 4 else F.floor(_sum("length", None, longest, F.col("first")) / (capacity - capacity // k + 1))
    ones = ones.withColumn("sequence", F.lit(next_sequence) + F.col("all_full") + dealt)
    ones = ones.withColumn("gap", F.lit(capacity) - _sum("length", "sequence", longest, F.col("first")))
    return ranges.unionByName(ones.select("gap", "length", "first", (F.col("first") + 1).alias("last"), "sequence", F.lit(1).cast("long").alias("sequences"), F.lit(1).cast("long").alias("per")))


def rounds(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``counts`` (length, n) → (length, first, last, sequence, gap, per): the piece of that length and
    rank r, first <= r < last, lies in ``sequence`` + (r - first) / per, behind capacity - ``gap`` tokens
    and the (r - first) % per pieces of its range before it."""
    spark = counts.sparkSession
    held = lambda df: stored(df.coalesce(1))
    as_state = lambda items, gaps: items.select(F.lit(True).alias("item"), F.col("length").alias("x"), F.col("left").alias("y"), F.col("rank").alias("z")).unionByName(
        gaps.select(F.lit(False).alias("item"), F.col("gap").alias("x"), F.col("sequence").alias("y"), F.col("sequences").alias("z")))
    items_of = lambda state, low=0: state.where(F.col("item") & (F.col("x") > low)).select(F.col("x").alias("length"), F.col("y").alias("left"), F.col("z").alias("rank")).coalesce(1)
    gaps_of = lambda state: state.where("not item").select(F.col("x").alias("gap"), F.col("y").alias("sequence"), F.col("z").alias("sequences")).coalesce(1)
    no_gaps = spark.createDataFrame([], "gap long, sequence long, sequences long")
    items = counts.where("n > 0").select(F.col("length").cast("long").alias("length"), F.col("n").cast("long").alias("left"), F.lit(0).cast("long").alias("rank"))
    state, next_sequence, done = held(as_state(items, no_gaps)), 0, []
    for k, after in zip(PHASES, [*PHASES[1:], capacity + 1]):
        low = capacity // after
        while not (phase := items_of(state, low)).isEmpty():
            gaps = gaps_of(state)
            placed = held(_matched(phase, gaps))
            if matched := not placed.isEmpty():
                gaps = _untouched(gaps, placed.coalesce(1)).unionByName(_gaps_after(placed))
            else:
                placed = held(_opened(phase, k, next_sequence, capacity))
                next_sequence = placed.agg(F.max(F.col("sequence") + F.col("sequences"))).first()[0]
                # Of single pieces that share a new sequence, the last one tells its gap.
                new = _gaps_after(placed).groupBy("sequence").agg(F.min("gap").alias("gap"), F.max("sequences").alias("sequences"))
                full = placed.groupBy("sequence").agg(F.min(F.col("gap") - F.col("per") * F.col("length")).alias("least")).where("least = 0").select("sequence")
                gaps = gaps.unionByName(new.join(full, "sequence", "left_anti").select("gap", "sequence", "sequences"))
            done.append(placed.select("length", "first", "last", "sequence", "gap", "per"))
            state = held(as_state(_items_after(items_of(state), placed.coalesce(1)), gaps))
            if not matched:
                break
    out = spark.createDataFrame([], "length long, first long, last long, sequence long, gap long, per long")
    for placed in done:
        out = out.unionByName(placed)
    return held(out)


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row a piece with sequence_id and offset.

    A null or empty text is its end id alone; repeated rows are packed each; a document of any
    length is tokenized whole; an empty table gives an empty result; further columns are ignored.
    """
    cut = stored(pieces(docs, tokenizer))
    parts = stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")))
    runs = rounds(parts.groupBy("length").agg(F.sum("n").alias("n"))).withColumnRenamed("length", "_length")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = cut.join(parts.select("part", "length", before.alias("before")), ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    # The rounds' ranges are a few thousand rows, whatever the corpus holds.
    found = ranked.join(F.broadcast(runs), (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    nth = F.col("rank") - F.col("first")
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.floor(nth / F.col("per"))).alias("sequence_id"),
        (CAPACITY - F.col("gap") + nth % F.col("per") * F.col("length")).alias("offset"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir), tokenizer_path())


QUERIES = {"op8_best_fit": op8_best_fit}
ORACLES: dict[str, str] = {}
