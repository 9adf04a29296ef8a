"""Line dedup by content-defined chunks of lines, in SQL functions only.

A rolling hash over the last ROLL line hashes ends a chunk wherever it is 0 modulo DIVISOR, so an
inserted line moves no boundary further down. Chunks of two or more lines that occur more than once in
the corpus are removed but for the first (by doc_id, then place). That takes repeated blocks whole, but
not their edges, which lie in chunks with other lines, nor passages too short to hold a chunk. For
these, each two lines that follow each other outside the repeated chunks are compared in the same way,
so that every repeated run of two or more lines goes whole.

Hashes only find the candidates; equal bytes decide. Texts are read three times and meet other tables
twice, by a shuffle at every size: once for the candidates' bytes, once for what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import documents, let, shuffled, stored

ROLL = 2
DIVISOR = 3
HAS_WORD = r"[^\x20\x09-\x0D]"


def _turned(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits)) if bits else x


def chunks(lines: Column) -> Column:
    """array of (first, last), 1-based lines of each chunk, from the lines of a text."""

    def ends(h: Column) -> Column:
        def roll(i: Column) -> Column:
            parts = [_turned(F.coalesce(F.get(h, i - 1 - j), F.lit(0).cast("long")), j) for j in range(ROLL)]
            out = parts[0]
            for p in parts[1:]:
                out = out.bitwiseXOR(p)
            return out

        return F.filter(F.sequence(F.lit(1), F.size(h)), lambda i: (i == F.size(h)) | (F.pmod(roll(i), F.lit(DIVISOR).cast("long")) == 0))

    hashes = F.transform(lines, lambda x: F.xxhash64(x))
    return let(let(hashes, ends), lambda e: F.transform(e, lambda x, k: F.struct((F.coalesce(F.get(e, k - 1), F.lit(0)) + 1).alias("first"), x.alias("last"))))


def pairs(lines: Column) -> Column:
    """array of (first, last) of each two lines that follow each other."""
    starts = F.when(F.size(lines) > 1, F.sequence(F.lit(1), F.size(lines) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("first"), (i + 1).alias("last")))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _text_of(lines: Column, run: Column) -> Column:
    return F.array_join(F.slice(lines, run["first"], run["last"] - run["first"] + 1), "\n")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, id, text, row): the input row as a struct, so that its columns may have any names, and its key: doc_id
    and the hash of its text, so hashes matter only among rows of one doc_id."""
    return docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"), F.col("text").alias("text"), F.xxhash64("text").alias("row"))


def _with(rows: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``found`` (id, row, ...) by document, in the same way at every size."""
    found = shuffled(found.withColumnsRenamed({"id": "_id", "row": "_row"}))
    return rows.join(found, rows.id.eqNullSafe(F.col("_id")) & (rows.row == F.col("_row")), how).drop("_id", "_row")


_ONE = ("id", "row", "first")


def _cut(rows: DataFrame) -> DataFrame:
    """(id, row, pair, first, last, hash) of each chunk of two or more lines and each pair of lines, in one scan. ``rows`` are (id, row, text)."""

    def pieces(x: Column) -> Column:
        piece = lambda pair: lambda c: F.struct(F.lit(pair).alias("pair"), c["first"].alias("first"), c["last"].alias("last"), F.xxhash64(_text_of(x, c)).alias("hash"))
        several = F.filter(chunks(x), lambda c: c["last"] > c["first"])
        return F.concat(F.transform(several, piece(False)), F.transform(pairs(x), piece(True)))

    return stored(rows.select("id", "row", F.explode(let(_lines(F.col("text")), pieces)).alias("c")).select("id", "row", "c.*"))


def _repeated(cut: DataFrame) -> DataFrame:
    """The pieces whose hash occurs more than once; ``is_first`` marks the first of each hash.

    The hashes are stored before they are joined, so that Spark sees their size and splits a piece that
    very many texts share.
    """
    again = stored(cut.groupBy("hash").agg(F.min(F.struct(*_ONE)).alias("one"), F.count("*").alias("n")).where("n > 1").select("hash", "one"))
    return cut.join(again, "hash").withColumn("is_first", F.struct(*_ONE).eqNullSafe(F.col("one"))).drop("one")


def _candidates(rows: DataFrame) -> DataFrame:
    """(id, row, runs): first and last line of the pieces of each text to be compared by their bytes: repeated
    chunks, and repeated pairs that don't lie within a repeated chunk. Of such chunks, the first one's pairs are
    compared too, as they may be the first of pairs elsewhere."""
    cut = _cut(rows)
    by_chunk = stored(_repeated(cut.where("not pair")))
    inside = by_chunk.where("not is_first").select(F.col("id").alias("_id"), F.col("row").alias("_row"), F.explode(F.sequence("first", F.col("last") - 1)).alias("_first"))
    own = cut.where("pair")
    others = stored(own.join(inside, own.id.eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")) & (F.col("first") == F.col("_first")), "left_anti"))
    every = by_chunk.unionByName(_repeated(others)).groupBy("id", "row")
    return stored(every.agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs")))


def _again(rows: DataFrame) -> DataFrame:
    """(id, row, runs): first and last line of the pieces, with a word in them, that occur before in the corpus, byte by byte."""
    taken = F.explode(let(_lines(F.col("text")), lambda x: F.transform("runs", lambda c: F.struct(c["first"].alias("first"), c["last"].alias("last"), _text_of(x, c).alias("lines")))))
    found = _with(rows, _candidates(rows)).select("id", "row", taken.alias("c")).select("id", "row", "c.*").where(F.rlike("lines", F.lit(HAS_WORD)))
    found = stored(found.withColumn("hash", F.xxhash64("lines")))
    firsts = found.groupBy("hash", "lines").agg(F.min(F.struct(*_ONE)).alias("one"), F.count("*").alias("n")).where("n > 1")
    firsts = stored(firsts.select(F.col("hash").alias("_hash"), F.col("lines").alias("_lines"), "one"))
    again = found.join(shuffled(firsts), (F.col("hash") == F.col("_hash")) & (F.col("lines") == F.col("_lines"))).where(~F.struct(*_ONE).eqNullSafe(F.col("one")))
    return stored(again.groupBy("id", "row").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as ``text``, and ``n_lines``, ``n_removed``.

    A line goes if it stands in a chunk that occurs earlier, or if it and the line before or after it
    occur together earlier; so the first occurrence of a line always stays somewhere. A null text stays null,
    with no lines; an empty text is one empty line; a text may lose all its lines and is then empty. Runs
    without a word stay. A null doc_id comes first. Rows equal in doc_id and text are one document: they
    keep and lose the same lines. Columns named n_lines or n_removed are replaced, others may have any
    name; an empty table gives an empty result.
    """
    docs = docs.drop("n_lines", "n_removed")
    rows = _keyed(docs)
    def kept(x: Column) -> Column:
        gone = F.flatten(F.transform("runs", lambda c: F.sequence(c["first"], c["last"])))
        return let(F.array_except(F.sequence(F.lit(1), F.size(x)), gone), lambda at: F.struct(
            F.array_join(F.transform(at, lambda i: F.get(x, i - 1)), "\n").alias("text"), (F.size(x) - F.size(at)).cast("long").alias("n")))

    told = _with(rows, _again(rows.select("id", "row", "text")), "left").select("doc", "text", F.when(F.col("runs").isNotNull(), let(_lines(F.col("text")), kept)).alias("out"))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(_lines(F.col("text")))).cast("long")
    same = [F.coalesce("out.text", "text").alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns]
    return told.select(*same, n_lines.alias("n_lines"), F.coalesce("out.n", F.lit(0).cast("long")).alias("n_removed"))


def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(documents(spark, sf_dir).select("doc_id", "text"))


QUERIES = {"op5_line_chunks": op5_line_chunks}
ORACLES: dict[str, str] = {}
