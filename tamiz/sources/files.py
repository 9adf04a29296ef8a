"""Sources: tables in files of any format, as lazy DataFrames."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tamiz.functions.text import ACCENTS
from tamiz.operators.stage import staged

# Fixed values.
SEPARATORS = [",", ";", "\t", "|"]
ENCODINGS = ["utf-8", "iso-8859-1"]
FORMATS = {"csv", "txt", "tsv", "json", "jsonl", "ndjson", "parquet"}
SNIFFED_LINES = 20
OVERLAP = 0.70

_s, _i, _f = T.StringType(), T.IntegerType(), T.FloatType()
_schema = lambda **c: T.StructType([T.StructField(k, v) for k, v in c.items()])
#: Typed tables of title data, by view.
TITLE_SCHEMAS = {
    "title_basics": _schema(tconst=_s, titleType=_s, primaryTitle=_s, originalTitle=_s, isAdult=_s, startYear=_i, endYear=_i, runtimeMinutes=_i, genres=_s),
    "title_ratings": _schema(tconst=_s, averageRating=_f, numVotes=_i),
    "title_principals": _schema(tconst=_s, ordering=_i, nconst=_s, category=_s, job=_s, characters=_s),
    "title_crew": _schema(tconst=_s, directors=_s, writers=_s),
    "title_akas": _schema(titleId=_s, ordering=_i, title=_s, region=_s, language=_s, types=_s, attributes=_s, isOriginalTitle=_s),
    "title_episode": _schema(tconst=_s, parentTconst=_s, seasonNumber=_i, episodeNumber=_i),
    "name_basics": _schema(nconst=_s, primaryName=_s, birthYear=_i, deathYear=_i, primaryProfession=_s, knownForTitles=_s),
}


@dataclass
class Table:
    name: str
    df: DataFrame
    origin: str
    kind: str
    #: Lines of delimited input with another number of fields than the header's.
    rejected: DataFrame | None = None


@dataclass
class Found:
    tables: dict[str, Table] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def table_name(path: str) -> str:
    """The file's name without accents and signs, t_ before a digit, 120 characters at most."""
    stem = re.sub(r"\.[^.]*$", "", path.rstrip("/").rsplit("/", 1)[-1]).translate(str.maketrans(*ACCENTS))
    name = re.sub("[^A-Za-z0-9]+", "_", stem).strip("_").lower() or "table"
    return (f"t_{name}" if name[0].isdigit() else name)[:120]


def distinct_names(names: list[str]) -> list[str]:
    out: list[str] = []
    for n in names:
        k, unique = 2, n
        while unique in out:
            unique, k = f"{n}_{k}", k + 1
        out.append(unique)
    return out


def exists(spark: SparkSession, path: str) -> bool:
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(top)


def listing(spark: SparkSession, path: str) -> list[str]:
    """Files, and folders of part files, in a folder of any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.getFileStatus(top).isDirectory():
        return [path]
    return sorted(s.getPath().toString() for s in fs.listStatus(top) if s.getPath().getName()[0] not in "._~")


def discover_tables(spark: SparkSession, path: str) -> Found:
    """Named tables of a file or folder. A file that can't be read is noted and the others go on."""
    paths = listing(spark, path)
    found = Found()
    for name, p in zip(distinct_names([table_name(p) for p in paths]), paths):
        kind = p.rsplit(".", 1)[-1].lower()
        try:
            if kind not in FORMATS:
                raise ValueError(f"unknown format {kind}; supported: {', '.join(sorted(FORMATS))}")
            if kind in ("csv", "txt", "tsv"):
                scan = scan_delimited(spark, p, "\t" if kind == "tsv" else None)
                found.tables[name] = Table(name, scan.rows, p, kind, scan.rejected)
            else:
                found.tables[name] = Table(name, read(spark, p, kind), p, kind)
        except Exception as error:  # noqa: BLE001  one bad file must not stop the others
            found.errors[p] = str(error)[:300]
    if not found.tables and len(paths) == 1 and found.errors:
        raise ValueError(next(iter(found.errors.values())))
    return found


def read(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    kind = kind or path.rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind in ("jsonl", "ndjson"):
        return flattened(spark.read.json(path))
    if kind == "json":
        return read_json(spark, path)
    return read_delimited(spark, path, "\t" if kind == "tsv" else None)


def sniff_separator(lines: list[str]) -> str:
    """The separator that splits the first lines into most columns, equally often; a comma if none does."""
    best, most = ",", 0
    for s in SEPARATORS:
        counts = [line.count(s) for line in lines]
        if counts and min(counts) > 0 and counts.count(counts[0]) * 2 > len(counts) and counts[0] > most:
            best, most = s, counts[0]
    return best


def header_row(lines: list[list[str]], most: int = 10) -> int:
    """The row that looks most like a header: text, few blanks, numbers below."""
    number = re.compile(r"^\s*[-+]?[0-9]+([.,][0-9]+)*\s*$")
    best, top = 0, None
    for i, row in enumerate(lines[:most]):
        filled = [c for c in row if c.strip()]
        below = lines[i + 1] if i + 1 < len(lines) else []
        score = 2 * (bool(filled) and sum(not number.match(c) for c in filled) > 0.6 * len(row))
        score += 2 * any(number.match(c) for c in below) + (len(row) - len(filled) < 0.3 * max(len(row), 1))
        score -= sum(c.startswith("Unnamed") for c in row)
        if top is None or score > top:
            best, top = i, score
    return best


@dataclass
class Scan:
    """A delimited input: its rows, and (file, reason, kept, line) of the lines that don't have the header's number of fields."""

    rows: DataFrame
    rejected: DataFrame


#: A table of a row a file is broadcast up to this many.
BROADCAST_FILES = 100_000
TOO_MANY, TOO_FEW, UNCLOSED = "too many fields", "too few fields", "unclosed quote"
def file_kinds(spark: SparkSession, path: str, encoding: str | None = None) -> dict[tuple[str, bool], list[str]]:
    """Files by encoding and by whether a line has an odd number of quotes, as told by all their lines. Files all of one
    kind are named by ``path`` alone."""
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    odd = _quotes(F.col("value")) % 2 == 1
    latin = F.lit(encoding != ENCODINGS[0]) if encoding else F.bool_or(~F.is_valid_utf8("value"))
    seen = text.groupBy("file").agg(latin.alias("latin"), F.bool_or(odd).alias("odd"))
    kinds: dict[tuple[str, bool], list[str]] = {}
    for r in seen.groupBy("latin", "odd").agg(F.array_sort(F.collect_list("file")).alias("files")).collect():  # names of files, which Spark's driver lists too
        kinds[encoding or ENCODINGS[r["latin"]], r["odd"]] = [unquote(f) for f in r["files"]]
    return {k: [path] for k in kinds} if len(kinds) == 1 else kinds or {(encoding or ENCODINGS[0], False): [path]}


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"')))


def _after(inside: Column, piece: Column) -> Column:
    """Whether what follows a piece between separators is inside quotes (1 or 0). A quote opens a field only at its beginning."""
    return F.when((inside == 1) | piece.startswith('"'), (inside + _quotes(piece)) % 2).otherwise(F.lit(0))


def _state_after(line: Column, separator: str, inside: int) -> Column:
    pieces = F.aggregate(F.split(line, re.escape(separator)), F.lit(inside), lambda s, p: _after(s, p))
    return F.when(F.contains(line, F.lit('"')), pieces).otherwise(F.lit(inside))


def _field_count(line: Column, separator: str) -> Column:
    """Separators within quotes end no field."""
    start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("n"))

    def step(a: Column, p: Column) -> Column:
        after = _after(a["s"], p)
        return F.struct(after.alias("s"), (a["n"] + (after == 0).cast("int")).alias("n"))

    return F.aggregate(F.split(line, re.escape(separator)), start, step)["n"]


def lines_of(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """(file, block, id, value): physical lines; ids of one block of a file rise with its lines."""
    # The reader hands on bytes as they are.
    value = F.col("value") if encoding == ENCODINGS[0] else F.decode(F.col("value").cast("binary"), encoding)
    text = spark.read.text(paths)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), value.alias("value"))


def whole_records(lines: DataFrame, separator: str) -> DataFrame:
    """(file, place, value, closed): lines joined where a quoted field goes on, and the record's place in its file.

    Files stay split. What a line does to the state "inside quotes" is one of four functions: it keeps it, turns it, or sets it either way. Their
    running composition is told by the last line that sets the state and the number of turns since, first within each
    block, then over the blocks of a file. Lines of a record that is never closed stay single, as it would take in all that follows.
    """
    told = lines.withColumns({f"t{k}": _state_after(F.col("value"), separator, k) for k in (0, 1)})
    block = Window.partitionBy("file", "block").orderBy("id")
    until, before = block.rowsBetween(Window.unboundedPreceding, Window.currentRow), block.rowsBetween(Window.unboundedPreceding, -1)
    turns = told.withColumn("turns", F.sum(((F.col("t0") == 1) & (F.col("t1") == 0)).cast("int")).over(until))
    turns = turns.withColumn("fixed", F.when(F.col("t0") == F.col("t1"), (F.col("t0") + F.col("turns")) % 2))
    held = staged(turns.withColumns({
        "n_before": F.coalesce(F.max("turns").over(before), F.lit(0)), "fixed_before": F.last("fixed", True).over(before), "fixed_until": F.last("fixed", True).over(until),
    }).select("file", "block", "id", "value", "turns", "n_before", "fixed_before", "fixed_until"))
    last = F.max_by(F.struct("turns", "fixed_until"), "id")
    inside = lambda s: F.count_if((F.coalesce("fixed_before", F.lit(s)) + F.col("n_before")) % 2 == 0)
    blocks = held.groupBy("file", "block").agg(last.alias("last"), inside(0).alias("if_outside"), inside(1).alias("if_inside"))
    # A file has few blocks: one for each split.
    of_file = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumn("turned", F.sum("last.turns").over(of_file))
    blocks = blocks.withColumn("set", F.when(F.col("last.fixed_until").isNotNull(), (F.col("last.fixed_until") + F.col("last.turns") + F.col("turned")) % 2))
    blocks = blocks.withColumn("after", (F.coalesce(F.last("set", True).over(of_file), F.lit(0)) + F.col("turned")) % 2)
    blocks = blocks.withColumn("state", F.coalesce(F.lag("after").over(of_file), F.lit(0)))
    blocks = blocks.withColumn("starts", F.when(F.col("state") == 0, F.col("if_outside")).otherwise(F.col("if_inside")))
    blocks = blocks.withColumn("first", F.coalesce(F.sum("starts").over(of_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ends_open = F.last("after").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == 1
    blocks = blocks.select("file", "block", "state", "first", ends_open.alias("ends_open"), F.sum("starts").over(Window.partitionBy("file")).alias("all"))
    placed = held.join(blocks, ["file", "block"]).withColumn("starts", (F.coalesce("fixed_before", F.col("state")) + F.col("n_before")) % 2 == 0)
    placed = placed.withColumn("place", F.col("first") + F.sum(F.col("starts").cast("int")).over(until) - 1)
    unclosed = F.col("ends_open") & (F.col("place") == F.col("all") - 1)
    single = placed.where(unclosed).select("file", "place", "value", F.lit(False).alias("closed"))
    gathered = placed.where(~unclosed).groupBy("file", "place").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "id", "value"))), lambda x: x["value"]), "\n").alias("value"))
    return gathered.withColumn("closed", F.lit(True)).unionByName(single)


def placed_lines(lines: DataFrame, n_files: int) -> DataFrame:
    """(file, place, value, closed) of lines that are records; the place is told in a file's first block, and null behind it. Lines stay where
    they were read, as the table of files is broadcast, unless there are too many of them."""
    first = lines.where("block = 0").groupBy(F.col("file").alias("_of")).agg(F.min("id").alias("_start"))
    first = F.broadcast(first) if n_files <= BROADCAST_FILES else first
    place = F.when(F.col("block") == 0, F.col("id") - F.col("_start"))
    return lines.join(first, F.col("file") == F.col("_of"), "left").select("file", place.alias("place"), "value", F.lit(True).alias("closed"))


def records(lines: list[str]) -> list[str]:
    """Lines joined where a quoted field goes on, without a last one that stays open."""
    out: list[str] = []
    for line in lines:
        if out and out[-1].count('"') % 2:
            out[-1] += f"\n{line}"
        else:
            out.append(line)
    return out[:-1] if len(out) > 1 and out[-1].count('"') % 2 else out


def scan_delimited(spark: SparkSession, path: str, separator: str | None = None, encoding: str | None = None) -> Scan:
    """Delimited text, every column a string, and what is wrong with its lines.

    A line with more fields than the header is left out; one with fewer is kept, with nulls; lines of a quoted field
    that is never closed are left out. All three are in ``rejected``. A file is Latin-1 if any of its bytes is not
    UTF-8, unless ``encoding`` tells. Lines before the header are cut by their place in each file. Only files with
    lines of an odd number of quotes have their lines joined, and stay split for it.
    """
    kinds = file_kinds(spark, path, encoding)
    n_files = sum(len(spark.read.text(p).inputFiles()) for p in kinds.values()) if len(kinds) == 1 else sum(map(len, kinds.values()))
    (first_encoding, odd), paths = min(kinds.items(), key=lambda k: k[1])
    lines = [r["value"] for r in lines_of(spark, paths[:1], first_encoding).limit(SNIFFED_LINES).collect()]
    lines = records(lines) if odd else lines
    if lines:
        lines[0] = lines[0].removeprefix("\ufeff")
    separator = separator or sniff_separator(lines)
    first = header_row([line.split(separator) for line in lines])
    header = next(csv.reader([lines[first]], delimiter=separator), []) if lines else []
    names = distinct_names([c.strip() or f"_c{i}" for i, c in enumerate(header)]) or ["value"]
    found = None
    for (coding, quoted), of_kind in kinds.items():
        own = lines_of(spark, of_kind, coding)
        own = whole_records(own, separator) if quoted else placed_lines(own, n_files)
        found = own if found is None else found.unionByName(own)
    body = (F.col("place").isNull() | (F.col("place") > first)) & (F.trim("value") != "")
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))] + [T.StructField("_bad", T.StringType())])
    options = {"sep": separator, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    # Within the case, so that no later filter on a field is tried on the header first.
    parsed = found.where(body).withColumn("r", F.when(body & F.col("closed"), F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)))
    n = _field_count(F.col("value"), separator)
    reason = F.when(~F.col("closed"), F.lit(UNCLOSED)).when(F.col("r._bad").isNotNull(), F.when(n > len(names), F.lit(TOO_MANY)).otherwise(F.lit(TOO_FEW)))
    parsed = parsed.withColumn("reason", reason)
    kept = F.col("reason").isNull() | (F.col("reason") == TOO_FEW)
    rows = parsed.where(kept).select(*[F.col(f"r._{i}").alias(c) for i, c in enumerate(names)])
    return Scan(rows, parsed.where("reason is not null").select("file", "reason", kept.alias("kept"), F.col("value").alias("line")))


def read_delimited(spark: SparkSession, path: str, separator: str | None = None, encoding: str | None = None) -> DataFrame:
    """The rows of ``scan_delimited``."""
    return scan_delimited(spark, path, separator, encoding).rows


def flattened(df: DataFrame) -> DataFrame:
    """Structs as columns with dotted names, at any depth."""
    def leaves(schema: T.StructType, path: str):
        for f in schema.fields:
            at = f"{path}.`{f.name}`" if path else f"`{f.name}`"
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, at)
            else:
                yield F.col(at).alias(at.replace("`", ""))

    return df.select(*leaves(df.schema, ""))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """An array of objects, an object that wraps one, a single object, or JSON lines; nested objects are flattened."""
    df = spark.read.option("multiLine", True).json(path)
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
    if lists and df.limit(2).count() == 1:
        sizes = df.select(*[F.size(F.col(f"`{c}`")).alias(c) for c in lists]).first()
        df = df.select(F.explode(F.col(f"`{max(lists, key=lambda c: sizes[c] or 0)}`")).alias("_r")).select("_r.*")
    elif df.limit(2).count() == 1:
        lines = spark.read.json(path)  # more than one line of objects would show here only
        df = lines if "_corrupt_record" not in lines.columns and lines.limit(2).count() > 1 else df
    return flattened(df)


def read_titles(spark: SparkSession, path: str, view: str) -> DataFrame:
    """A typed TSV of title data, \\N as null."""
    return spark.read.schema(TITLE_SCHEMAS[view]).options(sep="\t", header=True, nullValue=r"\N").csv(path)


def union_parts(parts: dict[str, DataFrame]) -> tuple[DataFrame, list[str]]:
    """Parts of one table under the primary's columns, and the names of parts left out.

    The primary has most columns and filled cells a row; a part joins if its plain names cover enough
    of the primary's. Provenance is added only where there is more than one part.
    """
    plain = lambda c: re.sub("[^a-z0-9]+", "", c.translate(str.maketrans(*ACCENTS)).lower())
    filled = lambda df: df.agg((sum((F.count(F.col(f"`{c}`")) for c in df.columns), F.lit(0)) / F.greatest(F.count("*"), F.lit(1))).alias("x")).first()["x"]
    primary = max(parts, key=lambda n: (len(parts[n].columns) + filled(parts[n]), n))
    want = {plain(c): c for c in parts[primary].columns}
    out, left = None, []
    for name in [primary, *[n for n in parts if n != primary]]:
        have = {plain(c): c for c in parts[name].columns}
        if len(want.keys() & have.keys()) < OVERLAP * len(want):
            left.append(name)
            continue
        one = parts[name].withColumnsRenamed({have[p]: want[p] for p in have if p in want})
        one = one.withColumn("hoja_origen", F.lit(name)) if len(parts) - len(left) > 1 else one
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out, left


def plan_ranges(df: DataFrame, key: str, chunk: int) -> DataFrame:
    """(n, low, high) ranges of an integer key with about ``chunk`` rows each, wider where keys are sparse."""
    span = df.agg(F.min(key).alias("a"), F.max(key).alias("b"), F.count("*").alias("rows")).where("rows > 0")
    step = F.greatest(F.lit(chunk), F.ceil(F.lit(chunk) * (F.col("b") - F.col("a") + 1) / F.col("rows"))).cast("long")
    ranges = span.withColumn("step", step).select("b", "step", F.posexplode(F.sequence("a", "b", "step")).alias("n", "low"))
    return ranges.select("n", "low", F.least(F.col("low") + F.col("step") - 1, F.col("b")).alias("high"))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, chunk: int, **options) -> DataFrame:
    """A database table in range partitions of its key. Databases spell names their own way, so the
    bounds are read by place."""
    row = spark.read.format("jdbc").options(url=url, query=f"SELECT min({key}) AS a, max({key}) AS b, count(*) AS n FROM {table}", **options).load().first()
    low, high, n = row
    parts = max(1, -(-int(n or 1) // chunk))
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=int(low or 0), upperBound=int(high or 0) + 1, numPartitions=parts, **options).load()


def pending(plan: DataFrame, ledger: DataFrame) -> DataFrame:
    """Chunks that the ledger doesn't have as completed."""
    return plan.join(ledger.where(F.col("status") == "completed").select("n"), "n", "left_anti")


def ledger_summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count("*").alias("chunks"), F.sum("rows").alias("rows"), F.sum("retries").alias("retries"), F.round(F.avg("seconds"), 6).alias("mean_seconds"))


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
