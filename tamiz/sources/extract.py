"""Resumable extracts: ranges of a key, each written, checked and recorded by itself.

An extract lives in a folder with two append-only tables. ``data`` holds the rows, in a directory for each chunk
and write (plans of more than DIRECTORIES chunks: for each block of neighbouring chunks, named by its first); ``ledger`` holds one row for each attempt at a chunk. An attempt is recorded only after its rows were
read back and their checksum equals that of the rows sent, so a run that ends at any point leaves either a
recorded chunk or one that the next run reads again. What an unrecorded write left behind is never read, as readers
take only the writes that the ledger names; so nothing has to be deleted, which suits object stores.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.sources.files import exists, listing, plan_ranges

PLAN = "n int, low long, high long, block int"
LEDGER = "n int, low long, high long, write string, status string, rows long, checksum string, error string, seconds double, at timestamp"
#: Chunks written by one job at least.
WAVE = 64
#: Jobs of a run at most, if none fails, so that a table is read as often whatever its size. A job's chunks are what is lost when it ends early.
PASSES = 16
#: Directories of chunks, or of blocks of them, so that files grow with the rows and not with the plan.
DIRECTORIES = 256
#: Attempts at a chunk in one run before it is left as failed.
ATTEMPTS = 3


@dataclass(frozen=True)
class Range:
    """A chunk: keys from low to high, both included; without bounds, the rows whose key is null."""

    n: int
    low: int | None
    high: int | None


def _within(key: str, part: Range) -> Column:
    return F.col(key).isNull() if part.low is None else F.col(key).between(part.low, part.high)


def _runs(parts: list[Range]) -> list[tuple[int, int, int, int]]:
    """(low, high, width, n) of ranges that follow each other without gaps, numbered in order and of one width; the last may be shorter."""
    runs: list[tuple[int, int, int, int]] = []
    last = None
    for p in sorted((p for p in parts if p.low is not None), key=lambda p: p.low):
        wide = p.high - p.low + 1
        if last and p.n == last.n + 1 and p.low == last.high + 1 and wide <= runs[-1][2] == last.high - last.low + 1 and p.high - runs[-1][0] < 2**62:
            runs[-1] = (runs[-1][0], p.high, *runs[-1][2:])
        else:
            runs.append((p.low, p.high, wide, p.n))
        last = p
    return runs


def chunk_of(key: str, parts: list[Range]) -> Column:
    """The number of the chunk that a row's key falls into. Ranges of a plan follow each other, so bounds are told by their order: within
    a run by division, between runs by halving."""
    x = F.col(key)

    def among(runs: list[tuple[int, int, int, int]]) -> Column:
        if len(runs) > 1:
            half = len(runs) // 2
            return F.when(x < runs[half][0], among(runs[:half])).otherwise(among(runs[half:]))
        low, high, width, n = runs[0]
        place = F.call_function("div", x.cast("long") - F.lit(low).cast("long"), F.lit(width).cast("long")) if high - low >= width else F.lit(0)
        return F.when(x.between(low, high), (place + n).cast("int"))

    runs = _runs(parts)
    chunk = among(runs) if runs else F.lit(None).cast("int")
    for p in parts:
        chunk = F.when(x.isNull(), F.lit(p.n)).otherwise(chunk) if p.low is None else chunk
    return chunk


def from_table(df: DataFrame, key: str) -> Callable[[list[Range]], DataFrame]:
    """Reads ranges of a DataFrame; the bounds of the wave reach its scan."""
    def read(parts: list[Range]) -> DataFrame:
        closed = [p for p in parts if p.low is not None]
        wanted = F.col(key).between(min(p.low for p in closed), max(p.high for p in closed)) if closed else F.lit(False)
        wanted = wanted | F.col(key).isNull() if len(closed) < len(parts) else wanted
        return df.where(wanted).withColumn("chunk", chunk_of(key, parts)).where("chunk is not null")

    return read


def from_jdbc(spark: SparkSession, url: str, table: str, key: str, **options) -> Callable[[list[Range]], DataFrame]:
    """Reads ranges of a database table, one query and one task each."""
    def read(parts: list[Range]) -> DataFrame:
        bounds = [f"{key} IS NULL" if p.low is None else f"{key} >= {p.low} AND {key} <= {p.high}" for p in parts]
        rows = spark.read.jdbc(url, table, predicates=bounds, properties={k: str(v) for k, v in options.items()})
        # A partition of the scan is a predicate, in the order given.
        return rows.withColumn("chunk", F.element_at(F.array(*[F.lit(p.n) for p in parts]), F.spark_partition_id() + 1))

    return read


def planned(df: DataFrame, key: str, chunk: int) -> list[Range]:
    """Ranges of about ``chunk`` rows, and one for rows without a key if there are any. One row a chunk comes to the driver."""
    parts = [Range(r["n"], r["low"], r["high"]) for r in plan_ranges(df, key, chunk).orderBy("n").collect()]
    return [*parts, Range(len(parts), None, None)] if df.where(F.col(key).isNull()).limit(1).count() else parts


def _row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _checksum(hashes: Column) -> Column:
    """Of a set of rows with repetitions, in any order: their number and the sum of their hashes."""
    return F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.coalesce(F.sum(hashes.cast("decimal(38,0)")), F.lit(0)).cast("string")), 256)


class Extract:
    """An extract in ``root``. The plan is frozen by the first run and read by later ones."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _has(self, name: str) -> bool:
        return exists(self.spark, f"{self.root}/{name}") and bool(listing(self.spark, f"{self.root}/{name}"))

    def plan(self, parts: list[Range] | None = None) -> list[Range]:
        """The extract's ranges; ``parts`` become its plan if it has none yet."""
        if not self._has("plan"):
            block = max(1, -(-len(parts or []) // DIRECTORIES))
            self.spark.createDataFrame([(p.n, p.low, p.high, block) for p in parts or []], PLAN).coalesce(1).write.parquet(f"{self.root}/plan")
        return [Range(r["n"], r["low"], r["high"]) for r in self._planned().orderBy("n").collect()]

    def _planned(self) -> DataFrame:
        return self.spark.read.schema(PLAN).parquet(f"{self.root}/plan")

    def _block(self) -> int:
        """Neighbouring chunks that share a directory; where there are more than one, a column ``_chunk`` tells them apart."""
        return self._planned().agg(F.max("block")).first()[0] or 1

    def _data(self, path: str) -> DataFrame:
        """Rows under ``path`` with their chunk and write."""
        data = self.spark.read.option("basePath", f"{self.root}/data").parquet(path)
        return data.withColumn("chunk", F.col("_chunk")).drop("_chunk") if "_chunk" in data.columns else data

    def ledger(self) -> DataFrame:
        """All attempts."""
        return self.spark.read.schema(LEDGER).parquet(f"{self.root}/ledger") if self._has("ledger") else self.spark.createDataFrame([], LEDGER)

    def chunks(self) -> DataFrame:
        """Each planned chunk as it stands: pending, completed or failed, its rows, checksum, last error and number of retries."""
        by_time = Window.partitionBy("n").orderBy(F.col("status") == "completed", "at")
        attempts = self.ledger().withColumns({"_last": F.row_number().over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "_all": F.count("*").over(Window.partitionBy("n"))})
        last = attempts.where("_last = _all").select("n", "write", "status", "rows", "checksum", "error", "seconds", (F.col("_all") - 1).alias("retries"))
        return self._planned().drop("block").join(last, "n", "left").fillna({"status": "pending", "retries": 0})

    def pending(self) -> list[Range]:
        left = self.chunks().where("status <> 'completed'").select("n", "low", "high").orderBy("n")
        return [Range(*r) for r in left.collect()]

    def _record(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(f"{self.root}/ledger")

    def _wave(self, read: Callable[[list[Range]], DataFrame], parts: list[Range], block: int) -> None:
        """Writes ``parts`` in one job, each directory in a task of its own, reads them back and records them. Raises before anything is recorded."""
        write, began = f"w{uuid.uuid4().hex}", time.time()  # a letter, so that it is never taken for a number
        rows, sent = read(parts), Observation()
        columns = [c for c in rows.columns if c != "chunk"]
        total = F.coalesce(F.sum(_row_hash(columns).cast("decimal(38,0)")), F.lit(0)).cast("string")
        own = [F.col("chunk").alias("_chunk")] if block > 1 else []
        kept = rows.select(*[F.col(f"`{c}`") for c in columns], *own, (F.col("chunk") - F.col("chunk") % block).cast("int").alias("chunk"))
        kept = kept.repartition(len({p.n // block for p in parts}), "chunk")
        kept.observe(sent, F.count("*").alias("n"), total.alias("total")).withColumn("write", F.lit(write)).write.mode("append").partitionBy("chunk", "write").parquet(f"{self.root}/data")
        found = {}
        if sent.get["n"]:
            back = self._data(f"{self.root}/data/*/write={write}")
            told = back.groupBy("chunk").agg(F.count("*").alias("n"), _checksum(_row_hash(columns)).alias("checksum"), F.sum(_row_hash(columns).cast("decimal(38,0)")).cast("string").alias("total"))
            found = {r["chunk"]: r for r in told.collect()}  # one row a chunk of the wave
        if found.keys() - {p.n for p in parts} or sum(r["n"] for r in found.values()) != sent.get["n"] or sum(int(r["total"]) for r in found.values()) != int(sent.get["total"] or 0):
            raise OSError(f"write {write} reads back other rows than were sent")
        each = (time.time() - began) / len(parts)
        now = datetime.now()
        empty = self.spark.range(0).agg(_checksum(F.col("id")).alias("c")).first()["c"] if len(found) < len(parts) else None
        self._record([(p.n, p.low, p.high, write, "completed", found[p.n]["n"] if p.n in found else 0, found[p.n]["checksum"] if p.n in found else empty, None, each, now) for p in parts])

    def run(self, read: Callable[[list[Range]], DataFrame], wave: int | None = None, attempts: int = ATTEMPTS, waves: int | None = None) -> None:
        """Reads what is not recorded as completed, in jobs of ``wave`` chunks (by default a sixteenth of it, WAVE at least); at most ``waves`` of them.

        A job that fails is taken apart, down to jobs of WAVE chunks at most and then to single ones, so one bad range holds up no other. Each
        failure of a chunk is recorded with its error; after ``attempts`` in this run it is left as failed, and the next run takes it up again.
        """
        left, block = self.pending(), self._block()
        wave = wave or max(WAVE, -(-len(left) // PASSES))
        for k in range(0, len(left), wave)[:waves]:
            self._attempt(read, left[k : k + wave], block, attempts)

    def _attempt(self, read: Callable[[list[Range]], DataFrame], parts: list[Range], block: int, attempts: int) -> None:
        try:
            return self._wave(read, parts, block)
        except Exception as error:  # noqa: BLE001  told apart below
            if len(parts) == 1:
                self._failed(parts[0], error)
        if len(parts) > WAVE:
            step = -(-len(parts) // PASSES)
            for k in range(0, len(parts), step):
                self._attempt(read, parts[k : k + step], block, attempts)
            return
        for p in parts:
            for _ in range(attempts - (len(parts) == 1)):
                try:
                    self._wave(read, [p], block)
                    break
                except Exception as error:  # noqa: BLE001  one bad range must not stop the others
                    self._failed(p, error)

    def _failed(self, p: Range, error: Exception) -> None:
        self._record([(p.n, p.low, p.high, None, "failed", None, None, str(error)[:300], None, datetime.now())])

    def rows(self) -> DataFrame:
        """The rows of all completed chunks, from the writes that the ledger names."""
        place = F.row_number().over(Window.partitionBy("write").orderBy("n"))
        done = self.chunks().where("status = 'completed'").select("n", "write").withColumn("_run", F.col("n") - place)
        done = done.groupBy("write", "_run").agg(F.min("n").alias("_first"), F.max("n").alias("_last")).withColumnRenamed("write", "_write")
        data = self._data(f"{self.root}/data")
        named = (F.col("write") == F.col("_write")) & F.col("chunk").between(F.col("_first"), F.col("_last"))
        kept = data.join(F.broadcast(done), named)  # a row for each run of chunks of a write: one a wave, and one more for each gap
        return kept.select("chunk", *[F.col(f"`{c}`") for c in data.columns if c not in ("chunk", "write")])

    def damaged(self) -> DataFrame:
        """(n, rows, found) of completed chunks whose data no longer give the recorded checksum."""
        data = self.rows()
        now = data.groupBy("chunk").agg(F.count("*").alias("found"), _checksum(_row_hash([c for c in data.columns if c != "chunk"])).alias("now"))
        done = self.chunks().where("status = 'completed' and rows > 0")
        return done.join(now, done.n == now.chunk, "left").where(~F.col("checksum").eqNullSafe(F.col("now"))).select("n", "rows", F.coalesce("found", F.lit(0)).alias("found"))

    def summary(self) -> DataFrame:
        """By status: chunks, rows, retries, and mean seconds of a chunk."""
        return self.chunks().groupBy("status").agg(F.count("*").alias("chunks"), F.sum("rows").alias("rows"), F.sum("retries").alias("retries"), F.avg("seconds").alias("mean_seconds"))
