"""Sinks: where clean, rejected and summed rows go."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Rows of one file at most.
FILE_ROWS = 2_000_000
#: Bytes that a task hashes as one value; longer files are hashed in ranges of so many.
BLOCK = 64 * 2**20
#: Bytes of a range that are held at once.
PIECE = 2**20


def flat(df: DataFrame) -> DataFrame:
    """Lists as a;b (nothing for null), structs and maps as JSON, for sinks that hold text only."""
    out = []
    for f in df.schema.fields:
        x = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            x = F.coalesce(F.array_join(x.cast("array<string>"), ";"), F.lit("")) if not isinstance(f.dataType.elementType, T.StructType) else F.to_json(x)
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            x = F.to_json(x)
        out.append(x.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = (), compression: str = "snappy") -> int:
    """Overwrites; lists stay lists. Returns the rows written, from the files' own statistics."""
    df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).option("compression", compression).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path).count()


def write_zstd(df: DataFrame, path: str, level: int = 3, block: int = BLOCK) -> DataFrame:
    """ZSTD files, and (path, bytes, checksum) of each by MD5."""
    df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    return checksums(df.sparkSession, path, "md5", block=block)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file that Hadoop calls file:/x, s3a://x and so on."""
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        return pafs.LocalFileSystem(), re.sub("^/+", "/", rest)
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", quote(path, safe=":/@")))


def _ranges_hashed(kind: str):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, start, size in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size"))):
                digest, left = hashlib.new(kind), size
                fs, name = _opened(path)
                with fs.open_input_file(name) as file:
                    file.seek(start)
                    while left:
                        piece = file.read(min(PIECE, left))
                        if not piece:
                            raise OSError(f"{path} ends before byte {start + size}")
                        digest.update(piece)
                        left -= len(piece)
                out.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("bytes"), batch.column("nth"), pa.array(out, pa.string())], ["path", "bytes", "nth", "digest"])

    return hashed


def checksums(spark: SparkSession, path: str, kind: str = "sha256", files: str = "*.parquet", block: int = BLOCK) -> DataFrame:
    """(path, bytes, checksum) of the files that a pattern names, of any size.

    A file of at most ``block`` bytes has its plain digest. A longer one is hashed in ranges of ``block`` bytes, each in a
    task of its own that holds PIECE bytes; its checksum is the digest of its ranges' hex digests in order, then "-" and
    their number, as object stores name what was uploaded in parts.
    Files without bytes are not listed, as Spark scans none.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", files).option("recursiveFileLookup", True).load(path)
    digest = F.md5 if kind == "md5" else lambda x: F.sha2(x, 256)
    small = found.where(F.col("length") <= block).select("path", F.col("length").alias("bytes"), digest(F.col("content")).alias("checksum"))
    ranges = found.where(F.col("length") > block).select("path", F.col("length").alias("bytes"), F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block).cast("long"))).alias("nth", "start"))
    ranges = ranges.withColumn("size", F.least(F.lit(block).cast("long"), F.col("bytes") - F.col("start"))).repartition(spark.sparkContext.defaultParallelism, "path", "nth")  # a number, as these rows are too small for Spark to keep apart
    parts = ranges.mapInArrow(_ranges_hashed(kind), "path string, bytes long, nth int, digest string").groupBy("path", "bytes").agg(F.array_sort(F.collect_list(F.struct("nth", "digest"))).alias("parts"))
    whole = F.concat(digest(F.array_join(F.col("parts.digest"), "")), F.lit("-"), F.size("parts"))
    return small.unionByName(parts.select("path", "bytes", whole.alias("checksum")))


def quarantine(df: DataFrame, path: str, reason: str, batch: str = "0") -> None:
    """Rejected rows with their reason. Each batch of a reason is a part of its own: a further one is added, and one that runs again overwrites itself."""
    df.write.mode("overwrite").parquet(f"{path}/reason={reason}/batch={batch}")


def run_path(root: str, run_id: str, table: str) -> str:
    """Runs never overwrite each other."""
    return f"{root.rstrip('/')}/{run_id}/{table}"


def _marker(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/LATEST")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def mark_latest(spark: SparkSession, root: str, run_id: str) -> None:
    """Names the run that readers of ``root`` should take, once all of it is written."""
    path, fs = _marker(spark, root)
    out = fs.create(path, True)
    out.write(run_id.encode())
    out.close()


def latest_run(spark: SparkSession, root: str) -> str | None:
    path, fs = _marker(spark, root)
    return spark.read.text(path.toString(), wholetext=True).first()[0] if fs.exists(path) else None


def _listed(spark: SparkSession, paths: dict[str, str], files: str) -> DataFrame:
    """(table_name, files, bytes, sha256): the digest of a table is that of its files' sorted digests."""
    out = None
    for name, path in paths.items():
        one = checksums(spark, path, files=files).withColumn("table_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("table_name").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sha2(F.array_join(F.array_sort(F.collect_list("checksum")), ","), 256).alias("sha256"))


def manifest(spark: SparkSession, paths: dict[str, str], settings: dict[str, str], inputs: dict[str, str] | None = None, errors: dict[str, str] | None = None) -> DataFrame:
    """One JSON row: rows and files of each output with size and SHA-256, totals and settings; the inputs by name, size and
    digest, and what went wrong, by table."""
    rows = None
    for name, path in paths.items():
        one = spark.read.parquet(path).agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    empty = spark.createDataFrame([], "table_name string, files long, bytes long, sha256 string")
    files = (_listed(spark, paths, "*.parquet").join(F.broadcast(rows), "table_name") if paths else empty.withColumn("rows", F.lit(None).cast("long")))  # one row a table
    whole = files.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"), F.array_sort(F.collect_list(F.struct("table_name", "files", "rows", "bytes", "sha256"))).alias("outputs"))
    texts = lambda d: F.create_map(*[F.lit(x) for k, v in d.items() for x in (k, v)]) if d else F.create_map().cast("map<string,string>")
    whole = whole.withColumns({"settings": texts(settings), "errors": texts(errors or {})})
    read = (_listed(spark, inputs, "*") if inputs else empty).agg(F.array_sort(F.collect_list(F.struct("table_name", "files", "bytes", "sha256"))).alias("inputs"))
    return whole.crossJoin(F.broadcast(read)).select(F.to_json(F.struct("*")).alias("manifest"))  # one row each


def publish(tables: dict[str, DataFrame], root: str) -> None:
    """Each table as Parquet under ``root`` and as a view for SQL."""
    for name, df in tables.items():
        write_parquet(df, f"{root}/{name}")
        df.sparkSession.read.parquet(f"{root}/{name}").createOrReplaceTempView(name)
