"""A registry of table schemas across runs: frozen by the first run, compared by every later one.

Each version of a dataset's schema is a file of its own, created only if it isn't there, so of two runs that freeze at
once one wins and the other compares. What each run found is appended to a log.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tamiz.operators import quality
from tamiz.sources.files import exists, listing

LOG = "dataset string, run string, version int, fingerprint string, first_time boolean, fatal boolean, changes array<struct<column_name: string, change: string, severity: string>>, at timestamp"


class DriftError(ValueError):
    """A table lacks a column of its frozen schema, or a type no longer fits."""


@dataclass(frozen=True)
class Evaluation:
    version: int
    fingerprint: str
    first_time: bool
    changes: list[tuple[str, str, str]]

    @property
    def fatal(self) -> bool:
        return any(severity == "fatal" for *_, severity in self.changes)


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, dataset: str, version: int):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions/{dataset}/{version:06d}.json")

    def version(self, dataset: str) -> int:
        """The latest version; 0 where nothing is frozen."""
        folder = f"{self.root}/versions/{dataset}"
        return max([int(f.rsplit("/", 1)[-1].removesuffix(".json")) for f in listing(self.spark, folder) if f.endswith(".json")], default=0) if exists(self.spark, folder) else 0

    def load(self, dataset: str, version: int | None = None) -> dict | None:
        """The record of a version, the latest by default."""
        version = version or self.version(dataset)
        return json.loads(self.spark.read.text(self._path(dataset, version).toString(), wholetext=True).first()[0]) if version else None

    def append(self, dataset: str, df: DataFrame, run: str, expected: int) -> bool:
        """Freezes the schema of ``df`` as the version behind ``expected``; False if another run has frozen that one already."""
        record = {"dataset": dataset, "schema": json.loads(df.schema.json()), "fingerprint": quality.fingerprint(df), "run": run, "at": datetime.now().isoformat()}
        path = self._path(dataset, expected + 1)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path):
            return False
        try:
            out = fs.create(path, False)  # fails if the file is there by now
        except Exception as error:  # noqa: BLE001  the store's own kind of error
            if fs.exists(path):
                return False
            raise OSError(f"{path.toString()} can't be written: {error}") from error
        out.write(json.dumps(record).encode())
        out.close()
        return True

    def evaluate(self, dataset: str, df: DataFrame, run: str) -> Evaluation:
        """Freezes the schema of a new dataset; compares a known one with its latest version. Either way the log gets a row."""
        first = self.version(dataset) == 0 and self.append(dataset, df, run, 0)
        version = self.version(dataset)
        record = self.load(dataset, version)
        frozen = self.spark.createDataFrame([], T.StructType.fromJson(record["schema"]))
        changes = sorted(tuple(r) for r in quality.drift(frozen, df).collect())  # one row a column
        found = Evaluation(version, record["fingerprint"], first, changes)
        row = [(dataset, run, version, found.fingerprint, first, found.fatal, changes, datetime.now())]
        self.spark.createDataFrame(row, LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return found

    def accept(self, dataset: str, df: DataFrame, run: str) -> int:
        """The schema of ``df`` becomes the next version, which a person asks for after a wanted change."""
        while not self.append(dataset, df, run, self.version(dataset)):
            pass
        return self.version(dataset)

    def check(self, dataset: str, df: DataFrame, run: str) -> Evaluation:
        """``evaluate``, with an error for a fatal change."""
        found = self.evaluate(dataset, df, run)
        if found.fatal:
            raise DriftError(", ".join(f"{column} {change}" for column, change, severity in found.changes if severity == "fatal"))
        return found

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(f"{self.root}/log") if exists(self.spark, f"{self.root}/log") else self.spark.createDataFrame([], LOG)
