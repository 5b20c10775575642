"""Resumable stages (E6, E12): each result is a table with a manifest of what it came from.

A stage's key is a hash of its name, its parameters and the keys of its inputs; a source
table's key is a hash of its files' paths, sizes and modification times. A stage whose manifest is
there with the same key is read back, any other is run and written, the manifest last. A run that
was cut off, or one with a changed parameter or input, therefore redoes only what it must.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Stage:
    """A stage's table, its key and whether this run made it."""

    data: DataFrame
    key: str
    rows: int
    made: bool


def source_key(table: DataFrame) -> str:
    """Key of a table read from files, from the files' names, sizes and times (no column is read)."""
    files = table.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    row = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(38,0)"))).first()
    return hashlib.sha256(f"{row[0]}:{row[1]}".encode()).hexdigest()


@dataclass
class Stages:
    spark: SparkSession
    root: str
    log: list[tuple[str, bool]] = field(default_factory=list)

    def run(self, name: str, make: Callable[[], DataFrame], inputs: list[str] = (), **params) -> Stage:
        """The stage's result: read back if its manifest is there, else made, written and recorded. Rows are counted from
        the written files' footers."""
        key = hashlib.sha256(json.dumps([name, params, list(inputs)], sort_keys=True, default=str).encode()).hexdigest()
        path = f"{self.root}/{name}-{key[:24]}"
        made = False
        try:
            rows = self.spark.read.json(f"{path}/manifest", schema="key string, rows bigint").first()["rows"]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            make().write.mode("overwrite").parquet(f"{path}/data")
            rows, made = self.spark.read.parquet(f"{path}/data").count(), True
            manifest = self.spark.createDataFrame([(key, rows, json.dumps(params, default=str))], "key string, rows bigint, params string")
            manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
        self.log.append((name, made))
        return Stage(self.spark.read.parquet(f"{path}/data"), key, rows, made)

    def table(self) -> DataFrame:
        """What this run did: one row a stage."""
        return self.spark.createDataFrame(self.log, "stage string, made boolean")
