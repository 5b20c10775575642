"""Session construction and the shared scratch folder.

Lineage is cut with ``DataFrame.checkpoint()`` or tables written under the
folder named by ``spark.checkpoint.dir``. That setting is read from the
session; only a local session (tests, bench) gets its own folder when unset.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "quench") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="quench-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """The frame as a compressed table in the shared scratch folder (a checkpoint would be several times as large)."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
