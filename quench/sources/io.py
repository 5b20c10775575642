"""Sources and sinks (S1-S10, S12): CSV / table / JDBC scans, table and file
sinks, storage modes, schema bootstrap.

Schemas are explicit (no inference pass). Row counts of writes come from a persisted frame
shared by the count and the write.
"""

from __future__ import annotations

import json
import logging
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.functions.constants import FEATURES, LABEL
from quench.session import scratch_path

log = logging.getLogger(__name__)

RAW_SCHEMA = ", ".join(f"{c} double" for c in FEATURES) + f", {LABEL} int"
AUDIT_COLUMNS = ("id", "loaded_at")
STORAGE_MODES = ("LOCAL", "DB", "BOTH")


def storage_mode(value: str | None = None) -> str:
    """Mode from the argument or the STORAGE_MODE environment variable; unknown -> LOCAL."""
    mode = (value or os.environ.get("STORAGE_MODE", "LOCAL")).upper()
    return mode if mode in STORAGE_MODES else "LOCAL"


def _nan_to_null(df: DataFrame) -> DataFrame:
    """Fold NaN into NULL for double columns (pandas treats both as missing)."""
    return df.select(*[
        F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) if t == "double" else F.col(c)
        for c, t in df.dtypes
    ])


def load_csv(spark: SparkSession, path: str, schema: str = RAW_SCHEMA) -> DataFrame:
    """Header CSV with an explicit schema; error if the path is missing or empty."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return _nan_to_null(df)


def read_table(spark: SparkSession, table_name: str, query: str | None = None) -> DataFrame:
    """Table scan (or a query over registered tables); audit columns dropped;
    error if empty."""
    df = spark.sql(query) if query else spark.table(table_name)
    df = df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])
    if df.isEmpty():
        raise ValueError(f"table {table_name} is empty")
    return df


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: dict | None = None) -> DataFrame:
    """S2 over JDBC (``dbtable`` or ``query``)."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    r = r.option("query", query) if query else r.option("dbtable", table)
    df = r.load()
    return df.drop(*[c for c in df.columns if c.lower() in AUDIT_COLUMNS])


def execute_query(spark: SparkSession, sql: str) -> DataFrame:
    """S3: ad-hoc SQL through Catalyst."""
    return spark.sql(sql)


def save_table(df: DataFrame, table_name: str, mode: str = "append", jdbc_url: str | None = None,
               properties: dict | None = None) -> int:
    """Replace (overwrite) or append; returns the number of rows written."""
    if mode == "replace":
        mode = "overwrite"
    spark = df.sparkSession
    if jdbc_url:
        # computed once into files, which are counted by their footers and then sent
        path = scratch_path(spark, "jdbc-out")
        df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        props = dict(properties or {})
        props.setdefault("batchsize", "1000")
        out.write.mode(mode).jdbc(jdbc_url, table_name, properties=props)
        return out.count()
    # counted from the table's own files (their footers), before and after an append
    before = spark.table(table_name).count() if mode == "append" and spark.catalog.tableExists(table_name) else 0
    df.write.mode(mode).saveAsTable(table_name)
    return int(spark.table(table_name).count() - before)


def load_csv_to_table(spark: SparkSession, csv_path: str, table_name: str, mode: str = "replace",
                      schema: str = RAW_SCHEMA) -> int:
    """CSV -> table, returns the row count."""
    return save_table(load_csv(spark, csv_path, schema), table_name, mode)


def save_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """A directory of part files (parquet default; CSV with header)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def save_with_mode(df: DataFrame, output_path: str, table_name: str, mode: str | None = None,
                   if_exists: str = "replace", fmt: str = "parquet") -> dict:
    """LOCAL writes files, DB writes the table (errors raise), BOTH writes
    files then the table (a table failure is logged and tolerated). The frame
    is persisted once so both writes share one computation."""
    mode = storage_mode(mode)
    out = {"mode": mode, "files": False, "table": False}
    df = df.persist()
    try:
        if mode in ("LOCAL", "BOTH"):
            save_files(df, output_path, fmt)
            out["files"] = True
        if mode in ("DB", "BOTH"):
            try:
                out["rows"] = save_table(df, table_name, "overwrite" if if_exists == "replace" else if_exists)
                out["table"] = True
            except Exception as e:  # noqa: BLE001
                if mode == "DB":
                    raise
                log.warning("table write failed in BOTH mode: %s", e)
    finally:
        df.unpersist()
    return out


def load_with_mode(spark: SparkSession, input_path: str, table_name: str, mode: str | None = None,
                   schema: str = RAW_SCHEMA) -> DataFrame:
    """DB reads the table and falls back to the CSV when the table cannot be
    resolved; LOCAL / BOTH read the CSV. Spark is lazy, so only resolution
    errors fall back -- later read errors surface to the caller."""
    mode = storage_mode(mode)
    if mode == "DB":
        try:
            return read_table(spark, table_name)
        except AnalysisException as e:
            log.warning("table %s unavailable (%s); reading %s", table_name, e, input_path)
    return load_csv(spark, input_path, schema)


def initialize_schema(spark: SparkSession, database: str = "water_quality") -> list[str]:
    """Declare the four tables if absent (keys, cascade and indexes are not
    enforced by Spark; the experiment id is a column)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    feats = ", ".join(f"{c} DOUBLE" for c in FEATURES)
    ddl = {
        "raw_water_quality": f"id BIGINT, {feats}, {LABEL} INT, loaded_at TIMESTAMP",
        "cleaned_water_quality": f"id BIGINT, {feats}, {LABEL} INT, cleaning_strategy STRING, "
                                 "processed_at TIMESTAMP",
        "experiments": "id STRING, experiment_name STRING, research_question STRING, description STRING, "
                       "parameters STRING, status STRING, started_at TIMESTAMP, completed_at TIMESTAMP",
        "model_metrics": "id STRING, experiment_id STRING, model_name STRING, strategy STRING, accuracy DOUBLE, "
                         "precision_score DOUBLE, recall DOUBLE, f1_score DOUBLE, roc_auc DOUBLE, "
                         "cv_recall_mean DOUBLE, cv_recall_std DOUBLE, stability_score DOUBLE, "
                         "additional_metrics STRING, created_at TIMESTAMP",
    }
    for name, cols in ddl.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet")
    return [f"{database}.{n}" for n in ddl]


def initialize_database(spark: SparkSession, csv_path: str, database: str = "water_quality") -> int:
    """Schema, then bulk-load the CSV (a warning and 0 when it is absent)."""
    initialize_schema(spark, database)
    try:
        df = load_csv(spark, csv_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("raw CSV not loaded (%s)", e)
        return 0
    stamped = df.select(F.monotonically_increasing_id().alias("id"), *FEATURES, LABEL,
                        F.current_timestamp().alias("loaded_at"))
    return save_table(stamped, f"{database}.raw_water_quality", "replace")


def save_model(model, path: str) -> None:
    """Fitted pipeline persistence."""
    model.save(path)


def load_model(path: str):
    """The saved model of any kind, ready to predict."""
    from quench.operators.boosted import BoostedTrees
    from quench.operators.deepforest import DeepForest, DeepTree
    from quench.operators.iforest import IsolationForestModel
    from quench.operators.knn import KNNClassifier
    from quench.operators.models import SparkClassifier

    meta = json.loads(SparkSession.getActiveSession().read.text(f"{path}/meta").first()[0])
    kinds = {"boosted trees": BoostedTrees, "deep forest": DeepForest, "deep tree": DeepTree, "isolation forest": IsolationForestModel, "nearest neighbours": KNNClassifier}
    return kinds.get(meta.get("kind"), SparkClassifier).load(path)
