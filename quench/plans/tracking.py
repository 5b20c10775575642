"""Experiment tracking (E7-E9) as append-only event tables.

Parquet has no UPDATE, so completing an experiment appends a second event;
the current state of each experiment is its latest event (``max_by`` on the
event sequence). Tracking failures are logged and tolerated, as in the
reference.
"""

from __future__ import annotations

import json
import logging
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

#: What a store that is missing, full or closed raises; anything else is a fault of ours and surfaces.
_FAILURES = (AnalysisException, Py4JJavaError, OSError)

EVENT_SCHEMA = ("id string, experiment_name string, research_question string, description string, "
                "parameters string, status string, event_seq bigint")

METRIC_COLUMNS = ["model_name", "strategy", "accuracy", "precision_score", "recall", "f1_score", "roc_auc",
                  "cv_recall_mean", "cv_recall_std", "stability_score"]


def _append(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], EVENT_SCHEMA).withColumn("event_time", F.current_timestamp()) \
        .write.mode("append").parquet(path)


def create_experiment(spark: SparkSession, path: str, name: str, research_question: str, description: str,
                      parameters: dict | None = None) -> str | None:
    """New experiment (status running); returns its id, None on failure."""
    try:
        exp_id = uuid.uuid4().hex
        _append(spark, path, (exp_id, name, research_question, description, json.dumps(parameters or {}),
                              "running", time.time_ns()))
        return exp_id
    except _FAILURES as e:
        log.warning("experiment not recorded: %s", e)
        return None


def complete_experiment(spark: SparkSession, path: str, exp_id: str | None, status: str = "completed") -> None:
    """Append the completion event."""
    if exp_id is None:
        return
    try:
        _append(spark, path, (exp_id, None, None, None, None, status, time.time_ns()))
    except _FAILURES as e:
        log.warning("experiment %s not completed: %s", exp_id, e)


def experiment_state(spark: SparkSession, path: str) -> DataFrame:
    """One row per experiment: its first event's description, latest status,
    start and completion times."""
    ev = spark.read.parquet(path)
    return ev.groupBy("id").agg(
        F.min_by("experiment_name", "event_seq").alias("experiment_name"),
        F.min_by("research_question", "event_seq").alias("research_question"),
        F.min_by("description", "event_seq").alias("description"),
        F.min_by("parameters", "event_seq").alias("parameters"),
        F.max_by("status", "event_seq").alias("status"),
        F.min("event_time").alias("started_at"),
        F.max(F.when(F.col("status") != "running", F.col("event_time"))).alias("completed_at"),
    )


def save_metrics(spark: SparkSession, path: str, exp_id: str | None, metrics: DataFrame) -> int:
    """Keep the known metric columns (``precision`` -> ``precision_score``),
    attach the experiment id; CV columns are kept. Returns rows written."""
    if exp_id is None:
        return 0
    try:
        m = metrics.withColumnRenamed("precision", "precision_score")
        if "model_name" not in m.columns:
            m = m.withColumn("model_name", F.lit("XGBoost"))
        cols = [F.col(c) if c in m.columns else F.lit(None).cast("string" if c in ("model_name", "strategy")
                                                                 else "double").alias(c) for c in METRIC_COLUMNS]
        out = m.select(F.lit(exp_id).alias("experiment_id"), *cols, F.current_timestamp().alias("created_at"))
        out = out.checkpoint(eager=True)  # computed once, for the write and the count
        out.write.mode("append").parquet(path)
        return out.count()
    except _FAILURES as e:
        log.warning("metrics not saved: %s", e)
        return 0
