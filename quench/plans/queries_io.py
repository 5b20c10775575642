"""Queries: sources, sinks and tracking as round trips over the fixture (S1, S3, S4, S8, E8-E10, F7 through a saved scaler)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quench.functions.constants import FEATURES, LABEL, ROW_ID
from quench.plans import tracking
from quench.plans.registry import register
from quench.plans.sqltext import FEATURE_LIST, with_ctes
from quench.session import scratch_path
from quench.sources import io
from quench.sources.fixtures import measurements_clean

_COLS = with_ctes(f"SELECT {FEATURE_LIST}, Potability FROM measurements")
_SUMS = ", ".join(f"sum({c}) AS {c}" for c in FEATURES)


def _csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "measurements-csv")
    io.save_files(measurements_clean(spark, sf_dir).select(*FEATURES, LABEL), path, "csv")
    return path


@register("s1_s8_csv_round_trip", _COLS, FEATURES)
def q_s1(spark, sf_dir):
    return io.load_csv(spark, _csv(spark, sf_dir))


@register("s8_parquet_round_trip", with_ctes(f"SELECT row_id, {FEATURE_LIST}, Potability FROM measurements"), FEATURES)
def q_s8(spark, sf_dir):
    path = scratch_path(spark, "measurements-parquet")
    io.save_files(measurements_clean(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("s3_ad_hoc_sql", with_ctes(f"SELECT Potability, count(*) AS n, {_SUMS} FROM measurements GROUP BY Potability"), FEATURES)
def q_s3(spark, sf_dir):
    view = f"measurements_{uuid.uuid4().hex[:8]}"
    measurements_clean(spark, sf_dir).createOrReplaceTempView(view)
    return io.execute_query(spark, f"SELECT Potability, count(*) AS n, {_SUMS} FROM {view} GROUP BY Potability")


@register("s4_s5_csv_to_table", _COLS, FEATURES)
def q_s4(spark, sf_dir):
    name = f"measurements_{uuid.uuid4().hex[:8]}"
    io.load_csv_to_table(spark, _csv(spark, sf_dir), name)
    return io.read_table(spark, name).select(*FEATURES, LABEL)


@register("e8_e9_tracked_label_shares", with_ctes(
    "SELECT CAST(Potability AS VARCHAR) AS experiment_name, 'completed' AS status, count(*) / (SELECT count(*) FROM measurements) AS accuracy "
    "FROM measurements GROUP BY Potability"), ["accuracy"])
def q_e8(spark, sf_dir):
    """One tracked experiment a label value, whose metric is the label's share."""
    events, metrics = scratch_path(spark, "experiment-events"), scratch_path(spark, "experiment-metrics")
    m = measurements_clean(spark, sf_dir)
    n = m.count()
    for r in m.groupBy(LABEL).count().collect():  # one row a label value
        exp = tracking.create_experiment(spark, events, str(r[LABEL]), "share", "share of a label", {"label": r[LABEL]})
        tracking.save_metrics(spark, metrics, exp, spark.createDataFrame([(r["count"] / n,)], "accuracy double"))
        tracking.complete_experiment(spark, events, exp)
    state = tracking.experiment_state(spark, events)
    return state.join(spark.read.parquet(metrics).select(F.col("experiment_id").alias("id"), "accuracy"), "id").select(
        "experiment_name", "status", "accuracy")


@register("e10_pipeline_summary", with_ctes(
    "SELECT r.n AS raw_records, c.n AS cleaned_records, r.n - c.n AS removed_records, 9 AS raw_features, 20 AS engineered_features, "
    "CAST(c.n - t.n AS BIGINT) AS train_rows, CAST(t.n AS BIGINT) AS test_rows "
    "FROM (SELECT count(*) AS n FROM measurements) AS r, (SELECT count(*) AS n FROM cl) AS c, "
    "(SELECT sum(round(n * 0.2)) AS n FROM (SELECT count(*) AS n FROM cl GROUP BY Potability)) AS t",
    extra=f"cl AS (SELECT DISTINCT {FEATURE_LIST}, Potability FROM measurements)"))
def q_e10(spark, sf_dir):
    from quench.plans.experiments import pipeline_summary, prepare_run

    run = prepare_run(spark, measurements_clean(spark, sf_dir), scratch_path(spark, "summarised-run"))
    return pipeline_summary(spark, run["counts"], {}).drop("baseline_accuracy", "baseline_recall", "baseline_f1")


def _modes(spark, sf_dir, mode: str, read: str):
    folder, name = scratch_path(spark, "modes"), f"measurements_{uuid.uuid4().hex[:8]}"
    io.save_with_mode(measurements_clean(spark, sf_dir).select(*FEATURES, LABEL), folder, name, mode, fmt="csv")
    return io.load_with_mode(spark, folder, name, read).select(*FEATURES, LABEL)


@register("s6_s7_local_mode", _COLS, FEATURES)
def q_s6_local(spark, sf_dir):
    """Files only; a read that asks for the table falls back to them."""
    return _modes(spark, sf_dir, "LOCAL", "DB")


@register("s6_s7_db_mode", _COLS, FEATURES)
def q_s6_db(spark, sf_dir):
    return _modes(spark, sf_dir, "DB", "DB")


@register("s6_s7_both_modes", _COLS, FEATURES)
def q_s6_both(spark, sf_dir):
    return _modes(spark, sf_dir, "BOTH", "BOTH")


@register("s2_row_ids_through_table", with_ctes("SELECT row_id, Potability FROM measurements"))
def q_s2_table(spark, sf_dir):
    name = f"measurements_{uuid.uuid4().hex[:8]}"
    io.save_table(measurements_clean(spark, sf_dir).select(ROW_ID, LABEL), name, "replace")
    return io.read_table(spark, name)
