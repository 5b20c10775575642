"""Sources, sinks, storage modes, schema bootstrap, JDBC round trip, tracking."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quench.functions.constants import FEATURES, LABEL
from quench.plans import tracking
from quench.sources import io
from quench.sources.fixtures import measurements_clean

from conftest import SF_SMALL


def _csv(spark):
    path = tempfile.mkdtemp(prefix="quench-csv-") + "/raw"
    measurements_clean(spark, SF_SMALL).select(*FEATURES, LABEL).write.option("header", True).csv(path)
    return path


def test_csv_table_round_trip_and_modes(spark):
    path = _csv(spark)
    df = io.load_csv(spark, path)
    n = df.count()
    assert n == measurements_clean(spark, SF_SMALL).count()
    assert df.where(F.col("ph").isNull()).count() > 0
    assert io.load_csv_to_table(spark, path, "raw_t", "replace") == n
    assert io.read_table(spark, "raw_t").count() == n
    assert io.save_table(df, "raw_t", "append") == n
    assert io.execute_query(spark, "SELECT count(*) AS c FROM raw_t").first()["c"] == 2 * n
    out = tempfile.mkdtemp(prefix="quench-out-") + "/clean"
    res = io.save_with_mode(df, out, "clean_t", "BOTH")
    assert res["files"] and res["table"] and spark.read.parquet(out).count() == n
    # DB mode falls back to CSV when the table cannot be resolved
    assert io.load_with_mode(spark, path, "no_such_table", "DB").count() == n
    with pytest.raises(Exception):
        io.load_csv(spark, "/nonexistent/path.csv")


def test_schema_bootstrap(spark):
    path = _csv(spark)
    tables = io.initialize_schema(spark, "wq_test")
    assert len(tables) == 4
    assert io.initialize_database(spark, path, "wq_test") > 0
    assert io.initialize_database(spark, "/nonexistent.csv", "wq_test") == 0


def test_jdbc_round_trip_with_embedded_derby(spark):
    url = "jdbc:derby:memory:quench_db;create=true"
    df = measurements_clean(spark, SF_SMALL).select("ph", "Hardness", LABEL).limit(50)
    try:
        n = io.save_table(df, "MEAS", "overwrite", jdbc_url=url,
                          properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    except Exception as e:  # noqa: BLE001
        pytest.skip(f"embedded Derby not available: {e}")
    back = io.read_jdbc(spark, url, "MEAS", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert n == 50 and back.count() == 50


def test_experiment_tracking(spark):
    path = tempfile.mkdtemp(prefix="quench-exp-") + "/events"
    eid = tracking.create_experiment(spark, path, "Imputation", "RQ1", "compare", {"k": 5})
    assert eid
    st = tracking.experiment_state(spark, path).first()
    assert st["status"] == "running" and st["completed_at"] is None
    tracking.complete_experiment(spark, path, eid)
    st = tracking.experiment_state(spark, path).first()
    assert st["status"] == "completed" and st["experiment_name"] == "Imputation"
    mpath = os.path.dirname(path) + "/metrics"
    m = spark.createDataFrame([("median", 0.7, 0.6, 0.5)], "strategy string, accuracy double, precision double, "
                                                          "recall double")
    assert tracking.save_metrics(spark, mpath, eid, m) == 1
    assert "precision_score" in spark.read.parquet(mpath).columns
