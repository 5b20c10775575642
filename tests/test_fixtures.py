"""The measurements fixture: what its join moves and what its file keeps."""

from pyspark.sql import functions as F

from quench.functions.constants import ROW_ID
from quench.sources import fixtures
from quench.sources.fixtures import measurements, measurements_plan

from conftest import SF_SMALL


def test_lineitem_moves_once(spark, monkeypatch):
    """Beyond small tables orders are shuffled even where Spark would broadcast them, the dimensions are not: the plan
    does not change as the tables grow."""
    monkeypatch.setattr(fixtures, "SMALL_ROWS", 0)
    plan = measurements_plan(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 2


def test_large_dimensions_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "BROADCAST_ROWS", 1)
    plan = measurements_plan(spark, SF_SMALL)
    assert "broadcast" not in plan._jdf.queryExecution().analyzed().toString().lower()


def test_row_ids_are_kept_as_bytes_and_read_as_text(spark):
    got = measurements(spark, SF_SMALL)
    kept = spark.read.parquet(fixtures._MATERIALISED[(spark.sparkContext.applicationId, SF_SMALL.rstrip("/"))])
    assert dict(kept.dtypes)[ROW_ID] == "binary"
    lazy = measurements_plan(spark, SF_SMALL)
    assert got.columns == lazy.columns and got.dtypes == lazy.dtypes
    assert got.exceptAll(lazy).isEmpty() and lazy.exceptAll(got).isEmpty()
    assert got.where(~F.col(ROW_ID).rlike("^[0-9a-f]{32}$")).isEmpty()
