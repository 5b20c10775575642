"""Streaming: late rows are dropped by the watermark (FIXTURES §5); a replayed batch leaves one copy."""

from pyspark.sql import functions as F

from quench.session import scratch_path
from quench.sources.fixtures import table
from quench.streaming import monitor

from conftest import SF_SMALL


def test_late_day_is_dropped_by_watermark(spark):
    src = scratch_path(spark, "events-by-day")
    ev = table(spark, SF_SMALL, "events").withColumn("day", F.to_date("ts"))
    days = sorted(r[0] for r in ev.select("day").distinct().collect())
    # one file a day, in order of arrival; the first day once more after all others: its rows are late
    for d in [*days, days[0]]:
        ev.where(F.col("day") == F.lit(d)).drop("day").coalesce(1).write.mode("append").parquet(f"{src}/events.parquet")
    out = monitor.run_to_table(monitor.window_monitor(monitor.read_event_stream(spark, src), "1 hour", None,
                                                      "2 hours"), spark, "late", output_mode="update")
    res = spark.read.parquet(out)
    final = res.groupBy("window_start", "event_type").agg(F.max_by("n_events", "_batch").alias("n"))
    batch = monitor.window_monitor(table(spark, SF_SMALL, "events")).select(
        "window_start", "event_type", F.col("n_events").alias("n_batch"))
    joined = final.join(batch, ["window_start", "event_type"], "full")
    # every window counts each event once: the replayed (late) copy never reached the state
    assert joined.where(F.col("n").isNull() | F.col("n_batch").isNull() | (F.col("n") != F.col("n_batch"))).count() == 0
    assert final.count() == batch.count()


def test_replayed_batch_overwrites_itself(spark):
    out = scratch_path(spark, "replayed")
    batch = spark.range(10).withColumn("v", F.lit(1))
    for _ in range(2):
        monitor.write_batch(batch, 3, out)
    monitor.write_batch(batch, 4, out)
    assert {r["_batch"]: r["count"] for r in spark.read.parquet(out).groupBy("_batch").count().collect()} == {3: 10, 4: 10}


def test_files_out_of_event_time_order(spark):
    """12 files of rows in random order, in three batches: the results of the one-file table."""
    src = scratch_path(spark, "events-shuffled")
    table(spark, SF_SMALL, "events").repartition(12, F.md5(F.col("event_id").cast("string"))).write.parquet(f"{src}/events.parquet")
    assert len(table(spark, src, "events").inputFiles()) > 8
    runs = [monitor.stream_window_monitor, lambda s, d: monitor.stream_window_monitor(s, d, "1 hour", "30 minutes"),
            monitor.stream_outlier_rate, monitor.stream_dedupe, monitor.stream_sessions]
    for run in runs:
        got, want = ([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in run(spark, d).collect()] for d in (src, SF_SMALL))
        assert sorted(got, key=str) == sorted(want, key=str)


def test_lateness_follows_the_files(spark):
    """Files that follow the event time keep the given delay, a file of old rows raises it to cover them."""
    src = scratch_path(spark, "events-ordered")
    ev = table(spark, SF_SMALL, "events").withColumn("day", F.to_date("ts"))
    days = sorted(r[0] for r in ev.select("day").distinct().collect())[:3]
    for k, d in enumerate([*days, days[0]]):
        ev.where(F.col("day") == F.lit(d)).drop("day").coalesce(1).write.mode("append").parquet(f"{src}/events.parquet")
        delay = monitor.lateness(spark, src, "2 hours")
        assert delay == "2 hours" if k < 3 else int(delay.split()[0]) > 2 * 86400
