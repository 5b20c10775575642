"""Stateful sessions: against the batch operator, with late, empty and keyless input."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quench.session import scratch_path
from quench.sources.fixtures import table
from quench.streaming import monitor, sessions

from conftest import SF_SMALL

GAP = 30 * 60_000_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20 * GAP), min_size=1, max_size=30), st.integers(1, 5))
def test_merged_in_any_parts(stamps, parts):
    """Sessions of rows merged batch by batch in any order equal one pass over the sorted rows."""
    want = []
    for t in sorted(stamps):
        if want and t - want[-1][1] < GAP:
            want[-1] = (want[-1][0], t, want[-1][2] + 1, want[-1][3])
        else:
            want.append((t, t, 1, 0))
    got = []
    for p in range(parts):
        got = sessions.merged(got + [(t, t, 1, 0) for t in stamps[p::parts]], GAP)
    assert got == want


def _write(df, src):
    df.coalesce(1).write.mode("append").parquet(f"{src}/events.parquet")


def test_late_rows_are_counted_and_the_rest_equals_the_batch(spark):
    """Eight files in order of event time, then one with a tenth of all rows again: those behind the watermark are
    late, row for row, and the others enter the sessions."""
    src = scratch_path(spark, "events-late")
    ev = table(spark, SF_SMALL, "events").withColumn("user_id", F.when(F.col("user_id") > 0, F.col("user_id")))  # a null user
    lo, hi = ev.select(F.unix_micros(F.min("ts").cast("timestamp")), F.unix_micros(F.max("ts").cast("timestamp"))).first()
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    part = F.least(F.lit(7), F.floor((at - lo) * 8 / (hi - lo)))
    for i in range(8):
        _write(ev.where(part == i), src)
    again = ev.where(F.col("event_id") % 10 == 0)
    _write(again, src)
    mark = (hi // 1000 - 2 * 3600 * 1000) * 1000  # of the ninth file, which is read in a batch of its own
    is_late = (F.floor(at / sessions.SLOT) + 1) * sessions.SLOT <= mark
    got, late = sessions.run_sessions(spark, src)
    user = lambda d: {r["user_id"]: r["n"] for r in d.collect()}
    want_late = again.where(is_late).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    assert user(late.groupBy("user_id").agg(F.sum("n_events").alias("n"))) == user(want_late)
    assert late.agg(F.sum("n_missing")).first()[0] == again.where(is_late).where(F.col("event_id") % 11 == 0).count()
    want = monitor.sessions(ev.unionByName(again.where(~is_late)))
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert rows(got.drop("closed")) == rows(want)
    assert got.where("closed").count() > 0 and got.where("NOT closed").count() > 0
    assert got.agg(F.sum("n_events")).first()[0] + late.agg(F.sum("n_events")).first()[0] == ev.count() + again.count()


def test_empty_table(spark):
    src = scratch_path(spark, "events-none")
    _write(table(spark, SF_SMALL, "events").limit(0), src)
    got, late = sessions.run_sessions(spark, src)
    assert got.count() == 0 and late.count() == 0
