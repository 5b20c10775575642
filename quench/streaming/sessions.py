"""H2 sessions by a stateful processor: per-user state with event-time timers, in append mode.

A session is emitted once, when the watermark has passed its end; rows that arrive behind
the watermark are not dropped in silence but counted, per user, in an output of their own.
Sessions still open when the stream stops are read from the query's state, so that closed,
open and late rows together are exactly the rows that came in.

Rows are summed per user and minute (``SLOT``) inside each task before the shuffle, so a hot user
costs a row a minute and task. Lateness is decided on the same minutes: a row is
late when its whole minute lies at or behind the watermark, and a session closes a minute
after its gap, so no row that is not late can still belong to a closed session.

State per user: its open sessions, at most (delay / gap + 2) of them, and one timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from quench.session import scratch_path
from quench.streaming.monitor import event_measurements, lateness, read_event_stream, write_batch

SLOT = 60_000_000  # microseconds
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE = "start bigint, last bigint, n_events bigint, n_missing bigint"
OUT = f"kind string, user_id bigint, {STATE}"


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (user_id, ts, missing) summed per user and minute."""
    for b in batches:
        t = pa.table({"user_id": b["user_id"], "slot": pa.array(b["ts"].to_numpy() // SLOT), "ts": b["ts"], "missing": b["missing"]})
        g = t.group_by(["user_id", "slot"]).aggregate([("ts", "min"), ("ts", "max"), ("missing", "count"), ("missing", "sum")])
        yield from pa.table([g[c].cast(pa.int64()) for c in ("user_id", "ts_min", "ts_max", "missing_count", "missing_sum")],
                            names=["user_id", "start", "last", "n_events", "n_missing"]).to_batches()


def merged(pieces: list[tuple[int, int, int, int]], gap: int) -> list[tuple[int, int, int, int]]:
    """Sessions (start, last, n_events, n_missing) of pieces: a piece less than ``gap`` after a session's last row joins it."""
    out: list[tuple[int, int, int, int]] = []
    for start, last, n, missing in sorted(pieces):
        if out and start - out[-1][1] < gap:
            s, e, m, k = out[-1]
            out[-1] = (s, max(e, last), m + n, k + missing)
        else:
            out.append((start, last, n, missing))
    return out


class SessionProcessor(StatefulProcessor):
    """Open sessions of one user; emits ``session`` rows when closed and a ``late`` row for a batch's late rows."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", STATE)

    def _closes(self, session) -> int:
        return -(-(session[1] + self.gap + SLOT) // 1000)

    def _keep(self, sessions: list) -> None:
        """The user's open sessions and one timer, at the earliest close."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if sessions:
            self.open.put(sessions)
            self.handle.registerTimer(min(map(self._closes, sessions)))
        else:
            self.open.clear()

    @staticmethod
    def _frame(kind: str, key, rows: list) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["start", "last", "n_events", "n_missing"])
        frame.insert(0, "kind", kind)
        frame.insert(1, "user_id", pd.array([None if key[1] else int(key[0])] * len(rows), dtype="Int64"))
        return frame

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        sessions = [tuple(s) for s in self.open.get()] if self.open.exists() else []
        late = []
        for frame in rows:
            pieces = list(zip(*(frame[c].tolist() for c in ("start", "last", "n_events", "n_missing"))))
            behind = [(p[0] // SLOT + 1) * SLOT <= mark for p in pieces]
            sessions = merged(sessions + [p for p, b in zip(pieces, behind) if not b], self.gap)
            late = [(min(p[0] for p in ps), max(p[1] for p in ps), sum(p[2] for p in ps), sum(p[3] for p in ps))
                    for ps in [late + [p for p, b in zip(pieces, behind) if b]] if ps]
        self._keep(sessions)
        yield self._frame("late", key, late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs()
        sessions = [tuple(s) for s in self.open.get()] if self.open.exists() else []
        closed = [s for s in sessions if self._closes(s) <= mark]
        self._keep([s for s in sessions if self._closes(s) > mark])
        yield self._frame("session", key, closed)


def micros(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.expr(f"unix_micros(TIMESTAMP_SECONDS(0) + INTERVAL {interval})")).first()[0]


def sessionize(events: DataFrame, gap: int, watermark: str) -> DataFrame:
    """The stream of ``OUT`` rows of a stream of events; ``gap`` in microseconds, more than a minute.

    The operator gets event times as numbers, without the watermark column, because Spark
    would drop late rows before the processor could count them."""
    if gap <= SLOT:
        raise ValueError("a session's gap must be longer than a minute")
    m = event_measurements(events).withColumn("ts", F.col("ts").cast("timestamp")).where("ts IS NOT NULL").withWatermark("ts", watermark)
    rows = m.select("user_id", F.unix_micros("ts").alias("ts"), F.col("value").isNull().cast("bigint").alias("missing"))
    slots = rows.mapInArrow(_slots, f"user_id bigint, {STATE}")
    # two keys without nulls: the pandas operator of Spark mixes up a null key with other keys of its batch
    keyed = slots.withColumn("no_user", F.col("user_id").isNull()).fillna(0, ["user_id"])
    return keyed.groupBy("user_id", "no_user").transformWithStateInPandas(SessionProcessor(gap), OUT, "Append", "EventTime")


def run_sessions(spark: SparkSession, sf_dir: str, gap: str = "30 minutes", watermark: str = "2 hours") -> tuple[DataFrame, DataFrame]:
    """All sessions (closed ones as emitted, open ones from the state) and the late rows per user and batch.

    ``watermark`` is taken as given: rows of files that lie farther out of order are late."""
    g = micros(spark, gap)
    out, ckpt = scratch_path(spark, "h2t-sink"), scratch_path(spark, "h2t-ckpt")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        q = (sessionize(read_event_stream(spark, sf_dir), g, watermark).writeStream.outputMode("append")
             .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, out))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROVIDER, before)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    emitted = spark.read.parquet(out)
    state = spark.read.format("statestore").option("stateVarName", "open").load(ckpt)
    still_open = state.select(F.when(~F.col("key.no_user"), F.col("key.user_id")).alias("user_id"), "list_element.*")
    late = emitted.where("kind = 'late'").select(F.col("_batch").alias("batch"), "user_id", "n_events", "n_missing")

    def shown(d: DataFrame, closed: bool) -> DataFrame:
        at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
        return d.select("user_id", at(F.col("start")).alias("session_start"), at(F.col("last") + F.lit(g)).alias("session_end"),
                        "n_events", "n_missing", F.lit(closed).alias("closed"))

    return shown(emitted.where("kind = 'session'"), True).unionByName(shown(still_open, False)), late


def stream_sessions_stateful(spark: SparkSession, sf_dir: str, gap: str = "30 minutes", watermark: str = "2 hours") -> DataFrame:
    """Every session of the table; the delay covers the disorder of its files, so no row is late."""
    found, _ = run_sessions(spark, sf_dir, gap, lateness(spark, sf_dir, watermark))
    return found.drop("closed")
