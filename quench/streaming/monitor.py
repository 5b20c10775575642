"""Structured Streaming: ingest + clean + derive with fitted statistics (H1),
windowed quality monitoring with watermarks (H2), streaming dedupe (H3).

The stream source is the events table itself; tests and the registered queries use
``trigger(availableNow=True)`` so a run processes everything present and
stops. Sinks are written by ``foreachBatch`` into parquet tables under the
checkpointed scratch folder: a batch overwrites its own partition, so one that is
replayed after a failure leaves the rows of one run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.session import scratch_path
from quench.sources.fixtures import table

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_measurements(df: DataFrame) -> DataFrame:
    """Events as measurements: ``value`` planted NULL when ``event_id % 11 = 0``."""
    return df.select("event_id", "ts", "user_id", "event_type",
                     F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
                     .alias("value"))


def read_event_stream(spark: SparkSession, sf_dir: str, max_files: int = 4) -> DataFrame:
    """The events table as a file stream: its files in order of arrival, ``max_files`` a batch. Files need not
    follow the event time: see ``lateness``."""
    return (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files)
            .parquet(f"{sf_dir.rstrip('/')}/events[.]parquet"))  # a pattern: the source takes a file as well as a folder


def lateness(spark: SparkSession, sf_dir: str, least: str) -> str:
    """A watermark delay under which no row of the table counts as late: ``least``, or the farthest that a
    file's oldest row lies behind the newest row of files that may be read before it, if that is more.

    The source reads files by modification time and leaves open the order of those of equal time. Where the
    files follow the event time the delay, and with it the state, stays at ``least``."""
    ev = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("_metadata.file_path").alias("path"),
                                               F.unix_millis("_metadata.file_modification_time").alias("at"))
    files = ev.groupBy("path", "at").agg(*[F.unix_micros(f("ts")).alias(c) for f, c in ((F.min, "lo"), (F.max, "hi"))]).filter("lo IS NOT NULL")
    newest, behind = None, 0
    at_once = files.groupBy("at").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("n"))
    for f in at_once.orderBy("at").collect():  # a row per modification time
        before = [x for x in (newest, f["hi"] if f["n"] > 1 else None) if x is not None]
        behind = max([behind, *(x - f["lo"] for x in before)])
        newest = max([f["hi"], *before])
    wanted = spark.range(1).select(F.expr(f"CAST(unix_micros(TIMESTAMP_SECONDS(0) + INTERVAL {least}) AS BIGINT)")).first()[0]
    return least if behind < wanted else f"{behind // 1_000_000 + 1} seconds"


def clean_derive(df: DataFrame, median_value: float) -> DataFrame:
    """H1 transform (same for batch and stream): impute with a fitted median, derive."""
    m = event_measurements(df)
    filled = F.coalesce(F.col("value"), F.lit(median_value))
    return m.select("event_id", "ts", "event_type", filled.alias("value_filled"),
                    (filled * filled).alias("value_squared"),
                    F.col("value").isNull().cast("int").alias("was_missing"))


def write_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """A micro-batch's own partition, overwritten when the batch is replayed."""
    batch.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")


def run_to_table(stream_df: DataFrame, spark: SparkSession, name: str, output_mode: str = "append") -> str:
    """Run a streaming DataFrame to completion (availableNow); every micro-batch
    overwrites its own partition ``_batch`` of a parquet table, whose path is returned."""
    out = scratch_path(spark, f"{name}-sink")
    ckpt = scratch_path(spark, f"{name}-ckpt")

    q = (stream_df.writeStream.outputMode(output_mode).foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, out))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def fitted_median(spark: SparkSession, sf_dir: str) -> float:
    from quench.operators.quantiles import exact_quantiles

    return exact_quantiles(event_measurements(table(spark, sf_dir, "events")), ["value"], [0.5])["value"][0.5]


def stream_clean_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: stream the staged events through the fitted cleaning and derivation."""
    med = fitted_median(spark, sf_dir)
    out = run_to_table(clean_derive(read_event_stream(spark, sf_dir), med), spark, "h1")
    return spark.read.parquet(out).drop("_batch")


def window_monitor(df: DataFrame, window: str = "1 hour", slide: str | None = None,
                   watermark: str = "2 hours") -> DataFrame:
    """H2: per window and event type -- events, missing values, mean, and values
    above a fixed limit; rows later than the watermark are dropped."""
    m = event_measurements(df).withColumn("ts", F.col("ts").cast("timestamp"))
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    return (m.withWatermark("ts", watermark).groupBy(w.alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.sum("value").alias("sum_value"), F.count("value").alias("n_value"),
        F.count_if(F.col("value") > 200.0).alias("n_above_limit"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n_events", "n_missing",
                "sum_value", "n_value", "n_above_limit"))


def stream_window_monitor(spark: SparkSession, sf_dir: str, window: str = "1 hour", slide: str | None = None,
                          watermark: str = "2 hours") -> DataFrame:
    """H2 on the stream in update mode; the final value of a window is its
    latest emitted update (``max_by`` on the batch id)."""
    delay = lateness(spark, sf_dir, watermark)
    out = run_to_table(window_monitor(read_event_stream(spark, sf_dir), window, slide, delay), spark, "h2",
                       output_mode="update")
    res = spark.read.parquet(out)
    cols = ["n_events", "n_missing", "sum_value", "n_value", "n_above_limit"]
    latest = res.groupBy("window_start", "event_type").agg(
        *[F.max_by(F.col(c), F.col("_batch")).alias(c) for c in cols])
    return latest.select("window_start", "event_type", "n_events", "n_missing",
                         F.try_divide(F.col("sum_value"), F.col("n_value")).alias("avg_value"),
                         (F.col("n_missing") / F.col("n_events")).alias("missing_rate"), "n_above_limit")


def sessions(df: DataFrame, gap: str = "30 minutes", watermark: str = "2 hours") -> DataFrame:
    """H2 session windows per user (batch, or stream with the watermark)."""
    m = event_measurements(df).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    s = m.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("value").isNull()).alias("n_missing"))
    return s.select("user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("session_end"), "n_events", "n_missing")


def stream_sessions(spark: SparkSession, sf_dir: str, gap: str = "30 minutes", watermark: str = "2 hours") -> DataFrame:
    """H2 sessions on the stream in complete mode: the last batch holds every session."""
    out = run_to_table(sessions(read_event_stream(spark, sf_dir), gap, lateness(spark, sf_dir, watermark)), spark, "h2s", output_mode="complete")
    res = spark.read.parquet(out)
    last = res.agg(F.max("_batch")).first()[0]
    return res.where(F.col("_batch") == F.lit(last)).drop("_batch")


def stream_outlier_rate(spark: SparkSession, sf_dir: str, window: str = "1 day", watermark: str = "2 hours") -> DataFrame:
    """H2: per window, the share of values outside the IQR bounds fitted on the table."""
    from quench.operators.clean import outlier_bounds

    lo, hi = outlier_bounds(event_measurements(table(spark, sf_dir, "events")), ["value"])["value"]
    m = event_measurements(read_event_stream(spark, sf_dir)).withColumn("ts", F.col("ts").cast("timestamp"))
    v = F.col("value")
    rate = (m.withWatermark("ts", lateness(spark, sf_dir, watermark)).groupBy(F.window("ts", window).alias("w")).agg(
        F.count("value").alias("n_value"), F.count_if((v < F.lit(lo)) | (v > F.lit(hi))).alias("n_outliers"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n_value", "n_outliers"))
    res = spark.read.parquet(run_to_table(rate, spark, "h2o", output_mode="update"))
    latest = res.groupBy("window_start").agg(*[F.max_by(F.col(c), F.col("_batch")).alias(c) for c in ("n_value", "n_outliers")])
    return latest.withColumn("outlier_rate", F.try_divide(F.col("n_outliers").cast("double"), F.col("n_value").cast("double")))


def stream_dedupe(spark: SparkSession, sf_dir: str, watermark: str = "2 hours") -> DataFrame:
    """H3: drop repeated events (same ``event_id``) within the watermark; the
    stream contains every event twice (the table and a replay of it)."""
    s = read_event_stream(spark, sf_dir).unionByName(read_event_stream(spark, sf_dir))
    d = (event_measurements(s).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness(spark, sf_dir, watermark))
         .dropDuplicatesWithinWatermark(["event_id"]))
    out = run_to_table(d, spark, "h3")
    return spark.read.parquet(out).drop("_batch").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
