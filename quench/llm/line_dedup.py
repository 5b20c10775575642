r"""Line de-duplication over levelled sorted runs of line hashes, in DataFrame operations only.

A line's key is the line with white space (``[\x20\x09-\x0D]``) stripped at both ends and A-Z
lower-cased. Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents
lose all their lines except in the largest doc_id that holds them.

1. Documents are split by doc_id into batches, largest ids first. A batch's keys (two
   independent 64-bit hashes) are aggregated to one row each: documents, largest doc_id.
2. A batch is merge-anti-joined with the runs so far: keys that no run holds form the batch's own
   run at level 0, keys that a run holds become hits that carry the run's largest doc_id. Runs
   are tables bucketed and sorted by hash with as many buckets as shuffle partitions, so a join
   moves only the batch, never the runs. ``fanout`` runs of a level are compacted into one run of
   the next level, so a batch meets a number of runs that grows with the logarithm of the batches.
   Every key is in exactly one run, with its largest doc_id, because ids come in descending order.
3. A key is frequent when its run row and its hits add up to ``min_docs`` documents. Frequent keys
   are joined to the lines: those on a 4096th or more of all lines (at most 4096 keys) by
   broadcast, the rest by broadcast if counted to be few and by shuffle otherwise, where no key
   holds more than a 4096th of the rows. A document's positions to drop are joined back to it.

All counts of a hot line are pre-aggregated before any shuffle. Equal 128-bit hashes are taken as
equal keys.

Cases: null text is one empty line, like the empty text; a document is a doc_id, so rows that
repeat one count once and lose or keep the same lines; a null doc_id is one document, smaller than
all others; lines shorter than ``min_chars`` always stay; a text that loses all its lines becomes
empty; an empty table gives an empty result; other columns are carried in one struct and never clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quench.llm.common import col, materialise, text_of, whole_row
from quench.session import scratch_path

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Frequent keys (two hashes and an id each) that may be broadcast, and documents and positions to drop.
BROADCAST_KEYS, BROADCAST_DOCS, BROADCAST_POSITIONS = 1_000_000, 250_000, 2_000_000
#: A key on this share of all lines is hot; there are at most as many hot keys.
HOT_SHARE = 4096


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def two_hashes(*cols: Column) -> tuple[Column, Column]:
    """Two hashes with different seeds: the literal's hash seeds the second."""
    return F.xxhash64(*cols), F.xxhash64(F.lit("second"), *cols)


class Runs:
    """Levelled sorted runs of ``h1, h2, n, m, top``: every key in one run, with its documents and
    lines in the batch that brought it and its largest doc_id."""

    def __init__(self, spark, fanout: int):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, rows: DataFrame) -> DataFrame:
        """A table bucketed and sorted by hash; both live in the scratch folder."""
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", scratch_path(self.spark, "line-run"))
         .saveAsTable(name, format="parquet"))
        return self.spark.table(name)

    def add(self, keys: DataFrame) -> list[DataFrame]:
        """Adds a batch; returns its hits, one frame a run: the batch's counts with the run's."""
        batch = self._write(keys)
        fresh, hits = batch, []
        for run in self.runs:
            old = run.select("h1", "h2", F.col("n").alias("run_n"), F.col("m").alias("run_m"), F.col("top").alias("run_top")).hint("merge")
            hits.append(batch.select("h1", "h2", "n", "m").join(old, ["h1", "h2"]))
            fresh = fresh.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self._push(0, self._write(fresh) if hits else batch)
        return hits

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._push(level + 1, self._write(merged.repartition(self.buckets, "h1", "h2")))


def frequent_keys(lines: DataFrame, batches: int, min_docs: int, fanout: int) -> DataFrame:
    """``h1, h2, m, top`` of the keys in at least ``min_docs`` documents; ``lines`` has ``batch, id, h1, h2``."""
    runs, hits = Runs(lines.sparkSession, fanout), None
    for b in range(batches):
        per_doc = lines.filter(F.col("batch") == b).groupBy("id", "h1", "h2").agg(F.count(F.lit(1)).alias("m"))
        keys = per_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m"), F.max("id").alias("top"))
        for found in runs.add(keys):
            found = materialise(found, "line-hits")
            hits = found if hits is None else hits.unionByName(found)
    all_runs = runs.runs
    many = all_runs[0]
    for run in all_runs[1:]:
        many = many.unionByName(run)
    many = many.filter(F.col("n") >= min_docs).select("h1", "h2", "m", "top")
    if hits is not None:
        summed = hits.groupBy("h1", "h2").agg((F.sum("n") + F.max("run_n")).alias("n"), (F.sum("m") + F.max("run_m")).alias("m"),
                                              F.max("run_top").alias("top"))
        many = many.unionByName(summed.filter(F.col("n") >= min_docs).drop("n")).groupBy("h1", "h2").agg(F.max("m").alias("m"), F.max("top").alias("top"))
    return materialise(many, "line-frequent")


def _join_frequent(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    if frequent.count() <= BROADCAST_KEYS:
        return lines.join(F.broadcast(frequent), ["h1", "h2"])
    hot = F.col("m") * HOT_SHARE >= F.lit(lines.count())
    return (lines.join(F.broadcast(frequent.filter(hot)), ["h1", "h2"])
            .unionByName(lines.join(frequent.filter(~hot), ["h1", "h2"])))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
                batches: int = 4, fanout: int = 2) -> DataFrame:
    """One row per input row: ``id, text`` (kept lines), ``n_lines, n_dropped`` and ``row`` (the input row)."""
    base = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"), whole_row(docs).alias("row"))
    r1, r2 = two_hashes(F.col("id"), F.col("text"))
    cut = F.split("text", "\n", -1)

    edges = sorted({e for e in base.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []})
    batch = sum(((F.col("id") <= F.lit(e)).cast("int") for e in edges), F.lit(0))
    exploded = base.select("id", r1.alias("r1"), r2.alias("r2"), F.posexplode(cut).alias("pos", "line"))
    key = exploded.select("id", "r1", "r2", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    h1, h2 = two_hashes(F.col("key"))
    hashed = key.select("id", "r1", "r2", "pos", h1.alias("h1"), h2.alias("h2"), F.coalesce(batch, F.lit(len(edges))).alias("batch"))
    path = scratch_path(docs.sparkSession, "line-hashes")
    hashed.write.partitionBy("batch").parquet(path)
    lines = docs.sparkSession.read.schema(hashed.schema).parquet(path)

    frequent = frequent_keys(lines, len(edges) + 1, min_docs, fanout)
    lost = _join_frequent(lines, frequent).filter(F.col("id").isNull() | (F.col("id") < F.col("top")))
    drops = materialise(lost.groupBy("r1", "r2").agg(F.array_sort(F.collect_set("pos")).alias("drop")), "line-drops")
    size = drops.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("drop")), F.lit(0))).first()
    if size[0] <= BROADCAST_DOCS and size[1] <= BROADCAST_POSITIONS:
        drops = F.broadcast(drops)

    def kept(lines_of: Column, drop: Column) -> Column:
        # the stretches between dropped positions
        def stretch(i):
            start = F.when(i == 0, F.lit(0)).otherwise(F.get(drop, i - 1) + 1)
            end = F.when(i == F.size(drop), F.size(lines_of)).otherwise(F.get(drop, i))
            return F.slice(lines_of, start + 1, end - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(drop)), stretch)), "\n")

    # the split text is bound once as a lambda variable, not once a stretch
    rest = F.get(F.transform(F.array(cut), lambda ls: kept(ls, F.col("drop"))), F.lit(0))
    joined = base.withColumn("r1", r1).withColumn("r2", r2).join(drops, ["r1", "r2"], "left")
    return joined.select("id", F.when(F.col("drop").isNull(), F.col("text")).otherwise(rest).alias("text"),
                         F.size(cut).cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), "row")
