"""Token-id output: Parquet files with a list column of ids, in ascending document order.

Each file (shard) holds a range of doc_ids, sorted, with ``shard, doc_id, first``
(ids before the document in its shard), ``n_tokens`` and ``ids``. The metadata columns
can be read without the ids. Row groups and pages are kept small enough to skip, page
indexes are written, and a filter on doc_id therefore reads only matching pages. Ids
are dictionary-encoded by default (at most 50k values) or delta-packed.

The order comes from a range partitioning on (doc_id, text hash) with a sort inside
each task; rows never meet in one task. Positions in the whole corpus are the shard's
base (a sum of one row a shard) plus ``first``.

Cases: null or empty texts hold only the end id; a null doc_id sorts first; rows that
repeat a doc_id follow one another, ordered by text hash; an empty table gives files
without rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quench.llm.common import col, text_of
from quench.llm.tokens import encoder

END = 2
#: Shard totals that may be broadcast: 16 bytes each.
BROADCAST_SHARDS = 1_000_000
_ROWS = 500
_SCHEMA = "shard int, doc_id long, first long, n_tokens long, ids array<int>"


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, tokenizer: str | None = None,
                 encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10) -> None:
    """Encode every text, append ``end`` and write the files. ``encoding``: "dictionary" or "delta"."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding: {encoding}")
    keyed = docs.select(col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, done = encoder(tokenizer, "byte"), TaskContext.get().partitionId(), 0
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                b = whole.slice(at, _ROWS)
                data = [enc.encode(t.as_py()) + last for t in b.column("text")]
                n = np.array([len(x) // 4 for x in data], np.int64)
                ends = np.concatenate([[0], np.cumsum(n)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4")))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), shard, np.int32)), b.column("doc_id"), pa.array(done + ends[:-1]),
                                                  pa.array(n), ids], ["shard", "doc_id", "first", "n_tokens", "ids"])
                done += int(ends[-1])

    (ordered.mapInArrow(run, _SCHEMA).write
     .option("compression", "zstd").option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", 2000).option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower()).parquet(path))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``shard, doc_id, start, n_tokens`` of every document; the ids are not read."""
    return _placed(spark, spark.read.schema(_SCHEMA).parquet(path).drop("ids"), path)


def read_tokens(spark: SparkSession, path: str, where=None) -> DataFrame:
    """``shard, doc_id, start, n_tokens, ids``; ``where`` (a condition on doc_id or n_tokens) is pushed to the files."""
    files = spark.read.schema(_SCHEMA).parquet(path)
    return _placed(spark, files if where is None else files.filter(where), path)


def _placed(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    totals = spark.read.schema(_SCHEMA).parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # one row a file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if totals.count() <= BROADCAST_SHARDS:
        base = F.broadcast(base)
    return rows.join(base, "shard", "left").withColumn("start", F.col("base") + F.col("first")).drop("base", "first")


def crc32_of_ids(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (unsigned crc32 of the ids as little-endian unsigned 32-bit integers)."""
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = [zlib.crc32(x.values.to_numpy().astype("<u4", copy=False).tobytes()) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
