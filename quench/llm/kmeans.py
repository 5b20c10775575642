"""Centroid clustering of integer vectors with scalar lookup tables.

A component x becomes the integer floor(256 x). In each round, every task tabulates
(value - centroid)^2 for each dimension, each integer value that occurs in its block of rows
and each centroid; a distance is then a sum of table gathers (NumPy, exact int64). A block
has at most as many values a dimension as rows, and one dimension's table exists at a time,
so memory is bounded by the block whatever the data hold. Tasks send a count and the
componentwise sums per centroid; only ``k`` centroids reach the driver and go back to the
tasks. The integer vectors are written once and every round reads that table, so a lost
executor costs its own tasks only.

Cases: vectors that are null, of another length, or hold a null, NaN or infinite component
are left out and nothing else is; repeated rows and repeated ids are vectors of their own; a
null id counts as the empty text where the start is drawn, and equal start hashes are ordered
by the vectors. Fewer than ``k`` kept vectors give as many centroids as vectors; an empty table
gives an empty result. An integer of 2^20 or more raises ValueError: distances and their sums
need not fit 64 bits then. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quench.llm.common import col, materialise

SCALE = 256
LARGEST = 1 << 20
#: Rows whose distances to all centroids are held at once.
BLOCK = 4096


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64) -> DataFrame:
    """``id, v``: the kept vectors as integers (long, so that none is out of range yet)."""
    x = col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    kept = rows.filter(x.isNotNull() & (F.size(x) == dims) & finite)
    return kept.select(col(id_col).alias("id"), F.transform(x, lambda e: F.floor(
        F.greatest(F.least(e.cast("double") * F.lit(float(SCALE)), F.lit(1e15)), F.lit(-1e15)))).alias("v"))


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and squared distance of each row."""
    dist = np.zeros((len(v), len(centroids)), np.int64)
    for d in range(v.shape[1]):
        values, at = np.unique(v[:, d], return_inverse=True)
        table = values[:, None] - centroids[None, :, d]
        table *= table
        dist += table[at]
    cluster = dist.argmin(axis=1)
    return cluster, dist[np.arange(len(v)), cluster]


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    flat = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    v = flat.reshape(-1, dims)
    for s in range(0, len(v), BLOCK):
        yield s, v[s:s + BLOCK]


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of each non-empty cluster."""
    k, dims = centroids.shape

    def task(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, v in _blocks(batch, dims):
                cluster, _ = nearest(v, centroids)
                count += np.bincount(cluster, minlength=k)
                np.add.at(total, cluster, v)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used], pa.int64()),
                                          pa.array(list(total[used]), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    parts = vectors.select("v").mapInArrow(task, "cluster int, n bigint, total array<bigint>")
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[d]) for d in range(dims)]).alias("total"))
    return {r["cluster"]: (r["n"], r["total"]) for r in rows.collect()}


def _assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    dims = centroids.shape[1]

    def task(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id"))
            for s, v in _blocks(batch, dims):
                cluster, dist = nearest(v, centroids)
                yield pa.RecordBatch.from_arrays([ids.slice(s, len(v)), pa.array(cluster, pa.int32()), pa.array(dist, pa.int64())],
                                                 ["id", "cluster", "distance"])

    return vectors.mapInArrow(task, f"id {vectors.schema['id'].dataType.simpleString()}, cluster int, distance bigint")


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, seed: str = "2",
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """``id, cluster, distance`` per kept vector, and the final centroids."""
    vectors = materialise(integer_vectors(rows, id_col, vector_col, dims), "kmeans-vectors")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    centroids = [list(r["v"]) for r in vectors.orderBy(place, "v").limit(k).select("v").collect()]
    if not centroids:
        return vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    largest = vectors.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()[0]
    if largest >= LARGEST:
        raise ValueError(f"a component of {largest} is too large for exact 64-bit distances (limit {LARGEST})")
    for _ in range(rounds):
        for c, (n, total) in _sums(vectors, np.array(centroids, np.int64)).items():
            centroids[c] = [s // n for s in total]
    return materialise(_assigned(vectors, np.array(centroids, np.int64)), "kmeans-assigned"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds the summed distance of each cluster and of all, and the digest of the cluster's centroid."""
    spark = assigned.sparkSession
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    small = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")  # k rows
    return assigned.join(F.broadcast(small), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
