"""Exact running sums over a total order without a single-partition window.

A window ``ORDER BY x`` with no ``PARTITION BY`` moves every row into one
task. Instead the order key is cut into value bins (edges from
``approxQuantile``, so bins hold similar row counts even for skewed keys, or
evenly spaced edges for a key known to be uniform):

* within a bin: a window ``PARTITION BY (parts, bin) ORDER BY key`` --
  many bounded tasks;
* across bins: per-bin totals (a table of #parts x #bins rows), a prefix
  over that small table, joined back null-safely, so rows whose partition
  value or order key is NULL keep their place (NULL keys come first, as in
  Spark's ascending order).

Rows that fit one bin's budget are one bin, which needs no edges, totals or offsets; more
rows make at least a bin a core and at most ``MAX_BINS``. Bins only steer task size. The input is
read up to four times, so callers hand over a written table. The order (``order_col`` plus
``tiebreak``) must be unique per row; callers group tied values first (AUC
and average ranks do).
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


MAX_BINS = 10_000
#: per-bin totals that may be broadcast (a few numbers each)
BROADCAST_ROWS = 200_000


def _bins(df: DataFrame, order_col: str, nbins: int, uniform: tuple[float, float] | None):
    if uniform:
        lo, hi = uniform
        edges = [lo + (hi - lo) * i / nbins for i in range(1, nbins)]
    else:
        probs = [i / nbins for i in range(1, nbins)]
        edges = sorted({e for e in df.stat.approxQuantile(order_col, probs, 1.0 / (4 * nbins)) if math.isfinite(e)})
    splits = [-math.inf, *edges, math.inf]
    binned = Bucketizer(splits=splits, inputCol="_ord", outputCol="_bin", handleInvalid="keep").transform(
        df.withColumn("_ord", F.col(order_col).cast("double")))
    return binned.withColumn("_bin", F.when(F.col("_ord").isNull(), F.lit(-1.0)).otherwise(F.col("_bin"))).drop("_ord")


def prefix_sums(df: DataFrame, order_col: str, sums: dict[str, str], partition_cols: list[str] | None = None,
                tiebreak: list[str] | None = None, rows_per_bin: int = 2_000_000, n_rows: int | None = None,
                uniform: tuple[float, float] | None = None) -> DataFrame:
    """Append ``{name}_before``: sum of ``sums[name]`` over rows strictly earlier in
    the order within the same partition. ``uniform``: the range of an order key known
    to be evenly spread (a hash), which needs no quantile sketch."""
    parts = list(partition_cols or [])
    tiebreak = list(tiebreak or [])
    if n_rows is None:
        n_rows = df.count()
    if n_rows <= rows_per_bin:
        before = Window.orderBy(order_col, *tiebreak).partitionBy(*parts, F.lit(0)).rowsBetween(Window.unboundedPreceding, -1)
        return df.select("*", *[F.coalesce(F.sum(F.col(expr)).over(before), F.lit(0)).alias(f"{name}_before") for name, expr in sums.items()])
    nbins = max(2, df.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows / max(rows_per_bin, 1)))
    binned = _bins(df, order_col, min(MAX_BINS, nbins), uniform)
    within = (Window.partitionBy(*parts, "_bin").orderBy(order_col, *tiebreak)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = binned
    for name, expr in sums.items():
        out = out.withColumn(f"_{name}_cum", F.sum(F.col(expr)).over(within))
    totals = binned.groupBy(*parts, "_bin").agg(*[F.sum(F.col(e)).alias(f"_{n}_tot") for n, e in sums.items()])
    totals = totals.checkpoint(eager=True)
    across = Window.partitionBy(*parts).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*parts, "_bin"])], *[
        F.coalesce(F.sum(f"_{n}_tot").over(across), F.lit(0)).alias(f"_{n}_off") for n in sums])
    if totals.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*parts, "_bin"])]
    out = out.join(offsets, same, "left")
    for name, expr in sums.items():
        out = out.withColumn(f"{name}_before", F.col(f"_{name}_off") + F.col(f"_{name}_cum") - F.col(expr))
    return out.drop("_bin", *[f"_k{i}" for i in range(len(parts) + 1)], *[f"_{n}_cum" for n in sums], *[f"_{n}_off" for n in sums])
