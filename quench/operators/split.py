"""Deterministic splits (F8-F10) and stratified folds (for M13).

Each row's position is the rank of ``md5(seed:row_id)`` within its label
(stratified) or globally; the first ``round(n * fraction)`` ranks of each
stratum form the held-out part. A split needs only the (hash, key) at that
rank: counts per (label, slice of the hash range) locate the slice that holds
it, slices are halved until few rows are left, and those are ordered. The split is
then a narrow filter on literals -- no row is shuffled. Folds need every row's
rank, which ``prefix_sums`` gives (binned, no single-partition window). The
same rows are chosen for any partitioning and at any scale. These are not the
rows scikit-learn's generator picks; the proportions and determinism are what
carry over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, ROW_ID, SEED
from quench.functions.hashing import TWO_52, hash_bits
from quench.operators.ordered import prefix_sums

#: label values that a stratified split accepts (its cut-offs are literals in the plan)
MAX_LABELS = 10_000
_SLICES = 1024
_FEW = 100_000


def _round_half_up(x: float) -> int:
    return int(x + 0.5)


def _cutoffs(df: DataFrame, seed: int, fraction: float, label: str | None, key: str) -> dict:
    """{label value: (hash, key) of the last held-out row, or None if there is none}."""
    rows = df.select((F.col(label) if label else F.lit(None).cast("int")).alias("l"), hash_bits(seed, F.col(key)).alias("h"),
                     F.col(key).alias("k"))
    size = 2**52 // _SLICES
    open_, cuts = {}, {}
    counted = rows.groupBy("l", F.floor(F.col("h") / size).alias("b")).count()
    if label and df.select(label).distinct().limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"a stratified split takes at most {MAX_LABELS} label values")
    slices: dict = {}
    for r in counted.collect():  # labels x slices
        slices.setdefault(r["l"], {})[r["b"]] = r["count"]
    for l, by in slices.items():
        quota = _round_half_up(sum(by.values()) * fraction)
        if quota == 0:
            cuts[l] = None
            continue
        before = 0
        for b in sorted(by):
            if before + by[b] >= quota:
                open_[l] = (b * size, (b + 1) * size, quota - before, by[b])
                break
            before += by[b]
    while any(n > _FEW and hi - lo > 1 for lo, hi, _, n in open_.values()):
        def inside(lo, hi):
            return (F.col("h") >= F.lit(lo)) & (F.col("h") < F.lit(hi))

        step = {l: max(1, (hi - lo) // _SLICES) for l, (lo, hi, _, _) in open_.items()}
        found: dict = {}
        cut = rows.where(_any(open_, inside))
        slot = _case({l: F.floor((F.col("h") - F.lit(lo)) / F.lit(step[l])) for l, (lo, _, _, _) in open_.items()})
        for r in cut.groupBy("l", slot.alias("b")).count().collect():
            found.setdefault(r["l"], {})[r["b"]] = r["count"]
        for l, (lo, hi, rank, _) in list(open_.items()):
            before = 0
            for b in sorted(found[l]):
                if before + found[l][b] >= rank:
                    open_[l] = (lo + b * step[l], min(hi, lo + (b + 1) * step[l]), rank - before, found[l][b])
                    break
                before += found[l][b]
    if open_:
        inside = rows.where(_any(open_, lambda lo, hi: (F.col("h") >= F.lit(lo)) & (F.col("h") < F.lit(hi))))
        rank = F.row_number().over(Window.partitionBy("l").orderBy("h", "k"))  # at most _FEW rows a label
        want = _case({l: F.lit(r) for l, (_, _, r, _) in open_.items()})
        for r in inside.withColumn("r", rank).where(F.col("r") == want).select("l", "h", "k").collect():
            cuts[r["l"]] = (r["h"], r["k"])
    return cuts


def _case(by_label: dict) -> Column:
    expr = None
    for l, value in by_label.items():
        cond = F.col("l").eqNullSafe(F.lit(l))
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def _any(open_: dict, inside) -> Column:
    cond = F.lit(False)
    for l, (lo, hi, _, _) in open_.items():
        cond = cond | (F.col("l").eqNullSafe(F.lit(l)) & inside(lo, hi))
    return cond


def split_data(df: DataFrame, test_size: float = 0.2, random_state: int = SEED, stratify: bool = True,
               label: str = LABEL, key: str = ROW_ID) -> DataFrame:
    """Adds ``split`` = 'train' | 'test'. A NULL label is a stratum of its own."""
    cuts = _cutoffs(df, random_state, test_size, label if stratify else None, key)
    h, k, test = hash_bits(random_state, F.col(key)), F.col(key), F.lit(False)
    for l, cut in cuts.items():
        if cut is not None:
            here = F.col(label).eqNullSafe(F.lit(l)) if stratify else F.lit(True)
            low = (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (k.isNull() | (k <= F.lit(cut[1]))))
            test = test | (here & low)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def split_data_with_validation(df: DataFrame, test_size: float = 0.2, val_size: float = 0.2,
                               random_state: int = SEED, stratify: bool = True, label: str = LABEL,
                               key: str = ROW_ID) -> DataFrame:
    """test first, then validation as a fraction of the remainder (64/16/20)."""
    first = split_data(df, test_size, random_state, stratify, label, key)
    rest = first.where(F.col("split") == "train").drop("split")
    second = split_data(rest, val_size, random_state + 1, stratify, label, key)
    second = second.withColumn("split", F.when(F.col("split") == "test", "val").otherwise("train"))
    return first.where(F.col("split") == "test").unionByName(second)


def assign_folds(df: DataFrame, k: int = 5, seed: int = SEED, label: str = LABEL, key: str = ROW_ID,
                 rows_per_bin: int = 2_000_000) -> DataFrame:
    """Stratified folds: ``fold = (rank within label - 1) mod k``."""
    hashed = df.withColumn("_h", hash_bits(seed, F.col(key))).withColumn("_one", F.lit(1))
    ranked = prefix_sums(hashed, "_h", {"_one": "_one"}, [label], [key], rows_per_bin, uniform=(0.0, TWO_52))
    return ranked.withColumn("fold", (F.col("_one_before") % k).cast("int")).drop("_one", "_one_before", "_h")


def train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("split") == "train").drop("split"), df.where(F.col("split") == "test").drop("split")
