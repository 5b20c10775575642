"""Exact k-nearest neighbours: C5 imputation over a k-d tree without emitting all
pairs, and the M6 classifier, by the same search where its rows are many.

C5: a search is a (row, missing feature) pair; its donors are the rows that have the
feature. Distances are NaN-aware Euclidean (shared coordinates, weighted by features /
shared coordinates, a weight of at least 1), so a gap in any shared coordinate bounds a
distance from below. Donors that are exact copies collapse to one row with a multiplicity.

1. For each feature that is searched, the donors that have it are put in the leaves of a
   k-d tree over the other features (``kdtree``; rows that lack a split coordinate have a
   branch of their own, so no complete column is needed).
2. Each search visits the smallest subtree on its way down that holds k donors with its
   feature. With k comparable donors found, the k-th distance is a radius; with fewer, it
   visits a subtree eight times as large, up to the whole tree.
3. Each search with a radius visits every other leaf whose box the ball touches. Every
   donor outside is farther than the k-th found, so the result is exact. Nothing is
   capped; ties at equal distance are broken by donor id.

A visit is a row (leaf, search). Leaves hold a bounded number of donors, and searches
that meet in one leaf are split into blocks, each of which gets the leaf's donors. Inside a
task a finer tree over the leaf's donors (``nearby``) finds at most k donors a search, so a
search is shuffled once for tens of thousands of donors and compared with few of them.
"""

from __future__ import annotations

import json
import logging
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, ROW_ID
from quench.operators import kdtree
from quench.operators.nearby import Nearby
from quench.session import scratch_table

log = logging.getLogger(__name__)

#: Donors of a leaf at most (fewer where leaves would not occupy all cores), and searches that meet them in one task.
CELL, BLOCK = 1 << 15, 1 << 15
#: Training rows up to which the classifier holds them in every task.
HELD = 100_000


def _visit(k: int, dims: int):
    """Donors of a leaf against the searches that visit it: ``tid, d2, did, mult, val``."""
    def run(searches: pa.Table, donors: pa.Table) -> pa.Table:
        def column(t, name):
            return t.column(name).combine_chunks()

        out = []
        if searches.num_rows and donors.num_rows:
            donors = donors.sort_by("did")  # so that equal distances are in order of the donor's id
            x, q = kdtree.matrix(column(donors, "x"), dims), kdtree.matrix(column(searches, "x"), dims)
            row, at, d2 = Nearby(x).search(q, k, column(searches, "r2").to_numpy())
            out.append(pa.table({"tid": column(searches, "tid").to_numpy()[row], "d2": d2, "did": column(donors, "did").take(pa.array(at)),
                                 "mult": column(donors, "mult").to_numpy()[at], "val": column(donors, "val").to_numpy()[at]}))
        if not out:
            return pa.table({"tid": pa.array([], pa.int64()), "d2": pa.array([], pa.float64()), "did": column(donors, "did").slice(0, 0),
                             "mult": pa.array([], pa.int64()), "val": pa.array([], pa.float64())})
        return pa.concat_tables(out).combine_chunks()

    return run


def _plan(trees, k: int, wave: int):
    """Which leaves each search visits next: ``leaves``, and the range of leaves visited then."""
    def task(batches):
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            f = col["f"].to_numpy()
            r2 = col["r2"].to_numpy(zero_copy_only=False).astype(float)
            lo, hi = col["lo"].to_numpy().copy(), col["hi"].to_numpy().copy()
            leaves = [[] for _ in range(b.num_rows)]
            x = kdtree.matrix(col["x"], next(iter(trees.value.values())).dims)
            ball = np.isfinite(r2)
            for feature, t in trees.value.items():
                mine = np.flatnonzero(ball & (f == feature))
                for s in range(0, len(mine), 1000):  # bounds the pairs of search and node held at once
                    part = mine[s:s + 1000]
                    row, leaf = t.within(x[part], None, r2[part])
                    row = part[row]
                    fresh = (leaf < lo[row]) | (leaf >= hi[row])
                    order = np.argsort(row[fresh], kind="stable")
                    rows, at = np.unique(row[fresh][order], return_index=True)
                    for i, ls in zip(rows, np.split(leaf[fresh][order], at[1:])):
                        leaves[i] = ls.tolist()
                rest = np.flatnonzero(~ball & (f == feature))
                if len(rest):
                    first, last = t.home(x[rest], None, min(k * 8 ** wave, 1 << 60))
                    for i, a, z in zip(rest, first, last):
                        fresh = np.concatenate([np.arange(a, min(z, lo[i])), np.arange(max(a, hi[i]), z)]) if hi[i] > lo[i] else np.arange(a, z)
                        leaves[i] = fresh[t.rows[t.leaves[fresh]] > 0].tolist()
                        lo[i], hi[i] = a, z
            yield pa.RecordBatch.from_arrays(
                [col["tid"], col["f"], col["x"], col["r2"], pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))],
                ["tid", "f", "x", "r2", "lo", "hi", "leaves"])

    return task


def _write(df: DataFrame) -> DataFrame:
    return scratch_table(df, "knn")


def _leaf_rows(spark: SparkSession, n: int) -> int:
    return min(CELL, max(kdtree.LEAF_ROWS, n // (4 * spark.sparkContext.defaultParallelism)))


def knn_search(searches: DataFrame, donors: DataFrame, dims: int, k: int, leaf_rows: int | None = None) -> DataFrame:
    """``tid, best``: the k nearest donors (d2, did, mult, val) of each search ``tid, f, x``; donors are
    distinct ``did, mult, x``. A donor of multiplicity m counts m times."""
    spark = searches.sparkSession
    if leaf_rows is None:
        leaf_rows = _leaf_rows(spark, donors.count())
    trees, placed = {}, None
    for f in sorted(r["f"] for r in searches.select("f").distinct().collect()):  # at most a row a feature
        x = F.array(*[F.lit(None).cast("double") if c == f else F.col("x")[c] for c in range(dims)])
        having = donors.where(F.col("x")[f].isNotNull()).select("did", "mult", F.col("x")[f].alias("val"), x.alias("x"))
        trees[f], own = kdtree.build(having, dims, _write, leaf_rows)
        own = own.withColumn("f", F.lit(f))
        placed = own if placed is None else placed.unionByName(own)
    if not trees:
        return searches.select("tid", F.lit(None).cast(f"array<struct<d2:double,did:{donors.schema['did'].dataType.simpleString()},mult:bigint,val:double>>").alias("best"))
    return _search(searches, trees, placed, dims, k)


def _search(searches: DataFrame, trees: dict, placed: DataFrame, dims: int, k: int) -> DataFrame:
    """``knn_search`` over donors ``did, mult, val, x, leaf, f`` that lie in the leaves of the tree of their ``f``."""
    spark = searches.sparkSession
    shared = spark.sparkContext.broadcast(trees)
    whole = F.element_at(F.create_map(*[F.lit(v) for f, t in trees.items() for v in (f, len(t.leaves))]), F.col("f"))
    did_type = placed.schema["did"].dataType.simpleString()
    best_type = f"array<struct<d2:double,did:{did_type},mult:bigint,val:double>>"
    state = _write(searches.select("tid", "f", "x", F.lit(float("inf")).alias("r2"), F.lit(0).alias("lo"), F.lit(0).alias("hi"),
                                  F.lit(None).cast(best_type).alias("best")))
    done = []
    wave = 0
    while True:
        plan = state.select("tid", "f", "x", "r2", "lo", "hi").mapInArrow(
            _plan(shared, k, wave), "tid bigint, f int, x array<double>, r2 double, lo int, hi int, leaves array<int>")
        plan = _write(plan)
        visits = plan.select("tid", "f", "x", "r2", F.explode("leaves").alias("leaf"))
        blocks = _write(visits.groupBy("f", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))  # a row a leaf
        left = visits.join(F.broadcast(blocks), ["f", "leaf"]).withColumn("block", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int")).drop("blocks")
        right = placed.join(F.broadcast(blocks), ["f", "leaf"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        found = left.groupBy("f", "leaf", "block").cogroup(right.groupBy("f", "leaf", "block")).applyInArrow(
            _visit(k, dims), f"tid bigint, d2 double, did {did_type}, mult bigint, val double")
        old = state.where(F.col("best").isNotNull()).select("tid", F.explode("best").alias("b")).select("tid", "b.*")
        merged = found.unionByName(old).groupBy("tid").agg(
            F.slice(F.array_sort(F.collect_list(F.struct("d2", "did", "mult", "val"))), 1, k).alias("best"))  # at most k a visit
        kth = F.aggregate("best", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(float("inf")).alias("r")),
                          lambda acc, b: F.when(acc["n"] >= k, acc).otherwise(F.struct(
                              (acc["n"] + b["mult"]).alias("n"), F.when(acc["n"] + b["mult"] >= k, b["d2"]).otherwise(F.lit(float("inf"))).alias("r"))),
                          lambda acc: acc["r"])
        balls = F.col("r2") < F.lit(float("inf"))
        final = balls | (F.col("hi") - F.col("lo") >= whole)
        after = _write(plan.drop("leaves").join(merged, "tid", "left").select(
            "tid", "f", F.when(~final, F.col("x")).alias("x"), F.coalesce(kth, F.lit(float("inf"))).alias("r2"), "lo", "hi", "best",
            final.alias("final")))
        done.append(after.where("final").select("tid", "best"))
        state = after.where("NOT final").drop("final")
        wave += 1
        if state.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def knn_impute(df: DataFrame, features: list[str], k: int = 5, key: str = ROW_ID) -> DataFrame:
    """Each missing value = uniform mean of that feature over the k nearest
    donors (rows with it present) by NaN-aware Euclidean distance over all
    features; the column mean when no donor is comparable."""
    if key not in df.columns:
        # rows without a key of their own get one for the search; equal rows have equal neighbours
        keyed = df.withColumn(key, F.xxhash64(*features)).checkpoint(eager=True)
        filled = knn_impute(keyed, features, k, key)
        return filled.drop(key)
    row = df.agg(*[F.avg(f).alias(f) for f in features], *[F.count_if(F.col(f).isNull()).alias(f"{f}__null") for f in features]).first()
    missing = [f for f in features if row[f"{f}__null"] > 0]
    if not missing:
        return df
    x = F.array(*[F.col(f).cast("double") for f in features])
    some = F.coalesce(*[F.col(f) for f in features]).isNotNull()  # a row without any value has no comparable donor
    donors = df.where(some).groupBy(*features).agg(F.min(key).alias("did"), F.count(F.lit(1)).alias("mult")).select("did", "mult", x.alias("x"))
    lacking = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(i)) for i, f in enumerate(features)]))
    searches = (df.where(some).select(F.col(key).alias("_key"), x.alias("x"), F.explode(lacking).alias("f")).distinct()
                .withColumn("tid", F.monotonically_increasing_id()))
    searches = _write(searches)
    best = knn_search(searches, _write(donors), len(features), k)
    taken = F.aggregate("best", F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("bigint").alias("n")),
                        lambda acc, b: F.struct((acc["s"] + b["val"] * F.least(b["mult"], F.lit(k) - acc["n"])).alias("s"),
                                                (acc["n"] + F.least(b["mult"], F.lit(k) - acc["n"])).alias("n")),
                        lambda acc: F.when(acc["n"] > 0, acc["s"] / acc["n"]))
    fills = searches.join(best.select("tid", taken.alias("fill")), "tid").select("_key", "f", "fill")
    wide = fills.groupBy("_key").agg(*[F.min(F.when(F.col("f") == features.index(f), F.col("fill"))).alias(f"_fill_{f}") for f in missing])
    joined = df.join(wide, df[key] == wide["_key"], "left")
    return joined.select(*[F.coalesce(df[c], F.col(f"_fill_{c}"), F.lit(row[c])).alias(c) if c in missing else df[c] for c in df.columns])


class KNNClassifier:
    """M6: 5-nearest-neighbour vote (uniform), probability = share of class 1; exact over all training rows.

    Of equal training rows only the k of least key can be among the k nearest, so the fit keeps those, numbered in
    order of the key (equal distances go by it). Rows to score are searched once for each distinct one. Up to
    ``held_rows`` kept rows are sent to the tasks with a k-d tree over them (``nearby``); more lie in the leaves
    of a k-d tree and are met as in C5 (``_search``). Nothing is capped. Values that are not finite are compared
    with every held row, or with the first rows of each pattern of infinities, whose distances are all alike."""

    name = "K-Nearest Neighbors"

    def __init__(self, k: int = 5, held_rows: int = HELD, block: int = 256):
        self.k, self.held_rows, self.block = k, held_rows, block

    def __getstate__(self):
        """Without the tables: what tasks need."""
        return {n: v for n, v in self.__dict__.items() if n not in ("kept", "leaves")}

    def fit(self, train: DataFrame, features: list[str], label: str = LABEL, key: str = ROW_ID):
        self.features, self.label, self.key = list(features), label, key
        x = [f"x{i}" for i in range(len(features))]
        nan = F.lit(float("nan"))
        rows = train.select(*[F.coalesce(F.col(f).cast("double"), nan).alias(c) for f, c in zip(features, x)],
                            F.coalesce(F.col(label).cast("int").cast("double"), nan).alias("y"), F.col(key).alias("key"))
        by = [F.col("key").asc_nulls_last(), F.col("y")]
        copy = F.row_number().over(Window.partitionBy(*x).orderBy(*by))
        kept = rows.withColumn("copy", copy).where(F.col("copy") <= self.k).orderBy(*by, *x)
        return self._keep(_write(kept.select(F.monotonically_increasing_id().alias("i"), F.array(*x).alias("x"), "y")))

    def _keep(self, kept: DataFrame) -> "KNNClassifier":
        """Takes the rows ``i, x, y``; those of a small table are held in memory."""
        self.kept, self.x, self.y = kept, None, None
        if kept.count() <= self.held_rows:
            rows = kept.orderBy("i").toArrow()
            self.x = kdtree.matrix(rows.column("x").combine_chunks(), len(self.features))
            self.y = rows.column("y").to_numpy()
        return self

    def save(self, path: str) -> None:
        """The kept training rows as Parquet and the settings as one line of text."""
        self.kept.write.mode("overwrite").parquet(f"{path}/rows")
        meta = {"kind": "nearest neighbours", "features": self.features, "label": self.label, "key": self.key, "k": self.k,
                "held_rows": self.held_rows, "block": self.block}
        self.kept.sparkSession.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> "KNNClassifier":
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        out = cls(meta["k"], meta.get("held_rows", HELD), meta["block"])
        out.features, out.label, out.key = meta["features"], meta["label"], meta["key"]
        return out._keep(spark.read.parquet(f"{path}/rows"))

    def index(self) -> "KNNClassifier":
        """Makes the tree over the training rows; of copies only the first k can be among the k nearest."""
        rows = np.flatnonzero(np.isfinite(self.x).all(1))
        _, copy_of = np.unique(self.x[rows], axis=0, return_inverse=True)
        by = np.argsort(copy_of, kind="stable")
        place = np.arange(len(by)) - np.searchsorted(copy_of[by], copy_of[by])
        self.rows = rows[np.sort(by[place < self.k])]
        self.near = Nearby(self.x[self.rows])
        return self

    def votes(self, q: np.ndarray) -> np.ndarray:
        """Share of class 1 among the k nearest training rows of each row of ``q``."""
        out = np.full(len(q), np.nan)
        k = min(self.k, len(self.x))
        plain = np.isfinite(q).all(1) & (len(self.rows) >= k)
        if k and plain.any():
            at = np.flatnonzero(plain)
            row, found, _ = self.near.search(q[at], k)
            short = np.bincount(row, minlength=len(at)) < k  # squares beyond the largest double
            out[at[~short]] = self.y[self.rows[found[~short[row]]]].reshape(-1, k).mean(1)
            plain[at[short]] = False
        rest = np.flatnonzero(~plain & ~np.isnan(q).any(1))
        for s in range(0, len(rest), self.block) if k else ():
            b = q[rest[s:s + self.block]]
            d = np.zeros((len(b), len(self.x)))
            with np.errstate(invalid="ignore"):
                for f in range(b.shape[1]):  # one feature at a time: exact differences, bounded memory
                    diff = b[:, f, None] - self.x[None, :, f]
                    d += diff * diff
            edge = np.partition(d, k - 1, axis=1)[:, k - 1]
            for i in range(len(b)):
                near = np.flatnonzero(d[i] <= edge[i])
                near = near[np.argsort(d[i][near], kind="stable")][:k]
                if len(near):
                    out[rest[s + i]] = self.y[near].mean()
        return out

    def _held_votes(self, asked: DataFrame) -> DataFrame:
        bc = asked.sparkSession.sparkContext.broadcast(self.index())

        @F.arrow_udf("double")
        def share(x: pa.Array) -> pa.Array:
            return pa.array(bc.value.votes(kdtree.matrix(x, len(bc.value.features))))

        return asked.withColumn("vote", share("x"))

    def _searched_votes(self, asked: DataFrame) -> DataFrame:
        spark, dims, k = asked.sparkSession, len(self.features), self.k
        finite = F.forall("x", lambda v: F.abs(v) < float("inf"))  # false for NaN, which counts as the largest
        if not hasattr(self, "leaves"):
            having = self.kept.where(finite).select(F.col("i").alias("did"), F.lit(1).cast("bigint").alias("mult"), F.col("y").alias("val"), "x")
            tree, placed = kdtree.build(having, dims, _write, _leaf_rows(spark, self.kept.count()))
            self.leaves = {0: tree}, placed.withColumn("f", F.lit(0))
        found = _write(asked.join(_search(asked.where(finite).select("tid", F.lit(0).alias("f"), "x"), *self.leaves, dims, k), "tid", "left"))
        best = F.coalesce("best", F.array().cast(found.schema["best"].dataType))
        taken = F.transform(best, lambda b: F.struct(b["did"].alias("i"), b["val"].alias("y")))
        more = F.array().cast("array<struct<i:bigint,y:double>>")
        far = KNNClassifier(k, block=self.block)
        if not found.where(~finite | (F.size(best) < k)).isEmpty():
            # infinite distances are all alike: only the first rows of each pattern of infinities can count
            pattern = F.transform("x", lambda v: F.when(F.abs(v) == float("inf"), F.signum(v)).otherwise(0.0))
            place = F.row_number().over(Window.partitionBy("pattern").orderBy("i"))
            first = (self.kept.where(~F.exists("x", lambda v: F.isnan(v))).withColumn("pattern", pattern).withColumn("place", place)
                     .where(F.col("place") <= 2 * k).orderBy("i").toArrow())
            x, y = kdtree.matrix(first.column("x").combine_chunks(), dims), first.column("y").to_numpy()
            far.x, far.y = np.vstack([x, np.full((k, dims), np.nan)]), np.append(y, np.full(k, np.nan))
            rows = list(zip(first.column("i").to_pylist(), y.tolist()))[:2 * k]
            more = F.array(*[F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(v).alias("y")) for i, v in rows]) if rows else more
            far.features = self.features
            infinite = far._held_votes(found.where(~finite).select("x"))
        voters = F.slice(F.concat(taken, F.filter(more, lambda m: ~F.exists(taken, lambda t: t["i"] == m["i"]))), 1, k)
        share = F.aggregate(voters, F.lit(0.0), lambda s, v: s + v["y"]) / k
        out = found.where(finite).select("x", F.when(F.size(voters) == k, share).alias("vote"))
        return out if far.__dict__.get("x") is None else out.unionByName(infinite)

    def predict(self, df: DataFrame) -> DataFrame:
        spark, names = df.sparkSession, [f"_q{i}" for i in range(len(self.features))]
        q = [F.col(f).cast("double").alias(n) for f, n in zip(self.features, names)]
        asked = df.select(*q).where(" AND ".join(f"{n} IS NOT NULL AND NOT isnan({n})" for n in names)).distinct()
        asked = _write(asked.select(F.monotonically_increasing_id().alias("tid"), F.array(*names).alias("x")))
        if self.x is not None:
            tasks = max(min(spark.sparkContext.defaultParallelism, -(-asked.count() // 1000)), -(-asked.count() // 50_000), 1)
            votes = _write(self._held_votes(asked.repartition(tasks)))
        else:
            votes = _write(self._searched_votes(asked))
        votes = votes.select(*[F.col("x")[i].alias(n) for i, n in enumerate(names)], "vote")
        on = reduce(Column.__and__, [F.col(f).cast("double") == F.col(n) for f, n in zip(self.features, names)])
        out = df.join(votes.withColumnRenamed("vote", "_vote"), on, "left").withColumn("probability", F.when(~F.isnan("_vote"), F.col("_vote")))
        return out.withColumn("prediction", (F.col("probability") > 0.5).cast("int")).drop("_vote", *names)

    def feature_importance(self):
        return None
