"""Isolation forest (M9) and anomaly scores (M10), after Liu, Ting & Zhou (2008).

Distributed and deterministic:

* sampling -- a pool of about 3*T*psi rows (all rows, if there are fewer) is
  chosen by content hash; every tree draws its own min(psi, n) rows from the
  whole pool by hash(seed, tree, row), so trees see samples of one size at any
  input size. The same rows are chosen for any partitioning.
* building -- ``groupBy(tree).applyInPandas`` grows the T trees in parallel
  with NumPy (random feature, uniform split between the node's min and max,
  depth limit ceil(log2 psi)); the RNG of a tree is seeded by (seed, tree).
* scoring -- the forest (<= T * (2 psi - 1) nodes) is collected and
  broadcast; a vectorised Arrow ``pandas_udf`` walks all trees for a batch
  of rows at once. score(x) = 2 ** (-E[h(x)] / c(psi)); higher = more
  anomalous (the reference's negated ``score_samples``).
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, ROW_ID, SEED
from quench.functions.hashing import hash_uniform
from quench.operators.quantiles import exact_quantiles

EULER = 0.5772156649015329
#: Rows scored at once; a block's arrays stay in the processor's cache.
ROWS = 8192

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left_child int, right_child int, "
               "size int, depth int")


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    nodes = []  # (feature, threshold, left, right, size, depth)

    def build(idx, depth):
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(idx), depth])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            return me
        f = int(cand[rng.integers(cand.size)])  # a feature that still varies in this node
        t = float(rng.uniform(lo[f], hi[f]))
        mask = sub[:, f] < t
        left = build(idx[mask], depth + 1)
        right = build(idx[~mask], depth + 1)
        nodes[me][0], nodes[me][1], nodes[me][2], nodes[me][3] = f, t, left, right
        return me

    build(np.arange(x.shape[0]), 0)
    return nodes


class IsolationForestModel:
    def __init__(self, features, nodes: pd.DataFrame, psi: int, n_trees: int, threshold: float | None = None):
        self.features = list(features)
        self.psi = psi
        self.n_trees = n_trees
        self.threshold = threshold
        self.nodes = nodes = nodes.sort_values(["tree", "node"])
        width = int(nodes.groupby("tree").size().max())
        shape = (n_trees, width)
        self.feat = np.full(shape, -1, dtype=np.int32)
        self.thr = np.zeros(shape)
        self.left = np.full(shape, -1, dtype=np.int32)
        self.right = np.full(shape, -1, dtype=np.int32)
        self.leaf_len = np.zeros(shape)
        t, n = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
        self.feat[t, n] = nodes["feature"].to_numpy()
        self.thr[t, n] = nodes["threshold"].to_numpy()
        self.left[t, n] = nodes["left_child"].to_numpy()
        self.right[t, n] = nodes["right_child"].to_numpy()
        # path length if the walk ends at this node: depth + c(size)
        self.leaf_len[t, n] = nodes["depth"].to_numpy() + np.array([c_factor(s) for s in nodes["size"].to_numpy()])
        self._complete()

    def _complete(self) -> None:
        """The trees as complete ones (a leaf above the last level is repeated below itself; the depth limit keeps them at about
        2 psi nodes): a level's features and thresholds by position, and the path length at each position of the last level."""
        trees = np.arange(self.n_trees)[:, None]
        at = np.zeros((self.n_trees, 1), dtype=np.int64)
        self.levels = []
        while (self.feat[trees, at] >= 0).any():
            inner = self.feat[trees, at] >= 0
            self.levels.append((np.where(inner, self.feat[trees, at], 0).astype(np.int64), self.thr[trees, at]))
            at = np.stack([np.where(inner, self.left[trees, at], at), np.where(inner, self.right[trees, at], at)], 2).reshape(self.n_trees, -1)
        self.ends = self.leaf_len[trees, at]

    def save(self, path: str) -> None:
        """The node table as Parquet and what scoring needs beside it as one line of text."""
        spark = SparkSession.getActiveSession()
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")  # at most T * (2 psi - 1) rows
        meta = {"kind": "isolation forest", "features": self.features, "psi": self.psi, "trees": self.n_trees, "threshold": self.threshold}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> "IsolationForestModel":
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return cls(meta["features"], spark.read.parquet(f"{path}/nodes").toPandas(), meta["psi"], meta["trees"], meta["threshold"])

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row. A step is a few lookups in one level's small tables; a missing value goes right."""
        total = np.zeros(x.shape[0])
        for s in range(0, x.shape[0], ROWS):
            n = min(ROWS, x.shape[0] - s)
            columns = np.ascontiguousarray(x[s:s + n].T).ravel()  # feature by feature
            rows = np.arange(n)
            at, f, xv, tv, left = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n), np.empty(n), np.empty(n, bool)
            levels = [(feature * n, threshold) for feature, threshold in self.levels]
            for t in range(self.n_trees):
                at[:] = 0
                for feature, threshold in levels:
                    np.take(feature[t], at, out=f, mode="clip")
                    np.add(f, rows, out=f)
                    np.take(columns, f, out=xv, mode="clip")
                    np.take(threshold[t], at, out=tv, mode="clip")
                    np.less(xv, tv, out=left)
                    np.multiply(at, 2, out=at)
                    np.add(at, 1, out=at)
                    np.subtract(at, left, out=at)
                np.take(self.ends[t], at, out=xv, mode="clip")
                total[s:s + n] += xv
        return total / self.n_trees

    def score_array(self, x: np.ndarray) -> np.ndarray:
        return np.power(2.0, -self.path_lengths(x) / c_factor(self.psi))

    def score(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        """Appends the anomaly score (vectorised over Arrow batches)."""
        spark = df.sparkSession
        bc = spark.sparkContext.broadcast(self)
        feats = self.features

        @F.pandas_udf("double")
        def _score(s: pd.DataFrame) -> pd.Series:
            model = bc.value
            x = s.to_numpy(dtype=float)
            return pd.Series(model.score_array(x))

        # not deterministic to the optimiser: a filter on the score (a join's "is not null" is one) would be pushed below and walk the trees again
        return df.withColumn(out, _score.asNondeterministic()(F.struct(*[F.col(f).cast("double").alias(f) for f in feats])))

    def predict(self, df: DataFrame, score_col: str = "anomaly_score") -> DataFrame:
        """M9 labels: anomaly (score above the contamination threshold) -> class 0, else 1."""
        scored = df if score_col in df.columns else self.score(df, score_col)
        return scored.withColumn("prediction", F.when(F.col(score_col) > F.lit(self.threshold), 0).otherwise(1))


def fit_isolation_forest(train: DataFrame, features: list[str], n_trees: int = 100, psi: int = 256,
                         contamination: float | None = None, seed: int = SEED, key: str = ROW_ID,
                         label: str = LABEL) -> IsolationForestModel:
    """M9: fit on ``train``; contamination defaults to min(share of class 0, 0.5)."""
    n = train.count()
    psi = int(min(psi, n))
    keep = min(1.0, 3.0 * n_trees * psi / max(n, 1))
    pool = train.where(hash_uniform(seed, "if-keep", F.col(key)) < F.lit(keep)).select(F.col(key), *features)
    pool = pool.checkpoint(eager=True)  # about 3 * n_trees * psi rows at most, whatever the input
    share = min(1.0, 3.0 * psi / max(pool.count(), 1))
    draw = F.xxhash64(F.lit(seed), F.col("tree"), F.col(key))
    sample = (pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
              .withColumn("_h", draw).where(F.pmod("_h", F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))))
    w = Window.partitionBy("tree").orderBy("_h", key)
    sample = sample.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= psi).drop("_r", "_h")
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(key)
        x = pdf[features].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        nodes = _grow(x, rng, max_depth)
        return pd.DataFrame({
            "tree": tree, "node": np.arange(len(nodes), dtype=np.int32),
            "feature": [nd[0] for nd in nodes], "threshold": [float(nd[1]) for nd in nodes],
            "left_child": [nd[2] for nd in nodes], "right_child": [nd[3] for nd in nodes],
            "size": [nd[4] for nd in nodes], "depth": [nd[5] for nd in nodes],
        })

    nodes = sample.groupBy("tree").applyInPandas(build, NODE_SCHEMA)
    # bounded by n_trees * (2 * psi - 1) rows, independent of the data size
    pdf = nodes.toPandas()
    sizes = pdf[pdf["node"] == 0].set_index("tree")["size"]
    if len(sizes) != n_trees:
        raise ValueError("the training table is empty")
    model = IsolationForestModel(features, pdf, psi, n_trees)
    if contamination is None:
        share0 = train.agg(F.avg((F.col(label) == 0).cast("double"))).first()[0] if label in train.columns else 0.1
        contamination = min(share0 or 0.0, 0.5)
    scored = model.score(train.select(*features)).select("anomaly_score").checkpoint(eager=True)
    q = exact_quantiles(scored, ["anomaly_score"], [1.0 - contamination])["anomaly_score"][1.0 - contamination]
    model.threshold = q
    model.contamination = contamination
    return model
