"""Gradient-boosted trees (M4, M8): ``pyspark.ml``'s algorithm on binned rows kept as byte blocks.

Rows are their bins, packed in blocks of up to ``BLOCK`` rows (a byte a feature, feature by feature).
Where the features' bins allow at most ``CELLS`` combinations, equal binned rows become one with a count.
A round is a pass a level: tasks count rows and sum residuals per (node, feature, bin), of the smaller of
two sister nodes only, and the driver adds up these small tables. Each row's score is kept beside its bins
and moved on by one tree a round. Up to ``FIT_ROWS`` rows are boosted inside one task.

Residuals are added as whole multiples of 2**-30, so sums are exact and trees do not depend on how rows lie
in tasks, beyond the sample that proposes the bins (``split_points``).
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, SEED

BINS, BLOCK, CELLS, FIT_ROWS = 32, 65_536, 100_000, 200_000
#: Rounds after which the scores are made anew from the stored bins, so that lineage stays short.
ANEW = 25
_ONE = float(1 << 30)
_EPSILON = 2.0 ** -52


def split_points(df: DataFrame, features: list[str], most: int, seed: int, n: int) -> list[np.ndarray]:
    """Each feature's thresholds between at most ``most`` bins as ``pyspark.ml`` proposes them: from all rows, or from
    the sample of about ``most`` squared rows (10,000 at least) that it would draw."""
    most = min(most, n)
    wanted = max(most * most, 10_000)
    share = wanted / n if wanted < n else 1.0
    rows = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    if share < 1.0:
        spark = df.sparkSession
        drawn = rows._jdf.toJavaRDD().sample(False, share, spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    sample = rows.toArrow()
    return [_thresholds(c.to_numpy().astype(float), most - 1, share * n) for c in sample.columns]


def checked_label(features: list[str], label: str) -> Column:
    """The label as an int; rows that ``pyspark.ml`` refuses to fit (missing or infinite features, another label) raise."""
    fine = F.col(label).isin(0, 1)
    for f in features:
        fine = fine & (F.abs(F.col(f).cast("double")) < float("inf"))  # false for NaN, which counts as the largest
    return F.when(fine, F.col(label).cast("int")).otherwise(F.raise_error(F.lit("trees are fitted on finite features and labels 0 and 1")).cast("int"))


def _thresholds(v: np.ndarray, most: int, total: float) -> np.ndarray:
    """At most ``most`` thresholds at even strides; ``total`` less the other values is the expected count of zeros."""
    values, counts = np.unique(v[(v != 0) & ~np.isnan(v)], return_counts=True)
    if not len(values):
        return np.zeros(0)
    zeros = total - counts.sum() - np.isnan(v).sum()
    if zeros > _EPSILON * len(v) * 100:
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts.astype(float), at, zeros)
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) <= most:
        return middle
    stride, out, upto = total / (most + 1), [], np.cumsum(counts, dtype=float)
    target = stride
    for i in range(1, len(values)):  # a sample larger than expected gives some more
        if abs(upto[i - 1] - target) < abs(upto[i] - target) and len(out) < 255:  # a bin is a byte
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def _bins(column: pa.Array, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of a struct column of doubles, a row of bytes a feature (missing values: the last bin)."""
    n = len(column)
    return np.stack([np.searchsorted(e, column.field(i).to_numpy(zero_copy_only=False).astype(float), side="left").astype(np.uint8)
                     for i, e in enumerate(edges)]) if n else np.zeros((len(edges), 0), np.uint8)


def _residuals(y: np.ndarray, score: np.ndarray, first: bool) -> np.ndarray:
    """What the next tree fits, in multiples of 2**-30: the label (-1 or 1) at first, then the log loss's negative gradient."""
    sign = y * 2.0 - 1.0
    return np.rint((sign if first else 4.0 * sign / (1.0 + np.exp(2.0 * sign * score))) * _ONE)


def _descend(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    node, at = np.zeros(x.shape[1], np.int64), np.arange(x.shape[1])
    for _ in range(levels):
        f = feature[node]
        node = np.where(f >= 0, 2 * node + 1 + (x[f, at] > cut[node]), node)
    return node


def _count(block, feature, cut, nodes, level, first, bins) -> np.ndarray:
    """Rows and summed residuals of the wanted nodes of a level, (nodes, 2, features, bins)."""
    x, y, w, score = block
    number = np.full(len(feature), -1)
    number[nodes] = np.arange(len(nodes))
    k = number[_descend(x, feature, cut, level)]
    own = np.flatnonzero(k >= 0)
    r = _residuals(y[own], score[own], first)
    size = len(nodes) * bins
    out, base = np.zeros((len(nodes), 2, len(x), bins), np.int64), k[own] * bins
    if w is not None:
        copies = w[own]
        r = r.astype(np.int64) * copies
    for j in range(len(x)):
        at = base + x[j, own]
        if w is None:  # at most 2**16 rows of at most 2**32: exact
            n, s = np.bincount(at, None, size), np.bincount(at, r, size).astype(np.int64)
        else:
            n, s = np.zeros((2, size), np.int64)
            np.add.at(n, at, copies)
            np.add.at(s, at, r)
        out[:, 0, j], out[:, 1, j] = n.reshape(-1, bins), s.reshape(-1, bins)
    return out


def _best(hist: np.ndarray):
    """The split (feature, bin) of largest gain, the first of equals, its gain and the rows and sums left of it; None: no split."""
    n, s = hist[0].cumsum(1)[:, :-1], hist[1].cumsum(1)[:, :-1].astype(float)
    rows, total = hist[0, 0].sum(), float(hist[1, 0].sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = n * ((rows - n) / rows) * (s / n - (total - s) / (rows - n)) ** 2
    gain[(n == 0) | (n == rows)] = 0.0
    if not gain.size:
        return None
    f, b = divmod(int(gain.argmax()), gain.shape[1])
    if gain[f, b] / _ONE ** 2 <= _EPSILON * rows:
        return None
    return f, b, float(gain[f, b]) / _ONE ** 2, int(n[f, b]), int(hist[1, f, :b + 1].sum())


def _grow(count, depth: int) -> dict[str, np.ndarray]:
    """One regression tree: the children of node i are 2 i + 1 and 2 i + 2. ``count(feature, cut, nodes, level)`` gives histograms."""
    size = 2 ** (depth + 1) - 1
    feature, cut, value, gain = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
    at = {0: count(feature, cut, [0], 0)[0]}
    value[0] = at[0][1, 0].sum() / at[0][0, 0].sum() / _ONE
    for level in range(depth):
        smaller = []
        for node, hist in at.items():
            best = _best(hist)
            if best is None:
                continue
            feature[node], cut[node], gain[node], n, s = best
            rows, total = int(hist[0, 0].sum()), int(hist[1, 0].sum())
            value[2 * node + 1], value[2 * node + 2] = s / n / _ONE, (total - s) / (rows - n) / _ONE
            smaller.append(2 * node + 1 if 2 * n <= rows else 2 * node + 2)
        if not smaller or level + 1 == depth:
            break
        found, parents = count(feature, cut, smaller, level + 1), at
        at = {}
        for node, hist in zip(smaller, found):
            at[node] = hist
            at[node + 1 if node % 2 else node - 1] = parents[(node - 1) // 2] - hist
        at = dict(sorted(at.items()))
    return {"feature": feature, "cut": cut, "value": value, "gain": gain}


def _advance(block, trees, depth: int):
    """The block with its scores moved on by weighted trees."""
    x, y, w, score = block
    for weight, t in trees:
        score = score + weight * t["value"][_descend(x, t["feature"], t["cut"], depth)]
    return x, y, w, score


def _block(row) -> tuple:
    """Arrays of a stored block, scores 0."""
    y = np.frombuffer(row["y"], np.uint8)
    return np.frombuffer(row["x"], np.uint8).reshape(-1, len(y)), y, np.frombuffer(row["w"], np.int64) if row["w"] is not None else None, np.zeros(len(y))


class BoostedTrees:
    """M4 and M8: ``rounds`` trees of ``depth`` levels on the log loss, each but the first weighted by ``rate``."""

    def __init__(self, name: str, rounds: int, depth: int, rate: float, seed: int = SEED, fit_rows: int = FIT_ROWS, cells: int = CELLS):
        self.name, self.rounds, self.depth, self.rate, self.seed, self.fit_rows, self.cells = name, rounds, depth, rate, seed, fit_rows, cells

    # ------------------------------------------------------------ fit

    def _blocks(self, train: DataFrame, label: str) -> DataFrame:
        edges, d = self.edges, len(self.features)
        rows = train.select(checked_label(self.features, label).alias("y"), F.struct(*[F.col(f).cast("double") for f in self.features]).alias("x"))
        kinds = pa.schema([("x", pa.binary()), ("y", pa.binary()), ("w", pa.binary())])

        def packed(x, y, w):
            return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()), pa.array([y.astype(np.uint8).tobytes()], pa.binary()),
                                               pa.array([None if w is None else w.astype(np.int64).tobytes()], pa.binary())], schema=kinds)

        def gather(parts):
            held, n = [], 0
            for p in parts:
                for s in range(0, len(p[1]), BLOCK):
                    piece = [None if a is None else a[..., s:s + BLOCK] for a in p]
                    if n + len(piece[1]) > BLOCK:
                        yield packed(*[None if a[0] is None else np.concatenate(a, -1) for a in zip(*held)])
                        held, n = [], 0
                    held.append(piece)
                    n += len(piece[1])
            if n:
                yield packed(*[None if a[0] is None else np.concatenate(a, -1) for a in zip(*held)])

        def whole(batches):
            yield from gather((_bins(b.column(1), edges), b.column(0).to_numpy(), None) for b in batches if b.num_rows)

        def binned(batches):
            for b in batches:
                x = np.ascontiguousarray(_bins(b.column(1), edges).T)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["y", "x"])

        def counted(batches):
            yield from gather((np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(-1, d).T, b.column(1).to_numpy(), b.column(2).to_numpy())
                              for b in batches if b.num_rows)

        to = "x binary, y binary, w binary"
        if np.prod([len(e) + 1.0 for e in edges]) > self.cells:
            return rows.mapInArrow(whole, to).checkpoint(eager=True)
        equal = rows.mapInArrow(binned, "y int, x binary").groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))
        return equal.select("x", "y", "w").mapInArrow(counted, to).checkpoint(eager=True)

    def fit(self, train: DataFrame, features: list[str], label: str = LABEL) -> "BoostedTrees":
        self.features, self.label = list(features), label
        self.edges = split_points(train, self.features, BINS, self.seed, train.count())
        blocks = self._blocks(train, label)
        n = blocks.agg(F.sum(F.length("y"))).first()[0]
        base = blocks.rdd
        if n <= self.fit_rows:
            self.trees = base.coalesce(1).mapPartitions(self._in_task()).collect()
        else:
            self.trees = self._over_table(base)
        return self

    def _bins(self) -> int:
        """Bins a feature may have."""
        return max(len(e) for e in self.edges) + 1

    def _weight(self, i: int) -> float:
        return self.rate if i else 1.0

    def _in_task(self):
        rounds, depth, bins, weights = self.rounds, self.depth, self._bins(), [self._weight(i) for i in range(self.rounds)]

        def run(rows):
            blocks = [_block(r) for r in rows]
            for i in range(rounds):
                tree = _grow(lambda feature, cut, nodes, level: sum(_count(b, feature, cut, nodes, level, not i, bins) for b in blocks), depth)  # noqa: B023
                blocks = [_advance(b, [(weights[i], tree)], depth) for b in blocks]
                yield tree

        return run

    def _over_table(self, base) -> list[dict]:
        trees, depth, bins, d = [], self.depth, self._bins(), len(self.features)
        state, stale = base.map(_block).persist(StorageLevel.MEMORY_AND_DISK), None
        for i in range(self.rounds):
            def count(feature, cut, nodes, level, state=state, first=not i):
                def task(blocks):
                    total = np.zeros((len(nodes), 2, d, bins), np.int64)
                    for b in blocks:
                        total += _count(b, feature, cut, nodes, level, first, bins)
                    yield total

                return sum(state.mapPartitions(task).collect())  # rows and sums per node, feature and bin

            tree = _grow(count, depth)
            if stale is not None:
                stale.unpersist()
            trees.append(tree)
            if i + 1 < self.rounds:
                if len(trees) % ANEW:
                    step, source = [(self._weight(i), tree)], state
                else:
                    step, source = [(self._weight(j), t) for j, t in enumerate(trees)], base.map(_block)
                stale, state = state, source.map(lambda b, step=step: _advance(b, step, depth)).persist(StorageLevel.MEMORY_AND_DISK)
        state.unpersist()
        return trees

    # ------------------------------------------------------------ use

    def predict(self, df: DataFrame) -> DataFrame:
        """Appends ``prediction`` (int) and ``probability`` of class 1."""
        edges, depth, step = self.edges, self.depth, [(self._weight(i), t) for i, t in enumerate(self.trees)]

        @F.arrow_udf("double")
        def margin(s: pa.Array) -> pa.Array:
            return pa.array(_advance((_bins(s, edges), None, None, np.zeros(len(s))), step, depth)[3])

        out = df.drop("prediction", "probability").withColumn("_m", margin(F.struct(*[F.col(f).cast("double") for f in self.features])))
        return out.withColumn("prediction", (F.col("_m") > 0).cast("int")).withColumn("probability", 1.0 / (1.0 + F.exp(-2.0 * F.col("_m")))).drop("_m")

    def feature_importance(self) -> list[tuple[str, float]]:
        """Mean over trees of each feature's share of the tree's gains."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            own = t["feature"] >= 0
            gains = np.bincount(t["feature"][own], t["gain"][own], len(total))
            total += gains / gains.sum() if gains.sum() else 0.0
        total = total / total.sum() if total.sum() else total
        return sorted(zip(self.features, map(float, total)), key=lambda t: (-t[1], t[0]))

    def save(self, path: str) -> None:
        """Settings, thresholds and trees as one line of text."""
        meta = {"kind": "boosted trees", "name": self.name, "rounds": self.rounds, "depth": self.depth, "rate": self.rate, "seed": self.seed, "label": self.label,
                "features": self.features, "edges": [e.tolist() for e in self.edges], "trees": [{k: v.tolist() for k, v in t.items()} for t in self.trees]}
        SparkSession.getActiveSession().createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> "BoostedTrees":
        meta = json.loads(SparkSession.getActiveSession().read.text(f"{path}/meta").first()[0])
        out = cls(meta["name"], meta["rounds"], meta["depth"], meta["rate"], meta["seed"])
        out.features, out.label, out.edges = meta["features"], meta["label"], [np.array(e) for e in meta["edges"]]
        out.trees = [{k: np.array(v) for k, v in t.items()} for t in meta["trees"]]
        return out
