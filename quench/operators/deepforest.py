"""Random forest of unlimited depth (M3) by hybrid growth, kept as a node table.

Features are cut into at most ``BINS`` bins at approximate quantiles; a row is its bins as
bytes. Every tree draws Poisson(1) copies of a row by hash of the row's key, so trees are the
same under any partitioning.

1. While a node holds more than ``fit_rows`` rows, it is grown level by level over the whole
   table: tasks add up histograms of the node's drawn features, the histograms are summed and
   the split chosen per node by Spark, and one row a node comes back.
2. A node that fits a task is finished there, whatever the depth: ``groupBy(part)`` hands its rows
   (bytes) to one task, which grows all open nodes of a level at once in NumPy.

The upper nodes (about ``rows / fit_rows`` a tree) are broadcast. The finished subtrees grow with the
data and are never collected or broadcast: rows to score are routed through the upper nodes
and meet the subtrees in a co-group, large parts in blocks.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, ROW_ID, SEED
from quench.session import scratch_table

BINS = 128
FIT_ROWS = 200_000
#: Nodes whose histograms one task adds up at once, and rows scored against one subtree at once.
OPEN_NODES, BLOCK = 2000, 200_000
#: Rows a node from which histograms over all bins are cheaper than sorting the rows; rows counted at once.
CROWDED, COUNTED = 64, 65_536
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
_NODES = "part bigint, node int, feature int, bin int, low int, high int, n0 double, n1 double, gain double"
INNER, LEAF, OPEN, PART = range(4)


def copies(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) copies of rows (by key hash) in a tree's sample."""
    z = h.astype(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return np.searchsorted(_POISSON, (z >> np.uint64(11)).astype(float) / (1 << 53), side="right")


def best_splits(hist: np.ndarray, loss=None) -> tuple[np.ndarray, np.ndarray]:
    """Of histograms (..., bins, 2): the least loss (the summed Gini impurity of both sides) and its bin (inf: no split)."""
    low0, low1 = hist[..., 0].cumsum(-1), hist[..., 1].cumsum(-1)
    impurity = (loss or _impurity)(low0, low1, low0[..., -1:] - low0, low1[..., -1:] - low1)
    at = impurity.argmin(-1)
    return np.take_along_axis(impurity, at[..., None], -1)[..., 0], at


def _impurity(low0, low1, high0, high1) -> np.ndarray:
    """Summed Gini impurity of both sides by their rows of class 0 and 1 (inf where a side is empty)."""
    nl, nr = low0 + low1, high0 + high1
    with np.errstate(divide="ignore", invalid="ignore"):
        impurity = nl - (low0 * low0 + low1 * low1) / nl + nr - (high0 * high0 + high1 * high1) / nr
    impurity[(nl <= 0) | (nr <= 0)] = np.inf
    return impurity


def _negative_gain(low0, low1, high0, high1) -> np.ndarray:
    """Minus the Gini gain as ``pyspark.ml`` computes it, term by term (inf where a side is empty)."""
    def gini(a, b):
        return 1.0 - (a / (a + b)) * (a / (a + b)) - (b / (a + b)) * (b / (a + b))

    nl, nr = low0 + low1, high0 + high1
    n = nl + nr
    with np.errstate(divide="ignore", invalid="ignore"):
        loss = -(gini(low0 + high0, low1 + high1) - nl / n * gini(low0, low1) - nr / n * gini(high0, high1))
    loss[(nl <= 0) | (nr <= 0)] = np.inf
    return loss


def sparse_splits(k: np.ndarray, b: np.ndarray, y: np.ndarray, w: np.ndarray, count: int, loss=_impurity, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """``best_splits`` of ``count`` nodes (each with rows) from their rows sorted by bin: no empty bin is touched, so small nodes cost
    what their rows cost. Rows are node, bin, class and copies."""
    packed = np.sort((k * bins + b) << 32 | np.arange(len(k)))
    key, row = packed >> 32, packed & 0xFFFFFFFF
    one = w[row] * y[row]
    end = np.flatnonzero(np.append(key[1:] != key[:-1], True))  # the last row of each (node, bin)
    low0, low1 = (w[row] - one).cumsum()[end], one.cumsum()[end]
    node, cut = key[end] // bins, key[end] % bins
    first = np.searchsorted(node, np.arange(count + 1))
    before = [np.insert(c, 0, 0.0)[first] for c in (low0, low1)]
    low0, low1, all0, all1 = low0 - before[0][node], low1 - before[1][node], np.diff(before[0])[node], np.diff(before[1])[node]
    impurity = loss(low0, low1, all0 - low0, all1 - low1)
    least = np.minimum.reduceat(impurity, first[:-1])
    hits = np.flatnonzero(impurity == least[node])
    return least, cut[hits[np.searchsorted(node[hits], np.arange(count))]]


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, m: int, rng: np.random.Generator, levels: float = math.inf, gain_only: bool = False,
         bins: int = BINS) -> dict[str, np.ndarray]:
    """A whole tree over binned rows: all open nodes of a level at once, ``m`` drawn features a node
    (all of them where none of those divides it), at most ``levels`` deep. ``gain_only``: splits by the gain as
    ``pyspark.ml`` computes it, features in their order, none without a gain."""
    loss = _negative_gain if gain_only else _impurity
    d = x.shape[1]
    out = {k: [] for k in ("feature", "bin", "low", "high", "n0", "n1", "gain")}
    rows, at, base, count = np.arange(len(x)), np.zeros(len(x), np.int64), 0, 1
    while count:
        levels -= 1
        totals = np.bincount(at * 2 + y[rows], w[rows], count * 2).reshape(count, 2)
        impure = (totals.min(1) > 0) & (levels >= 0)
        best = np.full(count, 0.0 if gain_only else np.inf)
        feature, cut = np.full(count, -1), np.zeros(count, np.int64)
        drawn = np.tile(np.arange(d), (count, 1)) if gain_only else rng.random((count, d)).argsort(1)
        order = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(count + 1))
        for j in range(d):
            todo = np.flatnonzero(impure & (np.isinf(best) if j >= m else True))
            if j >= m and not len(todo):
                break
            crowded = (ends[todo + 1] - ends[todo]).sum() > CROWDED * len(todo)
            for s in range(0, len(todo), OPEN_NODES if crowded else max(1, len(todo))):
                nodes = todo[s:s + OPEN_NODES] if crowded else todo
                number = np.full(count, -1)
                number[nodes] = np.arange(len(nodes))
                own = order[ends[nodes[0]]:ends[nodes[-1] + 1]]
                own = own[number[at[own]] >= 0]
                r, k = rows[own], number[at[own]]
                b = x[r, drawn[at[own], j]]
                if crowded:
                    hist = np.bincount((k * bins + b) * 2 + y[r], w[r], len(nodes) * bins * 2).reshape(-1, bins, 2)
                    impurity, where = best_splits(hist, loss) if gain_only else best_splits(hist)
                else:
                    impurity, where = sparse_splits(k, b, y[r], w[r], len(nodes), loss, bins)
                better = impurity < best[nodes]
                best[nodes[better]], feature[nodes[better]], cut[nodes[better]] = impurity[better], drawn[nodes[better], j], where[better]
        split = feature >= 0
        first = base + count + 2 * (np.cumsum(split) - 1)
        n = totals.sum(1)
        out["feature"].append(feature)
        out["bin"].append(cut)
        out["low"].append(np.where(split, first, -1))
        out["high"].append(np.where(split, first + 1, -1))
        out["n0"].append(totals[:, 0])
        out["n1"].append(totals[:, 1])
        out["gain"].append(np.where(split, -best * n if gain_only else n - (totals ** 2).sum(1) / n - np.where(split, best, 0.0), 0.0))
        keep = split[at]
        rows, at = rows[keep], at[keep]
        at = first[at] - base - count + (x[rows, feature[at]] > cut[at])
        base, count = base + count, 2 * int(split.sum())
    return {k: np.concatenate(v) for k, v in out.items()}


def descend(x: np.ndarray, node: np.ndarray, feature, cut, low, high) -> np.ndarray:
    while True:
        inner = np.flatnonzero(feature[node] >= 0)
        if not len(inner):
            return node
        at = node[inner]
        node[inner] = np.where(x[inner, feature[at]] <= cut[at], low[at], high[at])


def prune(tree: dict[str, np.ndarray]) -> None:
    """Makes a leaf of every node whose two children are leaves that say the same class, from the bottom up."""
    feature, one = tree["feature"], tree["n1"] > tree["n0"]
    while True:
        inner = np.flatnonzero(feature >= 0)
        low, high = tree["low"][inner], tree["high"][inner]
        same = inner[(feature[low] < 0) & (feature[high] < 0) & (one[low] == one[high])]
        if not len(same):
            return
        feature[same], tree["low"][same], tree["high"][same], tree["gain"][same] = -1, -1, -1, 0.0


def _bytes(column, dims: int) -> np.ndarray:
    """The values of a binary column, all of ``dims`` bytes, as rows of a matrix (no copy of a value through Python)."""
    parts = []
    for c in getattr(column, "chunks", [column]):
        if len(c):
            start = np.frombuffer(c.buffers()[1], np.int64 if pa.types.is_large_binary(c.type) else np.int32)[c.offset]
            parts.append(np.frombuffer(c.buffers()[2], np.uint8, len(c) * dims, start))
    return np.concatenate(parts).reshape(-1, dims) if parts else np.zeros((0, dims), np.uint8)


def _binary(rows: np.ndarray) -> pa.Array:
    """A byte matrix as a binary column."""
    n, width = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _blocks(batches, dims: int):
    """Bins, class and key hash of ``COUNTED`` rows or more at once, from batches of (h, y, x)."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= COUNTED:
            t = pa.Table.from_batches(held)
            yield _bytes(t.column("x"), dims), t.column("y").to_numpy(), t.column("h").to_numpy()
            held, n = [], 0
    if n:
        t = pa.Table.from_batches(held)
        yield _bytes(t.column("x"), dims), t.column("y").to_numpy(), t.column("h").to_numpy()


class _Top:
    """The upper nodes of all trees; node t is the root of tree t."""

    def __init__(self, trees: int):
        self.feature, self.cut, self.low, self.high = [-1] * trees, [0] * trees, [-1] * trees, [-1] * trees
        self.n, self.gain, self.kind, self.tree, self.tries = [(0.0, 0.0)] * trees, [0.0] * trees, [OPEN] * trees, list(range(trees)), [0] * trees
        self.level = [0] * trees

    def add(self, tree: int, n: tuple[float, float], kind: int, level: int = 0) -> int:
        for column, value in zip((self.feature, self.cut, self.low, self.high, self.n, self.gain, self.kind, self.tree, self.tries, self.level),
                                 (-1, 0, -1, -1, n, 0.0, kind, tree, 0, level)):
            column.append(value)
        return len(self.feature) - 1

    def arrays(self):
        return tuple(np.array(c, np.int32) for c in (self.feature, self.cut, self.low, self.high))


class DeepForest:
    """M3 with the reference's defaults: 100 trees, square root of the features a node, no depth limit."""

    name = "Random Forest"
    saved_as = "deep forest"
    levels: float = math.inf
    #: One tree on the rows themselves: all features in their order, ``pyspark.ml``'s gain.
    single = False

    def __init__(self, trees: int = 100, seed: int = SEED, fit_rows: int = FIT_ROWS):
        self.trees, self.seed, self.fit_rows = trees, seed, fit_rows

    # ------------------------------------------------------------ rows as bins

    def _edges(self, df: DataFrame) -> list[list[float]]:
        probs = [i / BINS for i in range(1, BINS)]
        row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), probs, 10_000).alias(f"e{i}") for i, f in enumerate(self.features)]).first()
        return [sorted({float(v) for v in row[f"e{i}"] or () if not math.isnan(v)}) for i in range(len(self.features))]

    def _binned(self, df: DataFrame, keep: dict) -> DataFrame:
        """The kept columns and ``x``: a byte a feature (missing values: the last bin)."""
        names = list(keep)
        source = df.select(*[c.alias(n) for n, c in keep.items()], F.array(*[F.col(f).cast("double") for f in self.features]).alias("x"))
        edges = [np.array(e) for e in self.edges]

        def task(batches):
            for b in batches:
                v = b.column(b.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(edges))
                bins = np.stack([np.searchsorted(e, v[:, i], side="left") for i, e in enumerate(edges)], 1).astype(np.uint8) if len(v) else v.astype(np.uint8)
                yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(n)) for n in names], _binary(bins)],
                                                 [*names, "x"])

        return source.mapInArrow(task, source.withColumn("x", F.lit(b"")).schema)

    # ------------------------------------------------------------ fit

    def fit(self, train: DataFrame, features: list[str], label: str = LABEL, key: str = ROW_ID) -> "DeepForest":
        self.features, self.label = list(features), label
        self.edges = self._edges(train)
        d = len(self.features)
        self.m = d if self.single else max(1, int(math.sqrt(d)))
        labelled = self._labelled(train)
        rows = self._binned(labelled, {"h": F.lit(0).cast("long") if self.single else F.xxhash64(F.col(key)), "y": F.col(label).cast("int")})
        # the forest has a hundred trees' work on a row, so it keeps the rows' tasks
        rows = scratch_table(rows, "binned") if self.single else rows.checkpoint(eager=True)
        n = rows.count()
        top = _Top(self.trees)
        if n <= self.fit_rows:
            top.kind = [PART] * self.trees
        while OPEN in top.kind:
            self._level(rows, top, d)
        self.top = top
        self.nodes = self._finish(rows, top, d).checkpoint(eager=True)
        return self

    def _labelled(self, train: DataFrame) -> DataFrame:
        return train.where(F.col(self.label).isNotNull())

    def _bins(self) -> int:
        """Bins a feature may have (``pyspark.ml``'s sample can propose some more than asked for)."""
        return max([BINS, *(len(e) + 1 for e in self.edges)])

    def _copies(self):
        """The function that gives rows' copies in a tree."""
        return (lambda h, t, seed: np.ones(len(h), np.int64)) if self.single else copies

    def _drawn(self, node: int, attempt: int, d: int) -> np.ndarray:
        if self.single:
            return np.arange(d)
        return np.random.default_rng([self.seed, 1, node]).permutation(d)[attempt * self.m:(attempt + 1) * self.m]

    def _level(self, rows: DataFrame, top: _Top, d: int) -> None:
        """Splits open nodes (as many as one task can hold histograms of) over the whole table."""
        some = [i for i, k in enumerate(top.kind) if k == OPEN][:OPEN_NODES]
        number = np.full(len(top.kind), -1)
        number[some] = np.arange(len(some))
        drawn = np.full((len(some), self.m), -1)
        for i, node in enumerate(some):
            f = self._drawn(node, top.tries[node], d)
            drawn[i, :len(f)] = f
        arrays, trees, seed, m, drawn_copies, single = top.arrays(), sorted({top.tree[i] for i in some}), self.seed, self.m, self._copies(), self.single
        bins = self._bins()

        of = {t: np.array([i for i, node in enumerate(some) if top.tree[node] == t]) for t in trees}
        for own in of.values():
            number[np.array(some)[own]] = np.arange(len(own))  # a tree's open nodes, counted from 0

        def count(batches):
            hist = np.zeros((len(some), m, bins, 2), np.int64)
            for x, y, h in _blocks(batches, d):
                for t, own in of.items():
                    w = drawn_copies(h, t, seed)
                    r = np.flatnonzero(w)
                    k = number[descend(x[r], np.full(len(r), t), *arrays)]
                    r, k = r[k >= 0], k[k >= 0]
                    if not len(r):
                        continue
                    yr, wr = y[r], w[r]
                    for j in range(m):
                        f = drawn[own[k], j]
                        ok = f >= 0
                        at = (k[ok] * bins + x[r[ok], f[ok]]) * 2 + yr[ok]
                        hist[own, j] += np.bincount(at, wr[ok], len(own) * bins * 2).reshape(-1, bins, 2).astype(np.int64)
            used = np.flatnonzero(hist.any((1, 2, 3)))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([hist[i].tobytes() for i in used], pa.binary())], ["k", "hist"])

        def choose(part: pa.Table) -> pa.Table:
            k = part.column("k")[0].as_py()
            hist = sum(np.frombuffer(v, np.int64).astype(float) for v in part.column("hist").to_pylist()).reshape(m, bins, 2)
            impurity, at = best_splits(hist, _negative_gain if single else None)
            impurity[(drawn[k] < 0) | (single & (impurity >= 0))] = np.inf
            j = int(impurity.argmin())
            total, low = hist[j].sum(0), hist[j, :at[j] + 1].sum(0)
            return pa.table({"k": pa.array([k], pa.int32()), "feature": pa.array([int(drawn[k, j]) if np.isfinite(impurity[j]) else -1], pa.int32()),
                             "bin": pa.array([int(at[j])], pa.int32()), "impurity": [float(impurity[j])], "n0": [float(total[0])], "n1": [float(total[1])],
                             "l0": [float(low[0])], "l1": [float(low[1])]})

        found = rows.select("h", "y", "x").mapInArrow(count, "k int, hist binary").groupBy("k").applyInArrow(
            choose, "k int, feature int, bin int, impurity double, n0 double, n1 double, l0 double, l1 double").collect()  # a row a node
        by = {r["k"]: r for r in found}
        for i, node in enumerate(some):
            r = by.get(i)
            if r is None:
                top.kind[node] = LEAF
                continue
            total = np.array([r["n0"], r["n1"]])
            top.n[node] = tuple(total)
            if total.min() == 0 or (r["feature"] < 0 and (top.tries[node] + 1) * self.m >= d):
                top.kind[node] = LEAF
            elif r["feature"] < 0:
                top.tries[node] += 1  # none of the drawn features divides it: draw on
            else:
                top.kind[node], top.feature[node], top.cut[node] = INNER, r["feature"], r["bin"]
                top.gain[node] = float(total.sum() * -r["impurity"] if self.single else total.sum() - (total ** 2).sum() / total.sum() - r["impurity"])
                low = np.array([r["l0"], r["l1"]])
                for side, counts in (("low", low), ("high", total - low)):
                    kind = LEAF if counts.min() == 0 or top.level[node] + 1 >= self.levels else PART if counts.sum() <= self.fit_rows else OPEN
                    getattr(top, side)[node] = top.add(top.tree[node], tuple(counts), kind, top.level[node] + 1)

    def _finish(self, rows: DataFrame, top: _Top, d: int) -> DataFrame:
        arrays, kind, seed, trees, m, drawn_copies, single = top.arrays(), np.array(top.kind), self.seed, self.trees, self.m, self._copies(), self.single
        bins = self._bins()
        left = {i: self.levels - top.level[i] for i in np.flatnonzero(kind == PART).tolist()} if single else {}

        def deal(batches):
            for x, y, h in _blocks(batches, d):
                for t in range(trees):
                    w = drawn_copies(h, t, seed)
                    r = np.flatnonzero(w)
                    node = descend(x[r], np.full(len(r), t), *arrays)
                    own = kind[node] == PART
                    r, node = r[own], node[own]
                    if len(r):  # class and copies (at most 12) ride in a last byte of x
                        dealt = np.column_stack([x[r], (w[r] * 2 + y[r]).astype(np.uint8)])
                        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), _binary(dealt)], ["part", "x"])

        def finish(part: pa.Table) -> pa.Table:
            number, x = part.column("part")[0].as_py(), _bytes(part.column("x"), d + 1)
            # copies are whole numbers, so the tree does not depend on the rows' order
            made = grow(np.ascontiguousarray(x[:, :d]), (x[:, d] & 1).astype(np.int64), (x[:, d] >> 1).astype(float), m, np.random.default_rng([seed, 2, number]),
                        left.get(number, math.inf), single, bins)
            if single:
                prune(made)
            n = len(made["feature"])
            kinds = {"feature": pa.int32(), "bin": pa.int32(), "low": pa.int32(), "high": pa.int32()}
            return pa.table({"part": pa.array(np.full(n, number), pa.int64()), "node": pa.array(np.arange(n), pa.int32()),
                             **{k: pa.array(v, kinds.get(k, pa.float64())) for k, v in made.items()}})

        dealt = rows.select("h", "y", "x").mapInArrow(deal, "part bigint, x binary")
        if single:  # few bytes, much work: tasks as many as parts, which adaptive execution would merge
            dealt = dealt.repartition(max(1, len(left)), "part")
        return dealt.groupBy("part").applyInArrow(finish, _NODES)

    # ------------------------------------------------------------ use

    def predict(self, df: DataFrame) -> DataFrame:
        """Appends ``prediction`` and ``probability`` (mean share of class 1 in the trees' leaves)."""
        rows = scratch_table(df.withColumn("_rid", F.monotonically_increasing_id()), "scored")
        binned = self._binned(rows, {"_rid": F.col("_rid")})
        top, d, trees = self.top, len(self.features), self.trees
        arrays, kind = top.arrays(), np.array(top.kind)
        share = np.array([b / (a + b) if a + b else 0.0 for a, b in top.n])

        def route(batches):
            for b in batches:
                x = _bytes(b.column(1), d)
                settled, parts = np.zeros(len(x)), np.full((len(x), trees), -1, np.int64)
                for t in range(trees):
                    node = descend(x, np.full(len(x), t), *arrays)
                    leaf = kind[node] == LEAF
                    settled += np.where(leaf, share[node], 0.0)
                    parts[:, t] = np.where(leaf, -1, node)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(settled), pa.ListArray.from_arrays(np.append(0, (parts >= 0).sum(1).cumsum()).astype(np.int32), parts[parts >= 0])],
                                                 ["_rid", "x", "settled", "parts"])

        routed = binned.mapInArrow(route, "_rid bigint, x binary, settled double, parts array<bigint>").checkpoint(eager=True)
        asked = routed.select("_rid", "x", F.explode("parts").alias("part"))
        blocks = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).checkpoint(eager=True)  # a row a part
        left = asked.join(F.broadcast(blocks), "part").withColumn("block", F.pmod(F.xxhash64("_rid"), F.col("blocks")).cast("int")).drop("blocks")
        right = self.nodes.join(F.broadcast(blocks), "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

        def vote(asked: pa.Table, nodes: pa.Table) -> pa.Table:
            if not asked.num_rows or not nodes.num_rows:
                return pa.table({"_rid": pa.array([], pa.int64()), "p": pa.array([], pa.float64())})
            nodes = nodes.sort_by("node")
            tree = [nodes.column(c).to_numpy() for c in ("feature", "bin", "low", "high")]
            x = _bytes(asked.column("x"), d)
            leaf = descend(x, np.zeros(len(x), np.int32), *tree)
            n0, n1 = nodes.column("n0").to_numpy()[leaf], nodes.column("n1").to_numpy()[leaf]
            return pa.table({"_rid": asked.column("_rid"), "p": n1 / (n0 + n1)})

        votes = left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(vote, "_rid bigint, p double")
        scored = votes.unionByName(routed.select("_rid", F.col("settled").alias("p"))).groupBy("_rid").agg((F.sum("p") / trees).alias("probability"))
        out = rows.drop("prediction", "probability").join(scored, "_rid").drop("_rid")
        return out.withColumn("prediction", (F.round("probability", 12) > 0.5).cast("int")).select(
            *[c for c in df.columns if c not in ("prediction", "probability")], "prediction", "probability")

    def feature_importance(self) -> list[tuple[str, float]]:
        """Mean over trees of each feature's share of the tree's impurity decrease."""
        spark = self.nodes.sparkSession
        top = [(i, self.top.tree[i], self.top.feature[i], self.top.gain[i]) for i in range(len(self.top.tree))]
        of = spark.createDataFrame(top, "part bigint, tree int, feature int, gain double")
        gains = (self.nodes.select("part", "feature", "gain").join(F.broadcast(of.select("part", "tree")), "part").select("tree", "feature", "gain")
                 .unionByName(of.select("tree", "feature", "gain")).where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("g")).collect())
        total, out = {}, dict.fromkeys(self.features, 0.0)
        for r in gains:
            total[r["tree"]] = total.get(r["tree"], 0.0) + r["g"]
        for r in gains:
            out[self.features[r["feature"]]] += r["g"] / total[r["tree"]] / len(total)
        return sorted(out.items(), key=lambda t: (-t[1], t[0]))

    def depth(self) -> int:
        """The depth of the deepest tree's finished part (levels below its root)."""
        def deepest(part: pa.Table) -> pa.Table:
            part = part.sort_by("node")
            low, high = part.column("low").to_numpy(), part.column("high").to_numpy()
            level = np.zeros(len(low), np.int32)
            for i in np.flatnonzero(low >= 0):  # children follow their parents
                level[low[i]] = level[high[i]] = level[i] + 1
            return pa.table({"depth": pa.array([int(level.max())], pa.int32())})

        return self.nodes.groupBy("part").applyInArrow(deepest, "depth int").agg(F.max("depth")).first()[0] or 0

    def save(self, path: str) -> None:
        """The node tables and what scoring needs beside them, as Parquet and one line of text."""
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        t = self.top
        rows = [(i, *map(int, r[:6]), *map(float, r[6:])) for i, r in enumerate(
            (f, c, lo, hi, k, tr, n[0], n[1], g) for f, c, lo, hi, k, tr, n, g in zip(t.feature, t.cut, t.low, t.high, t.kind, t.tree, t.n, t.gain))]
        spark.createDataFrame(rows, "node int, feature int, bin int, low int, high int, kind int, tree int, n0 double, n1 double, gain double") \
            .write.mode("overwrite").parquet(f"{path}/top")
        meta = {"name": self.name, "kind": self.saved_as, "trees": self.trees, "seed": self.seed, "fit_rows": self.fit_rows, "features": self.features,
                "label": self.label, "edges": self.edges}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> "DeepForest":
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        out = cls(meta["trees"], meta["seed"], meta["fit_rows"])
        out.features, out.label, out.edges = meta["features"], meta["label"], meta["edges"]
        out.m = max(1, int(math.sqrt(len(out.features))))
        out.nodes = spark.read.parquet(f"{path}/nodes")
        rows = spark.read.parquet(f"{path}/top").orderBy("node").collect()
        out.top = top = _Top(0)
        for r in rows:
            i = top.add(r["tree"], (r["n0"], r["n1"]), r["kind"])
            top.feature[i], top.cut[i], top.low[i], top.high[i], top.gain[i] = r["feature"], r["bin"], r["low"], r["high"], r["gain"]
        return out


class DeepTree(DeepForest):
    """M2: one tree of at most 30 levels on the rows themselves, split and pruned as ``pyspark.ml``'s."""

    name = "Decision Tree"
    saved_as = "deep tree"
    single = True

    def __init__(self, trees: int = 1, seed: int = SEED, fit_rows: int = FIT_ROWS, levels: int = 30):
        super().__init__(1, seed, fit_rows)
        self.levels = levels

    def _edges(self, df: DataFrame) -> list[list[float]]:
        from quench.operators.boosted import split_points

        return [e.tolist() for e in split_points(df, self.features, BINS, self.seed, df.count())]

    def _labelled(self, train: DataFrame) -> DataFrame:
        from quench.operators.boosted import checked_label

        return train.withColumn(self.label, checked_label(self.features, self.label))

    def fit(self, train: DataFrame, features: list[str], label: str = LABEL, key: str = ROW_ID) -> "DeepTree":
        super().fit(train, features, label, key)
        top = self.top
        for r in self.nodes.where("node = 0").collect():  # a row a part
            top.n[r["part"]] = (r["n0"], r["n1"])
            if r["feature"] < 0:
                top.kind[r["part"]] = LEAF
        for i in reversed(range(len(top.kind))):  # children follow their parents
            sides = (top.low[i], top.high[i])
            if top.kind[i] == INNER and all(top.kind[s] == LEAF for s in sides) and len({top.n[s][1] > top.n[s][0] for s in sides}) == 1:
                top.kind[i], top.feature[i], top.low[i], top.high[i], top.gain[i] = LEAF, -1, -1, -1, 0.0
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """M11, as the forest; a tree of few nodes goes to the rows instead."""
        if self.nodes.count() > self.NARROW:
            return super().predict(df)
        top, edges, d = self.top, [np.array(e) for e in self.edges], len(self.features)
        feature, cut, low, high = (c.astype(np.int64) for c in top.arrays())
        n = np.array(top.n, float).reshape(-1, 2)
        t = self.nodes.orderBy("part", "node").toPandas()
        if len(t):
            part, node = t["part"].to_numpy(), t["node"].to_numpy()
            base = len(feature) + np.flatnonzero(node == 0)
            start = np.repeat(base, np.diff(np.append(np.flatnonzero(node == 0), len(t))))
            moved = [np.where(t[c] >= 0, t[c] + start, -1) for c in ("low", "high")]
            roots = dict(zip(part[node == 0].tolist(), base.tolist()))
            to = np.array([roots.get(i, i) if k == PART else i for i, k in enumerate(top.kind)])
            low, high = (np.append(np.where(a >= 0, to[a], -1), b) for a, b in zip((low, high), moved))
            feature, cut = np.append(feature, t["feature"]), np.append(cut, t["bin"])
            n, root = np.concatenate([n, t[["n0", "n1"]].to_numpy()]), int(to[0])
        else:
            root = 0
        share = np.divide(n[:, 1], n.sum(1), out=np.zeros(len(n)), where=n.sum(1) > 0)

        @F.arrow_udf("double")
        def score(s: pa.Array) -> pa.Array:
            x = np.stack([np.searchsorted(edges[i], s.field(i).to_numpy(zero_copy_only=False).astype(float), side="left") for i in range(d)], 1) if len(s) else np.zeros((0, d), int)
            return pa.array(share[descend(x, np.full(len(s), root), feature, cut, low, high)])

        out = df.drop("prediction", "probability").withColumn("_p", score(F.struct(*[F.col(f).cast("double") for f in self.features])))
        return out.withColumn("prediction", (F.col("_p") > 0.5).cast("int")).withColumnRenamed("_p", "probability")

    #: Nodes up to which a tree is sent to the tasks that score rows (some 40 bytes a node).
    NARROW = 500_000
