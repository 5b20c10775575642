"""A k-d tree over rows with missing coordinates, grown by quantile splits.

Inner nodes have three children: at most the threshold, above it, and coordinate
missing; a row therefore lies in exactly one leaf and no column has to be complete.
The tree is grown on the driver from a bounded sample (``SAMPLE`` rows) and the
leaves are then counted over all rows; leaves that hold too many are grown on from a
sample of their own rows until none is left. There are at most about ``MAX_LEAVES``
leaves, so the broadcast tree has a fixed bound; with more rows leaves hold more.

Every node knows, from all rows, the box of its rows, which coordinates all of its
rows have (only those bound a distance from below) and how many rows have each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_ROWS = 1024
MAX_LEAVES = 200_000
SAMPLE = 200_000


class KDTree:
    def __init__(self, dims: int):
        self.dims = dims
        self.feature, self.threshold, self.children = [-1], [0.0], [(-1, -1, -1)]

    # ------------------------------------------------------------ growing

    def grow(self, node: int, x: np.ndarray, leaf_rows: float, nullable: np.ndarray, look: int = 0) -> bool:
        """Splits ``node`` until no leaf holds more than ``leaf_rows`` rows of ``x``; whether it split at all.
        ``look``: about how many of a node's rows choose its split (0: all)."""
        stack, grew = [(node, x)], False
        while stack:
            at, rows = stack.pop()
            split = None
            if len(rows) > leaf_rows:
                split = (self._split(rows[::len(rows) // look]) if 0 < 2 * look <= len(rows) else None) or self._split(rows)
            if split is None:
                continue
            c, t = split
            column = rows[:, c]
            sides = [column <= t, column > t, np.isnan(column)]
            made = []
            for side in sides:
                if side.any() or not (side is sides[2]) or nullable[c]:
                    made.append(len(self.feature))
                    self.feature.append(-1)
                    self.threshold.append(0.0)
                    self.children.append((-1, -1, -1))
                    stack.append((made[-1], rows[side]))
                else:
                    made.append(-1)
            self.feature[at], self.threshold[at], self.children[at] = c, t, tuple(made)
            grew = True
        return grew

    @staticmethod
    def _split(rows: np.ndarray) -> tuple[int, float] | None:
        """The widest coordinate (between its 5 and 95 % points, weighted by the rows that have it) at its median."""
        best, choice = 0.0, None
        for c in range(rows.shape[1]):
            v = np.sort(rows[:, c][~np.isnan(rows[:, c])])
            if len(v) < 2 or v[0] == v[-1]:
                continue
            n = len(v)
            wide = v[int(0.95 * (n - 1))] - v[int(0.05 * (n - 1))] or (v[-1] - v[0]) / n
            if wide * n / len(rows) > best:
                t = v[(n - 1) // 2]
                if t == v[-1]:  # copies of the largest value fill the upper half
                    t = v[np.searchsorted(v, t) - 1]
                best, choice = wide * n / len(rows), (c, float(t))
        if choice is None:  # rows differ only in what they lack
            for c in range(rows.shape[1]):
                if 0 < np.isnan(rows[:, c]).sum() < len(rows):
                    return c, float("inf")
        return choice

    def number_leaves(self) -> None:
        """Leaves in depth-first order: a node's leaves are one range."""
        feature = np.array(self.feature, np.int32)
        n = len(feature)
        self._feature, self._threshold = feature, np.array(self.threshold)
        self._children = np.array(self.children, np.int32).reshape(n, 3)
        self.first, self.last = np.zeros(n, np.int32), np.zeros(n, np.int32)
        leaves, stack = [], [(0, False)]
        while stack:
            at, closing = stack.pop()
            if closing:
                self.last[at] = len(leaves)
                continue
            self.first[at] = len(leaves)
            if feature[at] < 0:
                leaves.append(at)
                self.last[at] = len(leaves)
            else:
                stack.append((at, True))
                stack += [(c, False) for c in reversed(self.children[at]) if c >= 0]
        self.leaves = np.array(leaves, np.int32)

    def set_facts(self, facts: dict[int, tuple]) -> None:
        """``{leaf: (rows, present, least, most)}`` over all rows; inner nodes sum up their children."""
        n, d = len(self._feature), self.dims
        self.rows = np.zeros(n, np.int64)
        self.present = np.zeros((n, d), np.int64)
        self.least, self.most = np.full((n, d), np.inf), np.full((n, d), -np.inf)
        for number, (rows, present, least, most) in facts.items():
            at = self.leaves[number]
            self.rows[at], self.present[at] = rows, present
            self.least[at] = [np.inf if v is None else v for v in least]
            self.most[at] = [-np.inf if v is None else v for v in most]
        for at in range(n - 1, -1, -1):  # children have larger numbers
            for c in self.children[at]:
                if c >= 0:
                    self.rows[at] += self.rows[c]
                    self.present[at] += self.present[c]
                    self.least[at] = np.minimum(self.least[at], self.least[c])
                    self.most[at] = np.maximum(self.most[at], self.most[c])
        self.full = (self.present == self.rows[:, None]) & (self.rows[:, None] > 0)

    # ------------------------------------------------------------ use in tasks

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int32)
        while True:
            inner = np.flatnonzero(self._feature[node] >= 0)
            if not len(inner):
                return self.first[node]
            at = node[inner]
            v = x[inner, self._feature[at]]
            side = np.where(np.isnan(v), 2, np.where(v <= self._threshold[at], 0, 1))
            node[inner] = self._children[at, side]

    def _held(self, node: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
        """Rows of a node that have the wanted coordinate (None: all its rows)."""
        return self.rows[node] if wanted is None else self.present[node, wanted]

    def home(self, x: np.ndarray, wanted: np.ndarray | None, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The leaf range of the deepest node on each row's way down that holds ``least`` rows with coordinate
        ``wanted``; a row that lacks a split coordinate goes where most such rows are."""
        node = np.zeros(len(x), np.int32)
        chosen = node.copy()
        live = np.arange(len(x))
        while len(live):
            at = node[live]
            ok = self._held(at, None if wanted is None else wanted[live]) >= least
            live, at = live[ok], at[ok]
            chosen[live] = at
            inner = self._feature[at] >= 0
            live, at = live[inner], at[inner]
            v = x[live, self._feature[at]]
            kids = self._children[at]
            counts = np.where(kids >= 0, self._held(kids, None if wanted is None else wanted[live][:, None]), -1)
            side = np.where(np.isnan(v), counts.argmax(1), np.where(v <= self._threshold[at], 0, 1))
            node[live] = kids[np.arange(len(live)), side]
        return self.first[chosen], self.last[chosen]

    def within(self, x: np.ndarray, wanted: np.ndarray | None, radius2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf number) for all leaves with rows that have the wanted coordinate and may lie within the radius. A
        distance is weighted by coordinates / shared ones, and a node's rows share at most what some of them have."""
        has, q = ~np.isnan(x), np.nan_to_num(x)
        row, node, out = np.arange(len(x)), np.zeros(len(x), np.int32), []
        limit = radius2 * (1 + 1e-9) + 1e-300
        some = self.present > 0
        while len(row):
            keep = self._held(node, None if wanted is None else wanted[row]) > 0
            row, node = row[keep], node[keep]
            gap = np.maximum(np.maximum(self.least[node] - q[row], q[row] - self.most[node]), 0.0)
            gap[~(self.full[node] & has[row])] = 0.0
            shared = (some[node] & has[row]).sum(1)
            keep = (shared > 0) & ((gap * gap).sum(1) * self.dims <= limit[row] * np.maximum(shared, 1))
            row, node = row[keep], node[keep]
            leaf = self._feature[node] < 0
            out.append((row[leaf], self.first[node[leaf]]))
            row, node = row[~leaf], node[~leaf]
            kids = self._children[node]
            side = kids >= 0
            row, node = np.repeat(row, side.sum(1)), kids[side]
        return np.concatenate([np.empty(0, np.int64), *(r for r, _ in out)]), np.concatenate([np.empty(0, np.int32), *(n for _, n in out)])


def matrix(column, dims: int) -> np.ndarray:
    """An Arrow list column of doubles as rows; nulls become NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)


def _sample(rows: DataFrame, n: int, total: int, dims: int) -> np.ndarray:
    """At most about ``n`` of the rows, by content hash."""
    place = F.pmod(F.xxhash64("x"), F.lit(1 << 30))
    picked = rows if total <= n else rows.where(place < F.lit(int(n / total * (1 << 30))))
    got = picked.select("x").toArrow().column("x").combine_chunks()
    return matrix(got, dims) if len(got) else np.empty((0, dims))


def with_leaf(rows: DataFrame, tree: KDTree) -> DataFrame:
    """Appends ``leaf``."""
    import pyarrow as pa

    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def task(batches):
        for b in batches:
            leaf = shared.value.leaf_of(matrix(b.column(b.schema.get_field_index("x")), shared.value.dims))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int32())], [*b.schema.names, "leaf"])

    return rows.mapInArrow(task, rows.withColumn("leaf", F.lit(0)).schema)


def build(rows: DataFrame, dims: int, write, leaf_rows: int = LEAF_ROWS, max_leaves: int = MAX_LEAVES,
          sample: int = SAMPLE) -> tuple[KDTree, DataFrame]:
    """A tree over ``rows`` (distinct vectors ``x array<double>`` with other columns) and the rows with their leaf.
    ``write(df)`` materialises a frame."""
    facts = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col("x")[c]).alias(f"c{c}") for c in range(dims)]).first()
    total = facts["n"]
    nullable = np.array([facts[f"c{c}"] < total for c in range(dims)])
    leaf_rows = max(leaf_rows, -(-total // max_leaves))
    tree = KDTree(dims)
    got = _sample(rows, sample, total, dims)
    tree.grow(0, got, leaf_rows * len(got) / max(total, 1), nullable)
    while True:
        tree.number_leaves()
        placed = write(with_leaf(rows, tree))
        found = placed.groupBy("leaf").agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.count(F.col("x")[c]) for c in range(dims)]).alias("present"),
            F.array(*[F.min(F.col("x")[c]) for c in range(dims)]).alias("least"),
            F.array(*[F.max(F.col("x")[c]) for c in range(dims)]).alias("most")).collect()  # a row a leaf
        large = {r["leaf"]: r["n"] for r in found if r["n"] > 2 * leaf_rows} if total > sample else {}
        grew = False
        if large:
            crowded = placed.where(F.col("leaf").isin(list(large))) if len(large) < 1000 else placed.join(
                F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in large], "leaf int")), "leaf")
            share = min(1.0, sample / sum(large.values()))
            got = _sample(crowded, sample, sum(large.values()), dims)
            at = tree.leaf_of(got) if len(got) else np.empty(0, np.int32)
            for leaf in large:
                own = got[at == leaf]
                grew |= len(own) > 1 and tree.grow(int(tree.leaves[leaf]), own, max(leaf_rows * share, 1), nullable)
        if not grew:
            tree.set_facts({r["leaf"]: (r["n"], r["present"], r["least"], r["most"]) for r in found})
            return tree, placed
