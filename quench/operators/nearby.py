"""Exact nearest rows inside one task: a k-d tree (``kdtree``) over rows held in memory.

A query first meets the leaf it falls in; its k-th distance there is a radius, and only
the leaves that this ball touches are met then. Queries that meet a leaf do so
together, in NumPy. Nothing is capped; of equal distances the lower row comes first.
"""

from __future__ import annotations

import numpy as np

from quench.operators.kdtree import KDTree

#: Rows of a leaf, rows looked at for a split, and the distances held at once.
LEAF, LOOK, DISTANCES = 128, 512, 1 << 21


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared NaN-aware distances of each row of ``q`` to each of ``x`` (inf: nothing shared)."""
    total, shared = np.zeros((len(q), len(x))), np.zeros((len(q), len(x)))
    for c in range(q.shape[1]):
        a, b = ~np.isnan(q[:, c]), ~np.isnan(x[:, c])
        if not a.any() or not b.any():
            continue
        diff = np.where(a, q[:, c], 0.0)[:, None] - np.where(b, x[:, c], 0.0)[None, :]
        diff *= diff
        if a.all() and b.all():
            shared += 1.0
        else:
            both = a[:, None] & b[None, :]
            diff *= both
            shared += both
        total += diff
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, q.shape[1] / shared * total, np.inf)


def nearest(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest entries of each row; of equal ones those of lower column."""
    if d.shape[1] <= k:
        return tuple(a.ravel() for a in np.indices(d.shape))
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    edge = np.take_along_axis(d, near, 1).max(1)
    for i in np.flatnonzero((d <= edge[:, None]).sum(1) > k):  # ties at the edge
        at = np.flatnonzero(d[i] <= edge[i])
        near[i] = at[np.argsort(d[i][at], kind="stable")][:k]
    return np.repeat(np.arange(len(d)), k), near.ravel()


class Nearby:
    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF):
        self.x, self.tree = x, KDTree(x.shape[1])
        gaps = np.isnan(x)
        self.tree.grow(0, x, leaf_rows, gaps.any(0), LOOK)
        self.tree.number_leaves()
        leaf = self.tree.leaf_of(x)
        self.order = np.argsort(leaf, kind="stable")
        self.starts = np.searchsorted(leaf[self.order], np.arange(len(self.tree.leaves) + 1))
        facts = {}
        for n, (a, z) in enumerate(zip(self.starts[:-1], self.starts[1:])):
            if z > a:
                rows, gap = x[self.order[a:z]], gaps[self.order[a:z]]
                facts[n] = (z - a, (~gap).sum(0), np.where(gap, np.inf, rows).min(0), np.where(gap, -np.inf, rows).max(0))
        self.tree.set_facts(facts)

    def _meet(self, q, row, leaf, k, radius2):
        """At most k (row, index, distance) of each pair of query and leaf, none beyond the query's radius."""
        by = np.argsort(leaf, kind="stable")
        row, leaf = row[by], leaf[by]
        met, first = np.unique(leaf, return_index=True)
        for n, mine in zip(met, np.split(row, first[1:])):
            own = self.order[self.starts[n]:self.starts[n + 1]]
            step = max(1, DISTANCES // max(len(own), 1))
            for s in range(0, len(mine) if len(own) else 0, step):
                part = mine[s:s + step]
                d = distances(q[part], self.x[own])
                inside = (d <= radius2[part][:, None]) & np.isfinite(d)
                many = inside.sum(1) > k
                i, at = np.nonzero(inside & ~many[:, None])
                yield part[i], own[at], d[i, at]
                if many.any():
                    some = np.flatnonzero(many)
                    i, at = nearest(d[some], k)
                    yield part[some[i]], own[at], d[some[i], at]

    def search(self, q: np.ndarray, k: int, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, squared distance) of the k nearest comparable rows of each query within its bound, in that order."""
        radius2 = np.full(len(q), np.inf) if bound is None else bound.astype(float).copy()
        first, last = self.tree.home(q, None, k)
        spans = last - first
        row = np.repeat(np.arange(len(q)), spans)
        leaf = np.arange(len(row)) - np.repeat(np.cumsum(spans) - spans, spans) + first[row]
        found = [*self._meet(q, row, leaf, k, radius2)]
        row, _, d2 = _best(found, k)
        n = np.bincount(row, minlength=len(q))
        farthest = np.zeros(len(q))
        np.maximum.at(farthest, row, d2)
        radius2 = np.where(n >= k, np.minimum(radius2, farthest), radius2)
        rows, leaves = [], []
        for s in range(0, len(q), 1000):  # bounds the pairs of query and node held at once
            r, n = self.tree.within(q[s:s + 1000], None, radius2[s:s + 1000])
            r = r + s
            fresh = (n < first[r]) | (n >= last[r])
            rows.append(r[fresh])
            leaves.append(n[fresh])
        if rows:
            found += self._meet(q, np.concatenate(rows), np.concatenate(leaves), k, radius2)
        return _best(found, k)


def _best(found, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k least (distance, index) of each query."""
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    row, at, d2 = (np.concatenate(a) for a in zip(*found))
    by = np.lexsort((at, d2, row))
    row, at, d2 = row[by], at[by], d2[by]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
    place = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
    keep = place < k
    return row[keep], at[keep], d2[keep]
