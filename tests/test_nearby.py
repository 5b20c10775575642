"""The in-task tree search against all pairs, and how few rows it meets."""

import numpy as np

from quench.operators import nearby
from quench.operators.kdtree import KDTree
from quench.operators.knn import KNNClassifier


def test_search_matches_all_pairs():
    rng = np.random.default_rng(1)
    for n, dims, share in ((800, 3, 0.3), (600, 6, 0.2), (300, 2, 0.6)):
        x, q = np.round(rng.normal(size=(n, dims)), 1), np.round(rng.normal(size=(100, dims)), 1)
        x[rng.random(x.shape) < share] = np.nan
        q[rng.random(q.shape) < share] = np.nan
        bound = np.where(rng.random(100) < 0.5, np.inf, rng.random(100) * 0.3)
        row, at, d2 = nearby.Nearby(x, 16).search(q, 5, bound)
        every = nearby.distances(q, x)
        for i in range(100):
            near = np.lexsort((np.arange(n), every[i]))[:5]
            near = near[np.isfinite(every[i][near]) & (every[i][near] <= bound[i])]
            assert at[row == i].tolist() == near.tolist() and (d2[row == i] == every[i][near]).all()


def test_classifier_meets_few_rows(monkeypatch):
    """20,000 training rows, of which a third are copies of one: a query is compared with less than a twentieth of them."""
    rng = np.random.default_rng(2)
    model = KNNClassifier()
    model.x = rng.random((20_000, 3))
    model.x[::3] = 0.5
    model.y = rng.integers(0, 2, 20_000).astype(float)
    met, plain = [], nearby.distances
    monkeypatch.setattr(nearby, "distances", lambda q, x: met.append(len(q) * len(x)) or plain(q, x))
    q = np.vstack([rng.random((300, 3)), np.full((100, 3), 0.5)])
    got = model.index().votes(q)
    assert 0 < sum(met) < 400 * 20_000 / 20
    for i in range(400):
        assert got[i] == model.y[np.argsort(((model.x - q[i]) ** 2).sum(1), kind="stable")[:5]].mean()


def test_classifier_with_values_that_are_not_finite():
    model = KNNClassifier(3)
    model.x, model.y = np.array([[0.0], [1.0], [np.nan], [np.inf], [2.0]]), np.array([1.0, 1.0, 0.0, 0.0, 0.0])
    got = model.index().votes(np.array([[0.4], [np.nan], [-np.inf]]))
    assert got[0] == 2 / 3 and np.isnan(got[1]) and got[2] == 2 / 3
    model.x, model.y = model.x[2:], model.y[2:]
    assert np.isnan(model.index().votes(np.array([[0.4]]))).all()


def test_leaves_that_share_nothing_are_not_visited():
    """A query with one coordinate visits no leaf whose rows lack it, and no leaf beyond its weighted radius."""
    x = np.array([[v, np.nan] for v in range(8)] + [[np.nan, v] for v in range(8)], float)
    tree = nearby.Nearby(x, 2).tree
    assert isinstance(tree, KDTree)
    _, leaves = tree.within(np.array([[3.0, np.nan]]), None, np.array([np.inf]))
    assert (tree.present[tree.leaves[leaves], 0] > 0).all()
    near = tree.within(np.array([[3.0, np.nan]]), None, np.array([4.0]))[1]  # weight 2: values beyond sqrt(2) are too far
    assert set(tree.leaf_of(x[:8][abs(x[:8, 0] - 3) <= 1])) == set(near.tolist())


def _votes(x, y, key, q, k):
    """The share of class 1 by plain definition: not comparable last, then by distance, then by key (nulls last)."""
    out = []
    for v in q:
        with np.errstate(invalid="ignore", over="ignore"):
            d = ((x - v) ** 2).sum(1) if len(x) else np.zeros(0)
        n = min(k, len(x))
        near = sorted(range(len(x)), key=lambda i: (np.isnan(d[i]), d[i], key[i] is None, key[i] or "", y[i]))[:n]
        out.append(None if np.isnan(v).any() or not n or np.isnan(d[near]).any() or np.isnan(y[near]).any() else y[near].mean())
    return out


def _frame(spark, x, **more):
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    return spark.createDataFrame([(*r, *m) for r, m in zip(rows, zip(*more.values()))], "a double, b double, c double, " + ", ".join(
        f"{n} {'int' if n == 'Potability' else 'string'}" for n in more)).repartition(3)


def test_classifier_votes_over_all_training_rows(spark):
    """Ties, copies, repeated and null keys, gaps and infinite values: the same votes from a held block and from leaves."""
    rng = np.random.default_rng(7)
    x = np.vstack([rng.integers(0, 4, (700, 3)), rng.random((700, 3)) * 4, np.full((30, 3), 1.0)])
    x[5:9] = np.nan
    x[20:26, 0], x[26:30, 1], x[30:33, 2] = np.inf, -np.inf, 1e200
    y = rng.integers(0, 2, len(x))
    key = [None if i % 50 == 3 else f"k{i % 1100:04d}" for i in rng.permutation(len(x))]
    q = np.vstack([rng.integers(0, 4, (60, 3)), rng.random((60, 3)) * 4, [[np.inf, 1, 1], [1, -np.inf, 1], [np.inf, np.inf, 2], [np.nan, 1, 1], [1, 1, 1e200]]])
    want = _votes(x, y.astype(float), key, q, 5)
    train = _frame(spark, x, Potability=y.tolist(), row_id=key)
    test = _frame(spark, q, at=[f"{i:03d}" for i in range(len(q))])
    for held in (100_000, 0):
        model = KNNClassifier(held_rows=held).fit(train, ["a", "b", "c"])
        got = model.predict(test).orderBy("at").collect()
        assert [r["probability"] for r in got] == want
        assert [r["prediction"] for r in got] == [None if w is None else int(w > 0.5) for w in want]


def test_classifier_drops_no_training_row(spark):
    """Each of 120,000 different training rows is its own nearest: a fit on the 100,000 of least hash lost a sixth of them."""
    from pyspark.sql import functions as F

    train = spark.range(120_000).select(F.col("id").cast("string").alias("row_id"), F.col("id").cast("double").alias("a"),
                                        (F.xxhash64("id") % 2 == 0).cast("int").alias("Potability"))
    got = KNNClassifier(1).fit(train, ["a"]).predict(train)
    assert got.where("prediction <> Potability OR prediction IS NULL").isEmpty() and got.count() == 120_000
