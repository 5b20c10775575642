"""The forest without a depth limit: whole trees, growth split between tasks, partitioning, saving."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, ROW_ID
from quench.operators import deepforest
from quench.operators.deepforest import DeepForest
from quench.operators.models import make_model
from quench.plans.queries_models import PLANTED, _planted_split
from quench.sources.io import load_model

from conftest import SF_SMALL


def _leaf_impurity(x, y, w, tree):
    node = deepforest.descend(x, np.zeros(len(x), np.int64), tree["feature"], tree["bin"], tree["low"], tree["high"])
    own = w > 0
    for n in np.unique(node[own]):
        here = own & (node == n)
        if len(np.unique(y[here])) > 1:
            assert (x[here] == x[here][0]).all()  # only rows that no feature tells apart share a mixed leaf
        assert tree["n0"][n] == w[here & (y == 0)].sum() and tree["n1"][n] == w[here & (y == 1)].sum()


def test_grown_to_the_end():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 6, (2000, 4)).astype(np.uint8), rng.integers(0, 2, 2000)
    w = rng.poisson(1, 2000).astype(float)
    tree = deepforest.grow(x[w > 0], y[w > 0], w[w > 0], 2, rng)
    _leaf_impurity(x[w > 0], y[w > 0], w[w > 0], tree)
    assert (tree["gain"] >= -1e-9).all()


def test_first_split_is_the_best():
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 9, (300, 3)).astype(np.uint8), rng.integers(0, 2, 300)
    y[x[:, 1] > 5] = 1
    tree = deepforest.grow(x, y, np.ones(300), 3, rng)

    def gini(s):
        return len(s) * 2 * np.mean(s) * (1 - np.mean(s)) if len(s) else 0.0

    best = min((gini(y[x[:, f] <= b]) + gini(y[x[:, f] > b]), f, b) for f in range(3) for b in range(8) if 0 < (x[:, f] <= b).sum() < 300)
    assert gini(y[x[:, tree["feature"][0]] <= tree["bin"][0]]) + gini(y[x[:, tree["feature"][0]] > tree["bin"][0]]) == pytest.approx(best[0])


def test_deeper_than_any_limit():
    """One row in two alternates along one feature: a level a pair is the only way."""
    x = np.arange(120, dtype=np.uint8)[:, None]
    tree = deepforest.grow(x, np.arange(120) % 2, np.ones(120), 1, np.random.default_rng(0))
    _leaf_impurity(x, np.arange(120) % 2, np.ones(120), tree)
    assert (tree["feature"] < 0).sum() == 120


@pytest.fixture(scope="module")
def planted(spark):
    train, test = _planted_split(spark, SF_SMALL)
    return train, test


@pytest.mark.parametrize("fit_rows", [200_000, 600])
def test_planted_rule_partitioning_and_saving(spark, planted, fit_rows):
    train, test = planted
    model = DeepForest(trees=10, fit_rows=fit_rows).fit(train, PLANTED)
    assert (max(model.top.kind) == deepforest.PART) and (len(model.top.kind) > 10) == (fit_rows == 600)
    first = model.predict(test)
    assert first.where(F.col("prediction") != F.col(LABEL)).count() == 0
    rows = sorted(first.select(ROW_ID, "probability").collect())
    moved = DeepForest(trees=10, fit_rows=fit_rows).fit(train.repartition(7), PLANTED)
    assert sorted(moved.predict(test.repartition(5)).select(ROW_ID, "probability").collect()) == rows
    path = tempfile.mkdtemp(prefix="quench-forest-") + "/m"
    model.save(path)
    again = load_model(path)
    assert sorted(again.predict(test).select(ROW_ID, "probability").collect()) == rows
    importance = again.feature_importance()
    assert dict(importance) == pytest.approx(dict(model.feature_importance()))
    assert importance[0][0] == "q" and sum(v for _, v in importance) == pytest.approx(1.0)


def test_edges(spark, planted):
    train, test = planted
    assert isinstance(make_model("Random Forest", 10), DeepForest)
    one = DeepForest(trees=3).fit(train.where(f"{LABEL} = 1"), PLANTED)  # a single class: roots are leaves
    assert one.predict(test).agg(F.min("probability"), F.min("prediction")).first()[:] == (1.0, 1)
    gaps = train.withColumn("q", F.when(F.col("q") > -1, F.col("q")))
    scored = DeepForest(trees=3).fit(gaps, PLANTED).predict(test.withColumn("q", F.lit(None).cast("double")))
    assert scored.count() == test.count() and scored.where("probability IS NULL").isEmpty()
    assert DeepForest(trees=3).fit(train, PLANTED).predict(test.limit(0)).isEmpty()


def test_splits_from_sorted_rows_equal_those_from_histograms():
    rng = np.random.default_rng(9)
    n, count = 900, 40
    k = np.append(np.arange(count), rng.integers(0, count, n - count))
    b, y, w = rng.integers(0, 12, n), rng.integers(0, 2, n), rng.integers(1, 4, n).astype(float)
    b[k == 3] = 7  # one bin: no split
    hist = np.bincount((k * deepforest.BINS + b) * 2 + y, w, count * deepforest.BINS * 2).reshape(-1, deepforest.BINS, 2)
    impurity, cut = deepforest.best_splits(hist)
    least, where = deepforest.sparse_splits(k, b, y, w, count)
    assert np.isinf(least[3]) and (least == impurity).all()
    assert (where == cut)[np.isfinite(least)].all()


def test_small_nodes_are_not_cut_by_histograms(monkeypatch):
    """Noise labels give a node for every few rows: a histogram over all bins for each would cost more than the rows."""
    seen = []
    whole = deepforest.best_splits
    monkeypatch.setattr(deepforest, "best_splits", lambda hist: seen.append(len(hist)) or whole(hist))
    rng = np.random.default_rng(5)
    x, y, w = rng.integers(0, 128, (4000, 5)).astype(np.uint8), rng.integers(0, 2, 4000), np.ones(4000)
    tree = deepforest.grow(x, y, w, 2, np.random.default_rng(1))
    assert (tree["feature"] >= 0).sum() > 500 and sum(seen) < 300
    _leaf_impurity(x[:, :], y, w, tree)
