"""Boosted trees on binned blocks: equal to pyspark.ml, alike in one task and over the table, equal rows counted, saving."""

import tempfile

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, ROW_ID
from quench.operators.boosted import BoostedTrees, _descend
from quench.operators.deepforest import DeepTree
from quench.operators.models import SparkClassifier, make_model
from quench.sources.io import load_model


def _rows(spark, n=3000, values=None):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 4)) if values is None else rng.integers(0, values, (n, 4)).astype(float)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) > np.median(x[:, 0])).astype(int)
    rows = [(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"{ROW_ID} long, a double, b double, c double, d double, {LABEL} int").repartition(3, ROW_ID).checkpoint()


FEATS = ["a", "b", "c", "d"]


def _scores(model, df):
    return {r[ROW_ID]: (r["prediction"], r["probability"]) for r in model.predict(df).collect()}


@pytest.mark.parametrize("values", [None, 6])
def test_same_as_the_library(spark, values):
    df = _rows(spark, values=values)
    want = _scores(SparkClassifier("x", GBTClassifier(maxIter=8, maxDepth=3, stepSize=0.1, seed=42)).fit(df, FEATS), df)
    got = _scores(BoostedTrees("x", 8, 3, 0.1).fit(df, FEATS), df)
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-7) for k in want) and len(got) == len(want)


def test_more_bins_than_asked_for(spark):
    """A sample larger than expected proposes more thresholds; no bin may spill into the next node's."""
    df = _rows(spark, 600)
    model = BoostedTrees("x", 4, 3, 0.1, fit_rows=0).fit(df, FEATS)
    wide = BoostedTrees("x", 4, 3, 0.1)
    wide.features, wide.edges = FEATS, [np.linspace(-2, 2, 70)] * 4
    wide.trees = wide._over_table(wide._blocks(df, LABEL).rdd)
    for m in (model, wide):  # a leaf's value is its rows' mean residual: the first tree's is the mean label
        x = np.array([[r[f] for f in FEATS] for r in df.collect()])
        y = np.array([r[LABEL] for r in df.collect()]) * 2.0 - 1.0
        bins = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(m.edges)])
        node = _descend(bins, m.trees[0]["feature"], m.trees[0]["cut"], 3)
        for k in np.unique(node):
            assert m.trees[0]["value"][k] == pytest.approx(y[node == k].mean())


def test_same_trees_however_fitted(spark):
    """In one task or over the table, with equal rows counted or not, whatever the partitions; 30 rounds pass a new start of the scores."""
    df = _rows(spark, values=6)
    made = [BoostedTrees("x", 30, 3, 0.1, **kw).fit(rows, FEATS).trees
            for kw, rows in (({}, df), ({"fit_rows": 0}, df), ({"fit_rows": 0, "cells": 0}, df.repartition(5)), ({"cells": 0}, df.unionAll(df)))]
    for other in made[1:]:
        for a, b in zip(made[0], other, strict=True):
            assert (a["feature"] == b["feature"]).all() and (a["cut"] == b["cut"]).all() and np.allclose(a["value"], b["value"], atol=1e-8)


def test_equal_rows_are_kept_once(spark):
    """Rows that no bin tells apart are one row with a count, so a table of few values stays small in each of the passes."""
    df = _rows(spark, values=3)
    model = make_model("XGBoost", 0)
    model.fit(df, FEATS[:3])
    kept = model._blocks(df, LABEL).collect()
    assert sum(len(r["y"]) for r in kept) <= 2 * 27 and sum(np.frombuffer(r["w"], np.int64).sum() for r in kept) == df.count()


def test_saved_and_odd_rows(spark):
    df = _rows(spark)
    model = BoostedTrees("x", 5, 3, 0.1).fit(df, FEATS)
    path = tempfile.mkdtemp(prefix="quench-model-") + "/gbt"
    model.save(path)
    assert _scores(load_model(path), df) == _scores(model, df)
    assert sum(v for _, v in model.feature_importance()) == pytest.approx(1.0)
    same = df.withColumn("a", F.lit(2.0))
    assert len(_scores(BoostedTrees("x", 3, 2, 0.1).fit(same.limit(1), ["a"]), same)) == df.count()  # nothing to split
    gaps = df.withColumn("d", F.when(F.col(ROW_ID) % 11 > 0, F.col("d")))
    assert len(_scores(model, gaps)) == df.count()
    for odd in (gaps, df.withColumn(LABEL, F.lit(None).cast("int"))):  # refused, as by the library
        for m in (BoostedTrees("x", 3, 2, 0.1), DeepTree()):
            with pytest.raises(Exception, match="finite features and labels 0 and 1"):
                m.fit(odd, FEATS)
