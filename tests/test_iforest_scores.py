"""Isolation-forest scores: against a walk of each tree, and how often a plan walks them."""

import numpy as np
from pyspark.sql import functions as F

from quench.functions.constants import ROW_ID
from quench.operators import iforest
from quench.operators.iforest import c_factor, fit_isolation_forest


def _frame(spark):
    return spark.range(600).select(F.md5(F.col("id").cast("string")).alias(ROW_ID), (F.col("id") % 17).cast("double").alias("a"),
                                   F.when(F.col("id") % 50 != 0, F.sin("id")).alias("b"))


def _walk(model, row):
    lengths = []
    for _, tree in model.nodes.groupby("tree"):
        nodes = tree.set_index("node")
        at = nodes.loc[0]
        while at["feature"] >= 0:
            at = nodes.loc[at["left_child"] if row[int(at["feature"])] < at["threshold"] else at["right_child"]]
        lengths.append(at["depth"] + c_factor(at["size"]))
    return np.mean(lengths)


def test_scores_equal_a_walk_of_each_tree(spark, monkeypatch):
    monkeypatch.setattr(iforest, "ROWS", 7)  # blocks that do not divide the rows
    model = fit_isolation_forest(_frame(spark).na.fill(0.0), ["a", "b"], n_trees=9, psi=40, contamination=0.1)
    x = np.array([[a, b] for a in (-1.0, 3.0, 9.5, 30.0, np.nan) for b in (-2.0, 0.1, np.nan, 0.9)])
    assert np.allclose(model.path_lengths(x), [_walk(model, r) for r in x], rtol=0, atol=1e-12)
    assert len(model.path_lengths(x[:0])) == 0


def test_a_filter_on_the_score_does_not_walk_the_trees_again(spark):
    df = _frame(spark).na.fill(0.0)
    model = fit_isolation_forest(df, ["a", "b"], n_trees=5, psi=32, contamination=0.1)
    scored = model.predict(model.score(df)).where(F.col("prediction").isNotNull() & (F.abs("anomaly_score") < 2))
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert scored.count() == 600
