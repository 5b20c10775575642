"""The decision tree on the forest's step: equal to pyspark.ml's, wherever its nodes are split, narrow or by co-group, saved."""

import tempfile

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier

from quench.functions.constants import LABEL, ROW_ID
from quench.operators.deepforest import DeepTree
from quench.operators.models import SparkClassifier, make_model
from quench.sources.io import load_model

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 9, 3000), rng.normal(size=3000).round(1)])
    y = (x[:, 0] + (x[:, 1] > 4) + rng.normal(size=3000) > 0.5).astype(int)
    return spark.createDataFrame([(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))],
                                 f"{ROW_ID} long, a double, b double, c double, {LABEL} int").repartition(3, ROW_ID).checkpoint()


def _scores(model, df):
    return {r[ROW_ID]: (r["prediction"], r["probability"]) for r in model.predict(df).collect()}


@pytest.mark.parametrize("levels", [4, 30])
def test_same_as_the_library(rows, levels):
    """Whether the upper nodes are split over the table or not, and whichever way rows are scored."""
    library = SparkClassifier("x", DecisionTreeClassifier(maxDepth=levels, maxBins=128, seed=42)).fit(rows, FEATS)
    want = _scores(library, rows)
    for fit_rows, narrow in ((200_000, 500_000), (500, 500_000), (500, 0)):
        model = DeepTree(fit_rows=fit_rows, levels=levels)
        model.NARROW = narrow
        got = _scores(model.fit(rows, FEATS), rows)
        assert {k: (p, pytest.approx(q)) for k, (p, q) in want.items()} == got
        assert dict(model.feature_importance()) == pytest.approx(dict(library.feature_importance()))


def test_nodes_are_a_table(rows):
    """The model of a large table is not grown on, or collected to, the driver."""
    model = make_model("Decision Tree", 0).fit(rows, FEATS)
    assert isinstance(model, DeepTree) and model.nodes.count() > 100


def test_saved(rows):
    model = DeepTree(fit_rows=500).fit(rows, FEATS)
    path = tempfile.mkdtemp(prefix="quench-model-") + "/dt"
    model.save(path)
    again = load_model(path)
    assert isinstance(again, DeepTree) and _scores(again, rows) == _scores(model, rows)
