"""What the models are fitted on: Fourier features without an object a row, folds ranked once for all models."""

import math

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, ROW_ID, SEED
from quench.operators import split
from quench.operators.models import _rff_column, perform_cross_validation


def test_fourier_features(spark):
    df = spark.createDataFrame([(0.5, 1.0), (None, -2.0), (float("nan"), 3.5), (7.0, None)], "a double, b double")
    column = _rff_column(["a", "b"], 6)
    got = np.array([r[0] for r in df.coalesce(1).select(vector_to_array(column)).collect()])
    rng = np.random.default_rng(SEED)
    w, b = rng.normal(0.0, 1.0, size=(6, 2)), rng.uniform(0.0, 2.0 * math.pi, size=6)
    x = np.array([(0.5, 1.0), (0.0, -2.0), (0.0, 3.5), (7.0, 0.0)])
    assert np.allclose(got, math.sqrt(2.0 / 6) * np.cos(x @ w.T + b), atol=1e-12)
    assert df.where("a = 100").select(column).count() == 0
    assert "ArrowEvalPython" in df.select(column)._jdf.queryExecution().optimizedPlan().toString()


def test_folds_are_ranked_once_for_all_models(spark, monkeypatch):
    calls = []
    whole = split.assign_folds
    monkeypatch.setattr(split, "assign_folds", lambda *a, **k: calls.append(1) or whole(*a, **k))
    df = spark.range(300).select(F.md5(F.col("id").cast("string")).alias(ROW_ID), F.sin("id").alias("a"), F.cos("id").alias("b"),
                                 (F.sin("id") > 0).cast("int").alias(LABEL))
    got = perform_cross_validation(df, ["a", "b"], ["Naive Bayes", "Decision Tree"], 3, LABEL).collect()
    assert len(got) == 2 and len(calls) == 1
