"""Model bake-off, cross-validation, tuning, importance (M12-M16) and the
experiment composites (E1-E6, E10-E12) run end to end on sf0.001.

Boosted trees use a light configuration here (5 rounds, depth 3) so the suite
stays fast; the operators take the estimator factory as a parameter."""

import os
import tempfile

import pytest

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from quench.functions.constants import DERIVED_FEATURES, FEATURES, LABEL
from quench.operators import models
from quench.operators.models import SparkClassifier, make_model
from quench.plans import experiments as X
from quench.plans.queries_models import prepared
from quench.sources.fixtures import measurements_clean

from conftest import SF_SMALL

FEATS = FEATURES + DERIVED_FEATURES


def light(name, n):
    if name.startswith("XGBoost"):
        return SparkClassifier(name, GBTClassifier(maxIter=5, maxDepth=3, seed=42))
    return make_model(name, n)


def test_bakeoff_cv_tuning_importance(spark):
    train, test = prepared(spark, SF_SMALL)
    names = ["Logistic Regression", "Decision Tree", "Naive Bayes", "XGBoost"]
    base = models.train_baseline_models(train, test, FEATS, names=names,
                                        estimators={"XGBoost": light("XGBoost", 0)})
    rows = base.collect()
    assert [r["model"] for r in rows] and len(rows) == 4
    accs = [r["test_accuracy"] for r in rows]
    assert accs == sorted(accs, reverse=True)
    cv = models.perform_cross_validation(train, FEATS, names=["Naive Bayes"], k=3).first()
    assert cv["min_cv_accuracy"] <= cv["mean_cv_accuracy"] <= cv["max_cv_accuracy"]
    assert models.choose_model_to_tune(base) in ("Random Forest", "Gradient Boosting", "XGBoost")
    tuned = models.hyperparameter_tuning(
        train, FEATS, "Logistic Regression", k=3,
        grid_override=lambda est: [{est.regParam: 0.01, est.elasticNetParam: 0.0},
                                   {est.regParam: 0.1, est.elasticNetParam: 1.0}])
    assert 0.0 <= tuned.accuracy <= 1.0 and "regParam" in tuned.params and len(tuned.fold_accuracy) == 3
    assert abs(max(tuned.avg_accuracy) - tuned.accuracy) < 0.01 and "prediction" in tuned.model.transform(test).columns
    dt = make_model("Decision Tree", train.count()).fit(train, FEATS)
    imp = models.feature_importance_df(dt, spark, top_n=15).collect()
    assert len(imp) <= 15 and imp[0]["importance"] >= imp[-1]["importance"]
    assert models.feature_importance_df(make_model("Naive Bayes", 10).fit(train, FEATS), spark) is None
    path = tempfile.mkdtemp(prefix="quench-model-") + "/dt"
    dt.save(path)
    from quench.sources.io import load_model

    again = load_model(path).predict(test)
    assert sorted((r["row_id"], r["prediction"]) for r in again.collect()) == sorted((r["row_id"], r["prediction"]) for r in dt.predict(test).collect())
    svm = make_model("SVM", train.count()).fit(train, FEATS)
    svm.save(path + "-svm")
    assert load_model(path + "-svm").predict(test).agg({"probability": "sum"}).first()[0] == pytest.approx(
        svm.predict(test).agg({"probability": "sum"}).first()[0])


def test_run_all_experiments(spark):
    raw = measurements_clean(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="quench-rq-")
    res = X.run_all_experiments(spark, raw, out, factory=light)
    rq1 = res["rq1"].collect()
    assert sorted(r["strategy"] for r in rq1) == ["knn", "mean", "median"]
    assert all(0 <= r["accuracy"] <= 1 and r["stability_score"] <= 1 for r in rq1)
    assert {r["approach"] for r in res["rq2"].collect()} == {"raw_features", "derived_features"}
    c = res["rq3_correlation"].first()
    assert -1 <= c["pearson_correlation"] <= 1 and 0 <= c["pearson_p_value"] <= 1
    assert sorted(r["quartile"] for r in res["rq3_quartile"].collect()) == ["Q1_Low", "Q2", "Q3", "Q4_High"]
    rq4 = res["rq4"].orderBy("noise_level").collect()
    assert len(rq4) == 5 and rq4[0]["accuracy_degradation"] == 0.0
    assert res["rq5_alignment"].count() == 6
    made = {d[: d.rindex("-")]: f"{out}/stages/{d}/data" for d in os.listdir(f"{out}/stages")}
    ver = X.verify_outputs(spark, made | {"none": f"{out}/none"}).collect()
    assert [r["output"] for r in ver if not r["exists"]] == ["none"] and len(ver) == len(res) + 1
    train, test = prepared(spark, SF_SMALL)
    base = X.baseline_stage(train, test, FEATS, tempfile.mkdtemp(prefix="quench-base-") + "/m", factory=light)
    run = X.prepare_run(spark, raw, tempfile.mkdtemp(prefix="quench-prep-") + "/run")
    summ = X.pipeline_summary(spark, run["counts"], base).first()
    assert summ["train_rows"] + summ["test_rows"] == raw.count() == run["train"].count() + run["test"].count()
    assert summ["removed_records"] == 0 and summ["baseline_accuracy"] == base["accuracy"]
    # a second run reads every stage back; a changed setting redoes only the stages that depend on it
    assert all(r["made"] for r in res["stages"].collect())
    again = X.run_all_experiments(spark, raw, out, factory=None)
    assert not any(r["made"] for r in again["stages"].collect())
    assert sorted(map(tuple, again["rq1"].collect())) == sorted(map(tuple, res["rq1"].collect()))
    state = X.tracking.experiment_state(spark, f"{out}/events").collect()
    assert sorted((r["experiment_name"], r["status"]) for r in state) == [(n, "completed") for n in ("rq1", "rq2", "rq4")]
    assert spark.read.parquet(f"{out}/metrics").count() == 3 + 2 + 5


def test_stages_redo_what_changed(spark):
    from quench.plans.stages import Stages, source_key

    root = tempfile.mkdtemp(prefix="quench-stages-")
    spark.range(5).write.parquet(f"{root}/a")
    calls = []

    def run(factor, stop=False):
        stages = Stages(spark, f"{root}/s")
        first = stages.run("first", lambda: calls.append("first") or spark.read.parquet(f"{root}/a"), [source_key(spark.read.parquet(f"{root}/a"))])

        def second():
            calls.append("second")
            if stop:
                raise RuntimeError("lost")
            return first.data.selectExpr(f"id * {factor} AS id")

        return stages.run("second", second, [first.key], factor=factor)

    assert run(2).rows == 5 and calls == ["first", "second"]
    assert not run(2).made and calls == ["first", "second"]
    with pytest.raises(RuntimeError):
        run(3, stop=True)
    assert run(3).data.agg({"id": "sum"}).first()[0] == 30 and calls == ["first", "second", "second", "second"]
    spark.range(7).write.mode("overwrite").parquet(f"{root}/a")
    assert run(3).rows == 7 and calls[-2:] == ["first", "second"]


def test_failed_experiment_is_recorded(spark):
    folder = tempfile.mkdtemp(prefix="quench-tracked-")

    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError):
        X.tracked(spark, folder, "rq", "q", {}, fail)
    assert X.tracking.experiment_state(spark, f"{folder}/events").first()["status"] == "failed"


def _own_rows(spark):
    return spark.createDataFrame([(f"{i:04d}", i / 100 - 1, (i * 37 % 101) / 50, int((i > 100) != (i % 10 == 0))) for i in range(200)],
                                 "row_id string, a double, b double, Potability int")


def test_tuning_keeps_its_rows_once(spark, monkeypatch):
    """One kept table serves every fold and grid point; accuracy per fold is that of a fit without the fold."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    from quench.operators.split import assign_folds

    rows, kept = _own_rows(spark), []
    for name in ("persist", "cache"):
        def noted(self, *a, _was=getattr(Classic, name), **k):
            kept.append(self.columns)
            return _was(self, *a, **k)
        monkeypatch.setattr(Classic, name, noted)
    tuned = models.hyperparameter_tuning(rows, ["a", "b"], "Logistic Regression", k=4, grid_override=lambda est: [
        {est.regParam: 1e7, est.elasticNetParam: 0.0}, {est.regParam: 1e-3, est.elasticNetParam: 0.0}])
    assert kept == [["features", "label", "fold"]]
    assert tuned.params["regParam"] == 1e-3 and abs(tuned.avg_accuracy[1] - tuned.accuracy) < 1e-12
    folded = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(assign_folds(rows, 4)).withColumn("label", F.col("Potability").cast("double"))
    est = LogisticRegression(maxIter=1000, standardization=False, regParam=1e-3, elasticNetParam=0.0)
    for fold, share in enumerate(tuned.fold_accuracy):
        scored = est.fit(folded.where(F.col("fold") != fold)).transform(folded.where(F.col("fold") == fold))
        assert abs(share - scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]) < 1e-12


def test_tuning_refuses_empty_folds(spark):
    with pytest.raises(ValueError):
        models.hyperparameter_tuning(_own_rows(spark).limit(2), ["a", "b"], "Logistic Regression", k=5)


def test_bakeoff_on_its_training_rows_scores_them_once(spark, monkeypatch):
    rows, calls, was = _own_rows(spark), [], models.evaluate_predictions
    monkeypatch.setattr(models, "evaluate_predictions", lambda *a: calls.append(1) or was(*a))
    table = models.train_baseline_models(rows, rows, ["a", "b"], names=["Logistic Regression", "Naive Bayes"]).collect()
    assert len(calls) == 2 and all(r["train_accuracy"] == r["test_accuracy"] for r in table)
    other = models.train_baseline_models(rows, rows.where(F.col("a") < 0), ["a", "b"], names=["Naive Bayes"]).first()
    assert other["train_accuracy"] == {r["model"]: r["train_accuracy"] for r in table}["Naive Bayes"]


def test_bake_off_fits_the_whole_estimators(spark, monkeypatch):
    """All eight with their settings: the forest and the boosted trees had a tenth to a fifth of their trees."""
    from quench.operators import models
    from quench.plans import queries_experiments as Q

    fitted = {}

    class Known:
        def __init__(self, name):
            self.name = name

        def fit(self, train, features, label):
            return self

        def predict(self, df):
            return df.withColumn("prediction", F.col("Potability")).withColumn("probability", F.col("Potability").cast("double"))

    def made(name, n):
        fitted[name] = models_make(name, n)
        return Known(name)

    models_make = models.make_model
    monkeypatch.setattr(models, "make_model", made)
    rows = spark.createDataFrame([(f"{i:032x}", float(i % 2), 0.0, 0.0, i % 2) for i in range(20)], "row_id string, q double, t double, d double, Potability int")
    monkeypatch.setattr(Q, "_planted_split", lambda spark, sf_dir: (rows, rows))
    assert Q.q_m12_all(spark, "").count() == 8
    assert fitted["Random Forest"].trees == 100
    assert [(fitted[n].rounds, fitted[n].depth, fitted[n].rate) for n in ("Gradient Boosting", "XGBoost")] == [(100, 3, 0.1), (100, 6, 0.1)]


def test_svm_counts_equal_rows_once(spark, monkeypatch):
    """Equal rows are one weighted row, and what the fit makes small is the loss over all the rows."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (3000, 2)) - 1.5
    y = (x[:, 0] + 0.2 * rng.normal(size=3000) > 0).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, Potability int").coalesce(1)
    fit_rows = []
    fit = models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, data: fit_rows.append(data.count()) or fit(self, data))
    model = models.make_model("SVM", 3000).fit(df, ["a", "b"])
    scored, svm = model.predict(df).toPandas(), model.model.stages[-1]
    assert fit_rows[0] <= 32 and (scored["prediction"] == (scored["a"] > 0)).all()
    margin = scored["probability"] * (2 * scored["Potability"] - 1)
    assert np.allclose(model.stds, models._rff(2)(x).std(0, ddof=1))
    # the penalty (1 / n, halved) is on the coefficients of features of unit variance
    assert svm.summary().objectiveHistory[-1] == pytest.approx(np.maximum(1 - margin, 0).mean() + (svm.coefficients.toArray() ** 2).sum() / 6000, rel=1e-9)
