"""Classifiers (M1-M8), batch scoring (M11), bake-off (M12), cross-validation
(M13), grid search (M14, M15) and feature importance (M16) on ``pyspark.ml``.

Training data stays a DataFrame: features are assembled JVM-side with
``VectorAssembler``; estimators run distributed. Metrics come from the exact
aggregate operators in ``quench.operators.metrics``, not from sampled or
binned evaluators.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.util import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, SEED
from quench.operators import metrics as M
from quench.session import scratch_table

MODEL_NAMES = ["Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting", "SVM",
               "K-Nearest Neighbors", "Naive Bayes", "XGBoost"]

#: Depth and learning rate of the boosted trees; experiments E2-E5 keep XGBoost's default rate.
_BOOSTED = {"Gradient Boosting": (3, 0.1), "XGBoost": (6, 0.1), "XGBoost (default rate)": (6, 0.3)}


#: Different rows up to which the SVM is fitted on each of them once, with its count as weight.
EQUAL_ROWS = 100_000


def _rff(d: int, n_components: int = 64, gamma: float | None = None, seed: int = SEED):
    """Random Fourier features for an RBF kernel (Rahimi & Recht, 2007):
    z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2*gamma I), b ~ U(0, 2pi), a fixed
    (D x d) matrix drawn once."""
    gamma = gamma if gamma is not None else 1.0 / d
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, d))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    scale = math.sqrt(2.0 / n_components)
    return lambda x: scale * np.cos(np.nan_to_num(x) @ w.T + b)


def _rff_column(features: list[str], n_components: int = 64, gamma: float | None = None, seed: int = SEED, stds: list[float] | None = None):
    """``_rff`` per Arrow batch as one matrix product, each divided by its ``stds`` if given."""
    from pyspark.ml.functions import array_to_vector

    d, z_of = len(features), _rff(len(features), n_components, gamma, seed)
    by = None if stds is None else np.array(stds)

    @F.arrow_udf("array<double>")
    def rff(s: pa.Array) -> pa.Array:
        z = z_of(np.column_stack([s.field(i).to_numpy(zero_copy_only=False) for i in range(d)]).astype(float))
        if by is not None:
            z /= by
        # one buffer of all values: no object a row
        return pa.ListArray.from_arrays(np.arange(0, z.size + 1, n_components, dtype=np.int32), z.ravel())

    return array_to_vector(rff(F.struct(*[F.col(f).cast("double") for f in features])))


class SparkClassifier:
    """Assemble -> estimator, with the reference's fit/predict/predict_proba roles."""

    def __init__(self, name: str, estimator, rff: int = 0):
        self.name = name
        self.estimator = estimator
        self.rff = rff
        self.stds: list[float] | None = None
        self.model: PipelineModel | None = None
        self.features: list[str] = []

    def _prepare(self, df: DataFrame) -> DataFrame:
        if not self.rff:
            return df
        return df.withColumn("features", _rff_column(self.features, self.rff, stds=self.stds))

    def _inputs(self) -> list[str]:
        return ["features"] if self.rff else self.features

    def fit(self, train: DataFrame, features: list[str], label: str = LABEL) -> "SparkClassifier":
        self.features = list(features)
        self.label = label
        estimator, train = self._counted(train.withColumn("label", F.col(label).cast("double"))) if self.rff else (
            self.estimator, train.withColumn("label", F.col(label).cast("double")))
        data = self._prepare(train)
        stages = [estimator] if self.rff else [
            VectorAssembler(inputCols=self._inputs(), outputCol="features", handleInvalid="keep"), self.estimator]
        pipe = Pipeline(stages=stages)
        self.model = pipe.fit(data)
        return self

    def _counted(self, train: DataFrame):
        """The estimator and the rows it is fitted on: equal rows once, weighted by their count, where few differ (a pass of hundreds
        over 64 numbers a row costs most). The features are then scaled here: by weights, ``pyspark.ml`` takes another variance."""
        self.stds = None
        x = [F.col(f).cast("double").alias(f) for f in self.features]
        different = train.agg(F.approx_count_distinct(F.xxhash64(*x, "label"))).first()[0]
        if different > EQUAL_ROWS:
            return self.estimator, train
        rows = train.select(*x, "label").groupBy(*self.features, "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))
        rows = rows.coalesce(1 + different // 10_000).checkpoint(eager=True)  # a job a pass: few tasks
        t = rows.toArrow()
        n = t.column("weight").to_numpy()
        z = _rff(len(x), self.rff)(np.column_stack([t.column(f).to_numpy() for f in self.features]).astype(float))
        if n.sum() > 1:
            std = np.sqrt((n[:, None] * (z - (n @ z) / n.sum()) ** 2).sum(0) / (n.sum() - 1))
            self.stds = np.where(std > 0, std, 1.0).tolist()
        return self.estimator.copy({self.estimator.weightCol: "weight", self.estimator.standardization: self.stds is None}), rows

    def predict(self, df: DataFrame) -> DataFrame:
        """Appends ``prediction`` (int) and ``probability`` (class-1 probability;
        the margin for the SVM, the prediction when no score exists)."""
        out = self.model.transform(self._prepare(df))
        cols = out.columns
        if "probability" in cols:
            score = vector_to_array("probability")[1]
        elif "rawPrediction" in cols:
            score = vector_to_array("rawPrediction")[1]
        else:
            score = F.col("prediction")
        drop = [c for c in cols if c in ("features", "rawPrediction", "probability", "label") or c == "_rff"]
        return out.withColumn("_p", score.cast("double")).drop(*drop).withColumn(
            "prediction", F.col("prediction").cast("int")).withColumnRenamed("_p", "probability")

    def feature_importance(self) -> list[tuple[str, float]] | None:
        """M16 helper: (feature, importance) sorted descending, None if unsupported."""
        est = self.model.stages[-1]
        if not hasattr(est, "featureImportances"):
            return None
        imp = est.featureImportances.toArray()
        names = self._inputs()
        return sorted(zip(names, [float(v) for v in imp]), key=lambda t: (-t[1], t[0]))

    def save(self, path: str) -> None:
        """The fitted stages (``PipelineModel`` persistence) and what scoring needs beside them."""
        self.model.write().overwrite().save(f"{path}/stages")
        spark = SparkSession.getActiveSession()
        meta = {"name": self.name, "rff": self.rff, "stds": self.stds, "features": self.features, "label": self.label}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> "SparkClassifier":
        """A classifier that predicts as the saved one did."""
        meta = json.loads(SparkSession.getActiveSession().read.text(f"{path}/meta").first()[0])
        out = cls(meta["name"], None, meta["rff"])
        out.features, out.label, out.stds = meta["features"], meta["label"], meta.get("stds")
        out.model = PipelineModel.load(f"{path}/stages")
        return out


def make_model(name: str, n_train: int, seed: int = SEED, forest_depth: int | None = None):
    """M1-M8 with the reference's settings mapped to Spark parameters. The forest has no depth limit
    (``deepforest``) unless ``forest_depth`` sets one."""
    if name == "Logistic Regression":
        # C = 1 with L2 -> regParam = 1 / (C * n); no internal standardisation
        return SparkClassifier(name, LogisticRegression(maxIter=1000, regParam=1.0 / max(n_train, 1),
                                                        elasticNetParam=0.0, standardization=False))
    if name == "Decision Tree":
        from quench.operators.deepforest import DeepTree

        return DeepTree(seed=seed)
    if name == "Random Forest" and forest_depth is None:
        from quench.operators.deepforest import DeepForest

        return DeepForest(trees=100, seed=seed)
    if name == "Random Forest":
        return SparkClassifier(name, RandomForestClassifier(numTrees=100, maxDepth=forest_depth, maxBins=128, seed=seed,
                                                            featureSubsetStrategy="sqrt",
                                                            maxMemoryInMB=1024))
    if name in _BOOSTED:
        from quench.operators.boosted import BoostedTrees

        depth, rate = _BOOSTED[name]
        return BoostedTrees(name, 100, depth, rate, seed)
    if name == "SVM":
        return SparkClassifier(name, LinearSVC(maxIter=200, regParam=1.0 / max(n_train, 1)), rff=64)
    if name == "Naive Bayes":
        return SparkClassifier(name, NaiveBayes(modelType="gaussian"))
    if name == "K-Nearest Neighbors":
        from quench.operators.knn import KNNClassifier

        return KNNClassifier(k=5)
    raise ValueError(f"unknown model {name!r}")


def evaluate_predictions(pred: DataFrame, label: str = LABEL) -> dict:
    """A7 on a prediction frame: one aggregate row collected (a handful of numbers)."""
    p = pred.select(F.col(label).alias("label"), "prediction", F.col("probability").alias("score"))
    row = M.evaluate_model(p).first()
    return row.asDict()


def train_baseline_models(train: DataFrame, test: DataFrame, features: list[str], label: str = LABEL,
                          names: list[str] | None = None, estimators: dict | None = None) -> DataFrame:
    """Fit each model, metrics table sorted by test accuracy (desc)."""
    spark = train.sparkSession
    n_train = train.count()
    rows = []
    for name in names or MODEL_NAMES:
        model = (estimators or {}).get(name) or make_model(name, n_train)
        model.fit(train, features, label)
        te = evaluate_predictions(model.predict(test), label)
        seen = te if test is train else M.classification_metrics(
            model.predict(train).select(F.col(label).alias("label"), "prediction")).first()  # the table shows its accuracy only
        rows.append((name, seen["accuracy"], te["accuracy"], te["precision"], te["recall"], te["f1_score"],
                     te["roc_auc"]))
    df = spark.createDataFrame(rows, "model string, train_accuracy double, test_accuracy double, "
                                     "precision double, recall double, f1_score double, roc_auc double")
    return df.orderBy(F.desc("test_accuracy"), "model")


def written_folds(train: DataFrame, k: int, label: str = LABEL) -> DataFrame:
    """The rows with their stratified hash folds, written once."""
    from quench.operators.split import assign_folds

    return scratch_table(assign_folds(train, k, SEED, label), "folds")


def cross_validate(train: DataFrame, features: list[str], name: str, k: int = 5, label: str = LABEL,
                   factory=None, folded: DataFrame | None = None) -> dict:
    """M13 for one model: stratified hash folds; per-fold accuracy and recall. ``folded``: the rows with
    their folds (``written_folds``), if they are there already."""
    if folded is None:
        folded = written_folds(train, k, label)
    n = folded.count()
    accs, recs = [], []
    for f in range(k):
        tr = folded.where(F.col("fold") != f)
        va = folded.where(F.col("fold") == f)
        model = (factory(name, n) if factory else make_model(name, n)).fit(tr, features, label)
        m = evaluate_predictions(model.predict(va), label)
        accs.append(m["accuracy"])
        recs.append(m["recall"])
    a, r = np.array(accs), np.array(recs)
    return {"model": name, "mean_cv_accuracy": float(a.mean()), "std_cv_accuracy": float(a.std()),
            "min_cv_accuracy": float(a.min()), "max_cv_accuracy": float(a.max()),
            "cv_recall_mean": float(r.mean()), "cv_recall_std": float(r.std()), "fold_accuracy": accs}


def perform_cross_validation(train: DataFrame, features: list[str], names: list[str] | None = None, k: int = 5,
                             label: str = LABEL, factory=None) -> DataFrame:
    """M13 table, sorted by mean accuracy (desc)."""
    spark = train.sparkSession
    rows = []
    folded = written_folds(train, k, label)  # the same for every model
    for name in names or MODEL_NAMES:
        cv = cross_validate(train, features, name, k, label, factory, folded)
        rows.append((name, cv["mean_cv_accuracy"], cv["std_cv_accuracy"], cv["min_cv_accuracy"],
                     cv["max_cv_accuracy"]))
    df = spark.createDataFrame(rows, "model string, mean_cv_accuracy double, std_cv_accuracy double, "
                                     "min_cv_accuracy double, max_cv_accuracy double")
    return df.orderBy(F.desc("mean_cv_accuracy"), "model")


def param_grid(name: str, n_train: int):
    """M14 grids mapped from the reference (see README for dropped keys)."""
    if name == "Random Forest":
        est = RandomForestClassifier(seed=SEED, maxBins=128)
        # n_estimators, max_depth (None -> 30), min_samples_leaf
        grid = (ParamGridBuilder().addGrid(est.numTrees, [50, 100, 200]).addGrid(est.maxDepth, [10, 20, 30])
                .addGrid(est.minInstancesPerNode, [1, 2, 4]).build())
    elif name == "Gradient Boosting":
        est = GBTClassifier(seed=SEED)
        grid = (ParamGridBuilder().addGrid(est.maxIter, [50, 100, 200]).addGrid(est.stepSize, [0.01, 0.1, 0.2])
                .addGrid(est.maxDepth, [3, 5, 7]).build())
    elif name == "Logistic Regression":
        est = LogisticRegression(maxIter=1000, standardization=False)
        # C in {0.001, 0.01, 0.1, 1, 10, 100}; penalty l1 / l2
        cs = [0.001, 0.01, 0.1, 1, 10, 100]
        grid = (ParamGridBuilder().addGrid(est.regParam, [1.0 / (c * max(n_train, 1)) for c in cs])
                .addGrid(est.elasticNetParam, [1.0, 0.0]).build())
    elif name == "XGBoost":
        est = GBTClassifier(seed=SEED)
        grid = (ParamGridBuilder().addGrid(est.maxIter, [50, 100, 200]).addGrid(est.stepSize, [0.01, 0.1, 0.3])
                .addGrid(est.maxDepth, [3, 5, 7]).addGrid(est.subsamplingRate, [0.8, 1.0])
                .addGrid(est.featureSubsetStrategy, ["0.8", "all"]).build())
    else:
        raise ValueError(f"Hyperparameter tuning not implemented for {name}")
    return est, grid


@dataclass
class Tuned:
    """M14's outcome: the best model refitted on all rows, its parameters, and its accuracy per fold."""

    model: PipelineModel
    params: dict
    fold_accuracy: list[float]
    avg_accuracy: list[float]  # of every grid point, in the grid's order

    @property
    def accuracy(self) -> float:
        return float(np.mean(self.fold_accuracy))

    def __iter__(self):
        return iter((self.model, self.params, self.accuracy))


def hyperparameter_tuning(train: DataFrame, features: list[str], name: str = "Random Forest", k: int = 5,
                          label: str = LABEL, parallelism: int = 4, grid_override=None) -> Tuned:
    """The grid's points are fitted side by side (``parallelism``) on each of the stratified hash folds. The assembled
    rows are kept once for all folds, and a fit leaves its fold out as it reads. A point's folds are scored in one pass, which also gives the best point's accuracy per fold (M13's minimum and maximum)."""
    from quench.operators.split import assign_folds

    folded = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(assign_folds(train, k, SEED, label))
    data = folded.select("features", F.col(label).cast("double").alias("label"), "fold").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r["fold"]: (r["n"], r["top"]) for r in data.groupBy("fold").agg(F.count("*").alias("n"), F.max("label").alias("top")).collect()}
        if len(sizes) < max(k, 2):
            raise ValueError(f"{k} folds need rows in each of them, these have {len(sizes)}")
        est, grid = param_grid(name, sum(n for n, _ in sizes.values()))
        if grid_override is not None:
            grid = grid_override(est)

        def fit(fold: int | None, point):
            """On all folds but ``fold``; the label's classes are known, so the fit has no pass to count them."""
            tops = [top for f, (_, top) in sizes.items() if f != fold and top is not None]
            rows = data if fold is None else data.where(F.col("fold") != fold)
            if tops and 0 <= max(tops) < 100 and max(tops) == int(max(tops)):
                meta = {"ml_attr": {"type": "nominal", "name": "label", "num_vals": int(max(tops)) + 1}}
                rows = rows.withMetadata("label", meta)
            return est.fit(rows, point)

        def score(models: list) -> list[float]:
            """Accuracy by fold: each row is scored by the model that did not see its fold."""
            parts = [m.transform(data.where(F.col("fold") == f)).select("fold", (F.col("prediction") == F.col("label")).alias("hit"))
                     for f, m in enumerate(models)]
            hits = reduce(DataFrame.unionByName, parts).groupBy("fold").agg(F.avg(F.col("hit").cast("double")).alias("a"))
            shares = {r["fold"]: r["a"] for r in hits.collect()}
            return [shares[f] for f in range(k)]

        with ThreadPool(min(parallelism, len(grid))) as pool:
            inherit = inheritable_thread_target(train.sparkSession)
            models = pool.map(inherit(lambda task: fit(task[0], grid[task[1]])), [(f, i) for f in range(k) for i in range(len(grid))], 1)
            accuracy = pool.map(inherit(lambda i: score(models[i::len(grid)])), range(len(grid)), 1)
        average = [float(np.mean(a)) for a in accuracy]
        best = int(np.argmax(average))
        final = fit(None, grid[best])
    finally:
        data.unpersist()
    return Tuned(PipelineModel([VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), final]),
                 {p.name: v for p, v in grid[best].items()}, accuracy[best], average)


def tune_leader(baseline: DataFrame, train: DataFrame, features: list[str], k: int = 5, label: str = LABEL, grid_override=None) -> tuple[str, Tuned]:
    """Tunes the leader of a bake-off if it is a tree ensemble, else the Random Forest."""
    name = choose_model_to_tune(baseline)
    return name, hyperparameter_tuning(train, features, name, k, label, grid_override=grid_override)


def choose_model_to_tune(baseline: DataFrame) -> str:
    """Tune the leader if it is a tree ensemble, else Random Forest."""
    best = baseline.orderBy(F.desc("test_accuracy"), "model").first()["model"]
    return best if best in ("Random Forest", "Gradient Boosting", "XGBoost") else "Random Forest"


def feature_importance_df(model: SparkClassifier, spark, top_n: int | None = None) -> DataFrame | None:
    """(feature, importance) sorted desc; None when the model has none."""
    imp = model.feature_importance()
    if imp is None:
        return None
    df = spark.createDataFrame(imp, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return df.limit(top_n) if top_n else df
