"""Queries: the experiments (E1-E5), tuning and the full bake-off (M12-M15) and saved models (S12), with compared rows.

The experiments run with a deterministic rule in place of the boosted trees (every experiment takes the
estimator as a parameter): class 1 where the sum of all scaled features is positive. Everything around the
estimator, from imputation and scaling to splits, folds, metrics, ranks and tracking, is compared in SQL; the
estimators have their own compared rows. Bake-off, cross-validation and tuning run the real estimators on the
planted rule with one label in ten flipped, so no metric is a constant.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quench.functions.constants import FEATURES, LABEL, NOISE_LEVELS, ROW_ID
from quench.operators.deepforest import DeepForest
from quench.operators.iforest import fit_isolation_forest
from quench.operators.models import (
    MODEL_NAMES, hyperparameter_tuning, make_model, perform_cross_validation, train_baseline_models, tune_leader,
)
from quench.plans import experiments as X
from quench.plans.registry import register
from quench.plans.common import ENGINEERED, imputed
from quench.plans.queries_features import split_cte
from quench.plans.queries_models import _PLANTED_CTE, PLANTED, _planted_split, planted
from quench.plans.sqltext import FEATURE_LIST, bits_sql, gauss_sql, with_ctes
from quench.plans.sqltext_features import derived_sql, filled, imputed_cte, mean_cte, median_cte
from quench.session import scratch_path
from quench.sources.fixtures import measurements_clean
from quench.sources.io import load_model


class SumRule:
    """Class 1 where the features sum up to more than zero; importance is the correlation with the label in the training rows."""

    name = "sum rule"

    def fit(self, train, features, label=LABEL):
        self.features = list(features)
        row = train.agg(*[F.abs(F.corr(F.col(f), F.col(label).cast("double"))).alias(f) for f in features]).first()
        self.importance = [(f, row[f] or 0.0) for f in features]
        return self

    def predict(self, df):
        total = sum((F.col(f) for f in self.features), F.lit(0.0))
        out = df.withColumn("prediction", (total > 0).cast("int"))
        return out.withColumn("probability", F.col("prediction").cast("double"))

    def feature_importance(self):
        return self.importance


class SumDistance:
    """An anomaly score for E3: the sum of the features' absolute values."""

    def __init__(self, train, features, n_trees=0):
        self.features = features

    def score(self, df):
        return df.withColumn("anomaly_score", sum((F.abs(F.col(f)) for f in self.features), F.lit(0.0)))


def _rule(name, n):
    return SumRule()


def _scaled(cols):
    return [f"({c} - {c}_m) / coalesce(nullif({c}_s, 0), 1)" for c in cols]


def _rule_ctes(tag: str, src: str, cols: list[str]) -> str:
    """``p_<tag>``: row_id, y, prediction p, anomaly a and split of the rule over the rows of ``src``."""
    stats = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in cols)
    z = _scaled(cols)
    return (f"s_{tag} AS (SELECT {stats} FROM {src}),\n"
            f"z_{tag} AS (SELECT row_id, Potability, CASE WHEN {' + '.join(z)} > 0 THEN 1 ELSE 0 END AS p, {' + '.join(f'abs({x})' for x in z)} AS a "
            f"FROM {src} CROSS JOIN s_{tag}),\n" + split_cte(f"z_{tag}", f"p_{tag}", 42, 0.2))


_TEST = ("sum(p * Potability) AS tp, sum(p * (1 - Potability)) AS fp, sum((1 - p) * Potability) AS fn, sum((1 - p) * (1 - Potability)) AS tn, "
         "avg(CAST(p = Potability AS DOUBLE)) AS accuracy")
_FOLD = f"(row_number() OVER (PARTITION BY Potability ORDER BY {bits_sql(repr('42:') + ' || row_id')}, row_id) - 1) % 5"


def _e1(tag: str) -> str:
    return (f"SELECT '{tag}' AS strategy, 'completed' AS status, accuracy, tp / (tp + fp) AS precision_score, tp / (tp + fn) AS recall, "
            f"2 * tp / (2 * tp + fp + fn) AS f1_score, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS roc_auc, cv_recall_mean, cv_recall_std, stability_score "
            f"FROM (SELECT {_TEST} FROM p_{tag} WHERE split = 'test') CROSS JOIN (SELECT avg(r) AS cv_recall_mean, stddev_pop(r) AS cv_recall_std, "
            f"1 - stddev_pop(c) AS stability_score FROM (SELECT fold, avg(CAST(p = Potability AS DOUBLE)) AS c, sum(p * Potability) / sum(Potability) AS r "
            f"FROM (SELECT *, {_FOLD} AS fold FROM p_{tag} WHERE split = 'train') GROUP BY fold))")


_METRICS = ["accuracy", "precision_score", "recall", "f1_score", "roc_auc", "cv_recall_mean", "cv_recall_std", "stability_score"]


@register("e1_imputation_tracked", with_ctes(
    f"{_e1('median')} UNION ALL {_e1('mean')}",
    extra=f"dd AS (SELECT min(row_id) AS row_id, {FEATURE_LIST}, Potability FROM measurements GROUP BY {FEATURE_LIST}, Potability),\n"
    + median_cte("dd") + ",\n" + mean_cte("dd") + ",\n"
    + f"i_median AS (SELECT m.row_id, {filled('m', 'med')}, m.Potability FROM dd AS m CROSS JOIN med),\n"
    + f"i_mean AS (SELECT m.row_id, {filled('m', 'mu')}, m.Potability FROM dd AS m CROSS JOIN mu),\n"
    + _rule_ctes("median", "i_median", FEATURES) + ",\n" + _rule_ctes("mean", "i_mean", FEATURES)), _METRICS)
def q_e1(spark, sf_dir):
    """The experiment under tracking, read back from the metric and event tables (E1 with E7, E8, E9)."""
    folder = scratch_path(spark, "tracked")
    raw = measurements_clean(spark, sf_dir)
    X.tracked(spark, folder, "rq1", "imputation", {}, lambda: X.rq1_imputation(raw, _rule, ("median", "mean")))
    state = X.tracking.experiment_state(spark, f"{folder}/events").select(F.col("id").alias("experiment_id"), "status")
    return spark.read.parquet(f"{folder}/metrics").join(F.broadcast(state), "experiment_id").select("strategy", "status", *_METRICS)


_DERIVED = "eng AS (SELECT *, " + ", ".join(derived_sql()) + " FROM imputed)"
_UNSAFE = ("accuracy, tn / (tn + fp) AS recall_unsafe, tn / (tn + fn) AS precision_unsafe, 2 * tn / (2 * tn + fp + fn) AS f1_unsafe")


@register("e2_raw_and_derived_features", with_ctes(
    " UNION ALL ".join(f"SELECT '{tag}' AS approach, {n} AS n_features, {_UNSAFE} FROM (SELECT {_TEST} FROM p_{tag} WHERE split = 'test')"
                       for tag, n in (("raw_features", 9), ("derived_features", 20))),
    extra=imputed_cte() + ",\n" + _DERIVED + ",\n" + _rule_ctes("raw_features", "imputed", FEATURES) + ",\n" + _rule_ctes("derived_features", "eng", ENGINEERED)),
    ["accuracy", "recall_unsafe", "precision_unsafe", "f1_unsafe"])
def q_e2(spark, sf_dir):
    return X.rq2_feature_engineering(imputed(spark, sf_dir), _rule)


_E3 = imputed_cte() + ",\n" + _DERIVED + ",\n" + _rule_ctes("d", "eng", ENGINEERED) + """,
t AS (SELECT a, CAST(p <> Potability AS INTEGER) AS mis FROM p_d WHERE split = 'test')"""


@register("e3_correlations", with_ctes(
    "SELECT corr(a, mis) AS pearson_correlation, corr(ra, rm) AS spearman_correlation FROM (SELECT a, mis, "
    "rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, "
    "rank() OVER (ORDER BY mis) + (count(*) OVER (PARTITION BY mis) - 1) / 2.0 AS rm FROM t)", extra=_E3), ["pearson_correlation", "spearman_correlation"])
def q_e3(spark, sf_dir):
    return X.rq3_dual_layer(imputed(spark, sf_dir), _rule, anomaly=SumDistance)[0].select("pearson_correlation", "spearman_correlation")


@register("e3_quartile_rates", with_ctes(
    "SELECT quartile, avg(mis) AS rate, count(*) AS n FROM (SELECT mis, CASE WHEN a <= e1 THEN 'Q1_Low' WHEN a <= e2 THEN 'Q2' "
    "WHEN a <= e3 THEN 'Q3' ELSE 'Q4_High' END AS quartile FROM t CROSS JOIN (SELECT quantile_cont(a, 0.25) AS e1, quantile_cont(a, 0.5) AS e2, "
    "quantile_cont(a, 0.75) AS e3 FROM t)) GROUP BY quartile", extra=_E3), ["rate"])
def q_e3_quartiles(spark, sf_dir):
    out = X.rq3_dual_layer(imputed(spark, sf_dir), _rule, anomaly=SumDistance)[1]
    rate, n = out.columns[1:3]
    return out.select("quartile", F.col(rate).alias("rate"), F.col(n).alias("n"))


def _noisy_ctes(i: int, level: float) -> str:
    noisy = ", ".join(f"{c} + ({level} * {c}_sd) * {gauss_sql(repr('42:' + c + ':') + ' || row_id')} AS {c}" if level else c for c in FEATURES)
    return (f"n{i} AS (SELECT row_id, {noisy}, Potability FROM imputed CROSS JOIN sd),\ne{i} AS (SELECT *, {', '.join(derived_sql())} FROM n{i}),\n"
            + _rule_ctes(f"n{i}", f"e{i}", ENGINEERED))


@register("e4_noise_levels", with_ctes(
    "SELECT noise_level, accuracy, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1_score, "
    "first_value(accuracy) OVER (ORDER BY noise_level) - accuracy AS accuracy_degradation FROM (" + " UNION ALL ".join(
        f"SELECT CAST({level} AS DOUBLE) AS noise_level, {_TEST} FROM p_n{i} WHERE split = 'test'" for i, level in enumerate(NOISE_LEVELS)) + ")",
    extra=imputed_cte() + ",\nsd AS (SELECT " + ", ".join(f"stddev_samp({c}) AS {c}_sd" for c in FEATURES) + " FROM imputed),\n"
    + ",\n".join(_noisy_ctes(i, level) for i, level in enumerate(NOISE_LEVELS))), ["noise_level", "accuracy", "recall", "f1_score", "accuracy_degradation"])
def q_e4(spark, sf_dir):
    return X.rq4_robustness(imputed(spark, sf_dir), _rule).drop("processing_time_sec")


_RANKS = ("rk AS (SELECT feature, i AS importance_gain, CAST(row_number() OVER (ORDER BY i DESC, feature) AS INTEGER) AS feature_rank FROM ("
          + " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, p_d.Potability)) AS i FROM eng JOIN p_d USING (row_id) WHERE split = 'train'" for c in ENGINEERED) + "))")


@register("e5_standards_alignment", with_ctes(
    "SELECT feature, who AS who_importance, feature_rank, importance_gain, CASE WHEN feature_rank <= 10 THEN 'high' WHEN feature_rank <= 15 THEN 'medium' "
    "ELSE 'low' END AS alignment FROM rk JOIN (VALUES ('ph', 'high'), ('Hardness', 'medium'), ('Sulfate', 'medium'), ('Chloramines', 'high'), "
    "('Turbidity', 'high'), ('Trihalomethanes', 'high')) AS w(feature, who) USING (feature)",
    extra=imputed_cte() + ",\n" + _DERIVED + ",\n" + _rule_ctes("d", "eng", ENGINEERED) + ",\n" + _RANKS), ["importance_gain"])
def q_e5(spark, sf_dir):
    return X.rq5_importance(imputed(spark, sf_dir), _rule)[2]


@register("e5_predictions", with_ctes("SELECT row_id, CAST(p AS DOUBLE) AS prediction_probability FROM p_d WHERE split = 'test'",
                                      extra=imputed_cte() + ",\n" + _DERIVED + ",\n" + _rule_ctes("d", "eng", ENGINEERED)))
def q_e5_predictions(spark, sf_dir):
    return X.rq5_importance(imputed(spark, sf_dir), _rule)[1]


# ------------------------------------------------------------------ M12-M15 and S12 on the planted rule with flipped labels

_FLIP = "CAST(('0x' || substr(row_id, 5, 4)) AS BIGINT) % 10 = 0"
_FLIPPED = _PLANTED_CTE + f""",
fl AS (SELECT * REPLACE (CASE WHEN {_FLIP} THEN 1 - Potability ELSE Potability END AS Potability) FROM pl),
{split_cte("fl", "fsp", 42, 0.2)}"""


def _flip(df):
    noise = F.conv(F.substring(ROW_ID, 5, 4), 16, 10).cast("bigint") % 10 == 0
    return df.withColumn(LABEL, F.when(noise, 1 - F.col(LABEL)).otherwise(F.col(LABEL)))


_ALL = ", ".join(f"('{n}')" for n in sorted(MODEL_NAMES))


@register("m12_bake_off_all_models", f"""WITH {_PLANTED_CTE},
p AS (SELECT CASE WHEN {_FLIP} THEN 1 - Potability ELSE Potability END AS y, CASE WHEN q > 0 THEN 1 ELSE 0 END AS p FROM psp WHERE split = 'test'),
c AS (SELECT avg(CAST(p = y AS DOUBLE)) AS a, sum(p * y) AS tp, sum(p * (1 - y)) AS fp, sum((1 - p) * y) AS fn, sum((1 - p) * (1 - y)) AS tn FROM p)
SELECT model, 1.0 AS train_accuracy, a AS test_accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1_score
FROM (VALUES {_ALL}) AS m(model) CROSS JOIN c""", ["train_accuracy", "test_accuracy", "precision", "recall", "f1_score"])
def q_m12_all(spark, sf_dir):
    """All eight, trained on the rule and tested on rows of which a tenth has the other label."""
    train, test = _planted_split(spark, sf_dir)
    return train_baseline_models(train, _flip(test), PLANTED, LABEL, MODEL_NAMES).drop("roc_auc")


@register("m12_roc_auc_of_hard_scores", f"""WITH {_PLANTED_CTE},
p AS (SELECT CASE WHEN {_FLIP} THEN 1 - Potability ELSE Potability END AS y, CASE WHEN q > 0 THEN 1 ELSE 0 END AS p FROM psp WHERE split = 'test'),
c AS (SELECT sum(p * y) AS tp, sum(p * (1 - y)) AS fp, sum((1 - p) * y) AS fn, sum((1 - p) * (1 - y)) AS tn FROM p)
SELECT model, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS roc_auc FROM (VALUES ('Decision Tree'), ('K-Nearest Neighbors')) AS m(model) CROSS JOIN c""", ["roc_auc"])
def q_m12_auc(spark, sf_dir):
    """The two whose scores on the rule are 0 and 1, so that the area has a closed form."""
    train, test = _planted_split(spark, sf_dir)
    return train_baseline_models(train, _flip(test), PLANTED, LABEL, ["Decision Tree", "K-Nearest Neighbors"]).select("model", "roc_auc")


_FOLDS = f"""WITH {_FLIPPED},
f AS (SELECT CAST((CASE WHEN q > 0 THEN 1 ELSE 0 END) = Potability AS DOUBLE) AS ok, Potability AS y, {_FOLD} AS fold FROM fsp WHERE split = 'train'),
a AS (SELECT fold, avg(ok) AS acc, avg(y) AS one FROM f GROUP BY fold)"""


def _flipped_train(spark, sf_dir):
    """The training rows; the split is written once as columns (the row id as the 16 bytes of its md5): a pass reads those it needs."""
    from quench.operators.split import split_data, train_test

    path = scratch_path(spark, "flipped")
    parts = split_data(_flip(planted(spark, sf_dir)), 0.2, 42, True)
    parts.withColumn(ROW_ID, F.unhex(ROW_ID)).write.parquet(path)
    return train_test(spark.read.parquet(path).withColumn(ROW_ID, F.lower(F.hex(ROW_ID))))[0]


@register("m13_cross_validation_flipped", f"""{_FOLDS}
SELECT model, avg(acc) AS mean_cv_accuracy, stddev_pop(acc) AS std_cv_accuracy, min(acc) AS min_cv_accuracy, max(acc) AS max_cv_accuracy
FROM a CROSS JOIN (VALUES ('Logistic Regression'), ('Naive Bayes')) AS m(model) GROUP BY model""",
          ["mean_cv_accuracy", "std_cv_accuracy", "min_cv_accuracy", "max_cv_accuracy"])
def q_m13_flipped(spark, sf_dir):
    return perform_cross_validation(_flipped_train(spark, sf_dir), PLANTED, ["Logistic Regression", "Naive Bayes"], 5, LABEL)


@register("m14_grid_search", f"""{_FOLDS}
SELECT 'weak' AS best, avg(acc) AS best_accuracy, min(acc) AS min_accuracy, max(acc) AS max_accuracy, avg(greatest(one, 1 - one)) AS other_accuracy FROM a""",
          ["best_accuracy", "min_accuracy", "max_accuracy", "other_accuracy"])
def q_m14(spark, sf_dir):
    """Two penalties: the weak one finds the rule, the strong one says the larger class everywhere."""
    tuned = hyperparameter_tuning(_flipped_train(spark, sf_dir), PLANTED, "Logistic Regression", 5, LABEL,
                                  grid_override=lambda est: [{est.regParam: 1e7, est.elasticNetParam: 0.0}, {est.regParam: 1e-6, est.elasticNetParam: 0.0}])
    best = "weak" if tuned.params["regParam"] < 1 else "strong"
    return spark.createDataFrame([(best, tuned.accuracy, min(tuned.fold_accuracy), max(tuned.fold_accuracy), tuned.avg_accuracy[0])],
                                 "best string, best_accuracy double, min_accuracy double, max_accuracy double, other_accuracy double")


@register("m15_tuned_leader", f"""{_FOLDS}
SELECT 'Random Forest' AS model, 3 AS max_depth, avg(acc) AS best_accuracy, min(acc) AS min_accuracy, max(acc) AS max_accuracy FROM a""",
          ["best_accuracy", "min_accuracy", "max_accuracy"])
def q_m15(spark, sf_dir):
    """The leader of two models that are no tree ensemble, so the forest is tuned; its stumps of depth 0 say one class."""
    train = _flipped_train(spark, sf_dir)
    baseline = train_baseline_models(train, train, PLANTED, LABEL, ["Logistic Regression", "Naive Bayes"])
    name, tuned = tune_leader(baseline, train, PLANTED, 5, LABEL, lambda est: [
        {est.maxDepth: depth, est.numTrees: 3, est.featureSubsetStrategy: "all", est.minInstancesPerNode: 50} for depth in (0, 3)])
    return spark.createDataFrame([(name, tuned.params["maxDepth"], tuned.accuracy, min(tuned.fold_accuracy), max(tuned.fold_accuracy))],
                                 "model string, max_depth int, best_accuracy double, min_accuracy double, max_accuracy double")


def _reloaded(spark, model, scored):
    """Rows where the model and its saved and reloaded self score alike."""
    path = scratch_path(spark, "model")
    model.save(path)
    a, b = scored(model), scored(load_model(path))
    return a.join(b.withColumnsRenamed({"prediction": "p2", "score": "s2"}), ROW_ID).where(
        (F.col("prediction") == F.col("p2")) & (F.abs(F.col("score") - F.col("s2")) < 1e-12)).select(ROW_ID, "prediction")


_TEST_RULE = f"WITH {_PLANTED_CTE}\nSELECT row_id, Potability AS prediction FROM psp WHERE split = 'test'"


@register("s12_saved_forest", _TEST_RULE)
def q_s12_forest(spark, sf_dir):
    train, test = _planted_split(spark, sf_dir)
    model = DeepForest(trees=20).fit(train, PLANTED, LABEL)
    return _reloaded(spark, model, lambda m: m.predict(test).select(ROW_ID, "prediction", F.col("probability").alias("score")))


@register("s12_saved_nearest_neighbours", _TEST_RULE)
def q_s12_knn(spark, sf_dir):
    train, test = _planted_split(spark, sf_dir)
    model = make_model("K-Nearest Neighbors", train.count()).fit(train, PLANTED, LABEL)
    return _reloaded(spark, model, lambda m: m.predict(test).select(ROW_ID, "prediction", F.col("probability").alias("score")))


@register("s12_saved_isolation_forest", f"""WITH {_PLANTED_CTE}
SELECT row_id, CASE WHEN CAST(('0x' || substr(row_id, 1, 4)) AS BIGINT) % 50 = 0 THEN 0 ELSE 1 END AS prediction FROM pl""")
def q_s12_iforest(spark, sf_dir):
    far = F.conv(F.substring(ROW_ID, 1, 4), 16, 10).cast("bigint") % 50 == 0
    df = planted(spark, sf_dir).select(ROW_ID, far.alias("far"), *[F.when(far, F.col(c) + 1000).otherwise(F.col(c)).alias(c) for c in PLANTED])
    df = df.checkpoint(eager=True)
    model = fit_isolation_forest(df, PLANTED, n_trees=100, psi=256, contamination=df.agg(F.avg(F.col("far").cast("double"))).first()[0])
    return _reloaded(spark, model, lambda m: m.predict(m.score(df)).select(ROW_ID, "prediction", F.col("anomaly_score").alias("score")))
