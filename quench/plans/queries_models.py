"""Queries: model scoring (M1-M11), k-NN imputation.

Model fits on the measurements are not SQL; ``tests/`` checks them by brute force and
by properties. The planted queries give every model a compared row: a noise-free
rule with a margin (FIXTURES §3), which each model must reproduce on the held-out
split, naive Bayes in full SQL, and extreme rows for the isolation forest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quench.functions.constants import FEATURES, LABEL, ROW_ID
from quench.operators import clean
from quench.operators.iforest import fit_isolation_forest
from quench.operators.models import make_model
from quench.operators.scale import fit_scaler
from quench.operators.split import split_data, train_test
from quench.plans.registry import register
from quench.plans.common import ENGINEERED, engineered
from quench.plans.queries_features import split_cte
from quench.plans.sqltext import MEASUREMENTS_CTE, bits_sql
from quench.sources.fixtures import measurements_clean, table


def prepared(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Engineered, standard-scaled (fitted on all rows, as the reference), split 80/20
    stratified. Nothing is written: all of it is narrow over the written fixture and made again in each pass."""
    e = engineered(spark, sf_dir)
    scaled = fit_scaler(e, ENGINEERED, "standard").transform(e)
    return train_test(split_data(scaled, 0.2, 42, True))


def _model_query(name: str):
    def run(spark, sf_dir):
        train, test = prepared(spark, sf_dir)
        model = make_model(name, train.count()).fit(train, ENGINEERED, LABEL)
        return model.predict(test).select(ROW_ID, LABEL, "prediction", "probability")
    return run


for _key, _name in [
    ("m1_logistic_regression", "Logistic Regression"),
    ("m2_decision_tree", "Decision Tree"),
    ("m3_random_forest", "Random Forest"),
    ("m4_gradient_boosting", "Gradient Boosting"),
    ("m5_svm_rbf_features", "SVM"),
    ("m7_gaussian_naive_bayes", "Naive Bayes"),
    ("m8_boosted_trees_xgb_settings", "XGBoost"),
]:
    register(_key, note="rows-only: model predictions")(_model_query(_name))


@register("m9_m10_isolation_forest", note="rows-only: anomaly scores")
def q_m9(spark, sf_dir):
    train, test = prepared(spark, sf_dir)
    model = fit_isolation_forest(train, ENGINEERED, n_trees=100, psi=256)
    return model.predict(model.score(test)).select(ROW_ID, LABEL, "anomaly_score", "prediction")


def knn_imputed_sql(features: list[str], gaps: list[str], k: int = 5) -> str:
    """All pairs of rows with a gap and rows with the value; equal distances by the least key among equal rows."""
    def search(f):
        shared = {c: f"q.{c} IS NOT NULL AND d.{c} IS NOT NULL" for c in features if c != f}
        sq = " + ".join(f"CASE WHEN {on} THEN (q.{c} - d.{c}) * (q.{c} - d.{c}) ELSE 0.0 END" for c, on in shared.items())
        n = " + ".join(f"CASE WHEN {on} THEN 1 ELSE 0 END" for on in shared.values())
        return (f"near_{f} AS (SELECT q.row_id, min({{'d': CAST({len(features)} AS DOUBLE) / ({n}) * ({sq}), 'g': d.copy_of, 'v': d.{f}}}, {k}) AS best "
                f"FROM rows_ q, rows_ d WHERE q.{f} IS NULL AND d.{f} IS NOT NULL AND ({n}) > 0 GROUP BY q.row_id)")

    filled = ", ".join(f"coalesce({c}, list_avg(list_transform(near_{c}.best, lambda b: b.v)), (SELECT avg({c}) FROM rows_)) AS {c}" if c in gaps else c
                       for c in features)
    return (f"WITH {MEASUREMENTS_CTE},\nrows_ AS MATERIALIZED (SELECT *, min(row_id) OVER (PARTITION BY {', '.join(features)}) AS copy_of FROM measurements),\n"
            + ",\n".join(search(f) for f in gaps)
            + f"\nSELECT rows_.row_id, {filled} FROM rows_ " + " ".join(f"LEFT JOIN near_{f} ON rows_.row_id = near_{f}.row_id" for f in gaps))


#: The fixture's columns with gaps.
GAPS = ["ph", "Sulfate", "Trihalomethanes"]


@register("c5_impute_knn", knn_imputed_sql(FEATURES, GAPS), GAPS)
def q_c5(spark, sf_dir):
    return clean.handle_missing_values(measurements_clean(spark, sf_dir), "knn", n_neighbors=5, features=FEATURES).select(ROW_ID, *FEATURES)


@register("c5_impute_knn_no_complete_column", knn_imputed_sql(GAPS, GAPS), GAPS)
def q_c5_gaps(spark, sf_dir):
    return clean.handle_missing_values(measurements_clean(spark, sf_dir).select(ROW_ID, *GAPS), "knn", n_neighbors=5, features=GAPS)


# ------------------------------------------------------------------ planted rule: compared rows for every model

PLANTED = ["q", "t", "d"]


def planted(spark, sf_dir) -> DataFrame:
    """``lineitem`` rows whose quantity is not between 21 and 30; the label is quantity above 25.
    Features: quantity, tax and discount, standardised to comparable ranges by constants."""
    li = table(spark, sf_dir, "lineitem").where((F.col("l_quantity") <= 20) | (F.col("l_quantity") > 30))
    key = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
                            F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")))
    return li.select(key.alias(ROW_ID), ((F.col("l_quantity") - 25) / 10).alias("q"), (F.col("l_tax") * 10).alias("t"),
                     (F.col("l_discount") * 10).alias("d"), (F.col("l_quantity") > 25).cast("int").alias(LABEL))


_PLANTED_CTE = (
    "pl AS (SELECT md5(concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT))) AS row_id, "
    "(l_quantity - 25) / 10 AS q, l_tax * 10 AS t, l_discount * 10 AS d, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS Potability "
    "FROM lineitem WHERE l_quantity <= 20 OR l_quantity > 30),\n" + split_cte("pl", "psp", 42, 0.2))
_RULE = f"WITH {_PLANTED_CTE}\nSELECT row_id, Potability AS prediction FROM psp WHERE split = 'test'"


def _planted_split(spark, sf_dir):
    return train_test(split_data(planted(spark, sf_dir), 0.2, 42, True).checkpoint(eager=True))


def _planted_query(name: str):
    def run(spark, sf_dir):
        train, test = _planted_split(spark, sf_dir)
        return make_model(name, train.count()).fit(train, PLANTED, LABEL).predict(test).select(ROW_ID, "prediction")
    return run


for _key, _name in [
    ("m1_planted_rule", "Logistic Regression"), ("m2_planted_rule", "Decision Tree"), ("m3_planted_rule", "Random Forest"),
    ("m4_planted_rule", "Gradient Boosting"), ("m5_planted_rule", "SVM"), ("m6_planted_rule", "K-Nearest Neighbors"),
    ("m8_planted_rule", "XGBoost"),
]:
    register(_key, _RULE)(_planted_query(_name))

_NB_STATS = ", ".join(f"avg({c}) AS {c}_m, var_pop({c}) AS {c}_v" for c in PLANTED)
_NB_LL = " - ".join(["ln(p)"] + [f"0.5 * ln(2 * pi() * ({c}_v + eps)) - ({c} - {c}_m) * ({c} - {c}_m) / (2 * ({c}_v + eps))" for c in PLANTED])


@register("m7_naive_bayes_planted", f"""WITH {_PLANTED_CTE},
tr AS (SELECT * FROM psp WHERE split = 'train'),
eps AS (SELECT 1e-9 * greatest({", ".join(f"var_pop({c})" for c in PLANTED)}) AS eps FROM tr),
cl AS (SELECT Potability AS y, count(*) * 1.0 / (SELECT count(*) FROM tr) AS p, {_NB_STATS} FROM tr GROUP BY Potability),
ll AS (SELECT row_id, y, {_NB_LL} AS l FROM psp CROSS JOIN cl CROSS JOIN eps WHERE split = 'test')
SELECT a.row_id, CASE WHEN b.l > a.l THEN 1 ELSE 0 END AS prediction, 1 / (1 + exp(least(a.l - b.l, 700.0))) AS probability
FROM ll a JOIN ll b ON a.row_id = b.row_id AND a.y = 0 AND b.y = 1""", ["probability"])
def q_m7_planted(spark, sf_dir):
    train, test = _planted_split(spark, sf_dir)
    return make_model("Naive Bayes", train.count()).fit(train, PLANTED, LABEL).predict(test).select(ROW_ID, "prediction", "probability")


@register("m9_m10_planted_extremes", f"""WITH {_PLANTED_CTE}
SELECT row_id, CASE WHEN CAST(('0x' || substr(row_id, 1, 4)) AS BIGINT) % 50 = 0 THEN 0 ELSE 1 END AS prediction FROM pl""")
def q_m9_planted(spark, sf_dir):
    """One row in fifty (by key) lies far outside; the forest, told the share, must name those rows."""
    far = F.conv(F.substring(ROW_ID, 1, 4), 16, 10).cast("bigint") % 50 == 0
    df = planted(spark, sf_dir).select(ROW_ID, far.alias("far"), *[F.when(far, F.col(c) + 1000).otherwise(F.col(c)).alias(c) for c in PLANTED])
    df = df.checkpoint(eager=True)
    share = df.agg(F.avg(F.col("far").cast("double"))).first()[0]
    model = fit_isolation_forest(df, PLANTED, n_trees=100, psi=256, contamination=share)
    return model.predict(df).select(ROW_ID, "prediction")


# ------------------------------------------------------------------ M12, M13, M16 on the planted rule

_BAKE_OFF = ["Decision Tree", "K-Nearest Neighbors", "Logistic Regression", "Naive Bayes"]
_NAMES = ", ".join(f"('{n}')" for n in _BAKE_OFF)


@register("m12_bake_off_planted", f"""WITH {_PLANTED_CTE},
p AS (SELECT Potability AS y, CASE WHEN q > 0 THEN 1 ELSE 0 END AS p, split FROM psp)
SELECT m.model, tr.a AS train_accuracy, te.a AS test_accuracy, te.pr AS precision, te.re AS recall, 2 * te.pr * te.re / (te.pr + te.re) AS f1_score, 1.0 AS roc_auc
FROM (VALUES {_NAMES}) AS m(model)
CROSS JOIN (SELECT avg(CAST(p = y AS DOUBLE)) AS a FROM p WHERE split = 'train') AS tr
CROSS JOIN (SELECT avg(CAST(p = y AS DOUBLE)) AS a, sum(p * y) / sum(p) AS pr, sum(p * y) / sum(y) AS re FROM p WHERE split = 'test') AS te""",
          ["train_accuracy", "test_accuracy", "precision", "recall", "f1_score", "roc_auc"])
def q_m12_planted(spark, sf_dir):
    from quench.operators.models import train_baseline_models

    train, test = _planted_split(spark, sf_dir)
    return train_baseline_models(train, test, PLANTED, LABEL, _BAKE_OFF)


@register("m13_cross_validation_planted", f"""WITH {_PLANTED_CTE},
f AS (SELECT Potability AS y, CASE WHEN q > 0 THEN 1 ELSE 0 END AS p, (row_number() OVER (PARTITION BY Potability ORDER BY {bits_sql("'42:' || row_id")}, row_id) - 1) % 5 AS fold
      FROM psp WHERE split = 'train'),
a AS (SELECT fold, avg(CAST(p = y AS DOUBLE)) AS acc FROM f GROUP BY fold)
SELECT 'Decision Tree' AS model, avg(acc) AS mean_cv_accuracy, stddev_pop(acc) AS std_cv_accuracy, min(acc) AS min_cv_accuracy, max(acc) AS max_cv_accuracy FROM a""",
          ["mean_cv_accuracy", "std_cv_accuracy", "min_cv_accuracy", "max_cv_accuracy"])
def q_m13_planted(spark, sf_dir):
    from quench.operators.models import perform_cross_validation

    return perform_cross_validation(_planted_split(spark, sf_dir)[0], PLANTED, ["Decision Tree"], 5, LABEL)


@register("m16_feature_importance_planted", f"""WITH {_PLANTED_CTE}
SELECT 'q' AS feature, CAST(count(*) > 0 AS INTEGER) * 1.0 AS importance FROM psp UNION ALL
SELECT 't' AS feature, 0.0 AS importance UNION ALL SELECT 'd' AS feature, 0.0 AS importance""", ["importance"])
def q_m16_planted(spark, sf_dir):
    from quench.operators.models import feature_importance_df

    train, _ = _planted_split(spark, sf_dir)
    return feature_importance_df(make_model("Decision Tree", train.count()).fit(train, PLANTED, LABEL), spark)
