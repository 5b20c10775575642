"""Queries: metrics and statistics (A1-A17), ranking and lookups (R1-R9),
standards exceedance (H4) and the report table (S11)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quench.functions.constants import FEATURES, LABEL, NOISE_LEVELS, ROW_ID, STANDARDS
from quench.functions.hashing import hash_gauss
from quench.operators import clean, metrics, ranking, stats
from quench.operators.split import split_data, train_test
from quench.plans.registry import register
from quench.plans.common import ENGINEERED, importance, imputed
from quench.plans.queries_features import ENG_CTE, SPLIT_CTE
from quench.plans.sqltext import MEASUREMENTS_CTE, gauss_sql, with_ctes
from quench.sources.fixtures import measurements_clean, scored

CONF_SQL = ("SELECT count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 0 AND prediction = 1) AS fp, "
            "count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 1 AND prediction = 1) AS tp FROM scored")


def _s(body, extra=""):
    return with_ctes(body, scored=True, extra=extra)


def _ratio(n, d):
    return f"coalesce(CAST({n} AS DOUBLE) / nullif({d}, 0), 0.0)"


@register("a1_confusion_counts", _s(CONF_SQL))
def q_a1(spark, sf_dir):
    return metrics.confusion_counts(scored(spark, sf_dir))


_MET_SQL = (
    f"SELECT {_ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {_ratio('tp', 'tp + fp')} AS precision, "
    f"{_ratio('tp', 'tp + fn')} AS recall, {_ratio('2 * tp', '2 * tp + fp + fn')} AS f1_score, "
    f"{_ratio('tn', 'tn + fn')} AS precision_unsafe, {_ratio('tn', 'tn + fp')} AS recall_unsafe, "
    f"{_ratio('2 * tn', '2 * tn + fn + fp')} AS f1_unsafe FROM c"
)
_MET_COLS = ["accuracy", "precision", "recall", "f1_score", "precision_unsafe", "recall_unsafe", "f1_unsafe"]


@register("a2_a4_classification_metrics", _s(_MET_SQL, extra=f"c AS ({CONF_SQL})"), _MET_COLS)
def q_a2(spark, sf_dir):
    return metrics.classification_metrics(scored(spark, sf_dir))


_AUC_CTE = (
    "g AS (SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM scored GROUP BY score),\n"
    "gc AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg "
    "AS nb FROM g),\n"
    "auc AS (SELECT CAST(sum(pos * (2 * nb + neg)) AS DOUBLE) / nullif(2.0 * sum(pos) * sum(neg), 0) AS roc_auc FROM gc)"
)


@register("a5_roc_auc", _s("SELECT roc_auc FROM auc", extra=_AUC_CTE), ["roc_auc"])
def q_a5(spark, sf_dir):
    return metrics.roc_auc(scored(spark, sf_dir))


_REP_SQL = (
    "SELECT '0' AS class_name, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM m UNION ALL "
    "SELECT '1', p1, r1, f1, s1 FROM m UNION ALL "
    "SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM m UNION ALL "
    "SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1), "
    "(f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM m"
)
_REP_CTE = (
    f"c AS ({CONF_SQL}),\n"
    f"m AS (SELECT {_ratio('tp', 'tp + fp')} AS p1, {_ratio('tp', 'tp + fn')} AS r1, "
    f"{_ratio('2 * tp', '2 * tp + fp + fn')} AS f1, {_ratio('tn', 'tn + fn')} AS p0, {_ratio('tn', 'tn + fp')} AS r0, "
    f"{_ratio('2 * tn', '2 * tn + fn + fp')} AS f0, tn + fp AS s0, tp + fn AS s1 FROM c)"
)


@register("a6_classification_report", _s(_REP_SQL, extra=_REP_CTE), ["precision", "recall", "f1_score"])
def q_a6(spark, sf_dir):
    return metrics.classification_report(scored(spark, sf_dir))


@register("a7_evaluate_model", _s(
    "SELECT x.*, auc.roc_auc, c.* FROM (" + _MET_SQL + ") AS x CROSS JOIN auc CROSS JOIN c",
    extra=f"c AS ({CONF_SQL}),\n" + _AUC_CTE), _MET_COLS + ["roc_auc"])
def q_a7(spark, sf_dir):
    return metrics.evaluate_model(scored(spark, sf_dir))


_CV_COLS = ["cv_accuracy_mean", "cv_accuracy_std", "cv_recall_mean", "cv_recall_std", "stability_score",
            "cv_accuracy_min", "cv_accuracy_max"]


@register("a8_cv_summary", _s(
    "SELECT avg(acc) AS cv_accuracy_mean, stddev_pop(acc) AS cv_accuracy_std, avg(rec) AS cv_recall_mean, "
    "stddev_pop(rec) AS cv_recall_std, 1 - stddev_pop(acc) AS stability_score, min(acc) AS cv_accuracy_min, "
    "max(acc) AS cv_accuracy_max FROM per",
    extra="per AS (SELECT fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS acc, "
    + _ratio("count_if(label = 1 AND prediction = 1)", "count_if(label = 1)") + " AS rec FROM scored GROUP BY fold)"),
    _CV_COLS)
def q_a8(spark, sf_dir):
    return metrics.cv_summary(scored(spark, sf_dir))


@register("a9_misclassified", _s(
    "SELECT row_id, CAST(prediction <> label AS INTEGER) AS misclassified FROM scored"))
def q_a9(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select(ROW_ID, metrics.misclassified(s).alias("misclassified"))


_MIS = "CAST(prediction <> label AS INTEGER)"


@register("a10_pearson", _s(
    f"SELECT corr(raw_score, {_MIS}) AS pearson_correlation, count(*) AS n FROM scored"), ["pearson_correlation"])
def q_a10(spark, sf_dir):
    s = scored(spark, sf_dir)
    return stats.pearson(s.withColumn("misclassified", metrics.misclassified(s)), "raw_score", "misclassified")


@register("a11_spearman", _s(
    "SELECT corr(rx, ry) AS spearman_correlation, count(*) AS n FROM ("
    "SELECT rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rx, "
    "rank() OVER (ORDER BY mis) + (count(*) OVER (PARTITION BY mis) - 1) / 2.0 AS ry FROM "
    f"(SELECT score, {_MIS} AS mis FROM scored) AS t) AS r"), ["spearman_correlation"])
def q_a11(spark, sf_dir):
    s = scored(spark, sf_dir)
    return stats.spearman(s.withColumn("mis", metrics.misclassified(s)), "score", "mis")


_Q_CTE = (
    "qe AS (SELECT quantile_cont(raw_score, 0.25) AS e1, quantile_cont(raw_score, 0.5) AS e2, "
    "quantile_cont(raw_score, 0.75) AS e3 FROM scored),\n"
    f"qb AS (SELECT row_id, {_MIS} AS misclassified, CASE WHEN raw_score <= e1 THEN 'Q1_Low' WHEN raw_score <= e2 "
    "THEN 'Q2' WHEN raw_score <= e3 THEN 'Q3' ELSE 'Q4_High' END AS quartile FROM scored CROSS JOIN qe)"
)


@register("a12_quartile_bins", _s("SELECT row_id, quartile FROM qb", extra=_Q_CTE))
def q_a12(spark, sf_dir):
    return stats.qcut(scored(spark, sf_dir), "raw_score").select(ROW_ID, "quartile")


@register("a13_quartile_misclassification", _s(
    "SELECT l.quartile, avg(CAST(misclassified AS DOUBLE)) AS misclassification_rate, "
    "CAST(count(qb.row_id) AS BIGINT) AS n_samples FROM (VALUES ('Q1_Low'), ('Q2'), ('Q3'), ('Q4_High')) AS l(quartile) "
    "LEFT JOIN qb ON qb.quartile = l.quartile GROUP BY l.quartile", extra=_Q_CTE), ["misclassification_rate"])
def q_a13(spark, sf_dir):
    s = scored(spark, sf_dir)
    q = stats.qcut(s.withColumn("misclassified", metrics.misclassified(s)), "raw_score")
    return stats.rate_by_bin(q, "quartile", "misclassified")


def _noise_levels_spark(s):
    levels = F.array(*[F.struct(F.lit(i).alias("li"), F.lit(v).alias("noise_level"))
                       for i, v in enumerate(NOISE_LEVELS)])
    x = s.select(ROW_ID, "label", "score", F.explode(levels).alias("lv")).select(ROW_ID, "label", "score", "lv.*")
    noisy = F.col("score") + F.col("noise_level") * hash_gauss("noise", F.col("li"), F.col(ROW_ID))
    return x.withColumn("pred", (noisy >= 0.5).cast("int"))


_NOISE_SQL_CTE = (
    "lv AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, CAST({v} AS DOUBLE))" for i, v in enumerate(NOISE_LEVELS))
    + ") AS t(li, noise_level)),\n"
    "nz AS (SELECT li, noise_level, label, CASE WHEN score + noise_level * "
    + gauss_sql("'noise:' || li || ':' || row_id") + " >= 0.5 THEN 1 ELSE 0 END AS pred FROM scored CROSS JOIN lv),\n"
    "acc AS (SELECT noise_level, avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM nz "
    "GROUP BY noise_level)"
)


@register("a14_noise_degradation", _s(
    "SELECT noise_level, accuracy, first_value(accuracy) OVER (ORDER BY noise_level) - accuracy "
    "AS accuracy_degradation FROM acc", extra=_NOISE_SQL_CTE), ["noise_level", "accuracy", "accuracy_degradation"])
def q_a14(spark, sf_dir):
    x = _noise_levels_spark(scored(spark, sf_dir))
    acc = x.groupBy("noise_level").agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"))
    # five rows: a global window over the per-level table is bounded
    w = Window.orderBy("noise_level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return acc.withColumn("accuracy_degradation", F.first("accuracy").over(w) - F.col("accuracy"))


_APPROACH_SQL = (
    "ap AS (SELECT 'raw_features' AS approach, label, prediction AS pred FROM scored UNION ALL "
    "SELECT 'derived_features', label, CASE WHEN 0.5 * score + 0.5 * raw_score >= 0.5 THEN 1 ELSE 0 END FROM scored),\n"
    "apm AS (SELECT approach, avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) AS accuracy, "
    + _ratio("count_if(label = 0 AND pred = 0)", "count_if(label = 0)") + " AS recall_unsafe, "
    + _ratio("count_if(label = 0 AND pred = 0)", "count_if(pred = 0)") + " AS precision_unsafe, "
    + _ratio("2 * count_if(label = 0 AND pred = 0)", "count_if(label = 0) + count_if(pred = 0)")
    + " AS f1_unsafe FROM ap GROUP BY approach)"
)


def _approach_metrics(s):
    raw = s.select(F.lit("raw_features").alias("approach"), "label", F.col("prediction").alias("pred"))
    der = s.select(F.lit("derived_features").alias("approach"), "label",
                   (0.5 * F.col("score") + 0.5 * F.col("raw_score") >= 0.5).cast("int").alias("pred"))
    both = raw.unionByName(der)  # R5: result rows appended
    y, p = F.col("label"), F.col("pred")
    tn = F.count_if((y == 0) & (p == 0))
    return both.groupBy("approach").agg(
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.coalesce(F.try_divide(tn.cast("double"), F.count_if(y == 0)), F.lit(0.0)).alias("recall_unsafe"),
        F.coalesce(F.try_divide(tn.cast("double"), F.count_if(p == 0)), F.lit(0.0)).alias("precision_unsafe"),
        F.coalesce(F.try_divide((2 * tn).cast("double"), F.count_if(y == 0) + F.count_if(p == 0)), F.lit(0.0))
        .alias("f1_unsafe"))


_AP_COLS = ["accuracy", "recall_unsafe", "precision_unsafe", "f1_unsafe"]


@register("r5_append_results", _s("SELECT * FROM apm", extra=_APPROACH_SQL), _AP_COLS)
def q_r5(spark, sf_dir):
    return _approach_metrics(scored(spark, sf_dir))


@register("r6_filter_select", _s(
    "SELECT recall_unsafe, precision_unsafe, f1_unsafe FROM apm WHERE approach = 'raw_features'",
    extra=_APPROACH_SQL), _AP_COLS[1:])
def q_r6(spark, sf_dir):
    return (_approach_metrics(scored(spark, sf_dir)).where(F.col("approach") == "raw_features")
            .select("recall_unsafe", "precision_unsafe", "f1_unsafe"))


@register("a15_relative_improvement", _s(
    "SELECT r.recall_unsafe AS recall_unsafe_raw, d.recall_unsafe AS recall_unsafe_derived, "
    "(d.recall_unsafe - r.recall_unsafe) / nullif(r.recall_unsafe, 0) * 100 AS improvement_pct "
    "FROM apm AS r CROSS JOIN apm AS d WHERE r.approach = 'raw_features' AND d.approach = 'derived_features'",
    extra=_APPROACH_SQL), ["recall_unsafe_raw", "recall_unsafe_derived", "improvement_pct"])
def q_a15(spark, sf_dir):
    m = _approach_metrics(scored(spark, sf_dir))
    pv = m.groupBy().pivot("approach", ["raw_features", "derived_features"]).agg(F.first("recall_unsafe"))
    return pv.select(
        F.col("raw_features").alias("recall_unsafe_raw"), F.col("derived_features").alias("recall_unsafe_derived"),
        (F.try_divide(F.col("derived_features") - F.col("raw_features"), F.col("raw_features")) * 100)
        .alias("improvement_pct"))


@register("a16_trend_line", _s(
    "SELECT i, CASE WHEN i = 99 THEN hi ELSE lo + CAST(i AS DOUBLE) * (hi - lo) / 99.0 END AS x, slope, intercept, "
    "intercept + slope * (CASE WHEN i = 99 THEN hi ELSE lo + CAST(i AS DOUBLE) * (hi - lo) / 99.0 END) AS y "
    "FROM fit CROSS JOIN range(100) AS t(i)",
    extra=f"fit AS (SELECT regr_slope({_MIS}, raw_score) AS slope, regr_intercept({_MIS}, raw_score) AS intercept, "
    "min(raw_score) AS lo, max(raw_score) AS hi FROM scored)"), ["x", "slope", "intercept", "y"])
def q_a16(spark, sf_dir):
    s = scored(spark, sf_dir)
    return stats.trend_line(s.withColumn("misclassified", metrics.misclassified(s)), "raw_score", "misclassified") \
        .select(F.col("i").cast("bigint").alias("i"), "x", "slope", "intercept", "y")


@register("a17_contamination", with_ctes(
    "SELECT least(avg(CASE WHEN Potability = 0 THEN 1.0 ELSE 0.0 END), 0.5) AS contamination "
    "FROM sp WHERE split = 'train'", extra=SPLIT_CTE), ["contamination"])
def q_a17(spark, sf_dir):
    train, _ = train_test(split_data(imputed(spark, sf_dir), 0.2, 42, True))
    return metrics.contamination(train, LABEL)


# ------------------------------------------------------------------ importance, rank, lookups

_IMP_CTE = (ENG_CTE + ",\nimp AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, CAST(Potability AS DOUBLE))) AS importance_gain FROM eng"
    for c in ENGINEERED) + "),\nrk AS (SELECT feature, importance_gain, CAST(row_number() OVER "
    "(ORDER BY importance_gain DESC, feature) AS INTEGER) AS feature_rank FROM imp)")


def _ranked(spark, sf_dir):
    return ranking.with_rank(importance(spark, sf_dir), "importance_gain", "feature")


@register("r1_best_feature", with_ctes("SELECT feature, importance_gain FROM rk WHERE feature_rank = 1",
                                       extra=_IMP_CTE), ["importance_gain"])
def q_r1(spark, sf_dir):
    return ranking.top_k(importance(spark, sf_dir), "importance_gain", 1, "feature")


@register("r2_top5_features", with_ctes("SELECT feature, importance_gain FROM rk WHERE feature_rank <= 5",
                                        extra=_IMP_CTE), ["importance_gain"])
def q_r2(spark, sf_dir):
    return ranking.top_k(importance(spark, sf_dir), "importance_gain", 5, "feature")


@register("r3_feature_rank", with_ctes("SELECT feature, importance_gain, feature_rank FROM rk", extra=_IMP_CTE),
          ["importance_gain"])
def q_r3(spark, sf_dir):
    return _ranked(spark, sf_dir)


_STD_VALUES = ", ".join(f"('{f}', '{imp}')" for f, _, _, imp in STANDARDS)


@register("r4_standards_alignment", with_ctes(
    "SELECT rk.feature, s.who_importance, rk.feature_rank, rk.importance_gain, CASE WHEN feature_rank <= 10 THEN "
    "'high' WHEN feature_rank <= 15 THEN 'medium' ELSE 'low' END AS alignment FROM rk JOIN "
    f"(VALUES {_STD_VALUES}) AS s(feature, who_importance) ON rk.feature = s.feature", extra=_IMP_CTE),
    ["importance_gain"])
def q_r4(spark, sf_dir):
    return ranking.standards_alignment(_ranked(spark, sf_dir))


@register("r7_title_case", with_ctes(
    "SELECT feature, array_to_string(list_transform(string_split(replace(feature, '_', ' '), ' '), "
    "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS title FROM imp", extra=_IMP_CTE))
def q_r7(spark, sf_dir):
    return importance(spark, sf_dir).select("feature", ranking.title_case("feature").alias("title"))


@register("r8_feature_tags", with_ctes(
    "SELECT feature, (contains(feature, 'ph') OR contains(feature, 'Chloramines') OR contains(feature, 'Turbidity')) "
    "AS tagged FROM rk WHERE feature_rank <= 15", extra=_IMP_CTE))
def q_r8(spark, sf_dir):
    top = ranking.top_k(importance(spark, sf_dir), "importance_gain", 15, "feature")
    return top.select("feature", ranking.has_tag("feature").alias("tagged"))


@register("r9_importance_colour", with_ctes(
    f"SELECT s.feature, s.who_importance, CASE s.who_importance WHEN 'high' THEN '#e74c3c' WHEN 'medium' THEN "
    f"'#f39c12' WHEN 'low' THEN '#95a5a6' END AS colour FROM rk JOIN (VALUES {_STD_VALUES}) AS s(feature, "
    "who_importance) ON rk.feature = s.feature", extra=_IMP_CTE))
def q_r9(spark, sf_dir):
    al = ranking.standards_alignment(_ranked(spark, sf_dir))
    return al.select("feature", "who_importance", ranking.importance_colour("who_importance").alias("colour"))


@register("s11_report_table", with_ctes(
    "SELECT feature, round(importance_gain, 4) AS importance_gain FROM rk WHERE feature_rank <= 20",
    extra=_IMP_CTE), ["importance_gain"])
def q_s11(spark, sf_dir):
    top = ranking.top_k(importance(spark, sf_dir), "importance_gain", 20, "feature")
    return top.select("feature", F.round("importance_gain", 4).alias("importance_gain"))


# ------------------------------------------------------------------ standards exceedance

_H4_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({lo if lo is not None else 'NULL'} AS DOUBLE) AS min_value, "
    f"CAST({hi} AS DOUBLE) AS max_value, '{imp}' AS importance, count({f}) AS n_measured, "
    f"{f'count_if({f} < {lo})' if lo is not None else 'CAST(0 AS BIGINT)'} AS n_below, "
    f"count_if({f} > {hi}) AS n_above, "
    f"(({f'count_if({f} < {lo})' if lo is not None else '0'}) + count_if({f} > {hi})) * 100.0 / nullif(count({f}), 0) "
    f"AS exceed_pct FROM measurements"
    for f, lo, hi, imp in STANDARDS)


@register("h4_standards_exceedance", with_ctes(_H4_SQL), ["exceed_pct", "min_value", "max_value"])
def q_h4(spark, sf_dir):
    return ranking.standards_exceedance(measurements_clean(spark, sf_dir))


# ------------------------------------------------------------------ strategies appended (R5 over cleaning)

@register("r5_strategy_comparison", with_ctes(
    "SELECT 'median' AS strategy, count(*) AS n_rows, avg(ph) AS mean_ph, avg(Sulfate) AS mean_sulfate FROM imputed "
    "UNION ALL SELECT 'mean', count(*), avg(coalesce(m.ph, mu.ph)), avg(coalesce(m.Sulfate, mu.Sulfate)) "
    "FROM measurements AS m CROSS JOIN (SELECT avg(ph) AS ph, avg(Sulfate) AS Sulfate FROM measurements) AS mu "
    "UNION ALL SELECT 'drop', count(*), avg(ph), avg(Sulfate) FROM measurements WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES + ["Potability"]),
    extra=ENG_CTE), ["mean_ph", "mean_sulfate"])
def q_r5b(spark, sf_dir):
    m = measurements_clean(spark, sf_dir)
    frames = []
    for strategy in ("median", "mean", "drop"):
        d = clean.handle_missing_values(m, strategy, features=FEATURES)
        frames.append(d.agg(F.lit(strategy).alias("strategy"), F.count(F.lit(1)).alias("n_rows"),
                            F.avg("ph").alias("mean_ph"), F.avg("Sulfate").alias("mean_sulfate")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
