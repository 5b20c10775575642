"""Evaluation metrics (A1-A9, A17) as single aggregate passes.

Everything is computed from integer counts, so precision/recall/F1 are
exact ratios; zero denominators give 0 (scikit-learn ``zero_division=0``).
ROC-AUC is the exact tie-aware rank form over distinct scores, with the
running negative count from ``prefix_sums`` (no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quench.operators.ordered import prefix_sums


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """A1: one row (tn, fp, fn, tp) with class 1 as positive."""
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _prf(tp: Column, fp: Column, fn: Column):
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    return precision, recall, f1


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """A2-A4: accuracy and precision/recall/F1 for class 1 and for class 0."""
    return _metrics_of(confusion_counts(df, label, pred)).drop("tn", "fp", "fn", "tp")


def _metrics_of(c: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    p1, r1, f1 = _prf(tp, fp, fn)
    p0, r0, f0 = _prf(tn, fn, fp)
    return c.select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        p1.alias("precision"), r1.alias("recall"), f1.alias("f1_score"),
        p0.alias("precision_unsafe"), r0.alias("recall_unsafe"), f0.alias("f1_unsafe"), "tn", "fp", "fn", "tp",
    )


def _auc(counts: DataFrame, score: str, rows_per_bin: int) -> DataFrame:
    """AUC from one row per score with ``_pos`` and ``_neg`` counts; products are decimals, which
    hold the pairs of 10^18 rows."""
    pre = prefix_sums(counts.checkpoint(eager=True), score, {"_neg": "_neg"}, rows_per_bin=rows_per_bin)
    d = lambda c: c.cast("decimal(19,0)")
    tot = pre.agg(
        F.sum(d(F.col("_pos")) * d(2 * F.col("_neg_before") + F.col("_neg"))).alias("_num"),
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    return tot.select(F.try_divide(F.col("_num").cast("double"),
                                   F.lit(2.0) * F.col("_p").cast("double") * F.col("_n").cast("double")).alias("roc_auc"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", rows_per_bin: int = 2_000_000) -> DataFrame:
    """A5: one row ``roc_auc``; ties count one half; NULL when one class is absent. Rows without a
    score are left out."""
    g = df.where(F.col(score).isNotNull()).groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    return _auc(g, score, rows_per_bin)


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Rows '0', '1', 'macro avg', 'weighted avg' x (precision, recall, f1_score, support)."""
    c = confusion_counts(df, label, pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    p1, r1, f1 = _prf(tp, fp, fn)
    p0, r0, f0 = _prf(tn, fn, fp)
    s0, s1 = tn + fp, tp + fn
    tot = (s0 + s1).cast("double")

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class_name"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("bigint").alias("support"))

    rows = F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
        row("weighted avg", (p0 * s0 + p1 * s1) / tot, (r0 * s0 + r1 * s1) / tot, (f0 * s0 + f1 * s1) / tot, s0 + s1),
    )
    return c.select(F.explode(rows).alias("r")).select("r.*")


def evaluate_model(df: DataFrame, label: str = "label", pred: str = "prediction", score: str = "score") -> DataFrame:
    """One row with every headline metric plus the confusion counts, from one scan: rows are
    counted per (score, label, prediction), written, and everything follows from the counts."""
    g = (df.groupBy(F.col(score).alias("_s"), F.col(label).alias("_y"), F.col(pred).alias("_p_"))
         .agg(F.count(F.lit(1)).alias("_c")).checkpoint(eager=True))
    n = lambda y, p: F.coalesce(F.sum(F.when((F.col("_y") == y) & (F.col("_p_") == p), F.col("_c"))), F.lit(0))
    c = g.agg(n(0, 0).alias("tn"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(1, 1).alias("tp"))
    m = _metrics_of(c)
    per_score = g.where(F.col("_s").isNotNull()).groupBy("_s").agg(
        F.coalesce(F.sum(F.when(F.col("_y") == 1, F.col("_c"))), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum(F.when(F.col("_y") == 0, F.col("_c"))), F.lit(0)).alias("_neg"))
    # two one-row frames: the join pairs single rows
    return m.crossJoin(_auc(per_score, "_s", 2_000_000)).select(
        "accuracy", "precision", "recall", "f1_score", "precision_unsafe", "recall_unsafe", "f1_unsafe", "roc_auc", "tn", "fp", "fn", "tp")


def cv_summary(df: DataFrame, fold: str = "fold", label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-fold accuracy and recall -> mean and population std; stability = 1 - std(accuracy)."""
    y, p = F.col(label), F.col(pred)
    per = df.groupBy(fold).agg(
        F.avg((y == p).cast("double")).alias("acc"),
        _ratio(F.count_if((y == 1) & (p == 1)), F.count_if(y == 1)).alias("rec"))
    return per.agg(
        F.avg("acc").alias("cv_accuracy_mean"), F.stddev_pop("acc").alias("cv_accuracy_std"),
        F.avg("rec").alias("cv_recall_mean"), F.stddev_pop("rec").alias("cv_recall_std"),
        (1 - F.stddev_pop("acc")).alias("stability_score"),
        F.min("acc").alias("cv_accuracy_min"), F.max("acc").alias("cv_accuracy_max"))


def misclassified(df: DataFrame, label: str = "label", pred: str = "prediction") -> Column:
    """A9."""
    return (F.col(pred) != F.col(label)).cast("int")


def contamination(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of class 0, capped at 0.5."""
    return df.agg(F.least(F.avg((F.col(label) == 0).cast("double")), F.lit(0.5)).alias("contamination"))
