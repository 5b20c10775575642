"""Statistics (A10-A16): correlations, average ranks, quantile bins, trend line."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quench.functions.constants import QUARTILE_LABELS
from quench.operators.ordered import prefix_sums
from quench.operators.quantiles import exact_quantiles


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """A10: one row (pearson_correlation, n)."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("pearson_correlation"),
                    F.count(F.lit(1)).alias("n"))


def _betacf(a: float, b: float, x: float) -> float:
    # continued fraction for the regularized incomplete beta (Numerical Recipes form)
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, 300):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(c) > 1e-300 else 1e300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(c) > 1e-300 else 1e300
        de = d * c
        h *= de
        if abs(de - 1.0) < 3e-16:
            break
    return h


def _betainc(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbeta) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbeta) * _betacf(b, a, 1 - x) / b


def correlation_p_value(r: float | None, n: int) -> float | None:
    """Two-sided p of a correlation under H0 (t with n-2 dof), as scipy's pearsonr;
    a scalar computed from (r, n) on the driver."""
    if r is None or r != r or n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    dof = n - 2
    t2 = r * r * dof / (1 - r * r)
    return _betainc(dof / 2.0, 0.5, dof / (dof + t2))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (spearman_correlation, n) = Pearson of average ranks.

    Rows are counted per (x, y) first; ranks come from the distinct values, and the
    correlation from weighted sums of centred ranks, so no join sees single rows."""
    pairs = (df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("x"), F.col(y).alias("y"))
             .agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True))
    n = pairs.agg(F.sum("c")).first()[0] or 0
    ranked = pairs
    for v in ("x", "y"):
        values = pairs.groupBy(v).agg(F.sum("c").alias("_cnt")).checkpoint(eager=True)
        pre = prefix_sums(values, v, {"_cnt": "_cnt"})
        centred = F.col("_cnt_before") + (F.col("_cnt") + 1) / 2.0 - F.lit((n + 1) / 2.0)
        ranked = ranked.join(pre.select(v, centred.alias(f"r{v}")), v)
    s = ranked.agg(F.sum(F.col("c") * F.col("rx") * F.col("ry")).alias("xy"), F.sum(F.col("c") * F.col("rx") * F.col("rx")).alias("xx"),
                   F.sum(F.col("c") * F.col("ry") * F.col("ry")).alias("yy"))
    return s.select(F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))).alias("spearman_correlation"),
                    F.lit(n).cast("bigint").alias("n"))


def quantile_edges(df: DataFrame, col: str, q: int = 4) -> list[float]:
    probs = [i / q for i in range(q + 1)]
    qs = exact_quantiles(df, [col], probs)[col]
    edges = [qs[p] for p in probs]
    if len(set(edges)) != len(edges):
        raise ValueError(f"bin edges must be unique: {edges}")
    return edges


def qcut(df: DataFrame, col: str, out: str = "quartile", labels: list[str] = QUARTILE_LABELS) -> DataFrame:
    """Right-closed quantile bins on exact interpolated edges, lowest edge included."""
    edges = quantile_edges(df, col, len(labels))
    x = F.col(col)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for i, lab in enumerate(labels):
        expr = expr.when(x <= F.lit(edges[i + 1]), F.lit(lab))
    return df.withColumn(out, expr.otherwise(F.lit(None).cast("string")))


def rate_by_bin(df: DataFrame, bin_col: str, flag: str, labels: list[str] = QUARTILE_LABELS) -> DataFrame:
    """Mean of ``flag`` and row count per bin, empty bins kept (rate NULL, count 0)."""
    spark = df.sparkSession
    names = spark.createDataFrame([(lab,) for lab in labels], f"{bin_col} string")
    per = df.groupBy(bin_col).agg(F.avg(F.col(flag).cast("double")).alias("misclassification_rate"),
                                  F.count(F.lit(1)).alias("n_samples"))
    return names.join(F.broadcast(per), bin_col, "left").select(
        bin_col, "misclassification_rate", F.coalesce("n_samples", F.lit(0)).cast("bigint").alias("n_samples"))


def trend_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """Least-squares line of y on x evaluated at ``points`` evenly spaced x."""
    fit = df.agg(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
                 F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
                 F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    i = F.col("i")
    xs = F.when(i == points - 1, F.col("_hi")).otherwise(
        F.col("_lo") + i.cast("double") * (F.col("_hi") - F.col("_lo")) / float(points - 1))
    return (fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
            .select(i.alias("i"), xs.alias("x"), "slope", "intercept")
            .withColumn("y", F.col("intercept") + F.col("slope") * F.col("x")))
