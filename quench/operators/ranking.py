"""Sort, rank, top-k, lookup and string operators (R1-R9) and the standards
checks (R4 alignment, H4 exceedance).

Inputs here are small result tables (one row per feature or per model); the
standards dimension is a fixed 6-row table, so its broadcast is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quench.functions.constants import ALIGNMENT_HIGH_RANK, ALIGNMENT_MEDIUM_RANK, FEATURE_TAGS, STANDARDS

# Display colour per importance class (report lookup).
IMPORTANCE_COLOURS = {"high": "#e74c3c", "medium": "#f39c12", "low": "#95a5a6"}


def standards_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STANDARDS, "feature string, min_value double, max_value double, importance string")


def top_k(df: DataFrame, metric: str, k: int, tiebreak: str) -> DataFrame:
    """``orderBy(desc).limit(k)`` (a TakeOrdered: per-partition top-k, then merge)."""
    return df.orderBy(F.desc(metric), F.asc(tiebreak)).limit(k)


def with_rank(df: DataFrame, metric: str, tiebreak: str, out: str = "feature_rank") -> DataFrame:
    """1-based position in descending metric order. For result tables
    (one row per feature/model), so the global window is bounded."""
    w = Window.orderBy(F.desc(metric), F.asc(tiebreak))
    return df.withColumn(out, F.row_number().over(w))


def standards_alignment(ranked: DataFrame) -> DataFrame:
    """Keep standards whose feature exists; attach rank and importance;
    alignment high if rank <= 10, medium if <= 15, else low."""
    std = standards_df(ranked.sparkSession).select("feature", F.col("importance").alias("who_importance"))
    r = F.col("feature_rank")
    return ranked.join(F.broadcast(std), "feature").select(
        "feature", "who_importance", "feature_rank", "importance_gain",
        F.when(r <= ALIGNMENT_HIGH_RANK, "high").when(r <= ALIGNMENT_MEDIUM_RANK, "medium").otherwise("low")
        .alias("alignment"),
    )


def title_case(col: str):
    """R7: '_' -> ' ' then title case."""
    return F.initcap(F.translate(F.col(col), "_", " "))


def has_tag(col: str):
    """Case-sensitive containment of any tag."""
    cond = F.lit(False)
    for t in FEATURE_TAGS:
        cond = cond | F.col(col).contains(t)
    return cond


def importance_colour(col: str):
    """Value map via a map literal."""
    m = F.create_map(*[x for k, v in IMPORTANCE_COLOURS.items() for x in (F.lit(k), F.lit(v))])
    return m[F.col(col)]


def standards_exceedance(df: DataFrame) -> DataFrame:
    """H4: per standard feature, rows measured, below min, above max, share exceeding.

    One aggregate pass with conditional counts per (feature, limit) pair --
    the range join against the 6-row standards table is folded into literal
    predicates, so nothing is shuffled but one row per task."""
    aggs = []
    present = [s for s in STANDARDS if s[0] in df.columns]
    for feat, lo, hi, _ in present:
        x = F.col(feat)
        aggs += [
            F.count(x).alias(f"{feat}__n"),
            (F.count_if(x < F.lit(lo)) if lo is not None else F.lit(0).cast("bigint")).alias(f"{feat}__lo"),
            (F.count_if(x > F.lit(hi)) if hi is not None else F.lit(0).cast("bigint")).alias(f"{feat}__hi"),
        ]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(feat).alias("feature"), F.lit(lo).cast("double").alias("min_value"),
                 F.lit(hi).cast("double").alias("max_value"), F.lit(imp).alias("importance"),
                 F.col(f"{feat}__n").alias("n_measured"), F.col(f"{feat}__lo").alias("n_below"),
                 F.col(f"{feat}__hi").alias("n_above"))
        for feat, lo, hi, imp in present
    ])
    out = wide.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn(
        "exceed_pct",
        F.try_divide((F.col("n_below") + F.col("n_above")) * 100.0, F.col("n_measured").cast("double")))
