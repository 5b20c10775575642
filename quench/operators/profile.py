"""Profiling: shape, missing values, label distribution, describe.

Every profile is one aggregate pass over all columns (partial aggregation on
the map side, a single small row shuffled), then reshaped with ``unpivot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, LABEL_NAMES
from quench.operators.quantiles import exact_quantiles_with_counts


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_cols"))


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long form (column, missing) for every column, one pass."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "missing")


def missing_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Columns with missing values, count and percentage of rows."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_n"], cols, "column", "missing")
    return long.where(F.col("missing") > 0).select(
        "column", "missing", F.round(F.col("missing") * 100.0 / F.col("_n"), 4).alias("missing_pct")
    )


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Count per label value, NULL excluded, with display names."""
    name = F.when(F.col(label) == 1, F.lit(LABEL_NAMES[1])).when(F.col(label) == 0, F.lit(LABEL_NAMES[0]))
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col(label).alias("label"), name.alias("label_name"), "n")
        .orderBy(F.desc("n"), "label")
    )


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5: count, mean, sample std, min, 25/50/75 % (exact, linear), max per column."""
    stats = []
    for c in cols:
        x = F.col(c)
        stats += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                  F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    row = df.agg(*stats).first()
    counts = {c: int(row[f"{c}__count"]) for c in cols}
    q = exact_quantiles_with_counts(df, cols, [0.25, 0.5, 0.75], counts)
    spark = df.sparkSession
    data = [
        (c, counts[c], row[f"{c}__mean"], row[f"{c}__std"], row[f"{c}__min"],
         q[c][0.25], q[c][0.5], q[c][0.75], row[f"{c}__max"])
        for c in cols
    ]
    schema = ("column string, count bigint, mean double, std double, min double, "
              "p25 double, p50 double, p75 double, max double")
    # the result is one row per column: a few numbers, not data
    return spark.createDataFrame(data, schema)
