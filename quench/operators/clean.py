"""Cleaning: dedupe, missing-value strategies, outliers, composite.

Statistics (median / mean / bounds) are computed in one aggregate pass and
enter the row-wise plan as literals, so applying them is a narrow projection
inside whole-stage codegen: no join, no broadcast, no second shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, ROW_ID
from quench.operators.quantiles import exact_quantiles_with_counts

STRATEGIES = ("median", "mean", "knn", "drop")


def feature_columns(df: DataFrame, label: str = LABEL, exclude=(ROW_ID,)) -> list[str]:
    return [c for c in df.columns if c != label and c not in exclude and not c.startswith("_")]


def remove_duplicates(df: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """Full-row dedupe over data columns (NULLs compare equal); ``row_id`` is
    not part of the identity, and the least one of equal rows stays, whatever the
    partitioning. One shuffle on the row hash with map-side aggregation."""
    cols = key_cols or [c for c in df.columns if c != ROW_ID]
    rest = [c for c in df.columns if c not in cols]
    if not rest:
        return df.dropDuplicates(cols)
    first = [ROW_ID] * (ROW_ID in rest) + [c for c in rest if c != ROW_ID]
    kept = df.groupBy(*cols).agg(F.min(F.struct(*first)).alias("_kept"))
    return kept.select(*[F.col(f"_kept.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def missing_feature_columns(df: DataFrame, features: list[str]) -> list[str]:
    """Features with at least one NULL (one aggregate, one row collected)."""
    row = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in features]).first()
    return [c for c in features if row[c] == 1]


def column_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    counts = {c: int(row[c]) for c in cols}
    q = exact_quantiles_with_counts(df, cols, [0.5], counts)
    return {c: q[c][0.5] for c in cols}


def column_means(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    row = df.agg(*[F.avg(F.col(c)).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fill_with(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Replace NULLs by per-column constants (narrow projection)."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(values[c]).cast("double")).alias(c) if c in values and values[c] is not None
        else F.col(c)
        for c in df.columns
    ])


def handle_missing_values(df: DataFrame, strategy: str = "median", n_neighbors: int = 5,
                          features: list[str] | None = None, label: str = LABEL, fit_on: DataFrame | None = None) -> DataFrame:
    """C2-C7. ``fit_on``: the rows whose medians or means are used (a training part, so that nothing of
    the held-out part leaks); by default the input itself. Input returned unchanged when no feature has a NULL (even for
    ``drop``, as in the reference); an unknown strategy raises."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown missing-value strategy {strategy!r}; expected one of {STRATEGIES}")
    features = features or feature_columns(df, label)
    missing = missing_feature_columns(df, features)
    if not missing:
        return df
    if strategy == "median":
        return fill_with(df, column_medians(df if fit_on is None else fit_on, missing))
    if strategy == "mean":
        return fill_with(df, column_means(df if fit_on is None else fit_on, missing))
    if strategy == "drop":
        return df.na.drop("any", subset=features + [label])
    from quench.operators.knn import knn_impute

    return knn_impute(df, features, k=n_neighbors)


# ---------------------------------------------------------------- outliers

def outlier_bounds(df: DataFrame, features: list[str], method: str = "iqr",
                   threshold: float = 1.5) -> dict[str, tuple[float | None, float | None]]:
    """(lower, upper) per feature; a value is an outlier strictly outside."""
    if method == "iqr":
        row = df.agg(*[F.count(F.col(c)).alias(c) for c in features]).first()
        counts = {c: int(row[c]) for c in features}
        q = exact_quantiles_with_counts(df, features, [0.25, 0.75], counts)
        out = {}
        for c in features:
            q1, q3 = q[c][0.25], q[c][0.75]
            if q1 is None:
                out[c] = (None, None)
            else:
                iqr = q3 - q1
                out[c] = (q1 - threshold * iqr, q3 + threshold * iqr)
        return out
    if method == "zscore":
        row = df.agg(*[F.avg(F.col(c)).alias(f"{c}__m") for c in features],
                     *[F.stddev_samp(F.col(c)).alias(f"{c}__s") for c in features]).first()
        out = {}
        for c in features:
            m, s = row[f"{c}__m"], row[f"{c}__s"]
            if m is None or s is None or s == 0 or s != s:
                out[c] = (None, None)  # constant or too short: nothing is flagged
            else:
                out[c] = (m - threshold * s, m + threshold * s)
        return out
    raise ValueError(f"unknown outlier method {method!r}")


def detect_outliers(df: DataFrame, features: list[str] | None = None, method: str = "iqr",
                    threshold: float = 1.5, key: str = ROW_ID) -> DataFrame:
    """Long table (feature, row key, value) of flagged values; rows are kept
    in the data. NULL is never an outlier."""
    features = features or feature_columns(df)
    if method == "zscore":
        # |x - mean| / std > t, computed as the ratio
        row = df.agg(*[F.avg(F.col(c)).alias(f"{c}__m") for c in features],
                     *[F.stddev_samp(F.col(c)).alias(f"{c}__s") for c in features]).first()
    else:
        bounds = outlier_bounds(df, features, method, threshold)
    flags = []
    for c in features:
        x = F.col(c)
        if method == "zscore":
            m, s = row[f"{c}__m"], row[f"{c}__s"]
            flag = F.lit(False) if m is None or not s or s != s else F.abs((x - F.lit(m)) / F.lit(s)) > F.lit(threshold)
        else:
            lo, hi = bounds[c]
            flag = F.lit(False) if lo is None else (x < F.lit(lo)) | (x > F.lit(hi))
        flags.append(F.when(flag, F.struct(F.lit(c).alias("feature"), x.cast("double").alias("value"))))
    keys = [key] if key in df.columns else []
    return (
        df.select(*keys, F.explode(F.array_compact(F.array(*flags))).alias("o"))
        .select("o.feature", *keys, "o.value")
    )


def outlier_counts(outliers: DataFrame, features: list[str]) -> DataFrame:
    """Per-feature count (zero kept) plus a grand total row named TOTAL."""
    spark = outliers.sparkSession
    per = outliers.groupBy("feature").agg(F.count(F.lit(1)).alias("n_outliers"))
    names = spark.createDataFrame([(f,) for f in features], "feature string")
    full = names.join(F.broadcast(per), "feature", "left").select(
        "feature", F.coalesce("n_outliers", F.lit(0)).cast("bigint").alias("n_outliers"))
    total = full.agg(F.sum("n_outliers").cast("bigint").alias("n_outliers")).select(
        F.lit("TOTAL").alias("feature"), "n_outliers")
    return full.unionByName(total)


@dataclass
class CleanResult:
    data: DataFrame
    metadata: dict = field(default_factory=dict)
    outliers: DataFrame | None = None


def clean_dataset(df: DataFrame, missing_strategy: str = "median", n_neighbors: int = 5,
                  remove_dup: bool = True, detect_outlier: bool = True,
                  features: list[str] | None = None, label: str = LABEL) -> CleanResult:
    """C11: dedupe -> impute -> flag outliers. The cleaned frame is checkpointed
    (lineage cut in the shared checkpoint folder) because every later stage and
    the metadata counts reuse it."""
    features = features or feature_columns(df, label)
    initial_rows = df.count()
    out = remove_duplicates(df) if remove_dup else df
    out = handle_missing_values(out, missing_strategy, n_neighbors, features, label)
    out = out.checkpoint(eager=True)
    meta = {
        "initial_rows": initial_rows,
        "initial_cols": len(df.columns),
        "missing_strategy": missing_strategy,
    }
    outliers = None
    if detect_outlier:
        outliers = detect_outliers(out, features, "iqr", 1.5)
        meta["outliers_total"] = outliers.count()
    meta["final_rows"] = out.count()
    meta["final_cols"] = len(out.columns)
    return CleanResult(out, meta, outliers)
