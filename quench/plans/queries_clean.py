"""Queries: fixture scan, profiling (P1-P5), cleaning (C1-C4, C6, C8-C11),
and the flagship median-impute -> derive -> per-label means."""

from __future__ import annotations

from pyspark.sql import functions as F

from quench.functions.constants import DERIVED_FEATURES, FEATURES, LABEL, ROW_ID
from quench.operators import clean, profile
from quench.operators.features import create_derived_features
from quench.plans.registry import register
from quench.plans.sqltext import FEATURE_LIST, with_ctes
from quench.plans.sqltext_features import derived_sql, filled, imputed_cte, mean_cte, median_cte
from quench.sources.fixtures import measurements_clean, measurements_with_duplicates

ALL_COLS = FEATURES + [LABEL]

# ------------------------------------------------------------------ flagship

_FLAG_DOUBLES = [f"avg_{c}" for c in DERIVED_FEATURES]


def flagship(spark, sf_dir):
    m = measurements_clean(spark, sf_dir)
    d = clean.remove_duplicates(m)
    imp = clean.handle_missing_values(d, "median", features=FEATURES)
    der = create_derived_features(imp)
    return der.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"avg_{c}") for c in DERIVED_FEATURES]
    )


register(
    "flagship_label_profile",
    with_ctes(
        "SELECT Potability, count(*) AS n, "
        + ", ".join(f"avg({c}) AS avg_{c}" for c in DERIVED_FEATURES)
        + " FROM der GROUP BY Potability",
        extra=(
            f"dedup AS (SELECT DISTINCT {FEATURE_LIST}, Potability FROM measurements),\n"
            + imputed_cte("imp", "dedup", key=False)
            + ",\nder AS (SELECT Potability, " + ", ".join(derived_sql()) + " FROM imp)"
        ),
    ),
    _FLAG_DOUBLES,
)(flagship)


# ------------------------------------------------------------------ S2 scan of the fixture

@register("s2_measurements_scan",
          with_ctes(f"SELECT row_id, {FEATURE_LIST}, Potability FROM measurements"),
          FEATURES)
def q_scan(spark, sf_dir):
    return measurements_clean(spark, sf_dir)


# ------------------------------------------------------------------ profiling

@register("p1_shape", with_ctes("SELECT count(*) AS n_rows, 11 AS n_cols FROM measurements"))
def q_p1(spark, sf_dir):
    return profile.shape(measurements_clean(spark, sf_dir))


_P2_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM measurements" for c in [ROW_ID] + ALL_COLS
)


@register("p2_missing_counts", with_ctes(_P2_SQL))
def q_p2(spark, sf_dir):
    return profile.missing_counts(measurements_clean(spark, sf_dir)).withColumnRenamed("column", "column_name")


@register("p3_missing_summary", with_ctes(
    "SELECT column_name, missing, round(missing * 100.0 / n, 4) AS missing_pct FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS n FROM measurements"
        for c in [ROW_ID] + ALL_COLS)
    + ") AS t WHERE missing > 0"), ["missing_pct"])
def q_p3(spark, sf_dir):
    return profile.missing_summary(measurements_clean(spark, sf_dir)).withColumnRenamed("column", "column_name")


@register("p4_label_distribution", with_ctes(
    "SELECT Potability AS label, CASE WHEN Potability = 1 THEN 'Potable' WHEN Potability = 0 THEN 'Not Potable' END"
    " AS label_name, count(*) AS n FROM measurements WHERE Potability IS NOT NULL GROUP BY Potability"))
def q_p4(spark, sf_dir):
    return profile.label_distribution(measurements_clean(spark, sf_dir))


_DESCRIBE_DOUBLES = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@register("p5_describe", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
    f"quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM measurements" for c in FEATURES)),
    _DESCRIBE_DOUBLES)
def q_p5(spark, sf_dir):
    return profile.describe(measurements_clean(spark, sf_dir), FEATURES).withColumnRenamed("column", "column_name")


# ------------------------------------------------------------------ cleaning

_DUP_SQL_CTE = (f"dups AS (SELECT {FEATURE_LIST}, Potability FROM measurements UNION ALL "
                f"SELECT {FEATURE_LIST}, Potability FROM measurements WHERE _okey % 50 = 0)")


@register("c1_remove_duplicates",
          with_ctes(f"SELECT DISTINCT {FEATURE_LIST}, Potability FROM dups", extra=_DUP_SQL_CTE), FEATURES)
def q_c1(spark, sf_dir):
    return clean.remove_duplicates(measurements_with_duplicates(spark, sf_dir))


@register("c2_missing_feature_columns", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS feature FROM measurements HAVING count(*) > count({c})" for c in FEATURES)))
def q_c2(spark, sf_dir):
    m = measurements_clean(spark, sf_dir)
    # the decision is a one-row aggregate; the listing is that row unpivoted
    wide = m.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in FEATURES])
    return wide.unpivot([], FEATURES, "feature", "has_missing").where("has_missing = 1").select("feature")


@register("c3_impute_median", with_ctes(
    "SELECT * FROM imputed", extra=imputed_cte()), FEATURES)
def q_c3(spark, sf_dir):
    return clean.handle_missing_values(measurements_clean(spark, sf_dir), "median", features=FEATURES)


@register("c4_impute_mean", with_ctes(
    f"SELECT m.row_id, {filled('m', 'mu')}, m.Potability FROM measurements AS m CROSS JOIN mu",
    extra=mean_cte("measurements")), FEATURES)
def q_c4(spark, sf_dir):
    return clean.handle_missing_values(measurements_clean(spark, sf_dir), "mean", features=FEATURES)


@register("c6_drop_missing", with_ctes(
    f"SELECT row_id, {FEATURE_LIST}, Potability FROM measurements WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in ALL_COLS)), FEATURES)
def q_c6(spark, sf_dir):
    return clean.handle_missing_values(measurements_clean(spark, sf_dir), "drop", features=FEATURES)


_IQR_CTE = ("q AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in FEATURES)
    + " FROM measurements)")
_IQR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, row_id, {c} AS value FROM measurements CROSS JOIN q "
    f"WHERE {c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1)" for c in FEATURES)


@register("c8_outliers_iqr", with_ctes(_IQR_SQL, extra=_IQR_CTE), ["value"])
def q_c8(spark, sf_dir):
    return clean.detect_outliers(measurements_clean(spark, sf_dir), FEATURES, "iqr", 1.5)


_Z_CTE = ("z AS (SELECT " + ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in FEATURES)
          + " FROM measurements)")
_Z_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, row_id, {c} AS value FROM measurements CROSS JOIN z "
    f"WHERE {c}_s > 0 AND abs(({c} - {c}_m) / {c}_s) > 3.0" for c in FEATURES)


@register("c9_outliers_zscore", with_ctes(_Z_SQL, extra=_Z_CTE), ["value"])
def q_c9(spark, sf_dir):
    return clean.detect_outliers(measurements_clean(spark, sf_dir), FEATURES, "zscore", 3.0)


@register("c10_outlier_counts", with_ctes(
    "SELECT f.feature, CAST(coalesce(o.n, 0) AS BIGINT) AS n_outliers FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in FEATURES)
    + ") AS f LEFT JOIN (SELECT feature, count(*) AS n FROM o GROUP BY feature) AS o ON f.feature = o.feature"
    " UNION ALL SELECT 'TOTAL' AS feature, CAST(count(*) AS BIGINT) AS n_outliers FROM o",
    extra=_IQR_CTE + ",\no AS (" + _IQR_SQL + ")"))
def q_c10(spark, sf_dir):
    m = measurements_clean(spark, sf_dir)
    return clean.outlier_counts(clean.detect_outliers(m, FEATURES, "iqr", 1.5), FEATURES)


_C11_EXTRA = (
    _DUP_SQL_CTE + ",\n"
    + f"dd AS (SELECT DISTINCT {FEATURE_LIST}, Potability FROM dups),\n"
    + imputed_cte("imp", "dd", key=False) + ",\n"
    + "q AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in FEATURES)
    + " FROM imp),\n"
    + "o AS (" + " UNION ALL ".join(
        f"SELECT 1 AS x FROM imp CROSS JOIN q WHERE {c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) "
        f"OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1)" for c in FEATURES) + ")"
)


@register("c11_clean_dataset", with_ctes(
    "SELECT (SELECT count(*) FROM dups) AS initial_rows, 10 AS initial_cols, "
    "(SELECT count(*) FROM imp) AS final_rows, 10 AS final_cols, 'median' AS missing_strategy, "
    "(SELECT count(*) FROM o) AS outliers_total", extra=_C11_EXTRA))
def q_c11(spark, sf_dir):
    res = clean.clean_dataset(measurements_with_duplicates(spark, sf_dir), "median", features=FEATURES)
    md = res.metadata
    return spark.createDataFrame(
        [(md["initial_rows"], md["initial_cols"], md["final_rows"], md["final_cols"], md["missing_strategy"],
          md["outliers_total"])],
        "initial_rows bigint, initial_cols int, final_rows bigint, final_cols int, missing_strategy string, "
        "outliers_total bigint")
