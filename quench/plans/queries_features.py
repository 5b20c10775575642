"""Queries: feature projections, scaling, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from quench.functions.constants import DERIVED_FEATURES, FEATURES, LABEL, ROW_ID
from quench.operators import features as feat
from quench.operators.scale import fit_scaler, scale_features
from quench.operators.split import split_data, split_data_with_validation, train_test
from quench.plans.registry import register
from quench.plans.common import ENGINEERED, engineered, imputed
from quench.plans.sqltext import bits_sql, gauss_sql, with_ctes
from quench.plans.sqltext_features import derived_sql, imputed_cte, interaction_sql
from quench.session import scratch_path
from quench.sources.fixtures import measurements_clean

IMP = imputed_cte()
ENG_CTE = IMP + ",\neng AS (SELECT *, " + ", ".join(derived_sql()) + " FROM imputed)"
INTERACTIONS = [s.split(" AS ")[1] for s in interaction_sql()]


@register("f1_f3_derived_features", with_ctes(
    "SELECT row_id, " + ", ".join(ENGINEERED) + ", Potability FROM eng", extra=ENG_CTE), ENGINEERED)
def q_f1(spark, sf_dir):
    return engineered(spark, sf_dir)


@register("f4_interaction_features", with_ctes(
    "SELECT row_id, " + ", ".join(interaction_sql()) + " FROM imputed", extra=IMP), INTERACTIONS)
def q_f4(spark, sf_dir):
    df = feat.create_interaction_features(imputed(spark, sf_dir))
    return df.select(ROW_ID, *INTERACTIONS)


def _scaled_sql(src: str, cols: list[str], kind: str, stats_src: str | None = None) -> tuple[str, str]:
    stats_src = stats_src or src
    if kind == "standard":
        stats = ", ".join(f"avg({c}) AS {c}_c, coalesce(nullif(stddev_pop({c}), 0), 1) AS {c}_s" for c in cols)
    else:
        stats = ", ".join(f"min({c}) AS {c}_c, coalesce(nullif(max({c}) - min({c}), 0), 1) AS {c}_s" for c in cols)
    cte = f"st AS (SELECT {stats} FROM {stats_src})"
    body = ", ".join(f"({c} - {c}_c) / {c}_s AS {c}" for c in cols)
    return cte, body


_cte, _body = _scaled_sql("imputed", FEATURES, "standard")


@register("f5_standard_scale", with_ctes(
    f"SELECT row_id, {_body}, Potability FROM imputed CROSS JOIN st", extra=IMP + ",\n" + _cte), FEATURES)
def q_f5(spark, sf_dir):
    df = imputed(spark, sf_dir)
    return fit_scaler(df, FEATURES, "standard").transform(df)


_cte6, _body6 = _scaled_sql("imputed", FEATURES, "minmax")


@register("f6_minmax_scale", with_ctes(
    f"SELECT row_id, {_body6}, Potability FROM imputed CROSS JOIN st", extra=IMP + ",\n" + _cte6), FEATURES)
def q_f6(spark, sf_dir):
    df = imputed(spark, sf_dir)
    return fit_scaler(df, FEATURES, "minmax").transform(df)


def split_cte(src: str, name: str, seed: int, frac: float, stratify: bool = True, label: str = "Potability") -> str:
    part = f"PARTITION BY {label} " if stratify else ""
    return (
        f"{name}_r AS (SELECT *, row_number() OVER ({part}ORDER BY {bits_sql(repr(f'{seed}:') + ' || row_id')}, "
        f"row_id) AS _rk, count(*) OVER ({part.strip()}) AS _n FROM {src}),\n"
        f"{name} AS (SELECT * EXCLUDE (_rk, _n), CASE WHEN _rk <= round(_n * {frac}) THEN 'test' ELSE 'train' END "
        f"AS split FROM {name}_r)"
    )


SPLIT_CTE = IMP + ",\n" + split_cte("imputed", "sp", 42, 0.2)


@register("f7_apply_fitted_scaler", with_ctes(
    "SELECT row_id, " + ", ".join(f"({c} - {c}_c) / {c}_s AS {c}" for c in FEATURES)
    + ", Potability FROM sp CROSS JOIN st WHERE split = 'test'",
    extra=SPLIT_CTE + ",\n" + _scaled_sql("sp", FEATURES, "standard", "(SELECT * FROM sp WHERE split = 'train')")[0]),
    FEATURES)
def q_f7(spark, sf_dir):
    sp = split_data(imputed(spark, sf_dir), 0.2, 42, True)
    train, test = train_test(sp)
    path = scratch_path(spark, "scaler")
    scale_features(train, "standard", True, path, FEATURES)
    return scale_features(test, "standard", False, path, FEATURES)[0]


@register("f8_stratified_split", with_ctes("SELECT row_id, Potability, split FROM sp", extra=SPLIT_CTE))
def q_f8(spark, sf_dir):
    return split_data(imputed(spark, sf_dir), 0.2, 42, True).select(ROW_ID, LABEL, "split")


@register("f9_random_split", with_ctes(
    "SELECT row_id, Potability, split FROM sp9",
    extra=IMP + ",\n" + split_cte("imputed", "sp9", 42, 0.2, stratify=False)))
def q_f9(spark, sf_dir):
    return split_data(imputed(spark, sf_dir), 0.2, 42, False).select(ROW_ID, LABEL, "split")


@register("f10_three_way_split", with_ctes(
    "SELECT row_id, Potability, split FROM sp WHERE split = 'test' UNION ALL "
    "SELECT row_id, Potability, CASE WHEN split = 'test' THEN 'val' ELSE 'train' END AS split FROM sp2",
    extra=SPLIT_CTE + ",\nrest AS (SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'),\n"
    + split_cte("rest", "sp2", 43, 0.2)))
def q_f10(spark, sf_dir):
    return split_data_with_validation(imputed(spark, sf_dir), 0.2, 0.2, 42, True).select(ROW_ID, LABEL, "split")


_cte11, _body11 = _scaled_sql("eng", ENGINEERED, "standard")


@register("f11_feature_pipeline", with_ctes(
    f"SELECT row_id, {_body11}, Potability FROM eng CROSS JOIN st", extra=ENG_CTE + ",\n" + _cte11), ENGINEERED)
def q_f11(spark, sf_dir):
    df = engineered(spark, sf_dir)
    return fit_scaler(df, ENGINEERED, "standard").transform(df)


@register("f12_gaussian_noise", with_ctes(
    "SELECT row_id, " + ", ".join(
        f"{c} + (0.1 * {c}_sd) * {gauss_sql(repr('42:' + c + ':') + ' || row_id')} AS {c}" for c in FEATURES)
    + ", Potability FROM imputed CROSS JOIN sd",
    extra=IMP + ",\nsd AS (SELECT " + ", ".join(f"stddev_samp({c}) AS {c}_sd" for c in FEATURES)
    + " FROM imputed)"), FEATURES)
def q_f12(spark, sf_dir):
    df = imputed(spark, sf_dir)
    return feat.add_gaussian_noise(df, FEATURES, 0.1, feat.sample_stds(df, FEATURES), seed=42)


# ------------------------------------------------------------------ outliers over the engineered features
# (the raw fixture columns are uniform and have none; ratios have heavy tails)

_EIQR_CTE = ENG_CTE + ",\nq AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in ENGINEERED) + " FROM eng)"
_EIQR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, row_id, {c} AS value FROM eng CROSS JOIN q "
    f"WHERE {c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1)" for c in ENGINEERED)


@register("c8_outliers_iqr_engineered", with_ctes(_EIQR_SQL, extra=_EIQR_CTE), ["value"])
def q_c8e(spark, sf_dir):
    from quench.operators import clean

    return clean.detect_outliers(engineered(spark, sf_dir), ENGINEERED, "iqr", 1.5)


_EZ_CTE = ENG_CTE + ",\nz AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in ENGINEERED) + " FROM eng)"
_EZ_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, row_id, {c} AS value FROM eng CROSS JOIN z "
    f"WHERE {c}_s > 0 AND abs(({c} - {c}_m) / {c}_s) > 3.0" for c in ENGINEERED)


@register("c9_outliers_zscore_engineered", with_ctes(_EZ_SQL, extra=_EZ_CTE), ["value"])
def q_c9e(spark, sf_dir):
    from quench.operators import clean

    return clean.detect_outliers(engineered(spark, sf_dir), ENGINEERED, "zscore", 3.0)


# ------------------------------------------------------------------ composites: interactions, leakage-free fits, non-vacuous outlier counts

_ALL11 = ENGINEERED + INTERACTIONS
_cte11i, _body11i = _scaled_sql("engi", _ALL11, "standard")


@register("f11_feature_pipeline_interactions", with_ctes(
    f"SELECT row_id, {_body11i}, Potability, 'derived,interactions,scaling' AS steps, 30 AS n_features FROM engi CROSS JOIN st",
    extra=ENG_CTE + ",\nengi AS (SELECT *, " + ", ".join(interaction_sql()) + " FROM eng),\n" + _cte11i), _ALL11)
def q_f11i(spark, sf_dir):
    out, meta = feat.feature_pipeline(imputed(spark, sf_dir), FEATURES, create_interactions=True)
    return out.withColumn("steps", F.lit(",".join(meta["steps"]))).withColumn("n_features", F.lit(len(meta["final_features"]) - 2))


_TRAIN_CTE = split_cte("measurements", "spm", 42, 0.2)


@register("c3_impute_median_fit_on_train", with_ctes(
    "SELECT row_id, " + ", ".join(f"coalesce({c}, {c}_m) AS {c}" for c in FEATURES) + ", Potability, split FROM spm CROSS JOIN med",
    extra=_TRAIN_CTE + ",\nmed AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}_m" for c in FEATURES)
    + " FROM spm WHERE split = 'train')"), FEATURES)
def q_c3_train(spark, sf_dir):
    from quench.operators import clean

    sp = split_data(measurements_clean(spark, sf_dir), 0.2, 42, True)
    return clean.handle_missing_values(sp, "median", features=FEATURES, fit_on=sp.where(F.col("split") == "train"))


@register("c10_outlier_counts_engineered", with_ctes(
    "SELECT f.feature, CAST(coalesce(o.n, 0) AS BIGINT) AS n_outliers FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in ENGINEERED)
    + ") AS f LEFT JOIN (SELECT feature, count(*) AS n FROM o GROUP BY feature) AS o ON f.feature = o.feature"
    " UNION ALL SELECT 'TOTAL' AS feature, CAST(count(*) AS BIGINT) AS n_outliers FROM o",
    extra=_EIQR_CTE + ",\no AS (" + _EIQR_SQL + ")"))
def q_c10e(spark, sf_dir):
    from quench.operators import clean

    return clean.outlier_counts(clean.detect_outliers(engineered(spark, sf_dir), ENGINEERED, "iqr", 1.5), ENGINEERED)


@register("c11_clean_dataset_engineered", with_ctes(
    "SELECT (SELECT count(*) FROM eng) AS initial_rows, (SELECT count(*) FROM eng) AS final_rows, (SELECT count(*) FROM o) AS outliers_total",
    extra=_EIQR_CTE + ",\no AS (" + _EIQR_SQL + ")"))
def q_c11e(spark, sf_dir):
    from quench.operators import clean

    md = clean.clean_dataset(engineered(spark, sf_dir), "median", features=ENGINEERED).metadata
    return spark.createDataFrame([(md["initial_rows"], md["final_rows"], md["outliers_total"])],
                                 "initial_rows bigint, final_rows bigint, outliers_total bigint")
