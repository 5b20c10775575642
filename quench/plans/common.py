"""Shared Spark-side building blocks for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.functions.constants import DERIVED_FEATURES, FEATURES, LABEL, ROW_ID
from quench.operators import clean
from quench.operators.features import create_derived_features
from quench.sources.fixtures import measurements_clean

ENGINEERED = FEATURES + DERIVED_FEATURES


def imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture after median imputation (the cleaned measurements)."""
    return clean.handle_missing_values(measurements_clean(spark, sf_dir), "median", features=FEATURES)


def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imputed fixture plus the eleven derived features (20 features)."""
    return create_derived_features(imputed(spark, sf_dir))


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-derived importance per engineered feature: |corr(feature, label)|,
    one aggregate pass for all 20 columns, then unpivot."""
    e = engineered(spark, sf_dir)
    wide = e.agg(*[F.abs(F.corr(F.col(c), F.col(LABEL).cast("double"))).alias(c) for c in ENGINEERED])
    return wide.unpivot([], ENGINEERED, "feature", "importance_gain")
