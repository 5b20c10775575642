"""Scaling (F5-F7) and scaler persistence.

A fitted scaler is a tiny table ``(feature, center, scale)``: one aggregate
pass fits it, it is saved as parquet, and applying it is a projection with
the statistics as literals (no join against the data).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.functions.constants import LABEL, ROW_ID

SCALER_TYPES = ("standard", "minmax")


@dataclass
class ScalerModel:
    kind: str
    center: dict[str, float]
    scale: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[
            ((F.col(c) - F.lit(self.center[c])) / F.lit(self.scale[c])).alias(c) if c in self.center else F.col(c)
            for c in df.columns
        ])

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(self.kind, c, float(self.center[c]), float(self.scale[c])) for c in self.center]
        return spark.createDataFrame(rows, "kind string, feature string, center double, scale double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ScalerModel":
        rows = spark.read.parquet(path).collect()  # one row per feature
        kind = rows[0]["kind"] if rows else "standard"
        return ScalerModel(kind, {r["feature"]: r["center"] for r in rows}, {r["feature"]: r["scale"] for r in rows})


def fit_scaler(df: DataFrame, features: list[str], scaler_type: str = "standard") -> ScalerModel:
    """(x - mean) / population std (zero std -> 1); F6: (x - min) / (max - min)
    (zero range -> 1, so a constant column maps to 0). Unknown types raise."""
    if scaler_type not in SCALER_TYPES:
        raise ValueError(f"unknown scaler type {scaler_type!r}; expected one of {SCALER_TYPES}")
    if scaler_type == "standard":
        row = df.agg(*[F.avg(F.col(c)).alias(f"{c}__a") for c in features],
                     *[F.stddev_pop(F.col(c)).alias(f"{c}__b") for c in features]).first()
        center = {c: row[f"{c}__a"] for c in features}
        scale = {c: (row[f"{c}__b"] if row[f"{c}__b"] not in (None, 0.0) else 1.0) for c in features}
    else:
        row = df.agg(*[F.min(F.col(c)).alias(f"{c}__a") for c in features],
                     *[F.max(F.col(c)).alias(f"{c}__b") for c in features]).first()
        center = {c: row[f"{c}__a"] for c in features}
        scale = {}
        for c in features:
            lo, hi = row[f"{c}__a"], row[f"{c}__b"]
            scale[c] = (hi - lo) if lo is not None and hi != lo else 1.0
    center = {c: (v if v is not None else 0.0) for c, v in center.items()}
    return ScalerModel(scaler_type, center, scale)


def scale_features(df: DataFrame, scaler_type: str = "standard", fit: bool = True,
                   scaler_path: str | None = None, features: list[str] | None = None,
                   label: str = LABEL) -> tuple[DataFrame, ScalerModel]:
    """F5-F7 in the reference's shape: fit on ``df`` (or load from ``scaler_path``)."""
    features = features or [c for c in df.columns if c not in (label, ROW_ID) and not c.startswith("_")]
    if fit:
        model = fit_scaler(df, features, scaler_type)
        if scaler_path:
            model.save(df.sparkSession, scaler_path)
    else:
        if not scaler_path:
            raise ValueError("scaler_path is required when fit=False")
        model = ScalerModel.load(df.sparkSession, scaler_path)
    return model.transform(df), model
