"""Feature projections (F1-F4, F11, F12): narrow ``select``s, all JVM-side."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quench.functions.constants import (
    INDEX_FEATURES, INTERACTION_KEYS, LABEL, RATIO_EPSILON, RATIO_FEATURES, ROW_ID,
    SQUARED_FEATURES, SUM_FEATURES,
)
from quench.functions.hashing import hash_gauss


def derived_exprs() -> list[Column]:
    """F1-F3 as column expressions. Ratios divide by (b + 1e-5) with
    ``try_divide``: a divisor of exactly zero gives NULL instead of an ANSI error."""
    out = []
    for name, a, b in RATIO_FEATURES:
        out.append(F.try_divide(F.col(a), F.col(b) + F.lit(RATIO_EPSILON)).alias(name))
    for name, a, b in INDEX_FEATURES:
        out.append(((F.col(a) + F.col(b)) / 2).alias(name))
    for name, a in SQUARED_FEATURES:
        out.append((F.col(a) * F.col(a)).alias(name))
    for name, a, b in SUM_FEATURES:
        out.append((F.col(a) + F.col(b)).alias(name))
    return out


def create_derived_features(df: DataFrame) -> DataFrame:
    """Append the eleven derived columns (label stays last if present)."""
    cols = [c for c in df.columns if c != LABEL]
    tail = [F.col(LABEL)] if LABEL in df.columns else []
    return df.select(*cols, *derived_exprs(), *tail)


def interaction_exprs(keys: list[str] = INTERACTION_KEYS) -> list[Column]:
    return [(F.col(a) * F.col(b)).alias(f"{a}_x_{b}") for a, b in combinations(keys, 2)]


def create_interaction_features(df: DataFrame, top_n: int = 5) -> DataFrame:
    """pairwise products of the five key features (``top_n`` accepted, unused,
    as in the reference)."""
    cols = [c for c in df.columns if c != LABEL]
    tail = [F.col(LABEL)] if LABEL in df.columns else []
    return df.select(*cols, *interaction_exprs(), *tail)


def add_gaussian_noise(df: DataFrame, features: list[str], level: float, stds: dict[str, float],
                       seed: int = 42, key: str = ROW_ID) -> DataFrame:
    """x + level * std(x) * z, z ~ N(0,1) drawn from md5(seed:feature:key).

    Repeatable for any partitioning (unlike ``F.randn``); ``stds`` are the
    sample deviations of the un-noised columns (one aggregate upstream)."""
    out = []
    for c in df.columns:
        if c in features and level != 0.0 and stds.get(c) is not None:
            z = hash_gauss(seed, F.lit(c), F.col(key))
            out.append((F.col(c) + F.lit(level * stds[c]) * z).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def sample_stds(df: DataFrame, features: list[str]) -> dict[str, float]:
    row = df.agg(*[F.stddev_samp(F.col(c)).alias(c) for c in features]).first()
    return {c: row[c] for c in features}


def feature_pipeline(df: DataFrame, features: list[str], create_derived: bool = True, create_interactions: bool = False,
                     scale: bool = True, scaler_type: str = "standard", fit_on: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """derive -> interact -> scale, with the step list and the feature lists. The scaler is fitted on
    ``fit_on`` taken through the same steps (by default on the input itself)."""
    from quench.operators.scale import fit_scaler

    meta: dict = {"initial_features": list(df.columns), "steps": []}
    names = list(features)
    for wanted, step, add in ((create_derived, "derived", create_derived_features), (create_interactions, "interactions", create_interaction_features)):
        if wanted:
            before = set(df.columns)
            df = add(df)
            names += [c for c in df.columns if c not in before]
            fit_on = None if fit_on is None else add(fit_on)
            meta["steps"].append(step)
    if scale:
        meta["scaler"] = fit_scaler(df if fit_on is None else fit_on, names, scaler_type)
        df = meta["scaler"].transform(df)
        meta["steps"].append("scaling")
    meta["final_features"] = list(df.columns)
    return df, meta
