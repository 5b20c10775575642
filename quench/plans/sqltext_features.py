"""SQL text for the feature formulas (oracle side)."""

from __future__ import annotations

from itertools import combinations

from quench.functions.constants import (
    FEATURES, INDEX_FEATURES, INTERACTION_KEYS, RATIO_FEATURES, SQUARED_FEATURES, SUM_FEATURES,
)


def derived_sql() -> list[str]:
    out = [f"{a} / nullif({b} + 1e-5, 0) AS {n}" for n, a, b in RATIO_FEATURES]
    out += [f"({a} + {b}) / 2 AS {n}" for n, a, b in INDEX_FEATURES]
    out += [f"{a} * {a} AS {n}" for n, a in SQUARED_FEATURES]
    out += [f"{a} + {b} AS {n}" for n, a, b in SUM_FEATURES]
    return out


def interaction_sql() -> list[str]:
    return [f"{a} * {b} AS {a}_x_{b}" for a, b in combinations(INTERACTION_KEYS, 2)]


def median_cte(src: str, name: str = "med", cols=FEATURES) -> str:
    return f"{name} AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in cols) + f" FROM {src})"


def mean_cte(src: str, name: str = "mu", cols=FEATURES) -> str:
    return f"{name} AS (SELECT " + ", ".join(f"avg({c}) AS {c}" for c in cols) + f" FROM {src})"


def filled(src_alias: str, stat_alias: str, cols=FEATURES) -> str:
    return ", ".join(f"coalesce({src_alias}.{c}, {stat_alias}.{c}) AS {c}" for c in cols)


def imputed_cte(name: str = "imputed", src: str = "measurements", key: bool = True) -> str:
    """Median-imputed fixture (all nine features; coalesce is the identity on complete columns)."""
    k = "m.row_id, " if key else ""
    return (median_cte(src) + ",\n" + f"{name} AS (SELECT {k}{filled('m', 'med')}, m.Potability "
            f"FROM {src} AS m CROSS JOIN med)")
