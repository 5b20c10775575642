"""Oracle SQL building blocks (DuckDB dialect, ANSI where possible).

The oracle is written independently of the Spark code: the same fixture and
the same formulas, expressed in SQL over the pre-registered driver views.
"""

from __future__ import annotations

from quench.functions.constants import FEATURES

MEASUREMENTS_CTE = """measurements AS (
  SELECT
    md5(concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                  CAST(round(l_extendedprice * 100) AS BIGINT))) AS row_id,
    CASE WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN NULL ELSE l_quantity / 5 + 1 END AS ph,
    CAST(p_size AS DOUBLE) * 10.0 AS Hardness,
    l_extendedprice AS Solids,
    l_tax * 100 + 0.0 AS Chloramines,
    CASE WHEN (l_partkey + l_linenumber) % 5 = 0 THEN NULL ELSE o_totalprice / 1000 END AS Sulfate,
    p_retailprice AS Conductivity,
    l_discount * 100 + 0.0 AS Organic_carbon,
    CASE WHEN (l_partkey + l_suppkey + l_linenumber) % 20 = 0 THEN NULL ELSE s_acctbal / 100 END AS Trihalomethanes,
    CAST(l_linenumber AS DOUBLE) AS Turbidity,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS Potability,
    l_orderkey AS _okey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

FEATURE_LIST = ", ".join(FEATURES)


def uniform_sql(key_sql: str, offset: int = 1) -> str:
    """(52 bits of md5 + 0.5) / 2^52, as in quench.functions.hashing."""
    return (f"((CAST(('0x' || substr(md5({key_sql}), {offset}, 13)) AS BIGINT) + 0.5) "
            f"/ 4503599627370496.0)")


def bits_sql(key_sql: str) -> str:
    return f"CAST(('0x' || substr(md5({key_sql}), 1, 13)) AS BIGINT)"


def gauss_sql(key_sql: str) -> str:
    u1 = uniform_sql(key_sql, 1)
    u2 = uniform_sql(key_sql, 14)
    return f"(sqrt(-2.0 * ln({u1})) * cos(2.0 * pi() * {u2}))"


SCORED_CTE = (
    MEASUREMENTS_CTE
    + """,
scored AS (
  SELECT row_id, Potability AS label,
    round(0.6 * """ + uniform_sql("'7:' || row_id") + """ + 0.4 * Potability, 2) AS score,
    """ + uniform_sql("'7:' || row_id") + """ AS raw_score,
    CASE WHEN round(0.6 * """ + uniform_sql("'7:' || row_id") + """ + 0.4 * Potability, 2) >= 0.5
         THEN 1 ELSE 0 END AS prediction,
    CAST(CAST(('0x' || substr(md5('fold:' || row_id), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold
  FROM measurements
)"""
)


def with_ctes(body: str, scored: bool = False, extra: str = "") -> str:
    ctes = SCORED_CTE if scored else MEASUREMENTS_CTE
    if extra:
        ctes = ctes + ",\n" + extra
    return f"WITH {ctes}\n{body}"


def rounded(sql: str, doubles: list[str], places: int = 6) -> str:
    """Round the named double columns of a result (both sides do the same)."""
    if not doubles:
        return sql
    rep = ", ".join(f"round({c}, {places}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS _q"
