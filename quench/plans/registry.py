"""Registered queries: each a Spark plan over the driver tables plus, where the
semantics are SQL-expressible, an independently written DuckDB oracle.

``QUERIES[name] = Query(spark_fn, sql, doubles)``; double columns listed in
``doubles`` are rounded to 6 places on both sides (summation order differs
between engines in the last bits).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.plans.sqltext import rounded

PLACES = 6


@dataclass
class Query:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)
    note: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.fn(spark, sf_dir)
        if not self.doubles:
            return df
        return df.select(*[F.round(F.col(c), PLACES).alias(c) if c in self.doubles else F.col(c) for c in df.columns])

    def oracle(self) -> str | None:
        return rounded(self.sql, self.doubles, PLACES) if self.sql else None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles: list[str] | None = None, note: str = ""):
    def deco(fn):
        QUERIES[name] = Query(fn, sql, list(doubles or []), note)
        return fn
    return deco

