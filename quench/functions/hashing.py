"""Deterministic per-row randomness from content hashes.

``F.rand`` / ``F.randn`` depend on partitioning, so repeated runs on a
different cluster layout would pick different rows. Every random draw here is
a pure function of (seed, salt, key), computed JVM-side with ``md5``:

    bits(x)    = first 13 hex digits of md5(x) as an integer in [0, 2^52)
    uniform(x) = (bits(x) + 0.5) / 2^52           -- never 0, never 1
    gauss(x)   = Box-Muller on two independent 52-bit slices of md5(x)

The same formulas are expressible in DuckDB, which the oracle relies on.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_52 = float(2**52)


def _key(seed, *parts) -> Column:
    cols = [F.lit(str(seed))] + [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *cols)


def hash_bits(seed, *parts, offset: int = 1) -> Column:
    """52 uniformly distributed bits of md5(seed:parts...) as a bigint."""
    return F.conv(F.substring(F.md5(_key(seed, *parts)), offset, 13), 16, 10).cast("bigint")


def hash_uniform(seed, *parts, offset: int = 1) -> Column:
    return (hash_bits(seed, *parts, offset=offset).cast("double") + F.lit(0.5)) / F.lit(TWO_52)


def hash_gauss(seed, *parts) -> Column:
    """Standard normal draw by Box-Muller over two slices of one md5."""
    u1 = hash_uniform(seed, *parts, offset=1)
    u2 = hash_uniform(seed, *parts, offset=14)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)

