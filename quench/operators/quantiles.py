"""Exact quantiles (linear interpolation, as pandas/NumPy and DuckDB
``quantile_cont``) without funnelling a column through one task.

Spark's exact ``percentile``/``median`` merge a value->count map of every
distinct value into a single task per group; at 100 TB that is the whole
column. Here, for each wanted rank ``r`` (0-based, ascending, NULLs skipped):

1. n = count(col) per column (one aggregate pass over all columns).
2. While a bracket of rows around a rank is large, one pass builds a KLL sketch of
   each bracket (a few tens of KB a map task; all ranks of a column share the first)
   and takes values a <= v_r <= b from it, ``SLACK`` in rank to either side; one
   aggregate of ``count_if`` verifies below(a) <= r < upto(b) and keeps the old
   bound on a side where it does not hold. A pass shrinks a bracket about
   ``1 / (2 SLACK)`` times, unless copies of one value fill it, and those collapse below.
3. One scan tags each row with the brackets its value falls in, rows are
   grouped by (bracket, value) -- duplicates collapse, so a value held by a
   third of all rows is one row -- and a window per bracket (about
   ``max_bracket`` distinct values) yields the cumulative counts that
   locate rank r exactly.

The same path runs at every size.

Only a few numbers per (column, probability) reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Size parameter of the sketches (their rank error is about 0.13 %) and the rank taken beyond a wanted one.
ACCURACY = 4_000
SLACK = 0.004
MAX_BRACKET = 100_000


@dataclass
class _Bracket:
    col: str
    lo: float | None  # inclusive lower value bound, None = -inf
    hi: float | None  # inclusive upper value bound, None = +inf
    below: int  # rows of col strictly below lo
    size: int  # rows with lo <= value <= hi
    ranks: list[int] = field(default_factory=list)


def _in_bracket(c, b: _Bracket):
    cond = c.isNotNull()
    if b.lo is not None:
        cond = cond & (c >= F.lit(b.lo))
    if b.hi is not None:
        cond = cond & (c <= F.lit(b.hi))
    return cond


def _narrow(df: DataFrame, brackets: list[_Bracket], accuracy: int, max_bracket: int) -> list[_Bracket]:
    """Split big brackets into one for each pair of ranks and shrink each by approximate quantiles."""
    out: list[_Bracket] = []
    work: list[_Bracket] = []
    for b in brackets:
        if b.size <= max_bracket:
            out.append(b)
        else:
            for r in b.ranks:  # the two ranks of an interpolation stay together
                if work and work[-1].col == b.col and work[-1].ranks[-1] == r - 1:
                    work[-1].ranks.append(r)
                else:
                    work.append(_Bracket(b.col, b.lo, b.hi, b.below, b.size, [r]))
    while work:
        # one pass for all big brackets: a sketch a bracket (ranks in the same bracket share it) proposes bounds for every rank
        aggs = []
        for i, b in enumerate(work):
            c = F.col(b.col).cast("double")
            sketch = F.kll_sketch_agg_double(F.when(_in_bracket(c, b), c), F.lit(accuracy))
            for side, r, slack in (("lo", b.ranks[0], -SLACK), ("hi", b.ranks[-1], SLACK)):
                share = min(1.0, max(0.0, (r - b.below) / max(b.size - 1, 1) + slack))
                aggs.append(F.kll_sketch_get_quantile_double(sketch, F.lit(share)).alias(f"{side}{i}"))
        row = df.agg(*aggs).first()
        cand = [(b, row[f"lo{i}"], row[f"hi{i}"]) for i, b in enumerate(work)]
        # verify the candidate bounds exactly
        checks = []
        for i, (b, a_val, b_val) in enumerate(cand):
            c = F.col(b.col)
            checks.append(F.count_if(c < F.lit(a_val)).alias(f"lt{i}"))
            checks.append(F.count_if(c <= F.lit(b_val)).alias(f"le{i}"))
        crow = df.agg(*checks).first()
        nxt = []
        for i, (b, a_val, b_val) in enumerate(cand):
            lt, le = crow[f"lt{i}"], crow[f"le{i}"]
            lo, below = (a_val, lt) if lt <= b.ranks[0] else (b.lo, b.below)
            hi, upto = (b_val, le) if le > b.ranks[-1] else (b.hi, b.below + b.size)
            nb = _Bracket(b.col, lo, hi, below, upto - below, b.ranks)
            if nb.size <= max_bracket or nb.size >= b.size:
                out.append(nb)
            else:
                nxt.append(nb)
        work = nxt
    return out


def exact_ranks(df: DataFrame, wanted: dict[str, list[int]], counts: dict[str, int],
                accuracy: int = ACCURACY, max_bracket: int = MAX_BRACKET) -> dict[tuple[str, int], float]:
    """Value at each wanted 0-based rank per column."""
    brackets = [
        _Bracket(c, None, None, 0, counts[c], sorted(set(rs))) for c, rs in wanted.items() if rs and counts[c] > 0
    ]
    if not brackets:
        return {}
    brackets = _narrow(df, brackets, accuracy, max_bracket)
    # tag rows with every bracket they fall in; one scan for all columns
    tags = []
    for i, b in enumerate(brackets):
        c = F.col(b.col)
        tags.append(F.when(_in_bracket(c, b), F.struct(F.lit(i).alias("bid"), c.cast("double").alias("v"))))
    tagged = df.select(F.explode(F.array_compact(F.array(*tags))).alias("t")).select("t.bid", "t.v")
    grouped = tagged.groupBy("bid", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("bid").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = grouped.withColumn("upto", F.sum("n").over(w)).withColumn("before", F.col("upto") - F.col("n"))
    conds = []
    for i, b in enumerate(brackets):
        for r in b.ranks:
            rr = r - b.below
            conds.append((F.col("bid") == i) & (F.col("before") <= rr) & (F.col("upto") > rr))
    hit = F.lit(False)
    for cnd in conds:
        hit = hit | cnd
    rows = cum.where(hit).select("bid", "v", "before", "upto").collect()
    out: dict[tuple[str, int], float] = {}
    for row in rows:
        b = brackets[row["bid"]]
        for r in b.ranks:
            if row["before"] <= r - b.below < row["upto"]:
                out[(b.col, r)] = row["v"]
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    accuracy: int = ACCURACY, max_bracket: int = MAX_BRACKET) -> dict[str, dict[float, float | None]]:
    """{col: {p: quantile}} with linear interpolation; None for an all-NULL column."""
    counts_row = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    counts = {c: int(counts_row[c]) for c in cols}
    return exact_quantiles_with_counts(df, cols, probs, counts, accuracy, max_bracket)


def exact_quantiles_with_counts(df, cols, probs, counts, accuracy=ACCURACY, max_bracket=MAX_BRACKET):
    wanted: dict[str, list[int]] = {}
    for c in cols:
        n = counts[c]
        rs = []
        for p in probs:
            if n > 0:
                pos = p * (n - 1)
                rs += [math.floor(pos), math.ceil(pos)]
        wanted[c] = rs
    vals = exact_ranks(df, wanted, counts, accuracy, max_bracket)
    result: dict[str, dict[float, float | None]] = {}
    for c in cols:
        n = counts[c]
        result[c] = {}
        for p in probs:
            if n == 0:
                result[c][p] = None
                continue
            pos = p * (n - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            vlo, vhi = vals[(c, lo)], vals[(c, hi)]
            frac = pos - lo
            # NumPy's 'linear' form: lo + (hi - lo) * frac
            result[c][p] = vlo if hi == lo else vlo + (vhi - vlo) * frac
    return result
