"""Exact de-duplication by progressive refinement, in DataFrame operations only.

1. Rows are grouped by the length of their normalised text; a length held by one
   row is settled.
2. Survivors are grouped by (length, hash of the first ``prefix_chars``
   characters); a pair held by one row is settled.
3. Only rows of surviving pairs get the SHA-256 of the whole text, and equal
   digests form the groups.

Steps 1 and 2 move a length and a 64-bit hash a row, pre-aggregated before the
shuffle, so a group that holds a third of all rows arrives as one row a task. The
keys of surviving groups are broadcast only when counted to be few; otherwise they
are joined by shuffle. The table of decisions is joined back with an equi-join
that AQE can split when one group is hot.

Cases: null text counts as empty; empty texts are equal to one another; of rows
that repeat a doc_id the first written stays; a null doc_id stays only if its whole
group has none; an empty table gives an empty result; other columns are carried in
one struct and never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quench.llm.common import col, materialise, text_of, whole_row

#: Surviving (length, prefix) keys that may be broadcast: 16 bytes each.
BROADCAST_KEYS = 1_000_000


def normalised(text_col: str) -> Column:
    r"""The text with each ``[\x20\x09-\x0D]+`` replaced by one space."""
    return F.regexp_replace(text_of(text_col), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 256,
                 carry: bool = False, digest: bool = False) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept`` plus ``row`` (the input row, with
    ``carry``) and ``sha256`` (of the normalised text, for every row, with ``digest``)."""
    text = docs.select(col(id_col).alias("id"), normalised(text_col).alias("norm"),
                       *([whole_row(docs).alias("row")] if carry else []))
    keyed = text.withColumn("len", F.length("norm")).withColumn("prefix", F.xxhash64(F.substring("norm", 1, prefix_chars)))

    # Counted per (length, prefix) first, so that copies reach the grouping by length as one row.
    pairs = materialise(keyed.groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n")), "dedup-pairs")
    lengths = pairs.groupBy("len").agg(F.sum("n").alias("rows")).filter("rows > 1").select("len")
    survivors = materialise(pairs.join(lengths, "len", "left_semi").filter("n > 1").select("len", "prefix", F.lit(True).alias("open")),
                            "dedup-open")
    if survivors.count() <= BROADCAST_KEYS:
        survivors = F.broadcast(survivors)

    whole = F.sha2(F.col("norm"), 256)
    rows = materialise(
        keyed.join(survivors, ["len", "prefix"], "left")
        .select("id", "len", "prefix", F.when(F.col("open"), whole).alias("full"), F.monotonically_increasing_id().alias("rid"),
                *(["row"] if carry else []), *([whole.alias("sha256")] if digest else [])), "dedup-rows")

    extra = [c for c in ("row", "sha256") if c in rows.columns]
    key = ["len", "prefix", "full"]
    groups = (rows.filter("full IS NOT NULL").groupBy(*key)
              .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")).alias("first"), F.count(F.lit(1)).alias("group_size")))
    copies = (rows.filter("full IS NOT NULL").join(groups, key)
              .select("id", F.col("first.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("first.rid")).alias("kept"), *extra))
    singles = rows.filter("full IS NULL").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                                 F.lit(True).alias("kept"), *extra)
    return singles.unionByName(copies)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows and columns without all but the first of equal texts."""
    return exact_groups(docs, id_col, text_col, carry=True).filter("kept").select("row.*")
