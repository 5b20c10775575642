"""Derived fixtures over the driver tables.

``measurements`` maps the TPC-H-ish star schema onto the nine-measurement
model (FIXTURES.md §3). It is a lazy join; Catalyst prunes the unused
columns at each parquet scan. ``orders`` grows with ``lineitem`` and is
co-partitioned with it by a shuffle on the order key (small tables aside);
``supplier`` and ``part`` are broadcast while they have few rows, so that
``lineitem`` moves once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.functions.constants import FEATURES, LABEL, ROW_ID
from quench.functions.hashing import hash_uniform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond, value):
    return F.when(cond, F.lit(None).cast("double")).otherwise(value)


_MATERIALISED: dict[tuple[str, str], str] = {}

#: Rows (three numbers each) up to which a dimension is broadcast, about 150 MB as a hash table.
BROADCAST_ROWS = 2_000_000
#: Rows of ``lineitem`` up to which Spark may broadcast ``orders`` as well and the rows are dealt over the cores.
SMALL_ROWS = 1_000_000


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture, written once per application into the shared scratch folder
    (the ingest step: every operator pass then scans parquet with pruning and
    pushdown instead of re-running the four-way join). The row id is kept as the
    16 bytes of its md5, half its text."""
    from quench.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _MATERIALISED.get(key)
    if path is None:
        path = scratch_path(spark, "measurements")
        plan = measurements_plan(spark, sf_dir)
        cores, li = spark.sparkContext.defaultParallelism, table(spark, sf_dir, "lineitem")
        if li.count() <= SMALL_ROWS and li.rdd.getNumPartitions() < cores:
            # no shuffle on the order key: a file a core, or every later scan would run in few tasks
            plan = plan.repartition(cores)
        plan.withColumn(ROW_ID, F.unhex(ROW_ID)).write.mode("overwrite").parquet(path)
        _MATERIALISED[key] = path
    return spark.read.parquet(path).withColumn(ROW_ID, F.lower(F.hex(ROW_ID)))


def measurements_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lazy join that defines the fixture."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias(LABEL),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    part = _dimension(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"))
    if table(spark, sf_dir, "lineitem").count() > SMALL_ROWS:
        orders = orders.hint("merge")
    supp = _dimension(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"))
    j = (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(part, li.l_partkey == part.p_partkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
    )
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    okey, pkey, skey, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return j.select(
        F.md5(F.concat_ws(":", okey.cast("string"), pkey.cast("string"), skey.cast("string"),
                          ln.cast("string"), cents.cast("string"))).alias(ROW_ID),
        _null_when((okey + ln) % 7 == 0, F.col("l_quantity") / 5 + 1).alias("ph"),
        (F.col("p_size") * 10.0).alias("Hardness"),
        F.col("l_extendedprice").alias("Solids"),
        (F.col("l_tax") * 100 + 0.0).alias("Chloramines"),
        _null_when((pkey + ln) % 5 == 0, F.col("o_totalprice") / 1000).alias("Sulfate"),
        F.col("p_retailprice").alias("Conductivity"),
        (F.col("l_discount") * 100 + 0.0).alias("Organic_carbon"),
        _null_when((pkey + skey + ln) % 20 == 0, F.col("s_acctbal") / 100).alias("Trihalomethanes"),
        (ln * 1.0).alias("Turbidity"),
        LABEL,
        okey.alias("_okey"),
    )


def _dimension(df: DataFrame) -> DataFrame:
    """Broadcast if counted (from the files' footers) to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def measurements_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture without helper columns."""
    return measurements(spark, sf_dir).drop("_okey")


def measurements_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture rows without ``row_id`` plus an exact copy of every row with
    ``l_orderkey % 50 = 0`` (planted duplicates for the dedupe operator)."""
    m = measurements(spark, sf_dir)
    cols = FEATURES + [LABEL]
    return m.select(*cols).unionAll(m.where(F.col("_okey") % 50 == 0).select(*cols))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a label and a planted, tie-heavy class-1 score (no model needed).

    score  = round(0.6 * u(row_id) + 0.4 * label, 2)      (ties on purpose)
    prediction = 1 when score >= 0.5
    fold   = 5-way hash fold for cross-validation summaries
    """
    m = measurements(spark, sf_dir)
    u = hash_uniform(7, F.col(ROW_ID))
    score = F.round(F.lit(0.6) * u + F.lit(0.4) * F.col(LABEL), 2)
    return m.select(
        ROW_ID,
        F.col(LABEL).alias("label"),
        score.alias("score"),
        u.alias("raw_score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("prediction"),
        (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("fold"), F.col(ROW_ID))), 1, 8), 16, 10)
         .cast("bigint") % 5).cast("int").alias("fold"),
    )
