"""A training corpus from raw documents: toxicity, exact copies, near copies, benchmark
leaks, then packing. Each stage reads what its predecessor kept and wrote.

Null or empty texts pass the toxicity stage unless the classifier rejects them; copies of
the empty text count as copies. The last stage's rows are those of ``packing.pack`` with a
crc32 in place of the ids. Extra columns of ``documents`` are kept by every stage but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.llm import decontaminate, exact_dedup, packing, simhash_dedup, toxicity
from quench.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = packing.pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.assign(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("simhash_near_dedup", drop_near_copies),
          ("benchmark_decontamination", drop_contaminated), ("best_fit_packing", pack)]

#: Compression distances, fingerprints and tokenizer ids have no SQL form: tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
