"""The whole pipeline against a plain version of its stages on what the toxicity stage kept."""

from pyspark.sql import functions as F

import corpus_pipeline
from quench.session import scratch_path
from tests.llm import brute
from tests.llm.test_operators import check_packing

GIVEN = "/root/testdata/sf0.01"


def test_pipeline_given(spark):
    sf = scratch_path(spark, "pipeline-given")
    given = {t: spark.read.parquet(f"{GIVEN}/{t}.parquet") for t in ("documents", "labels", "benchmark")}
    long = given["documents"].filter("length(text) > 5000 AND doc_id % 5 = 0")  # the given rows hold no near copies within the radius
    near = long.withColumn("doc_id", F.col("doc_id") + 1_000_000).withColumn("text", F.concat("text", F.lit(" zz")))
    given["documents"] = given["documents"].unionByName(near)
    for t, rows in given.items():
        rows.write.parquet(f"{sf}/{t}.parquet")
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [(r["doc_id"], r["text"] or "") for r in corpus_pipeline.drop_toxic(spark, documents, sf).collect()]
    sizes = [documents.count(), len(docs)]
    first = {}
    for i, t in sorted(docs):
        first.setdefault(brute.normalise(t), (i, t))
    docs = list(first.values())
    sizes.append(len(docs))
    ids = [i for i, _ in docs]
    docs = [d for d, c in zip(docs, brute.near_components(ids, [brute.simhash(t) for _, t in docs])) if d[0] == c]
    sizes.append(len(docs))
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [d for d, (_, hits, _) in zip(docs, brute.decontaminate([t for _, t in docs], items)) if not hits]
    sizes.append(len(docs))
    assert sizes[1] > sizes[2] > sizes[3] > sizes[4] > 0, sizes  # every stage after the first has work
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check_packing([tuple(r) for r in out.collect()], docs)
