"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quench.llm.common import fold, table
from quench.session import scratch_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import packing

    cut = packing.pieces(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.assign(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import decontaminate

    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), (fold("id", toxicity.FOLDS) == toxicity.HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import token_files

    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.crc32_of_ids(token_files.read_tokens(spark, path))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import exact_dedup

    rows = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest=True)
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import pii

    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.train(docs))
    return found.select(F.col("id").alias("doc_id"),
                        *[F.size(pii.of_kind("base", k)).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
                        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.concat("base", "added")).alias("spans"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import secrets

    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))
    return found.select(F.col("id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in secrets.KINDS[:3]],
                        F.sha2(secrets.listed(*secrets.KINDS[:3]), 256).alias("base_sha256"), secrets.listed(*secrets.KINDS).alias("spans"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import html_extract

    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import lm_score

    return lm_score.lm_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import simhash_dedup

    rows = simhash_dedup.near_groups(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import line_dedup

    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import kmeans

    rows = kmeans.with_inertia(*kmeans.cluster(table(spark, sf_dir, "embeddings")))
    return rows.withColumnRenamed("id", "vec_id")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quench.llm import conversation_repair

    given = table(spark, sf_dir, "conversations")
    return conversation_repair.digests(given.select(F.col("conv_id").alias("conv")), conversation_repair.damage(given)).withColumnRenamed("conv", "conv_id")


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_benchmark_decontamination, op3_toxicity, op4_token_files, op5_exact_dedup, op6_personal_data, op7_secret_scan, op8_html_extraction, op9_lm_scores,
                                   op10_simhash_near_dedup, op11_line_dedup, op12_centroid_clustering, op13_conversation_repair)}

_BENCH_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _kmeans_sql(rounds: int = 5, k: int = 40) -> str:
    """Unrolled rounds: a<r> assigns every vector to the centroids c<r>, c<r+1> are the floored means."""
    assign = """a{r} AS (SELECT i, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT i, c, CAST(list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM x, c{r}) GROUP BY i)"""
    move = """m{r} AS (SELECT c, list(m ORDER BY j) AS w FROM (
  SELECT c, j, CAST((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
  FROM (SELECT c, unnest(v) AS e, unnest(range(1, 65)) AS j FROM a{r} JOIN x USING (i)) GROUP BY c, j) GROUP BY c),
c{s} AS (SELECT c, coalesce(m{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN m{r} USING (c))"""
    steps = ",\n".join(x for r in range(rounds) for x in (assign.format(r=r), move.format(r=r, s=r + 1)))
    return f"""
WITH x AS (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v AS w
  FROM (SELECT v, sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM x) ORDER BY h, v LIMIT {k}),
{steps},
{assign.format(r=rounds)},
s AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY c)
SELECT vec_id, c AS cluster, d AS distance, cluster_inertia, (SELECT CAST(sum(d) AS BIGINT) FROM a{rounds}) AS inertia,
       sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{rounds} JOIN x USING (i) JOIN c{rounds} USING (c) JOIN s USING (c)"""


ORACLES = {
    "op2_benchmark_decontamination": f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_BENCH_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_BENCH_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM bw),
occ AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
        FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, i, n, t FROM occ WHERE (n, t) IN (SELECT n, t FROM bw)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
          FROM (SELECT DISTINCT r, item_id FROM hit JOIN bw USING (n, t)) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op5_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
    "op11_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key
      HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
j AS (SELECT r, line, pos, top IS NOT NULL AND (doc_id IS NULL OR doc_id < top) AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j JOIN d USING (r) GROUP BY r""",
    "op12_centroid_clustering": _kmeans_sql(),
}
