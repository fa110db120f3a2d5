"""The operators as registered queries, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm import (
    decontamination, manifest, mixing, negatives, neighbours, ngram_join, packing, secrets, sharding, toxicity,
    vafile, warc, wrappers,
)
from mercata.llm.support import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def entry(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@entry("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 24)


@entry("op7_source_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select(
        "row.doc_id", "row.source", F.col("mix.size").alias("size"), F.col("mix.source_size").alias("source_size"),
        F.col("mix.target").alias("target"), F.col("mix.copies").alias("copies"),
        (F.col("mix.copies") * F.col("mix.size")).cast("long").alias("taken"),
    )


@entry("op2_block_neighbours", """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@entry("op5_va_file", """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), q AS (SELECT vec_id AS query_id, e AS qe FROM v WHERE vec_id % 50 = 0),
s AS (
  SELECT query_id, vec_id, CAST(list_inner_product(CAST(qe AS DOUBLE[]), CAST(e AS DOUBLE[])) AS BIGINT) AS score
  FROM q JOIN v ON query_id <> vec_id AND len(qe) = len(e)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"))


@entry("op6_secret_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@entry("op10_warc_salvage", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS kept FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM g
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


@entry("op9_toxicity_crf")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_tagged", "spans"
    )


@entry("op4_wrapper_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


@entry("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@entry("op1_ngram_jaccard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, sf_dir, "documents"))


@entry("op11_decontamination", decontamination.CONTAMINATED_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@entry("op12_merkle_manifest", manifest.manifest_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


@entry("op13_hard_negatives", negatives.HARD_NEGATIVES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    moved = (F.col("label").cast("long") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    return negatives.hard_negatives(embeddings.withColumn("label", label))
