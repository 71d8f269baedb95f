"""The operators over the given tables, under the names the driver runs. Parameters are those of production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textloom.llm.bpe import round_trip_digests
from textloom.llm.common import remainder_is, table
from textloom.llm import fingerprint, manifest
from textloom.llm.filter_audit import AUDIT_SQL, filter_audit
from textloom.llm.fingerprint import fingerprint_edits
from textloom.llm.jaccard import jaccard_components
from textloom.llm.language import fit_languages, predict_languages
from textloom.llm.manifest import manifest_audit
from textloom.llm.mixing import MIX_SQL, mix_sources
from textloom.llm.pii import find_pii
from textloom.llm.quality import AdditiveModel, fit_quality, score_quality
from textloom.llm.simhash import simhash_components
from textloom.llm.token_counts import token_counts
from textloom.llm.topk import quantised, top_k
from textloom.llm.urls import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str = "byte_bpe_50k.json") -> bytes:
    """Read on the driver and broadcast, so executors need no file."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file(), limit=1024)


@query
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_file())


#: (verdict, host, path)
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


ORACLE_SQL["op8_url_filter"] = """
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
judged AS (
  SELECT *, CASE
    WHEN '.' || host LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN '.' || host LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN '.' || host LIKE '%.com' AND path LIKE '/%' THEN 'com/'
    WHEN '.' || host LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN '.' || host LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


ORACLE_SQL["op6_mix_sources"] = MIX_SQL


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


ORACLE_SQL["op3_fingerprints"] = fingerprint.sql()


@query
def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder_is("doc_id", 4, 2)
    model = fit_languages(docs.where(docs["doc_id"].isNotNull() & ~held_out))
    return predict_languages(docs, model, keep={"held_out": held_out})


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> AdditiveModel:
    labels = table(spark, sf_dir, "labels")
    return fit_quality(docs, labels.where(~remainder_is("doc_id", 5, 0)))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, quality_model(spark, docs, sf_dir),
                         keep={"doc_id": docs["doc_id"], "held_out": remainder_is("doc_id", 5, 0)})


@query
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


ORACLE_SQL["op2_exact_top_k"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(c.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents")).drop("found")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_audit(table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_merkle_manifest"] = manifest.sql()


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), words=3, bits=2)


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL["op13_filter_audit"] = AUDIT_SQL
