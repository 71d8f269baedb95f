"""From raw documents to token ids: what is worth keeping, once, without personal data, in the wanted mix, encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.cluster import fits_broadcast, write_and_read
from textloom.llm.bpe import encode
from textloom.llm.jaccard import jaccard_components
from textloom.llm.mixing import mixed_rows
from textloom.llm.pii import redact_pii
from textloom.llm.quality import keep_good
from textloom.llm.queries import quality_model, tokenizer_file

#: Documents that score less are rejected.
QUALITY_THRESHOLD = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier doesn't reject. It is fitted on labelled documents of this input."""
    return keep_good(docs, quality_model(spark, docs, sf_dir), QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles with a Jaccard similarity of 0.8 or more: the one with
    the smallest id. Of rows that agree in id and text one stays; rows without an id stay. An id may have several texts:
    then rows are told apart by a number, and the smallest id and number of a group stays."""
    rows, ids = docs.agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    if rows > ids:
        named = write_and_read(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).withColumn(
            "_row", F.monotonically_increasing_id()), "named")
        found = jaccard_components(named.select("_row", "text"), words=5, percent=80, id_col="_row")
        first = write_and_read(found.join(named.select("_row", "doc_id"), "_row").groupBy("component_id").agg(
            F.min(F.struct("doc_id", "_row")).alias("first")).select("first._row"), "first")
        kept = named.join(F.broadcast(first) if fits_broadcast(first) else first, "_row", "left_semi").select(docs.columns)
        return kept.union(docs.where("doc_id IS NULL"))
    found = write_and_read(jaccard_components(docs.select("doc_id", "text"), words=5, percent=80), "components")
    gone = found.where("doc_id <> component_id").select("doc_id")
    return docs.join(F.broadcast(gone) if fits_broadcast(gone) else gone, "doc_id", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows."""
    return redact_pii(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share of the mix asks for: 0 to 2 times."""
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens."""
    return encode(docs, tokenizer_file())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`; each result is written to shared storage and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_and_read(docs, name)
    return docs
