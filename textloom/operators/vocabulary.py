"""Term statistics, vocabulary and TF-IDF."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from textloom.cluster import materialise, scratch_path, write_and_read
from textloom.fixed_values import MAX_DF, MAX_FEATURES, MIN_DF, NGRAM_RANGE
from textloom.functions.cleaning import clean_text
from textloom.functions.term_batches import counted, feature_text, lists_of, places
from textloom.functions.terms import feature_tokens, ngrams, term_counts


def terms_of(tokens: Column | str, ngram_range: tuple[int, int] = NGRAM_RANGE) -> Column:
    return ngrams(feature_tokens(clean_text(tokens)), ngram_range)


def term_rows(
    df: DataFrame, keep: list[str], tokens_col: str = "tokens", ngram_range: tuple[int, int] = NGRAM_RANGE
) -> DataFrame:
    """keep..., term, tf. Counted inside the row, so no shuffle.

    The outer form of the generator, because the plain one adds a filter on its input and the
    optimiser would push a second copy of the whole cleaning chain below the first. Rows without
    terms give one row with a null term.
    """
    return df.select(*keep, F.inline_outer(term_counts(terms_of(tokens_col, ngram_range))))


def document_frequencies(terms: DataFrame) -> DataFrame:
    """term, df, cf; partial sums on the map side."""
    return (
        terms.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
        .where(F.col("term").isNotNull())
    )


def term_totals(df: DataFrame, tokens_col: str = "tokens", ngram_range: tuple[int, int] = NGRAM_RANGE) -> DataFrame:
    """As `document_frequencies` of `term_rows`, counted by Arrow batch: a term is shuffled once a slice of a batch at most."""
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in counted(batch.column(0), ngram_range):
                df, cf = np.bincount(c.codes, minlength=len(c.terms)), np.bincount(c.codes, c.tf, len(c.terms))
                yield pa.RecordBatch.from_arrays([c.terms, pa.array(df), pa.array(cf.astype(np.int64))], names=["term", "df", "cf"])

    parts = df.select(feature_text(df, tokens_col)).mapInArrow(totals, "term string, df long, cf long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


@dataclass
class Vocabulary:
    table: DataFrame  # term, idx, df, cf, idf: at most max_features rows
    n_docs: int
    size: int
    ngram_range: tuple[int, int] = NGRAM_RANGE
    sublinear_tf: bool = True  # 1 + ln(tf) instead of tf

    def feature_names(self) -> DataFrame:
        return self.table.select("idx", "term")


# Counts are grouped in steps of 1/32 of a doubling to find a cut-off for the top n.
STEPS = 32


def top_terms(freq: DataFrame, n: int) -> DataFrame:
    """The n most counted terms, ties by term.

    `orderBy.limit` merges n rows of every partition in one task. The histogram of counts, a couple
    of thousand numbers at most, first drops the terms that cannot be among them.
    """
    step = F.floor(F.log2("cf") * STEPS)
    histogram = freq.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    cutoff, seen = None, 0
    for row in sorted(histogram, key=lambda r: -r["step"]):
        cutoff, seen = row["step"], seen + row["n"]
        if seen >= n:
            break
    if cutoff is not None:
        freq = freq.where(step >= cutoff)
    return freq.orderBy(F.desc("cf"), "term").limit(n)


def fit_vocabulary(
    df: DataFrame,
    tokens_col: str = "tokens",
    max_features: int = MAX_FEATURES,
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    min_df: int = MIN_DF,
    max_df: str = MAX_DF,
    sublinear_tf: bool = True,
) -> Vocabulary:
    """Terms within the df limits, the `max_features` most counted of them, with smoothed idf."""
    n_docs = df.count()
    most = floor(Fraction(max_df) * n_docs)
    freq = term_totals(df, tokens_col, ngram_range)
    freq = write_and_read(freq.where((F.col("df") >= min_df) & (F.col("df") <= most)), "frequencies")
    # max_features rows at most, so one window over all of them is small.
    by_term = Window.orderBy("term")
    table = materialise(
        top_terms(freq, max_features)
        .withColumn("idx", (F.row_number().over(by_term) - 1).cast("int"))
        .withColumn("idf", F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0)
    )
    return Vocabulary(table, n_docs, table.count(), ngram_range, sublinear_tf)


def _weights(texts: pa.Array, terms: pa.Array, idf: np.ndarray, ngram_range: tuple[int, int], sublinear: bool) -> pa.Array:
    """Indices and L2-normed weights of each document's known terms, by index."""
    sizes, indices, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0)]
    for c in counted(texts, ngram_range):
        rows, idx, tf = places(c, terms)
        w = (1.0 + np.log(tf) if sublinear else tf) * idf[idx]
        norm = np.sqrt(np.bincount(rows, w * w, c.n))
        sizes.append(np.bincount(rows, minlength=c.n))
        indices.append(idx.astype(np.int32))
        values.append(w / norm[rows])
    sizes = np.concatenate(sizes)
    return pa.StructArray.from_arrays(
        [lists_of(sizes, pa.array(np.concatenate(x))) for x in (indices, values)], names=["indices", "values"])


def known_terms(vocab: Vocabulary) -> tuple[pa.Array, np.ndarray]:
    """Terms and their idf by index: at most `max_features` rows."""
    table = vocab.table.select("idx", "term", "idf").toArrow().sort_by("idx").combine_chunks()
    return pa.array(table.column("term").to_pylist(), pa.string()), table.column("idf").to_numpy()


def weighed(df: DataFrame, vocab: Vocabulary, tokens_col: str = "tokens", out: str = "cells") -> DataFrame:
    """Adds struct<indices, values>, looked up in the row: a vocabulary has at most `max_features` terms, so it is sent
    to every worker, and documents are neither taken apart nor shuffled. Terms outside it are dropped."""
    shared = df.sparkSession.sparkContext.broadcast(known_terms(vocab))
    ngram_range, sublinear = vocab.ngram_range, vocab.sublinear_tf

    @F.arrow_udf("struct<indices:array<int>,values:array<double>>")
    def weigh(texts: pa.Array) -> pa.Array:
        return _weights(texts, *shared.value, ngram_range, sublinear)

    return df.withColumn(out, weigh(feature_text(df, tokens_col)))


def tfidf_rows(
    df: DataFrame, vocab: Vocabulary, id_col: str = "id", tokens_col: str = "tokens", keep: list[str] | None = None
) -> DataFrame:
    """id, keep..., term, weight; documents without a known term have no rows."""
    keep = keep or []
    cells = weighed(df.select(id_col, *keep, tokens_col), vocab, tokens_col)
    rows = cells.select(id_col, *keep, F.inline_outer(F.arrays_zip("cells.indices", "cells.values")))
    rows = rows.toDF(id_col, *keep, "idx", "weight").where(F.col("idx").isNotNull())
    names = F.broadcast(vocab.feature_names())  # at most max_features rows
    return rows.join(names, "idx").select(id_col, *keep, "term", "weight")


def tfidf_vectors(
    df: DataFrame, vocab: Vocabulary, keep: list[str], id_col: str = "id", tokens_col: str = "tokens"
) -> DataFrame:
    """keep..., features: one sparse vector per document, zeros kept, stored as a table.

    Iterative training reads its input many times, so it is written once. The stored struct is what
    a vector column consists of, and reading it back as one needs no per-row Python.
    """
    rows = weighed(df.select(*dict.fromkeys([*keep, tokens_col])), vocab, tokens_col)
    features = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(vocab.size).alias("size"),
        F.col("cells.indices").alias("indices"),
        F.col("cells.values").alias("values"),
    )
    stored = rows.select(*keep, features.alias("features"))
    path = scratch_path(df.sparkSession, "features")
    stored.write.parquet(path)
    fields = [f for f in stored.schema.fields if f.name != "features"]
    schema = T.StructType([*fields, T.StructField("features", VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)
