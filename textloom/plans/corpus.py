"""The given tables as corpora, and the steps the queries share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.cluster import spread, write_and_read
from textloom.functions.cleaning import clean_text, with_tokens
from textloom.operators.lemma import fit_lemmas, lemmatise
from textloom.operators.lookups import name_to_id
from textloom.operators.naive_bayes import fit_nb, nb_predict, nb_scores
from textloom.operators.split import SplitModel, fit_folds, fit_split
from textloom.operators.vocabulary import Vocabulary, fit_vocabulary

LANGS = ["en", "fr", "de", "es"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, text, emotion (the language), label."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("emotion"),
        name_to_id("lang", LANGS).alias("label"))


def lemmatised_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents with tokens (lemmas) and content, and the table of lemmas (token, lemma). Cleaning is the costliest step
    and several passes follow, so its result is written once, as tokens and as one string; each pass reads the columns it needs."""
    docs = write_and_read(with_tokens(spread(documents(spark, sf_dir)), min_token_len=1), "cleaned")
    lemmas = fit_lemmas(docs)
    return write_and_read(lemmatise(docs, lemmas).withColumn("content", clean_text("tokens")), "lemmatised"), lemmas


def cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemmatised_documents(spark, sf_dir)[0]


@dataclass
class NaiveBayesRun:
    corpus: DataFrame  # cleaned documents with their split
    lemmas: DataFrame
    vocab: Vocabulary
    weights: DataFrame

    def scores(self, *splits: str) -> DataFrame:
        rows = self.corpus.where(F.col("split").isin(list(splits))) if splits else self.corpus
        return nb_scores(rows, self.weights, self.vocab, len(LANGS), ["split", "emotion", "label"], tokens_col="content")

    def predictions(self, *splits: str) -> DataFrame:
        return nb_predict(self.scores(*splits))

    def outcomes(self, *splits: str) -> DataFrame:
        """id, split, actual, predicted."""
        return self.predictions(*splits).select(
            "id", "split", F.col("label").alias("actual"), F.col("prediction").alias("predicted"))


def content_split(corpus: DataFrame) -> SplitModel:
    return fit_split(corpus, key_col="content", group_by_content=True)


def naive_bayes(spark: SparkSession, sf_dir: str) -> NaiveBayesRun:
    corpus, lemmas = lemmatised_documents(spark, sf_dir)
    corpus = content_split(corpus).transform(corpus)
    train = corpus.where("split = 'train'")
    vocab = fit_vocabulary(train, "content")
    return NaiveBayesRun(corpus, lemmas, vocab, fit_nb(train, vocab, len(LANGS), tokens_col="content"))


def folded_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = cleaned_documents(spark, sf_dir)
    train = content_split(corpus).transform(corpus).where("split = 'train'")
    return fit_folds(train, key_col="content", group_by_content=True).transform(train, "fold")
