"""One entry per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.cluster import materialise, scratch_path, spread, write_and_read
from textloom.functions.cleaning import clean_text, normalise_text, remove_stop_words, tokenise, with_tokens
from textloom.functions.keys import choose
from textloom.operators import eda, evaluate as ev
from textloom.operators.embed import mean_pool
from textloom.operators.lemma import fit_lemmas, lemmatise, token_frequencies
from textloom.operators.lookups import encode_labels, id_to_name, name_to_id, predicted_name
from textloom.operators.naive_bayes import (
    argmax, nb_cross_validate, nb_predict as predict_nb, nb_scores as score_nb,
)
from textloom.operators.report import confidence, one_hot, preview, ranked_probabilities as rank_probabilities
from textloom.operators.split import fit_folds, fit_holdout, fit_split, sample_rows as sample
from textloom.operators.vocabulary import (
    document_frequencies, fit_vocabulary, term_rows, terms_of, tfidf_rows,
)
from textloom.plans.corpus import (
    LANGS, cleaned_documents, content_split, documents, folded_train, lemmatised_documents, naive_bayes, table,
)
from textloom.sources.labelled import load_labelled_csv, load_splits, union_splits as union_of_splits, write_labelled_csv
from textloom.sources.lines import line_rows, read_line_files
from textloom.sources.synthetic import synthetic_corpus as generate
from textloom.streaming.score import running_accuracy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, without a trailing underscore."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


# Sources and sinks.

@query
def load_labelled(spark, sf_dir):
    """A CSV with padded upper-case headers and no label column; names outside the list are dropped."""
    path = scratch_path(spark, "labelled")
    raw = documents(spark, sf_dir).select(
        F.col("id").alias(" ID"), F.col("text").alias(" Text "), F.col("emotion").alias("EMOTION "))
    raw.write.csv(path, header=True, escape='"')
    df = load_labelled_csv(spark, path, ["en", "fr", "de"])
    return df.select(F.col("id").cast("bigint").alias("id"), "text", "label", "emotion")


@query
def load_labelled_names(spark, sf_dir):
    """Labels as names, whole numbers and decimals in one column; only true nulls go."""
    path = scratch_path(spark, "labelled")
    number = F.col("label").cast("string")
    text = F.when(F.pmod("id", F.lit(4)) == 0, F.col("emotion")).when(F.pmod("id", F.lit(4)) == 1, number).when(
        F.pmod("id", F.lit(4)) == 2, F.concat(F.lit(" "), number, F.lit(".0 ")))
    documents(spark, sf_dir).select("id", "text", text.alias("Label")).write.csv(path, header=True, escape='"')
    df = load_labelled_csv(spark, path, LANGS)
    return df.select(F.col("id").cast("bigint").alias("id"), "label", "emotion")


@query
def line_files(spark, sf_dir):
    """Text files of the turns of each role, read back as lines with the role from their name."""
    path = scratch_path(spark, "lines")
    for role in ("user", "assistant", "system"):
        table(spark, sf_dir, "conversations").where(F.col("role") == role).select("text").write.text(f"{path}/{role}_samples")
    return read_line_files(spark, f"{path}/*")


@query
def union_splits(spark, sf_dir):
    roles = ["user", "assistant", "system"]
    return union_of_splits({
        "train": documents(spark, sf_dir).select("text", F.col("label").cast("bigint").alias("label")),
        "validation": table(spark, sf_dir, "conversations").select(
            "text", name_to_id("role", roles).cast("bigint").alias("label")),
        "test": table(spark, sf_dir, "benchmark").select("text", F.pmod("item_id", F.lit(6)).alias("label")),
    }, LANGS).select("text", "label", "emotion")


@query
def load_splits_files(spark, sf_dir):
    """Splits as CSV files, their columns in different orders, labels as names, decimals and whole numbers."""
    docs, path = documents(spark, sf_dir), scratch_path(spark, "splits")
    parts = {
        "train": docs.select("text", F.col("emotion").alias("label")),
        "validation": docs.select(F.concat("label", F.lit(".0")).alias(" Label"), F.col("text").alias("TEXT ")),
        "test": docs.select("label", "id", "text")}
    for k, (name, rows) in enumerate(parts.items()):
        write_labelled_csv(rows.where(F.pmod("id", F.lit(3)) == k), f"{path}/{name}")
    return load_splits(spark, {name: f"{path}/{name}" for name in parts}, "csv", LANGS)


@query
def synthetic_corpus(spark, sf_dir):
    return generate(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")))


@query
def line_source(spark, sf_dir):
    return line_rows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "roundtrip")
    write_labelled_csv(documents(spark, sf_dir).select("id", "text", "label", "emotion"), path)
    df = load_labelled_csv(spark, path, LANGS)
    return df.select(F.col("id").cast("bigint").alias("id"), "text", "label", "emotion")


# Labels.

@query
def label_lookup(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "id", name_to_id("emotion", ["en", "fr", "de"]).alias("label"),
        id_to_name(F.pmod("id", F.lit(6)).cast("int"), LANGS).alias("name"))


@query
def encode_labels_(spark, sf_dir):
    claimed = documents(spark, sf_dir).withColumn("label", F.pmod("id", F.lit(4)).cast("int"))
    return encode_labels(claimed, LANGS).select("id", "label", "emotion")


@query
def class_weights(spark, sf_dir):
    return ev.class_weights(documents(spark, sf_dir), len(LANGS)).select("label", "n", F.round("weight", 6).alias("weight"))


# Cleaning.

@query
def clean_normalise(spark, sf_dir):
    return spread(documents(spark, sf_dir)).select("id", normalise_text("text").alias("cleaned"))


@query
def clean_pages(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages"))
    both = F.concat_ws(" ", "url", "html")
    return pages.select("page_id", normalise_text("html").alias("cleaned"), normalise_text(both).alias("cleaned_with_url"))


EDGE_CASES = [
    "I'm SO happy :D ", "see https://a.co/x :) ", "www.site.com/a b ", "I love it <3 ", "broken </3 ",
    ">:( grr :( ", "<p>sad</p> ", "5 < 6 and 7 > 2 ", "room 101 ", "don''t gimme 'tis cannot ", "axdb ",
    "  \t ", "they'll've gone, dogs' won't we're 'a' wanna be ", "www.", "\U0001F600www.☃x y ", "a<b ",
]


def decorated(spark, sf_dir):
    """Documents, each with a hard case put in front: the tables themselves hold few of them. And each case alone, with
    an empty and a null text, under ids from -1 down."""
    cases = F.array(*map(F.lit, EDGE_CASES))
    case = F.get(cases, F.pmod("id", F.lit(len(EDGE_CASES))).cast("int"))
    alone = [(-1 - k, text) for k, text in enumerate([*EDGE_CASES, "", None])]
    return spread(documents(spark, sf_dir)).select("id", F.concat(case, "text").alias("text")).union(
        spark.createDataFrame(alone, "id bigint, text string"))


@query
def clean_edge_cases(spark, sf_dir):
    norm = decorated(spark, sf_dir).select("id", normalise_text("text").alias("cleaned"))
    return norm.select("id", "cleaned", F.array_join(tokenise("cleaned"), "|").alias("tokens"))


@query
def fold_negation(spark, sf_dir):
    """Tokens of documents and hard cases, with n't as a word that features keep."""
    return with_tokens(decorated(spark, sf_dir), fold_negation=True).select("id", clean_text("tokens").alias("tokens"))


@query
def tokenise_(spark, sf_dir):
    norm = spread(documents(spark, sf_dir)).select("id", normalise_text("text").alias("n"))
    return norm.select("id", F.array_join(tokenise("n"), " ").alias("tokens"))


@query
def remove_stopwords(spark, sf_dir):
    norm = spread(documents(spark, sf_dir)).select("id", normalise_text("text").alias("n"))
    kept = norm.select("id", remove_stop_words(tokenise("n")).alias("t"))
    return kept.select("id", F.size("t").alias("n_tokens"), clean_text("t").alias("tokens"))


def _with_lemmas(spark, sf_dir):
    corpus = write_and_read(with_tokens(spread(documents(spark, sf_dir)), min_token_len=1).select("id", "tokens"), "tokens")
    return corpus, fit_lemmas(corpus)


@query
def lemmatise_(spark, sf_dir):
    corpus, lemmas = _with_lemmas(spark, sf_dir)
    tokens = token_frequencies(corpus)
    return tokens.join(lemmas, "token", "left").select("token", F.coalesce("lemma", "token").alias("lemma"), "df")


@query
def clean_full(spark, sf_dir):
    corpus, lemmas = _with_lemmas(spark, sf_dir)
    return lemmatise(corpus, lemmas).select("id", clean_text("tokens").alias("clean_text"))


# Exploration.

@query
def class_distribution(spark, sf_dir):
    return eda.class_distribution(documents(spark, sf_dir))


@query
def token_length_stats(spark, sf_dir):
    return eda.token_length_stats(documents(spark, sf_dir))


@query
def token_length_histogram(spark, sf_dir):
    return eda.token_length_histogram(documents(spark, sf_dir))


@query
def token_length_box(spark, sf_dir):
    return eda.token_length_box(documents(spark, sf_dir))


@query
def top_terms_per_class(spark, sf_dir):
    return eda.top_terms_per_class(with_tokens(spread(documents(spark, sf_dir))))


@query
def sample_rows(spark, sf_dir):
    """Raw and cleaned text of a seeded sample of 50."""
    rows = sample(documents(spark, sf_dir), 50)
    return with_tokens(rows).select(
        "id", preview("text").alias("raw"), preview(clean_text("tokens")).alias("clean"))


# Terms and features.

@query
def feature_tokens(spark, sf_dir):
    docs = with_tokens(spread(documents(spark, sf_dir)))
    feats = docs.select("id", terms_of("tokens", (1, 1)).alias("f"))
    return feats.select("id", F.size("f").alias("n"), F.array_join("f", " ").alias("features"))


@query
def ngrams_1_2(spark, sf_dir):
    docs = with_tokens(spread(documents(spark, sf_dir)))
    return term_rows(docs, ["id"]).where("term IS NOT NULL").select("id", "term", F.col("tf").cast("bigint").alias("tf"))


@query
def term_doc_freq(spark, sf_dir):
    return document_frequencies(term_rows(with_tokens(spread(documents(spark, sf_dir))), []))


@query
def vocabulary_topk(spark, sf_dir):
    vocab = fit_vocabulary(with_tokens(spread(documents(spark, sf_dir))), max_features=2_000)
    return vocab.table.select("term", "idx", "df", "cf", F.round("idf", 6).alias("idf"))


def _train_rows(spark, sf_dir):
    corpus = cleaned_documents(spark, sf_dir)
    return fit_split(corpus).transform(corpus).where("split = 'train'")


@query
def tfidf_fit_transform(spark, sf_dir):
    train = _train_rows(spark, sf_dir)
    rows = tfidf_rows(train, fit_vocabulary(train, "content"), tokens_col="content")
    return rows.select("id", "term", F.round("weight", 6).alias("weight"))


@query
def tfidf_transform(spark, sf_dir):
    """Fitted on the train split, applied to all splits and to the texts of another table in one pass."""
    corpus, lemmas = lemmatised_documents(spark, sf_dir)
    corpus = fit_split(corpus).transform(corpus).select("id", "content", "split")
    vocab = fit_vocabulary(corpus.where("split = 'train'"), "content")
    unseen = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    unseen = write_and_read(lemmatise(with_tokens(unseen, min_token_len=1), lemmas), "unseen")
    rows = corpus.unionByName(unseen.select("id", clean_text("tokens").alias("content"), F.lit("benchmark").alias("split")))
    return tfidf_rows(rows, vocab, tokens_col="content", keep=["split"]).select("id", "split", "term", F.round("weight", 6).alias("weight"))


@query
def embed_mean_pool(spark, sf_dir):
    """Words used in two documents or more get a row of `embeddings` each; texts get the mean."""
    corpus = cleaned_documents(spark, sf_dir)
    given = table(spark, sf_dir, "embeddings")
    n = given.agg(F.count("*").cast("int").alias("n")).scalar()
    words = token_frequencies(corpus).where("df >= 2").select("token", choose("token", n, salt="vec").alias("vec_id"))
    vectors = materialise(words.join(given, "vec_id").select("token", F.col("embedding").alias("vector")))
    pooled = mean_pool(corpus, vectors, 64)
    return pooled.select("id", F.posexplode_outer("embedding").alias("dim", "v")).select(
        "id", "dim", F.round("v", 6).alias("value"))


# Splits.

@query
def stratified_split(spark, sf_dir):
    docs = documents(spark, sf_dir).select("id", "label")
    return fit_split(docs).transform(docs)


@query
def split_sizes(spark, sf_dir):
    """Split by content: copies stay together."""
    corpus = cleaned_documents(spark, sf_dir)
    return content_split(corpus).transform(corpus).groupBy("split", "emotion").agg(
        F.count("*").alias("n_rows"), F.count_distinct(F.md5("content")).alias("n_contents"))


def _train_ids(spark, sf_dir):
    docs = documents(spark, sf_dir).select("id", "label")
    return fit_split(docs).transform(docs).where("split = 'train'").select("id", "label")


@query
def stratified_folds(spark, sf_dir):
    train = _train_ids(spark, sf_dir)
    return fit_folds(train).transform(train, "fold")


@query
def holdout_split(spark, sf_dir):
    train = _train_ids(spark, sf_dir)
    return fit_holdout(train).transform(train)


# A predictor with a closed form, and everything computed from predictions.

@query
def nb_scores(spark, sf_dir):
    scored = naive_bayes(spark, sf_dir).scores()
    return scored.select("id", "split", F.posexplode_outer("scores").alias("label", "s")).select(
        "id", "split", "label", F.round("s", 4).alias("score"))


@query
def nb_predict(spark, sf_dir):
    return naive_bayes(spark, sf_dir).predictions().select(
        "id", "split", "prediction", predicted_name("prediction", LANGS).alias("emotion"))


@query
def score_unknown(spark, sf_dir):
    """Lines of conversations scored by the model of the documents; lines without tokens are unknown."""
    run = naive_bayes(spark, sf_dir)
    lines = line_rows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    lines = lines.select(
        F.concat_ws("/", "conv_id", "turn", "line_no").alias("id"), F.col("line").alias("text"))
    tokens = lemmatise(with_tokens(spread(lines), min_token_len=1), run.lemmas)
    scored = predict_nb(score_nb(tokens, run.weights, run.vocab, len(LANGS)))
    return scored.select("id", predicted_name("prediction", LANGS).alias("emotion"),
                         F.round(F.array_max("probability"), 6).alias("top_probability"))


@query
def argmax_class(spark, sf_dir):
    return naive_bayes(spark, sf_dir).scores().select("id", "split", argmax("scores").alias("label"))


@query
def ranked_probabilities(spark, sf_dir):
    ranked = rank_probabilities(naive_bayes(spark, sf_dir).predictions(), LANGS, keep=["split"])
    return ranked.select("id", "split", "rank", "emotion", F.round("probability", 6).alias("probability"))


@query
def onehot_fallback(spark, sf_dir):
    rows = naive_bayes(spark, sf_dir).predictions()
    return rows.select("id", "split", F.posexplode_outer(one_hot("prediction", len(LANGS))).alias("label", "p"))


@query
def scored_report(spark, sf_dir):
    run = naive_bayes(spark, sf_dir)
    rows = run.predictions().join(run.corpus.select("id", preview("text").alias("preview")), "id")
    return rows.select(
        "id", "split", "preview", predicted_name("prediction", LANGS).alias("predicted"),
        F.round(confidence("probability", "prediction") * 100, 1).alias("confidence_pct"),
        (predicted_name("prediction", LANGS) == F.col("emotion")).alias("hit"))


def _counts(spark, sf_dir, by=()):
    return materialise(ev.confusion_counts(naive_bayes(spark, sf_dir).outcomes("val", "test"), by))


@query
def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_counts(spark, sf_dir, ["split"]), LANGS, ["split"], with_unknown=True)


@query
def confusion_pivot(spark, sf_dir):
    return ev.confusion_pivot(_counts(spark, sf_dir), LANGS)


@query
def one_vs_rest_counts(spark, sf_dir):
    return ev.one_vs_rest_counts(_counts(spark, sf_dir), LANGS)


@query
def per_class_metrics(spark, sf_dir):
    return ev.per_class_metrics(_counts(spark, sf_dir), LANGS)


@query
def weighted_metrics(spark, sf_dir):
    return ev.weighted_metrics(_counts(spark, sf_dir), LANGS)


@query
def overall_metrics(spark, sf_dir):
    return ev.overall_metrics(_counts(spark, sf_dir), LANGS)


@query
def macro_f1(spark, sf_dir):
    return ev.macro_f1(_counts(spark, sf_dir), LANGS)


@query
def classification_report(spark, sf_dir):
    return ev.classification_report(_counts(spark, sf_dir), LANGS)


@query
def metrics_by_split(spark, sf_dir):
    return ev.overall_metrics(_counts(spark, sf_dir, ["split"]), LANGS, ["split"])


@query
def batch_accuracy(spark, sf_dir):
    return ev.accuracy_by_class(naive_bayes(spark, sf_dir).outcomes(), LANGS)


@query
def stream_batch_accuracy(spark, sf_dir):
    """The same table, kept up by a stream over the stored predictions."""
    outcomes, folder = naive_bayes(spark, sf_dir).outcomes(), scratch_path(spark, "outcomes")
    outcomes.write.parquet(folder)
    return running_accuracy(spark, folder, outcomes.schema, LANGS)


def _cv_scores(spark, sf_dir):
    train = folded_train(spark, sf_dir)
    outcomes = nb_cross_validate(train, fit_vocabulary(train, "content"), len(LANGS), tokens_col="content")
    return ev.fold_scores(outcomes, LANGS, ["grid_idx", "alpha"])


@query
def cv_summary(spark, sf_dir):
    return ev.cv_summary(_cv_scores(spark, sf_dir), ["grid_idx", "alpha"])


@query
def best_params(spark, sf_dir):
    return ev.best_params(_cv_scores(spark, sf_dir), ["grid_idx", "alpha"])
