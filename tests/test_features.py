from math import log, sqrt

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.cluster import fits_broadcast, lookup_join, materialise
from textloom.functions import with_tokens
from textloom.operators import eda
from textloom.operators.embed import mean_pool
from textloom.operators.lemma import fit_lemmas, lemma_table, lemmatise
from textloom.operators.naive_bayes import argmax, fit_nb, nb_cross_validate, nb_predict, nb_scores, softmax
from textloom.operators.vocabulary import document_frequencies, fit_vocabulary, term_rows, tfidf_rows, tfidf_vectors, top_terms


@pytest.fixture(scope="module")
def small(spark):
    # "aa" in all rows, "zz" in one, "bb" twice in row 1, nothing known in row 3.
    data = [(0, 0, ["aa", "bb", "cc"]), (1, 0, ["aa", "bb", "bb"]), (2, 1, ["aa", "cc"]), (3, 1, ["aa", "zz"])]
    return spark.createDataFrame(data, "id bigint, label int, tokens array<string>")


def test_vocabulary_limits(small):
    vocab = fit_vocabulary(small, ngram_range=(1, 1))
    rows = {r.term: r for r in vocab.table.collect()}
    assert set(rows) == {"bb", "cc"} and (rows["bb"].df, rows["bb"].cf, rows["bb"].idx) == (2, 3, 0)
    assert rows["cc"].idf == pytest.approx(log(5 / 3) + 1)
    assert [r.term for r in fit_vocabulary(small, ngram_range=(1, 1), max_features=1).table.collect()] == ["bb"]


def test_tfidf_by_hand(small):
    vocab = fit_vocabulary(small, ngram_range=(1, 1))
    cells = {(r.id, r.term): r.weight for r in tfidf_rows(small, vocab).collect()}
    idf = log(5 / 3) + 1
    assert cells == {
        (0, "bb"): pytest.approx(1 / sqrt(2)), (0, "cc"): pytest.approx(1 / sqrt(2)),
        (1, "bb"): pytest.approx(1.0), (2, "cc"): pytest.approx(1.0)}
    vectors = {r.id: r.features for r in tfidf_vectors(small, vocab, ["id", "label"]).collect()}
    assert len(vectors) == 4 and vectors[3].numNonzeros() == 0 and idf > 0
    assert {round(float(v.norm(2)), 9) for v in vectors.values()} == {0.0, 1.0}


def test_unseen_terms_change_nothing(small, spark):
    vocab = fit_vocabulary(small, ngram_range=(1, 1))
    a = spark.createDataFrame([(9, ["bb", "cc"])], "id bigint, tokens array<string>")
    b = spark.createDataFrame([(9, ["bb", "qq", "cc", "new"])], "id bigint, tokens array<string>")
    assert tfidf_rows(a, vocab).exceptAll(tfidf_rows(b, vocab)).isEmpty()


def test_top_terms_prefilter_is_exact(spark):
    freq = spark.range(1, 4_000).select(
        F.format_string("t%05d", "id").alias("term"), F.lit(2).alias("df"), (F.lit(40_000) / F.col("id")).cast("bigint").alias("cf"))
    for n in (1, 10, 333, 3_999, 10_000):
        expected = freq.orderBy(F.desc("cf"), "term").limit(n)
        got = top_terms(freq, n)
        assert got.count() == expected.count() and got.exceptAll(expected).isEmpty()


def test_terms_need_no_shuffle(spark, sf):
    docs = with_tokens(spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"), "text"))
    terms = term_rows(docs, ["id"])
    plan = terms._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("regexp_extract_all") == 1  # one cleaning chain, not a second in a pushed-down filter
    counted = document_frequencies(terms)._jdf.queryExecution().executedPlan().toString()
    assert counted.count("Exchange") == 1 and "partial_count" in counted


def test_lookup_join_beyond_the_limits(spark):
    # A third of the facts share a key; half of the others have no match.
    facts = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200).alias("k"))
    lookup = materialise(spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")))
    assert fits_broadcast(lookup) and not fits_broadcast(lookup, rows=99) and not fits_broadcast(lookup, size=10)
    for how in ("inner", "left"):
        small = lookup_join(facts, lookup, ["k"], "id", how)
        large = lookup_join(facts, lookup, ["k"], "id", how, rows=1, heavy=100)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in large._jdf.queryExecution().executedPlan().toString()
        assert small.count() == large.count() and small.exceptAll(large.select(small.columns)).isEmpty()
        plain = lookup_join(facts, lookup, ["k"], "id", how, rows=1)  # no key is heavy
        assert small.exceptAll(plain.select(small.columns)).isEmpty() and small.count() == plain.count()


def test_lemmas(spark):
    words = ["run", "runs", "hope", "hoping", "city", "cities", "box", "boxes", "wolf", "wolves", "woman", "women",
             "went", "watch", "watches", "glass", "walked", "bus", "xyzs", "people"]
    tokens = spark.createDataFrame([(w, 2) for w in words], "token string, df int")
    lexicon = spark.createDataFrame([(w,) for w in ["run", "hope", "city", "box", "wolf", "woman", "watch", "glass", "walk", "go"]], "token string")
    got = {r.token: r.lemma for r in lemma_table(tokens, lexicon).collect()}
    assert got == {"runs": "run", "hoping": "hope", "cities": "city", "boxes": "box", "wolves": "wolf", "women": "woman",
                   "went": "go", "watches": "watch", "walked": "walk"}


def test_lemmatise_paths_agree(spark):
    data = [(0, "x", ["cats", "ran", "a", "cat", "cats"]), (1, "y", []), (2, "z", ["cat", "dogs"])]
    df = spark.createDataFrame(data, "id bigint, other string, tokens array<string>")
    lemmas = fit_lemmas(df, lexicon=spark.createDataFrame([("cat",)], "token string"))
    a = {r.id: (r.other, r.tokens) for r in lemmatise(df, lemmas).collect()}
    b = {r.id: (r.other, r.tokens) for r in lemmatise(df, lemmas, rows=0).collect()}
    assert a == b == {0: ("x", ["cat", "ran", "cat", "cat"]), 1: ("y", []), 2: ("z", ["cat", "dogs"])}


def test_mean_pool(spark):
    vectors = materialise(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 0.0])], "token string, vector array<float>"))
    data = [(0, ["a", "b"]), (1, ["a", "zz", "a", "b"]), (2, ["zz"]), (3, [])]
    df = spark.createDataFrame(data, "id bigint, tokens array<string>")
    got = {r.id: r.embedding for r in mean_pool(df, vectors, 2).collect()}
    assert got[0] == [2.0, 1.0] and got[1] == pytest.approx([5 / 3, 4 / 3])
    assert got[2] == [0.0, 0.0] and got[3] == [0.0, 0.0]


def test_naive_bayes_by_hand(small):
    vocab = fit_vocabulary(small, ngram_range=(1, 1))
    weights = {r.term: r.weights for r in fit_nb(small, vocab, 2).collect()}
    # Counts: bb 3/0, cc 1/1; totals 4/1; two terms.
    assert weights["bb"] == pytest.approx([-log((1 + 0) / (2 + 1)), -log((1 + 3) / (2 + 4))])
    scored = nb_predict(nb_scores(small, fit_nb(small, vocab, 2), vocab, 2, ["label"]))
    rows = {r.id: r for r in scored.collect()}
    assert rows[1].prediction == 0 and sum(rows[1].probability) == pytest.approx(1.0)
    assert rows[3].scores == [0.0, 0.0] and rows[3].prediction == 0


def test_unknown_and_ties(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0], 0), (1, [1.0, 1.0], 2), (2, [800.0, -800.0], 1)], "id int, scores array<double>, n_tokens int")
    rows = {r.id: r for r in nb_predict(df).collect()}
    assert rows[0].prediction == -1 and rows[0].probability == [0.0, 0.0]
    assert rows[1].prediction == 0 and rows[1].probability == [0.5, 0.5]
    assert rows[2].probability == [1.0, 0.0]
    assert df.select(argmax("scores").alias("a"), softmax("scores").alias("s")).count() == 3


def test_cross_validation_equals_separate_fits(spark, small):
    big = spark.range(60).select(
        "id", (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 3).cast("int").alias("fold"),
        F.array(*[F.concat(F.lit("w"), F.lit(chr(97 + i)), F.when((F.col("id") * (i + 3)) % 7 < 3, F.col("id") % 2).otherwise(5).cast("string"))
                  for i in range(4)]).alias("tokens")).withColumn("tokens", F.transform("tokens", lambda t: F.translate(t, "015", "xyz")))
    vocab = fit_vocabulary(big, ngram_range=(1, 1))
    got = {(r.id, r.alpha): r.predicted for r in nb_cross_validate(big, vocab, 2, alphas=[0.1, 1.0]).collect()}
    for f in range(3):
        for alpha in (0.1, 1.0):
            weights = fit_nb(big.where(F.col("fold") != f), vocab, 2, alpha)
            assert weights.count() == vocab.size  # also the terms these folds lack
            for r in nb_predict(nb_scores(big.where(F.col("fold") == f), weights, vocab, 2)).collect():
                assert got[r.id, alpha] == r.prediction


def test_histogram_edges(spark):
    same = spark.createDataFrame([("a b",), ("c d",)], "text string")
    assert [tuple(r) for r in eda.token_length_histogram(same).collect()] == [(0, 2.0, 2.0, 2)]
    spread = spark.createDataFrame([(" ".join(["w"] * n),) for n in (0, 1, 39, 40)], "text string")
    rows = {r.bin: r.n for r in eda.token_length_histogram(spread).collect()}
    assert len(rows) == 40 and rows[39] == 2 and rows[0] == 1 and rows[5] == 0
    assert eda.token_length_histogram(spread.limit(0)).isEmpty()


def test_box_against_numpy(spark):
    lengths = [1, 2, 2, 3, 4, 4, 5, 50]
    df = spark.createDataFrame([("x", " ".join(["w"] * n)) for n in lengths], "emotion string, text string")
    row = eda.token_length_box(df).first()
    assert [row.q1, row.median, row.q3] == list(np.percentile(lengths, [25, 50, 75]))
    assert (row.whisker_low, row.whisker_high, row.outliers) == (1, 5, 1)
    near = eda.token_length_box(df, approximate=True).first()
    assert near.n_rows == 8 and near.outliers == 1


def test_top_terms_limit_before_shuffle(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("lang").alias("emotion"), F.split("text", " ").alias("tokens"))
    plan = eda.top_terms_per_class(docs)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def _by_lists(spark, texts):
    rows = [(i, i % 3, t.split(" ") if t else [], t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id bigint, label int, tokens array<string>, content string")


def test_terms_by_batch_are_those_of_the_row(spark):
    """Apostrophes, single letters, other alphabets, empty texts; several slices, larger ranges."""
    import pyarrow as pa

    from textloom.functions import term_batches
    from textloom.operators.vocabulary import term_totals

    df = _by_lists(spark, ["aa bb aa bb", "", "don't n't aa x bb", "café aa Bb cc aa", "'aa' bb'cc", "aa", "zz zz zz zz"])
    for grams in ((1, 1), (1, 2), (2, 3)):
        expected = document_frequencies(term_rows(df, [], ngram_range=grams))
        for col in ("tokens", "content"):
            got = term_totals(df, col, grams)
            assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert len(list(term_batches.slices(np.array([5, 0, 5, 9]), 8))) > 1
    one = list(term_batches.counted(pa.array(["aa bb aa", None]), (1, 2)))
    assert [(c.terms[k].as_py(), n) for c in one for k, n in zip(c.codes, c.tf)] == [("aa", 2), ("bb", 1), ("aa bb", 1), ("bb aa", 1)]


def test_terms_and_scores_without_a_row_a_term(spark):
    """Neither counts nor scores take documents apart in Spark: one row a document is shuffled, not one a term."""
    df = _by_lists(spark, ["aa bb", "aa cc cc", "bb cc", "aa bb dd", "dd"] * 4)
    vocab = fit_vocabulary(df, "content", max_df="1.0")
    weights = fit_nb(df, vocab, 3, tokens_col="content")
    scored = nb_scores(df, weights, vocab, 3, ["label"], tokens_col="content")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert scored.count() == 20 and {r.n_tokens for r in scored.collect()} == {1, 2, 3}
    # Rows with the same keys are added up.
    twice = nb_scores(df.union(df), weights, vocab, 3, ["label"], tokens_col="content")
    both = {r.id: r.scores for r in scored.collect()}
    assert all(r.scores == pytest.approx([2 * s for s in both[r.id]]) for r in twice.collect())
    # The sums of the joined terms' weights.
    terms = term_rows(df, ["id"]).join(weights, "term").select("id", "tf", F.posexplode("weights").alias("c", "w"))
    for r in terms.groupBy("id", "c").agg(F.sum(F.col("tf") * F.col("w")).alias("s")).collect():
        assert both[r.id][r.c] == pytest.approx(r.s)
