import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from textloom.functions import clean_text, feature_tokens, ngrams, normalise_text, term_counts, tokenise, with_tokens, word_count

GOLDEN = [
    ("I'm SO happy :D", "i'm so happy d"),
    ("see https://a.co/x :)", "see https confused a co x happy"),
    ("www.site.com/a b", "b"),
    ("I love it <3", "i love it love"),
    ("broken </3", "broken heartbroken"),
    (">:( grr :(", "angry grr sad"),
    ("<p>sad</p>", "sad"),
    ("5 < 6 and 7 > 2", ""),
    ("room 101", "room"),
    ("don''t", "don't"),
    ("axdb", "a laughing b"),
    ("   ", ""),
    (None, ""),
    ("www.a b  c", "b c"),
    ("a < b", "a b"),
    ("x<y <b>z</b> <open", "x z open"),
]


@pytest.mark.parametrize("column", ["normalised"])
def test_golden_rows(spark, column):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(GOLDEN)], "id int, text string")
    rows = df.select("id", normalise_text("text").alias(column)).orderBy("id").collect()
    assert [r[column] for r in rows] == [b for _, b in GOLDEN]


TOKENS = [
    ("can't", ["ca", "n't"]),
    ("they'll've", ["they'll", "'ve"]),
    ("it's he's", ["it", "'s", "he", "'s"]),
    ("i'm you're we've he'd", ["i", "'m", "you", "'re", "we", "'ve", "he", "'d"]),
    ("cannot gonna gotta lemme gimme wanna go", ["can", "not", "gon", "na", "got", "ta", "lem", "me", "gim", "me", "wan", "na", "go"]),
    ("'tis 'twas", ["'t", "is", "'t", "was"]),
    ("the dogs' tail", ["the", "dogs", "'", "tail"]),
    ("plain words", ["plain", "words"]),
    ("", []),
]


def test_tokens(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(TOKENS)], "id int, n string")
    rows = df.select("id", tokenise("n").alias("t")).orderBy("id").collect()
    assert [r["t"] for r in rows] == [b for _, b in TOKENS]


def test_options(spark):
    df = spark.createDataFrame([("I am not very happy, no, we're fine",)], "text string")

    def run(**options):
        return with_tokens(df, **options).first()["tokens"]

    assert run() == ["not", "very", "happy", "no", "'re", "fine"]
    assert run(custom_stopwords=["happy", "no"]) == ["not", "very", "no", "'re", "fine"]  # preserved words stay
    assert run(remove_stopwords=False, min_token_len=1)[:2] == ["i", "am"]
    assert run(min_token_len=5) == ["happy"]


def test_cleaning_stays_in_the_jvm(spark, sf):
    df = with_tokens(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    plan = df.select("doc_id", "tokens")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_many_open_brackets_stay_linear(spark):
    import time

    df = spark.createDataFrame([("<a " * 300_000,)], "text string")
    start = time.time()
    df.select(normalise_text("text").alias("n")).select(F.length("n")).collect()
    assert time.time() - start < 30


def test_terms(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b", "a"],), ([],), (["x"],)], "t array<string>")
    rows = df.select(
        ngrams("t").alias("g"), ngrams("t", (2, 3)).alias("h"),
        term_counts("t").alias("c"), term_counts(ngrams("t")).alias("gc")).collect()
    assert rows[0]["g"] == ["a", "b", "a", "b", "a", "a b", "b a", "a b", "b a"]
    assert rows[0]["h"] == ["a b", "b a", "a b", "b a", "a b a", "b a b", "a b a"]
    assert [tuple(x) for x in rows[0]["c"]] == [("a", 3), ("b", 2)]
    assert [tuple(x) for x in rows[0]["gc"]] == [("a", 3), ("a b", 2), ("b", 2), ("b a", 2)]
    assert rows[1]["g"] == [] and rows[1]["c"] == [] and rows[2]["gc"][0]["term"] == "x"


def test_feature_tokens_and_counts(spark):
    df = spark.createDataFrame([("ca n't 's a bc",), (None,), (" \t x y z ",)], "t string")
    rows = df.select(feature_tokens("t").alias("f"), word_count("t").alias("n")).collect()
    assert rows[0]["f"] == ["ca", "bc"]
    assert [r["n"] for r in rows] == [5, 0, 3]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abxdwD<>/:)(' .=3;-p\tPé\U0001F600")), max_size=60), min_size=5, max_size=20))
def test_output_alphabet(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for (n,) in df.select(normalise_text("text")).collect():
        assert set(n) <= set("abcdefghijklmnopqrstuvwxyz' ") and "  " not in n and "''" not in n and n == n.strip()


def test_clean_text_joins(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(clean_text("t")).collect()] == ["a b", ""]


def test_fold_negation(spark):
    from textloom.operators.stages import TextCleaner
    from textloom.operators.vocabulary import terms_of

    df = spark.createDataFrame([(1, "I don't like it, can't you see? n't"), (2, "not bad"), (3, "")], "id int, text string")
    kept = {r.id: r.tokens for r in with_tokens(df).collect()}
    folded = with_tokens(df, fold_negation=True)
    assert {r.id: r.tokens for r in folded.collect()} == {k: ["not" if t == "n't" else t for t in v] for k, v in kept.items()}
    assert "n't" in kept[1] and kept[2] == ["not", "bad"] and kept[3] == []
    terms = {r.id: r.t for r in folded.select("id", terms_of("tokens", (1, 1)).alias("t")).collect()}
    assert terms[1].count("not") == kept[1].count("n't")
    staged = {r.id: r.tokens for r in TextCleaner(foldNegation=True).transform(df).collect()}
    assert staged == {r.id: r.tokens for r in folded.collect()}


def test_rare_replacements_run_only_where_needed(spark):
    """Guards leave out no replacement: every run of four of the characters that emoticons have, and of two-part words."""
    from functools import reduce
    from itertools import product

    from pyspark.sql import functions as F

    from textloom.functions import cleaning

    parts = [":", "-", ")", "(", "=", "<", "/", "3", "x", "d", ";", ">", "✂"]
    texts = ["".join(p) for p in product(parts, repeat=4)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(f" {pair[1]} ")), cleaning.LONGEST_EMOTICONS_FIRST, F.col("t"))
    symbols = F.regexp_replace("t", f"[{cleaning.SYMBOL_RANGES}]+", " ")
    assert df.where((plain != cleaning.replace_emoticons(F.col("t"))) | (symbols != cleaning.remove_symbols(F.col("t")))).isEmpty()
    plan = df.select(cleaning.replace_emoticons(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in plan
    words = spark.createDataFrame([("i cannot 'tis d'ye gimme gonna gotta lemme more'n wanna go wanna",)], "n string")
    assert words.select(cleaning.tokenise("n")).first()[0] == (
        "i can not 't is d 'ye gim me gon na got ta lem me more 'n wan na go wan na".split())
