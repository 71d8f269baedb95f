import numpy as np

from textloom.llm import queries
from textloom.llm.language import fit_languages, predict_languages


def test_held_out_accuracy_and_cases(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op1_language_mixture(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "lang", "crc32(cast(doc_id AS string)) % 4 = 2 AS held").collect()
    held = [d for d in docs if d["held"]]
    assert len(got) == len(docs) and all(got[d["doc_id"]]["held_out"] == d["held"] for d in docs)
    assert np.mean([got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_mixtures_and_odd_rows(spark):
    en, fr = "the cat and the other thing that they were thinking of ", "le chat est dans la maison avec les autres choses "
    train = spark.createDataFrame([(en * 20, "en"), (fr * 20, "fr"), (None, "de"), ("x", None)], "text string, lang string")
    model = fit_languages(train)
    assert model.languages == ["en", "fr"]
    rows = [(1, en), (2, None), (3, "12 !?"), (4, en * 3 + fr * 3), (4, en * 3 + fr * 3), (None, fr * 3000), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' AS score", "'z' AS lang_pred")
    got = {}
    for r in predict_languages(df, model).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert got[1][0]["lang_pred"] == "en" and got[1][0]["score"] == 1.0 and got[None][0]["lang_pred"] == "fr"
    assert all((r["lang_pred"], r["score"], r["mixture"]) == ("und", 0.0, {}) for k in (2, 3, 5) for r in got[k])
    assert len(got[4]) == 2 and set(got[4][0]["mixture"]) == {"en", "fr"} and 0.35 < got[4][0]["score"] < 0.65
    assert predict_languages(df.limit(0), model).count() == 0
    empty = fit_languages(train.limit(0))
    assert predict_languages(df, empty).where("lang_pred <> 'und'").count() == 0


def test_copies_count_once(spark):
    fr = [f"le chat numero {w} est dans la maison avec les autres choses" for w in ("un", "deux", "trois")]
    en = [f"the cat and the other thing {w} that they were thinking of" for w in ("ab", "cd", "ef", "gh", "ij", "kl")]
    hot = "zzz qqq zzz qqq zzz xxx zzz qqq " * 4
    once = spark.createDataFrame([(t, "fr") for t in fr] + [(t, "en") for t in [*en, hot]], "text string, lang string")
    copies = once.selectExpr("*", f"explode(sequence(1, CASE WHEN lang = 'fr' THEN 10000 WHEN text = '{hot}' THEN 5000 ELSE 1 END)) AS k")
    one, many = fit_languages(once), fit_languages(copies.repartition(4))
    assert one.languages == many.languages == ["en", "fr"]
    assert np.array_equal(one.log_likelihood, many.log_likelihood)
    assert (many.log_likelihood.std(axis=1) > 0).all()
