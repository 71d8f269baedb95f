import numpy as np

from textloom.llm import queries
from textloom.llm.quality import AdditiveModel, fit_additive, fit_quality, keep_good, score_quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op7_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.85
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_interaction_is_learned():
    r = np.random.default_rng(0)
    x = r.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    model = fit_additive(x, y)
    assert np.mean((model.score(x) > 0.5) == y) > 0.95
    again = fit_additive(x[::-1], y[::-1])
    assert np.array_equal(model.score(x), again.score(x))  # the order of rows doesn't matter


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (2, "", 1.0), (None, "abc " * 9000, 2.0)], "doc_id long, text string, score double")
    for labels in ([], [(1, 1), (2, None), (None, 0)]):
        model = fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        got = score_quality(docs, model, keep={"doc_id": docs["doc_id"]}).collect()
        assert len(got) == 4 and len({r["score"] for r in got}) == 1
    kept = keep_good(docs, AdditiveModel(intercept=-9.0))
    assert kept.columns == docs.columns and kept.count() == 0 and keep_good(docs, AdditiveModel()).count() == 4
    assert score_quality(docs.limit(0), AdditiveModel()).count() == 0


def test_rows_are_bounded_where_an_id_repeats(spark, monkeypatch):
    from textloom.llm import quality

    seen = []
    monkeypatch.setattr(quality, "fit_additive", lambda x, y: seen.append(len(x)))
    docs = spark.range(3000).selectExpr("1L AS doc_id", "concat('text ', id) AS text")
    fit_quality(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), max_rows=10)
    fit_quality(docs.limit(7), spark.createDataFrame([(1, 1)], "doc_id long, quality int"), max_rows=10)
    assert seen == [10, 7]
