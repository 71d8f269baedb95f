import corpus_pipeline as cp
from test_jaccard import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(cp.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.count())
        if k < 4:
            assert docs.columns == columns, name
        if name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert {r["doc_id"] for r in docs.collect()} == {i for i, _, c in brute(rows, 5, 80) if i == c}
        if name == "personal_data":
            assert docs.where("text LIKE '%@mail%.example.com%'").count() == 0 and docs.where("n_chars <> length(text)").count() == 0
        if name == "mix":
            assert docs.groupBy("doc_id").count().where("count > 2").count() == 0
    assert seen[0] < spark.read.parquet(f"{SF}/documents.parquet").count() and seen[1] < seen[0] and seen[2] == seen[1]
    assert cp.run(spark, SF).count() == seen[-1] == seen[-2]


def test_extra_columns_nulls_and_empty(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, size int"
    rows = [(1, None, None, None, None, 1.0, "r", 1), (None, "x y z", "en", "s", 5, None, None, None), (2, "", "en", "s", 0, 1.0, "r", 2),
            (2, "", "en", "s", 0, 1.0, "r", 2), (3, "word " * 30_000, "en", "t", 150_000, 1.0, "r", 2)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            assert name == "tokens" or out.columns == docs.columns
            out.count()


def test_an_id_with_several_texts(spark):
    word = lambda c, n=40: " ".join(f"{c}{k}" for k in range(n))
    a, x = word("a"), word("x")

    def kept(rows):
        docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return sorted(((r["doc_id"], r["text"]) for r in cp.near_duplicates(spark, docs, SF).collect()), key=str)

    assert kept([(3, a + " more"), (5, a), (5, x)]) == [(3, a + " more"), (5, x)]
    assert len(kept([(5, a), (5, a + " more")])) == 1
    assert kept([(7, a), (5, a), (5, a), (None, a), (None, a), (2, ""), (2, "")]) == sorted(
        [(5, a), (None, a), (None, a), (2, "")], key=str)
