from types import SimpleNamespace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from textloom.functions import with_tokens
from textloom.operators.embed import fit_word2vec, mean_pool, word_vectors
from textloom.operators.lemma import LemmaMap, fit_lemmas, lemmatise
from textloom.operators.split import fit_folds, fit_split
from textloom.operators.stages import TermMaker, TextCleaner
from textloom.operators.vocabulary import fit_vocabulary
from textloom.plans.registry import model_spec, register_model
from textloom.plans.train import (
    grid_search, history, load_preferred, save_model, score, sweep, text_model, text_stages, tfidf_data,
    train_model, word2vec_data, word2vec_stages,
)
from textloom.fixed_values import EMOTIONS, UNKNOWN
from textloom.sources import synthetic_corpus
from textloom.streaming.score import score_stream

LIGHT = {"svm": {"maxIter": 10}, "rf": {"numTrees": 10, "maxDepth": 8}, "gb": {"maxIter": 3, "maxDepth": 3},
         "mlp": {"top": 60, "hidden": 16, "maxIter": 40}, "cnb": {}}


@pytest.fixture(scope="module")
def ready(spark):
    corpus = with_tokens(synthetic_corpus(spark.range(480))).cache()
    split = fit_split(corpus).transform(corpus)
    train = split.where("split = 'train'")
    vocab = fit_vocabulary(train, max_features=200)
    return split, train, vocab, tfidf_data(train, vocab, 6)


@pytest.mark.parametrize("name", LIGHT)
def test_beats_the_majority_class(spark, ready, name, tmp_path):
    split, train, vocab, data = ready
    trained = train_model(name, data, LIGHT[name])
    model = text_model(text_stages(vocab), trained, EMOTIONS)
    held = split.where("split <> 'train'").select("id", "text", "label")
    extra = spark.createDataFrame([(-1, " 12 ?! ", 0)], "id bigint, text string, label int")
    scored = score(held.unionByName(extra), model).cache()
    known = scored.where("id >= 0")
    hits = known.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert hits > 1 / 6 + 0.3
    totals = [r[0] for r in known.select(F.aggregate("probability", F.lit(0.0), lambda a, b: a + b)).collect()]
    assert totals == pytest.approx([1.0] * len(totals))
    blank = scored.where("id = -1").first()
    assert (blank.emotion, blank.prediction, sum(blank.probability)) == (UNKNOWN, -1, 0.0)

    saved = PipelineModel.load(save_model(model, str(tmp_path), name))
    columns = ["id", "prediction", "emotion"]
    assert score(held.repartition(5), saved).select(columns).exceptAll(known.select(columns)).isEmpty()


def test_preferred_model_and_stream(spark, ready, tmp_path):
    split, _, vocab, data = ready
    with pytest.raises(FileNotFoundError):
        load_preferred(spark, str(tmp_path))
    save_model(text_model(text_stages(vocab), train_model("rf", data, LIGHT["rf"]), EMOTIONS), str(tmp_path), "rf")
    model = load_preferred(spark, str(tmp_path))
    rows = split.select("id", "text")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    score_stream(stream, model, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).select("id", "emotion")
    assert streamed.count() == rows.count()
    assert streamed.exceptAll(score(rows, model).select("id", "emotion")).isEmpty()


def test_grid_search_and_sweep(ready):
    _, _, _, data = ready
    tuned = grid_search("rf", data, points=[{"numTrees": 1, "maxDepth": 1}, {"numTrees": 20, "maxDepth": 8}], folds=3)
    assert tuned.params == {"numTrees": 20, "maxDepth": 8}
    rows = {r.grid_idx: r.mean for r in tuned.scores.collect()}
    assert rows[1] > rows[0]
    swept = sweep("mlp", data, [{"hidden": 8}, {"hidden": 16}], fixed={"top": 60, "maxIter": 20})
    scores = [r.accuracy for r in swept.scores.orderBy("grid_idx").collect()]
    assert swept.params["hidden"] == (8 if scores[0] >= scores[1] else 16)


def test_sweep_points_are_different_models(ready):
    _, _, _, data = ready
    weights = []
    for point in [{"hidden": h, "maxIter": m} for h in (8, 16) for m in (2, 6)]:
        net = train_model("mlp", data, {"top": 60, **point}).stages[-1]
        weights.append(tuple(net.stages[-1].weights.toArray()))
    assert len(set(weights)) == 4
    for name, wrong in (("mlp", {"stepSize": 0.1}), ("rf", {"maxDepth": 40})):
        with pytest.raises(ValueError):
            train_model(name, data, wrong)


def test_copies_stay_in_one_fold(spark, ready):
    split, train, vocab, _ = ready
    copies = train.unionByName(train.withColumn("id", F.col("id") + 10_000))
    rows = tfidf_data(copies, vocab, 6).rows
    folds = fit_folds(rows, key_col="content_key", group_by_content=True).transform(rows, "fold")
    for out in ("fold", "calibration_fold"):
        assert folds.groupBy("content_key").agg(F.count_distinct(out).alias("n")).where("n > 1").isEmpty()


def test_registry(ready, spark):
    _, _, _, data = ready
    with pytest.raises(ValueError, match="unknown model"):
        model_spec("nope")
    assert [len(model_spec(n).points()) for n in ("svm", "rf", "gb", "cnb")] == [4, 12, 12, 3]
    from pyspark.ml.classification import LogisticRegression

    register_model("lr", lambda p, d: LogisticRegression(maxIter=10, weightCol="weight"))
    trained = train_model("lr", data)
    losses = [r.loss for r in history(spark, trained.stages).orderBy("iteration").collect()]
    assert len(losses) > 1 and losses[-1] < losses[0]


def test_stages_match_operators(spark, ready):
    split, train, vocab, data = ready
    got = PipelineModel(text_stages(vocab)).transform(train.select("id", "text")).select("id", F.col("features").alias("f"))
    for r in got.join(data.rows, "id").collect():
        assert abs(r.f.toArray() - r.features.toArray()).max() < 1e-12


def test_lemmas_in_the_pipeline(spark):
    df = spark.createDataFrame([(0, "Cats walked homes"), (1, "the cat walk home"), (2, "a cat walk home x"), (3, "")], "id bigint, text string")
    tokens = with_tokens(df, min_token_len=1)
    lemmas = fit_lemmas(tokens)
    vocab = fit_vocabulary(lemmatise(tokens, lemmas), max_df="1.0")
    stage = text_stages(vocab, lemmas=lemmas)[0]
    a = {r.id: r.tokens for r in stage.transform(df).collect()}
    b = {r.id: r.tokens for r in lemmatise(tokens, lemmas).collect()}
    assert a == b and a[0] == ["cat", "walk", "home"] and a[3] == []


def test_lemma_map(spark):
    words = {"cats": "cat", "ran": "run", "mice": "mouse", "é": "e", "a" * 500: "a", "running": "run", "zz": "", "better": "good"}
    table = spark.createDataFrame(list(words.items()), "token string, lemma string")
    known = LemmaMap.of(table)
    assert {w: known.get(w) for w in words} == words and len(known) == len(words)
    assert [known.get(w) for w in ("cat", "", "aaa", "zzz", "É")] == ["cat", "", "aaa", "zzz", "É"]
    assert LemmaMap.of(table.limit(0)).get("cats") == "cats"
    big = LemmaMap.of(spark.range(300_000).selectExpr("concat('w', id, 's') AS token", "concat('w', id) AS lemma"))
    assert [big.get(f"w{k}s") for k in (0, 7, 299_999)] == ["w0", "w7", "w299999"] and len(big.forms) == 1


def test_lemma_map_has_a_bound(spark, monkeypatch):
    import textloom.operators.lemma as module

    monkeypatch.setattr(module, "MAP_BYTES", 10)
    with pytest.raises(ValueError, match="too many"):
        LemmaMap.of(spark.createDataFrame([("cats", "cat")], "token string, lemma string"))


def test_saved_lemmas_in_a_stream(spark, tmp_path):
    """The table of lemmas is saved with the model, and a stream gives the tokens of a batch."""
    df = spark.createDataFrame([(k, f"cats walked home{'s' * (k % 2)} the cat walk home") for k in range(40)] + [(40, None)],
                               "id bigint, text string")
    lemmas = fit_lemmas(with_tokens(df, min_token_len=1))
    model = PipelineModel([TextCleaner(lemmas), TermMaker()])
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    df.write.parquet(str(tmp_path / "in"))
    stream = again.transform(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).select("id", "tokens")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = {r.id: r.tokens for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {r.id: r.tokens for r in lemmatise(with_tokens(df, min_token_len=1), lemmas).collect()}
    assert got[1] == ["cat", "walk", "home", "cat", "walk", "home"] and got[40] == []
    plain = PipelineModel([TextCleaner()])
    plain.write().overwrite().save(str(tmp_path / "plain"))
    assert PipelineModel.load(str(tmp_path / "plain")).transform(df).where("id = 1").first().tokens[0] == "cats"


def test_word2vec(spark, ready, tmp_path):
    split, train, _, _ = ready
    model = fit_word2vec(train, vector_size=8, epochs=1, partitions=1)
    model.write().overwrite().save(str(tmp_path / "w2v"))
    from pyspark.ml.feature import Word2VecModel

    model = Word2VecModel.load(str(tmp_path / "w2v"))
    odd = spark.createDataFrame([(0, "cheerful zzzz qqqq cheerful furious"), (1, "zzzz"), (2, "")], "id bigint, text string")
    by_stage = {r.id: r.features.toArray() for r in PipelineModel(word2vec_stages(model)).transform(odd).collect()}
    pooled = {r.id: r.embedding for r in mean_pool(with_tokens(odd), word_vectors(model), 8).collect()}
    for i in range(3):
        assert by_stage[i] == pytest.approx(pooled[i], abs=1e-5)
    assert any(pooled[0]) and not any(pooled[1])
    data = word2vec_data(train, model, 6)
    fitted = text_model(word2vec_stages(model), train_model("rf", data, LIGHT["rf"]), EMOTIONS)
    assert score(split.limit(5).select("id", "text"), fitted).count() == 5


def test_boosting_queries_run_all_rounds(spark, ready, monkeypatch):
    """`boosting_curves` and `train_gb` train with the library's settings."""
    from textloom.plans import model_queries, registry, train

    wanted, found = vars(registry.boost_of({})), []
    prepared = SimpleNamespace(data=ready[3], model=lambda trained: trained)
    monkeypatch.setattr(model_queries, "Prepared", lambda spark, sf_dir: prepared)
    monkeypatch.setattr(train, "boosting_rounds", lambda rows, size, classes, model, seed: found.append(model) or spark.createDataFrame(
        [(0, 1.0, 1.0, 0.5, 0.5)], "iteration int, loss double, val_loss double, accuracy double, val_accuracy double"))
    model_queries.boosting_curves(spark, "")
    assert [vars(m) for m in found] == [wanted] and wanted["rounds"] == 150
    monkeypatch.undo()
    monkeypatch.setattr(registry, "BoostedTrees", lambda size, classes, model, seed: SimpleNamespace(fit=lambda rows: found.append(model)))
    model_queries.Prepared.fit(prepared, "gb")
    assert [vars(m) for m in found] == [wanted] * 2
