import pytest
from pyspark.sql import functions as F

from textloom.fixed_values import UNKNOWN_ID
from textloom.operators import evaluate as ev
from textloom.operators.report import confidence_text, one_hot, preview, probability_map, ranked_probabilities, scored_report

NAMES = ["a", "b", "c"]


def frame(spark, pairs):
    return spark.createDataFrame([(i, a, p) for i, (a, p) in enumerate(pairs)], "id int, actual int, predicted int")


def brute(pairs, k):
    n, rows = len(pairs), []
    for c in range(k):
        tp = sum(a == c == p for a, p in pairs)
        fp = sum(a != c == p for a, p in pairs)
        fn = sum(a == c != p for a, p in pairs)
        rows.append((c, tp + fn, tp, fp, fn, n - tp - fp - fn))
    return rows


CASES = {
    "all right": [(0, 0), (1, 1), (2, 2)],
    "one class never predicted": [(0, 0), (1, 0), (1, 0), (2, 2)],
    "one class absent": [(0, 0), (0, 2), (2, 2), (2, 0)],
    "single class": [(1, 1), (1, 1)],
    "with unknown": [(0, UNKNOWN_ID), (0, 0), (1, 2), (2, 2)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_brute_force(spark, name):
    pairs = CASES[name]
    counts = ev.confusion_counts(frame(spark, pairs))
    got = ev.one_vs_rest_counts(counts, NAMES).orderBy("label").collect()
    assert [(r.label, r.support, r.tp, r.fp, r.fn, r.tn) for r in got] == brute(pairs, 3)
    matrix = ev.confusion_matrix(counts, NAMES, with_unknown=True).collect()
    assert len(matrix) == 12 and sum(r.n for r in matrix) == len(pairs)
    overall = {r.metric: r.value for r in ev.overall_metrics(counts, NAMES).collect()}
    accuracy = sum(a == p for a, p in pairs) / len(pairs)
    assert overall["accuracy"] == overall["recall"] == pytest.approx(accuracy, abs=1e-4)
    report = {r.name: r for r in ev.classification_report(counts, NAMES).collect()}
    assert set(report) == {*NAMES, "accuracy", "macro avg", "weighted avg"}
    assert report["weighted avg"].support == len(pairs)
    wide = {r.actual: r for r in ev.confusion_pivot(counts, NAMES).collect()}
    assert set(wide) == {0, 1, 2} and sum(r["a"] + r["b"] + r["c"] for r in wide.values()) == sum(
        p != UNKNOWN_ID for _, p in pairs)


def test_macro_f1_evaluator_matches(spark):
    df = frame(spark, [(0, 0), (0, 1), (1, 1), (2, 0), (2, 2)])
    table = ev.macro_f1(ev.confusion_counts(df), NAMES, digits=9).first()["macro_f1"]
    scored = df.select(F.col("actual").alias("label"), F.col("predicted").cast("double").alias("prediction"))
    assert ev.MacroF1Evaluator().evaluate(scored) == pytest.approx(table)


def test_metrics_per_group_and_evaluation(spark):
    df = frame(spark, [(0, 0), (1, 1), (0, 1), (1, 0)]).withColumn("split", F.when(F.col("id") < 2, "val").otherwise("test"))
    e = ev.Evaluation(df, NAMES, ["split"])
    accuracy = {(r.split, r.metric): r.value for r in e.overall().collect()}
    assert accuracy["val", "accuracy"] == 1.0 and accuracy["test", "accuracy"] == 0.0
    assert e.per_class().count() == 6 and e.confusion().count() == 18 and e.report().count() == 12


def test_weights_and_accuracy(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    assert {r.label: r.weight for r in ev.class_weights(df, 2).collect()} == {0: 8 / 12, 1: 2.0}
    hits = ev.accuracy_by_class(frame(spark, [(0, 0), (0, 1), (0, UNKNOWN_ID), (1, 1)]), NAMES).collect()
    assert {(r.expected, r.correct, r.total, r.accuracy_pct) for r in hits} == {("a", 1, 3, 33.3), ("b", 1, 1, 100.0)}


def test_best_params_first_wins_ties(spark):
    scores = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.7), (1, 0, 0.6), (1, 1, 0.6), (2, 0, 0.1), (2, 1, 0.2)],
                                   "grid_idx int, fold int, score double")
    assert ev.best_params(scores, ["grid_idx"]).first().grid_idx == 0
    assert ev.cv_summary(scores, ["grid_idx"]).where("grid_idx = 1").first()["std"] == 0.0


def test_report_columns(spark):
    df = spark.createDataFrame(
        [(0, "x" * 81, [0.2, 0.5, 0.3], 1, "b"), (1, "y" * 80, [0.4, 0.4, 0.2], 0, "c"), (2, "", [0.0, 0.0, 0.0], -1, "a")],
        "id int, text string, probability array<double>, prediction int, emotion string")
    rows = {r.id: r for r in scored_report(df, NAMES, expected_col="emotion").collect()}
    assert rows[0].preview == "x" * 80 + "…" and rows[1].preview == "y" * 80
    assert (rows[0].confidence_text, rows[0].hit) == ("50.0%", True)
    assert (rows[2].emotion, rows[2].confidence, rows[2].hit) == ("unknown", 0.0, False)
    assert rows[0].probabilities == {"a": 0.2, "b": 0.5, "c": 0.3}
    ranked = ranked_probabilities(df, NAMES).where("id = 1").orderBy("rank").collect()
    assert [r.emotion for r in ranked] == ["a", "b", "c"]
    hot = df.select("id", one_hot("prediction", 3).alias("h"), preview("text").alias("p"), confidence_text(F.lit(0.123)).alias("c"),
                    probability_map("probability", NAMES).alias("m")).orderBy("id").collect()
    assert [r.h for r in hot] == [[0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
