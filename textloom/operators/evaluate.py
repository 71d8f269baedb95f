"""Metrics. Predictions collapse to at most classes^2 counts per group; all else derives from those.

Predictions are rows of (by..., actual, predicted) with class ids. `predicted` may also be the id of
`unknown`, which is never right but stays in every denominator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.cluster import materialise
from textloom.fixed_values import EMOTIONS, GOOD_F1, UNKNOWN_ID
from textloom.operators.lookups import id_to_name, predicted_name


def confusion_counts(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return predictions.groupBy(*by, "actual", "predicted").agg(F.count("*").alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion_matrix(
    counts: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = (), with_unknown: bool = False
) -> DataFrame:
    """by..., actual, predicted, names, n, row_pct; every cell present, 0 for empty ones."""
    ids = [F.lit(i) for i in range(len(labels))]
    shown = ids + ([F.lit(UNKNOWN_ID)] if with_unknown else [])
    groups = counts.select(*by).distinct() if by else counts.sparkSession.range(1).select()
    grid = groups.withColumn("actual", F.explode(F.array(*ids))).withColumn("predicted", F.explode(F.array(*shown)))
    cells = grid.join(counts, [*by, "actual", "predicted"], "left")
    n = F.coalesce("n", F.lit(0))
    row = Window.partitionBy(*by, "actual")
    return cells.select(
        *by, "actual", "predicted",
        id_to_name("actual", labels).alias("actual_name"),
        predicted_name("predicted", labels).alias("predicted_name"),
        n.alias("n"), F.round(_ratio(n, F.sum(n).over(row)), 4).alias("row_pct"),
    )


def confusion_pivot(counts: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = ()) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    matrix = confusion_matrix(counts, labels, by)
    return matrix.groupBy(*by, "actual", "actual_name").pivot("predicted_name", list(labels)).agg(F.sum("n"))


def one_vs_rest_counts(
    counts: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = ()
) -> DataFrame:
    """by..., label, emotion, support, tp, fp, fn, tn; every class present, also one never met."""
    hit = F.col("actual") == F.col("predicted")
    roles = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                 F.when(hit, F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("bigint").alias("named")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"),
                 F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("named")),
    )
    every = F.transform(F.array(*[F.lit(i) for i in range(len(labels))]), lambda i: F.struct(
        i.alias("label"), F.lit(0).cast("bigint").alias("support"),
        F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("named")))
    sums = (
        counts.select(*by, "n", F.inline(F.concat(roles, every)))
        .groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("support", "tp", "named")])
    )
    total = F.sum("support").over(Window.partitionBy(*by))
    c = F.col
    return (
        sums.withColumn("_total", total).where(c("label").between(0, len(labels) - 1))
        .select(
            *by, "label", id_to_name("label", labels).alias("emotion"), "support", "tp",
            (c("named") - c("tp")).alias("fp"), (c("support") - c("tp")).alias("fn"),
            (c("_total") - c("support") - c("named") + c("tp")).alias("tn"),
        )
    )


def _class_rates() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return {
        "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn),
        "f1": _ratio(tp * 2, tp * 2 + fp + fn),
        "sensitivity": _ratio(tp, tp + fn), "specificity": _ratio(tn, tn + fp),
    }


def per_class_metrics(counts: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = ()) -> DataFrame:
    rates = _class_rates()
    return one_vs_rest_counts(counts, labels, by).select(
        "*", *[F.round(v, 4).alias(k) for k, v in rates.items()],
        (rates["f1"] >= GOOD_F1).alias("good_f1"),
    )


def _averages(counts: DataFrame, labels: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per group with every scalar, unrounded but for the rates that are averaged rounded."""
    rates = _class_rates()
    n = F.sum("support")

    def weighted(rate: Column) -> Column:
        return F.sum(rate * F.col("support")) / n

    per_class = one_vs_rest_counts(counts, labels, by)
    return per_class.groupBy(*by).agg(
        n.alias("support"),
        (F.sum("tp") / n).alias("accuracy"),
        weighted(rates["precision"]).alias("precision"),
        weighted(rates["recall"]).alias("recall"),
        weighted(F.round(rates["sensitivity"], 4)).alias("sensitivity"),
        weighted(F.round(rates["specificity"], 4)).alias("specificity"),
        weighted(rates["f1"]).alias("f1_weighted"),
        *[F.avg(rates[k]).alias(f"macro_{k}") for k in ("precision", "recall", "f1")],
    )


def _long(df: DataFrame, names: list[str], by: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.round(m, 4).alias("value")) for m in names])
    return df.select(*by, F.inline(pairs))


OVERALL = ["accuracy", "precision", "recall", "sensitivity", "specificity", "f1_weighted"]


def overall_metrics(counts: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = ()) -> DataFrame:
    return _long(_averages(counts, labels, by), OVERALL, by)


def weighted_metrics(counts: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = ()) -> DataFrame:
    return _averages(counts, labels, by).select(*by, *[F.round(m, 4).alias(m) for m in OVERALL[1:]])


def macro_f1(counts: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    return _averages(counts, labels, by).select(*by, F.round("macro_f1", digits).alias("macro_f1"))


def classification_report(counts: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = ()) -> DataFrame:
    """name, precision, recall, f1, support: the classes, then accuracy, macro avg and weighted avg."""
    classes = per_class_metrics(counts, labels, by).select(
        *by, F.col("emotion").alias("name"), "precision", "recall", "f1", "support")
    none = F.lit(None).cast("double")
    rows = F.array(*[
        F.struct(F.lit(name).alias("name"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                 F.col("support").alias("support"))
        for name, p, r, f in [
            ("accuracy", none, none, F.round("accuracy", 4)),
            ("macro avg", *[F.round(f"macro_{k}", 4) for k in ("precision", "recall", "f1")]),
            ("weighted avg", F.round("precision", 4), F.round("recall", 4), F.round("f1_weighted", 4)),
        ]
    ])
    return classes.unionByName(_averages(counts, labels, by).select(*by, F.inline(rows)))


def accuracy_by_class(predictions: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = ()) -> DataFrame:
    """expected, correct, total, accuracy_pct. Plain sums, so it also runs on a stream in complete mode."""
    hit = F.when(F.col("actual") == F.col("predicted"), 1).otherwise(0)
    return (
        predictions.groupBy(*by, id_to_name("actual", labels).alias("expected"))
        .agg(F.sum(hit).alias("correct"), F.count("*").alias("total"))
        .withColumn("accuracy_pct", F.round(F.col("correct") * 100.0 / F.col("total"), 1))
    )


def class_weights(df: DataFrame, classes: int, label_col: str = "label") -> DataFrame:
    """label, n, weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn("weight", total / (F.col("n") * F.lit(float(classes))))


def fold_scores(predictions: DataFrame, labels: Sequence[str], model: Sequence[str], fold_col: str = "fold") -> DataFrame:
    """Macro F1 per model setting and fold."""
    by = [*model, fold_col]
    return macro_f1(confusion_counts(predictions, by), labels, by, digits=12).withColumnRenamed("macro_f1", "score")


def cv_summary(scores: DataFrame, model: Sequence[str]) -> DataFrame:
    return scores.groupBy(*model).agg(
        F.count("*").alias("folds"),
        F.round(F.avg("score"), 4).alias("mean"), F.round(F.stddev_pop("score"), 4).alias("std"))


def best_params(scores: DataFrame, model: Sequence[str], order: str = "grid_idx") -> DataFrame:
    """The setting with the best mean score, the first in grid order on ties."""
    mean = scores.groupBy(*model).agg(F.round(F.avg("score"), 6).alias("mean_score"))
    return mean.orderBy(F.desc("mean_score"), order).limit(1)


def macro_f1_of(counts: Sequence[tuple[int, int, int]]) -> float:
    """Of (actual, predicted, n), at most classes² of them, over the classes met."""
    f1 = []
    for c in {a for a, _, _ in counts} | {p for _, p, _ in counts}:
        tp = sum(n for a, p, n in counts if a == p == c)
        f1.append(2 * tp / sum(n * ((a == c) + (p == c)) for a, p, n in counts))
    return sum(f1) / len(f1) if f1 else 0.0


class MacroF1Evaluator(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Plain mean of the class F1 scores. Spark's own `f1` is weighted by class size."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        pairs = dataset.select(
            F.col(self.getLabelCol()).cast("int").alias("actual"),
            F.col(self.getPredictionCol()).cast("int").alias("predicted"))
        return macro_f1_of([(a, p, n) for a, p, n in confusion_counts(pairs).collect()])

    def isLargerBetter(self) -> bool:
        return True


class Evaluation:
    """All metric tables of one set of predictions, from counts computed once."""

    def __init__(self, predictions: DataFrame, labels: Sequence[str] = EMOTIONS, by: Sequence[str] = ()):
        self.counts = materialise(confusion_counts(predictions, by))
        self.labels, self.by = list(labels), list(by)

    def overall(self) -> DataFrame:
        return overall_metrics(self.counts, self.labels, self.by)

    def per_class(self) -> DataFrame:
        return per_class_metrics(self.counts, self.labels, self.by)

    def confusion(self) -> DataFrame:
        return confusion_matrix(self.counts, self.labels, self.by)

    def report(self) -> DataFrame:
        return classification_report(self.counts, self.labels, self.by)
