"""Binary classifiers, one per class, with their margins turned into probabilities (`linear_svm` has SVMs of its own).

Spark's OneVsRest trains them side by side. Its model, though, scores through Python functions and
gives no probabilities, so the binary models are taken out and become stages of their own.
"""

from __future__ import annotations

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import OneVsRest
from pyspark.sql import DataFrame

from textloom.operators.stages import MarginProbability


def fit_binary(df: DataFrame, classifier: Estimator, prefix: str, parallelism: int) -> list[Transformer]:
    """A model per class; model c writes the columns {prefix}_{c} (margins) and {prefix}_{c}_class."""
    weighted = classifier.hasParam("weightCol") and classifier.isSet("weightCol")
    trainer = OneVsRest(
        classifier=classifier, featuresCol=classifier.getFeaturesCol(), parallelism=parallelism,
        weightCol=classifier.getWeightCol() if weighted else None)
    models = trainer.fit(df).models
    for c, m in enumerate(models):
        m.set(m.rawPredictionCol, f"{prefix}_{c}")
        m.set(m.predictionCol, f"{prefix}_{c}_class")
        if m.hasParam("probabilityCol"):
            m.set(m.getParam("probabilityCol"), f"{prefix}_{c}_share")
    return models


def margin_columns(prefix: str, classes: int) -> list[str]:
    return [f"{prefix}_{c}" for c in range(classes)]


class OneVsRestMargins(Estimator):
    """Fits to a pipeline whose probability of a class is the sigmoid of slope x margin, scaled to sum to 1."""

    def __init__(self, classifier: Estimator, slope: float = 1.0, parallelism: int = 4):
        super().__init__()
        self.classifier, self.slope, self.parallelism = classifier, slope, parallelism

    def _fit(self, df: DataFrame) -> PipelineModel:
        models = fit_binary(df, self.classifier, "_margin", self.parallelism)
        k = len(models)
        return PipelineModel([*models, MarginProbability(
            marginCols=margin_columns("_margin", k), classes=k, slopes=[self.slope] * k, offsets=[0.0] * k)])
