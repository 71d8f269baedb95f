"""Classifiers by name, and their grids."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame, functions as F

from textloom.fixed_values import GRIDS, SEED
from textloom.operators.boosted_trees import Boost, BoostedTrees, tune as tune_boosting
from textloom.operators.forest import RandomForest
from textloom.operators.linear_svm import fit_calibrated, tune
from textloom.operators.perceptron import Net, Perceptron, TopFeatures, fit_nets, net_model

# Trees go no deeper.
DEEPEST = 30


@dataclass
class TrainingData:
    """label, weight, features and calibration_fold, with the figures the factories need."""

    rows: DataFrame
    n_rows: int
    classes: int
    size: int


@dataclass
class Spec:
    """`estimator` builds what is tuned; `finish` turns the chosen settings into scoring stages. `tune` scores all points
    on all folds (by point, then fold) where models can be trained together, `fit_all` fits all points on the same rows."""

    estimator: Callable[[Mapping, TrainingData], Estimator] | None
    grid: Mapping[str, Sequence] = field(default_factory=dict)
    finish: Callable[[Mapping, TrainingData], list] | None = None
    tune: Callable[[Sequence[Mapping], DataFrame, TrainingData, int], list[list[float]]] | None = None
    fit_all: Callable[[Sequence[Mapping], TrainingData], list[Transformer]] | None = None

    def points(self) -> list[dict]:
        return [dict(zip(self.grid, values)) for values in product(*self.grid.values())]

    def fit(self, params: Mapping, data: TrainingData) -> list:
        if self.finish:
            return self.finish(params, data)
        return [self.estimator(params, data).fit(data.rows)]

    def models(self, points: Sequence[Mapping], data: TrainingData) -> list[Transformer]:
        """What is tuned, fitted with the settings of each point."""
        return self.fit_all(points, data) if self.fit_all else [self.estimator(p, data).fit(data.rows) for p in points]


def reduced(top: int, data: TrainingData) -> TopFeatures:
    """The `top` features that differ most between classes: dense nets cannot take 50,000."""
    return TopFeatures(top, data.size, data.classes)


SVM_PASSES = 5_000


def _svm_calibrated(params: Mapping, data: TrainingData) -> list:
    model, _ = fit_calibrated(data.rows, data.size, data.classes, params.get("C", 1.0), params.get("maxIter", SVM_PASSES))
    return [model]


def _tune_svm(points: Sequence[Mapping], rows: DataFrame, data: TrainingData, folds: int) -> list[list[float]]:
    """All points and folds in one training."""
    passes = {p.get("maxIter", SVM_PASSES) for p in points}
    if len(passes) > 1:
        raise ValueError("the points of an SVM's grid share their maxIter")
    return tune(rows, data.size, data.classes, [p.get("C", 1.0) for p in points], folds, max_iter=passes.pop())


def _forest(params: Mapping, data: TrainingData) -> Estimator:
    depth = params.get("maxDepth", DEEPEST)
    if depth is None or depth > DEEPEST:
        raise ValueError(f"maxDepth {depth}: trees go no deeper than {DEEPEST} here, so name a depth up to that")
    return RandomForest(
        data.size, data.classes, params.get("numTrees", 200), depth,
        # A node is split from minSplit rows on; the children are bounded instead.
        max(1, params.get("minSplit", 5) // 2), SEED)


def boost_of(params: Mapping) -> Boost:
    return Boost(params.get("maxIter", 150), params.get("maxDepth", 5), params.get("stepSize", 0.1))


def _boosting(params: Mapping, data: TrainingData) -> Estimator:
    return BoostedTrees(data.size, data.classes, boost_of(params), SEED)


def _tune_boosting(points: Sequence[Mapping], rows: DataFrame, data: TrainingData, folds: int) -> list[list[float]]:
    """The folds of a point in one training, points that differ in maxIter too."""
    return tune_boosting(rows, data.size, data.classes, [vars(boost_of(p)) for p in points], folds, seed=SEED)


def _net_of(params: Mapping, data: TrainingData) -> tuple[tuple[int, ...], int]:
    """The layers and the number of steps."""
    top, hidden = min(params.get("top", 1_000), data.size), params.get("hidden", 128)
    # The solver is l-bfgs, which has no step size: naming one is an error rather than a setting without effect.
    if "stepSize" in params:
        raise ValueError("stepSize has no effect on this net: vary hidden or maxIter")
    return (top, hidden, hidden // 2, data.classes), params.get("maxIter", 100)


def _perceptron(params: Mapping, data: TrainingData) -> Estimator:
    layers, steps = _net_of(params, data)
    return Pipeline(stages=[reduced(layers[0], data), Perceptron(layers, steps, seed=SEED)])


def _perceptrons(points: Sequence[Mapping], data: TrainingData) -> list[Transformer]:
    """Nets of all points in the same passes; points that differ in maxIter only are one net after fewer or more steps."""
    wanted, out = [_net_of(p, data) for p in points], {}
    for top in {layers[0] for layers, _ in wanted}:
        slicer = reduced(top, data).fit(data.rows)
        steps: dict[tuple[int, ...], set[int]] = {}
        for layers, n in wanted:
            if layers[0] == top:
                steps.setdefault(layers, set()).add(n)
        nets = [Net(layers, tuple(sorted(n))) for layers, n in steps.items()]
        for net, trained in zip(nets, fit_nets(slicer.transform(data.rows), nets, seed=SEED)):
            for n in net.wanted:
                out[net.layers, n] = PipelineModel([slicer, net_model(data.rows.sparkSession, net.layers, trained, n, "reduced", SEED)])
    return [out[key] for key in wanted]


def _complement_nb(params: Mapping, data: TrainingData) -> Estimator:
    return NaiveBayes(modelType="complement", smoothing=params.get("alpha", 1.0), weightCol="weight")


REGISTRY: dict[str, Spec] = {}


def register_model(
    name: str, estimator: Callable[[Mapping, TrainingData], Estimator] | None, grid: Mapping[str, Sequence] | None = None,
    finish: Callable[[Mapping, TrainingData], list] | None = None,
    tune: Callable[[Sequence[Mapping], DataFrame, TrainingData, int], list[list[float]]] | None = None,
    fit_all: Callable[[Sequence[Mapping], TrainingData], list[Transformer]] | None = None,
) -> None:
    REGISTRY[name] = Spec(estimator, dict(grid or {}), finish, tune, fit_all)


def model_spec(name: str) -> Spec:
    if name not in REGISTRY:
        raise ValueError(f"unknown model '{name}', choose from {sorted(REGISTRY)}")
    return REGISTRY[name]


register_model("svm", None, GRIDS["svm"], _svm_calibrated, _tune_svm)
register_model("rf", _forest, GRIDS["rf"])
register_model("gb", _boosting, GRIDS["gb"], tune=_tune_boosting)
register_model("cnb", _complement_nb, GRIDS["cnb"])
# A recurrent net over a sequence of length one has no recurrence, so these names mean the same net.
for _name in ("mlp", "lstm", "gru"):
    register_model(_name, _perceptron, GRIDS["mlp"], fit_all=_perceptrons)


def balanced(rows: DataFrame, label_col: str = "label") -> DataFrame:
    """Adds weight = rows / (classes * rows of the class). Counts go through the driver: one number per class."""
    sizes = {r[0]: r[1] for r in rows.groupBy(label_col).agg(F.count("*")).collect()}
    total = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for c, n in sizes.items():
        weight = F.when(F.col(label_col) == c, total / (len(sizes) * n)).otherwise(weight)
    return rows.withColumn("weight", weight)
