"""Complement naive Bayes from term counts, with cross-validation over its smoothing in one pass."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from textloom.cluster import fits_broadcast, lookup_join, materialise
from textloom.fixed_values import GRIDS, UNKNOWN_ID
from textloom.functions.term_batches import counted, feature_text, lists_of, n_tokens, places
from textloom.operators.vocabulary import Vocabulary, known_terms, term_rows


def class_counts(
    df: DataFrame, vocab: Vocabulary, classes: int, id_col: str = "id", label_col: str = "label",
    tokens_col: str = "tokens", fold_col: str | None = None,
) -> DataFrame:
    """term, (fold,) counts array<bigint> by class id, over the vocabulary. Added up by Arrow batch, a row for each term,
    class and fold of a slice at most; the result has at most max_features (x folds) rows."""
    folds = [fold_col] if fold_col else []
    shared = df.sparkSession.sparkContext.broadcast(known_terms(vocab)[0])
    ngram_range = vocab.ngram_range

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Labels and folds as numbers of their different values, null among them.
            groups = pa.Table.from_arrays([*batch.columns[1:]], names=batch.schema.names[1:])
            kinds = [c.combine_chunks().dictionary_encode(null_encoding="encode") for c in groups.columns]
            width = [max(1, len(k.dictionary)) for k in kinds]
            group = np.zeros(batch.num_rows, np.int64)
            for k, w in zip(kinds, width):
                group = group * w + k.indices.to_numpy(zero_copy_only=False)
            some = int(np.prod(width))
            for c in counted(batch.column(0), ngram_range):
                rows, at, tf = places(c, shared.value)
                keys, back = np.unique(at * some + group[c.first + rows], return_inverse=True)
                own, out = keys % some, []
                for k, w in reversed(list(zip(kinds, width))):
                    out.append(k.dictionary.take(pa.array(own % w)))
                    own = own // w
                n = np.bincount(back, tf, len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [shared.value.take(pa.array(keys // some)), *reversed(out), pa.array(n)], names=["term", *groups.column_names, "tf"])

    rows = df.select(feature_text(df, tokens_col).alias("_features"), label_col, *folds)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (label_col, *folds))
    known = rows.mapInArrow(totals, f"term string, {kinds}, tf long")
    per_class = [F.sum(F.when(F.col(label_col) == c, F.col("tf")).otherwise(0)) for c in range(classes)]
    return known.groupBy("term", *folds).agg(F.array(*per_class).alias("counts"))


def _complement_weights(counts: Column, totals: Column, alpha: float, size: int) -> Column:
    """-ln of the smoothed share of the term in all other classes, per class."""
    all_here = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, b: a + b)
    all_words = F.aggregate(totals, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return F.zip_with(counts, totals, lambda c, n: -F.log(
        (F.lit(alpha) + all_here - c) / (F.lit(alpha * size) + all_words - n)))


def _totals(counts: DataFrame, classes: int) -> Column:
    sums = F.array(*[F.sum(F.get("counts", F.lit(c))) for c in range(classes)])
    return counts.agg(sums.alias("t"))


def fit_nb(
    train: DataFrame, vocab: Vocabulary, classes: int, alpha: float = 1.0, id_col: str = "id",
    label_col: str = "label", tokens_col: str = "tokens",
) -> DataFrame:
    """term, weights array<double> by class id, for every term of the vocabulary."""
    met = class_counts(train, vocab, classes, id_col, label_col, tokens_col)
    none = F.array_repeat(F.lit(0).cast("bigint"), classes)
    counts = materialise(vocab.table.select("term").join(met, "term", "left").withColumn(
        "counts", F.coalesce("counts", none)))
    totals = F.array(*[F.lit(int(n or 0)) for n in _totals(counts, classes).first()["t"]]).cast("array<bigint>")
    return materialise(counts.select("term", _complement_weights(F.col("counts"), totals, alpha, vocab.size).alias("weights")))


def _scored(
    df: DataFrame, weights: DataFrame, keys: list[str], width: int, tokens_col: str, ngram_range: tuple[int, int],
    fold_col: str | None = None,
) -> DataFrame:
    """keys..., scores: sums of the known terms' `width` weights, by the row's fold where there is one. Weights within the
    limits of a broadcast are looked up in the row, by Arrow batch, and one row a document is shuffled; else terms are joined.
    Rows with the same keys are added up."""
    on = ["term", fold_col] if fold_col else ["term"]
    if not fits_broadcast(weights):
        if df.schema[tokens_col].dataType == StringType():
            df = df.withColumn(tokens_col, F.split(tokens_col, " "))
        terms = lookup_join(term_rows(df, keys, tokens_col, ngram_range), weights, on, keys[0], "left")
        part = [F.coalesce(F.sum(F.col("tf") * F.get("weights", F.lit(c))), F.lit(0.0)) for c in range(width)]
        return terms.groupBy(*keys).agg(F.array(*part).alias("scores"))
    table = weights.select("term", (F.col(fold_col) if fold_col else F.lit(0)).alias("fold"), "weights").toArrow()
    by_fold: dict = {}
    for fold in set(table.column("fold").to_pylist()):
        own = table.filter(pc.equal(table.column("fold"), fold)).combine_chunks()
        flat = pa.array(own.column("weights").combine_chunks().flatten()) if own.num_rows else pa.array([], pa.float64())
        by_fold[fold] = (pa.array(own.column("term").to_pylist(), pa.string()), flat.to_numpy().reshape(own.num_rows, width))
    shared = df.sparkSession.sparkContext.broadcast(by_fold)

    @F.arrow_udf("array<double>")
    def add_up(texts: pa.Array, fold: pa.Array) -> pa.Array:
        scores, own = np.zeros((len(texts), width)), fold.to_pylist()
        for c in counted(texts, ngram_range):
            mine = own[c.first:c.first + c.n]
            for f in set(mine) & set(shared.value):
                terms, w = shared.value[f]
                rows, at, tf = places(c, terms)
                here = np.array([x == f for x in mine])
                some = here[rows]
                rows, at, tf = rows[some], at[some], tf[some]
                for k in range(width):
                    scores[c.first:c.first + c.n, k] += np.bincount(rows, tf * w[at, k], c.n)
        return lists_of(np.full(len(texts), width), pa.array(scores.ravel()))

    rows = df.select(*keys, feature_text(df, tokens_col).alias("_features"))
    rows = rows.select(*keys, add_up("_features", F.col(fold_col) if fold_col else F.lit(0)).alias("_s"))
    return rows.groupBy(*keys).agg(F.array(*[F.sum(F.get("_s", F.lit(c))) for c in range(width)]).alias("scores"))


def nb_scores(
    df: DataFrame, weights: DataFrame, vocab: Vocabulary, classes: int, keep: Sequence[str] = (),
    id_col: str = "id", tokens_col: str = "tokens",
) -> DataFrame:
    """id, keep..., n_tokens, scores array<double>."""
    others = [c for c in keep if c != id_col]
    with_size = df.withColumn("n_tokens", n_tokens(df, tokens_col))
    return _scored(with_size, weights, [id_col, *others, "n_tokens"], classes, tokens_col, vocab.ngram_range)


def softmax(scores: Column | str) -> Column:
    col = F.col(scores) if isinstance(scores, str) else scores
    shifted = F.transform(col, lambda s: F.exp(s - F.array_max(col)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b)
    return F.transform(shifted, lambda e: e / total)


def argmax(values: Column | str) -> Column:
    """Position of the largest value, the lowest on ties."""
    col = F.col(values) if isinstance(values, str) else values
    return (F.array_position(col, F.array_max(col)) - 1).cast("int")


def nb_predict(scored: DataFrame) -> DataFrame:
    """Adds prediction and probability. A text without tokens is unknown, with all probabilities 0."""
    empty = F.col("n_tokens") == 0
    return scored.withColumn(
        "prediction", F.when(empty, UNKNOWN_ID).otherwise(argmax("scores"))
    ).withColumn(
        "probability", F.when(empty, F.transform("scores", lambda s: F.lit(0.0))).otherwise(softmax("scores")))


def nb_cross_validate(
    train: DataFrame, vocab: Vocabulary, classes: int, alphas: Sequence[float] = tuple(GRIDS["cnb"]["alpha"]),
    id_col: str = "id", label_col: str = "label", fold_col: str = "fold", tokens_col: str = "tokens",
) -> DataFrame:
    """id, actual, fold, grid_idx, alpha, predicted: every row scored by the models that have not seen it.

    Counts add up, so the training counts of a fold are all counts minus its own: the text is read
    once for the counts and once for the scores, however many folds and grid points there are.
    """
    by_fold = materialise(class_counts(train, vocab, classes, id_col, label_col, tokens_col, fold_col))
    fold_totals = {r[fold_col]: r["t"] for r in by_fold.groupBy(fold_col).agg(
        F.array(*[F.sum(F.get("counts", F.lit(c))) for c in range(classes)]).alias("t")).collect()}
    totals = [sum(t[c] for t in fold_totals.values()) for c in range(classes)]

    spark = train.sparkSession
    fold_type = by_fold.schema[fold_col].dataType.simpleString()
    outside = spark.createDataFrame(
        [(f, [int(a - b) for a, b in zip(totals, t)]) for f, t in fold_totals.items()],
        f"{fold_col} {fold_type}, totals array<bigint>")
    all_counts = by_fold.groupBy("term").agg(
        F.array(*[F.sum(F.get("counts", F.lit(c))) for c in range(classes)]).alias("all"))
    folds = F.array(*[F.lit(f) for f in sorted(fold_totals)])
    grid = all_counts.select("term", "all", F.explode(folds).alias(fold_col)).join(
        by_fold, ["term", fold_col], "left").join(F.broadcast(outside), fold_col)  # one row per fold
    own = F.coalesce("counts", F.array_repeat(F.lit(0).cast("bigint"), classes))
    grid = grid.withColumn("_counts", F.zip_with("all", own, lambda a, b: a - b))
    weights = materialise(grid.select(
        "term", fold_col,
        F.concat(*[_complement_weights(F.col("_counts"), F.col("totals"), a, vocab.size) for a in alphas]).alias("weights"),
    ))
    scored = _scored(train, weights, [id_col, label_col, fold_col], classes * len(alphas), tokens_col, vocab.ngram_range, fold_col)
    points = F.array(*[
        F.struct(F.lit(i).alias("grid_idx"), F.lit(float(a)).alias("alpha"),
                 argmax(F.slice("scores", i * classes + 1, classes)).alias("predicted"))
        for i, a in enumerate(alphas)
    ])
    return scored.select(id_col, F.col(label_col).alias("actual"), fold_col, F.inline_outer(points))
