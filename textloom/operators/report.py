"""What the scorer shows: previews, confidences, ranked classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from textloom.fixed_values import EMOTIONS, PREVIEW_CHARS, UNKNOWN_ID
from textloom.operators.lookups import predicted_name


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def preview(text: Column | str, chars: int = PREVIEW_CHARS) -> Column:
    col = _col(text)
    return F.when(F.length(col) > chars, F.concat(F.substring(col, 1, chars), F.lit("…"))).otherwise(col)


def confidence(probability: Column | str, prediction: Column | str) -> Column:
    """Probability of the predicted class; 0 for an unknown text."""
    return F.when(_col(prediction) == UNKNOWN_ID, 0.0).otherwise(F.get(_col(probability), _col(prediction)))


def confidence_text(share: Column | str) -> Column:
    return F.format_string("%.1f%%", _col(share) * 100)


def one_hot(prediction: Column | str, classes: int) -> Column:
    """Probabilities for a model that gives none."""
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == _col(prediction)).cast("double"))


def probability_map(probability: Column | str, labels: Sequence[str] = EMOTIONS) -> Column:
    """Class name -> probability, 4 decimals."""
    return F.map_from_arrays(
        F.array(*map(F.lit, labels)), F.transform(_col(probability), lambda p: F.round(p, 4)))


def ranked_probabilities(
    df: DataFrame, labels: Sequence[str] = EMOTIONS, id_col: str = "id", probability_col: str = "probability",
    keep: Sequence[str] = (),
) -> DataFrame:
    """id, keep..., rank, emotion, probability, by probability; lower class id first on ties. Sorted in the row."""
    pairs = F.transform(probability_col, lambda p, i: F.struct((-p).alias("p"), i.alias("label")))
    ranked = df.select(id_col, *keep, F.posexplode_outer(F.sort_array(pairs)).alias("rank", "x"))
    return ranked.select(
        id_col, *keep, (F.col("rank") + 1).alias("rank"),
        F.get(F.array(*map(F.lit, labels)), F.col("x.label")).alias("emotion"),
        (-F.col("x.p")).alias("probability"))


def scored_report(
    df: DataFrame, labels: Sequence[str] = EMOTIONS, id_col: str = "id", text_col: str = "text",
    expected_col: str | None = None,
) -> DataFrame:
    """Preview, class, confidence and, where the class is known, whether it was hit."""
    share = confidence("probability", "prediction")
    cols = [
        F.col(id_col), preview(text_col).alias("preview"),
        predicted_name("prediction", labels).alias("emotion"),
        share.alias("confidence"), confidence_text(share).alias("confidence_text"),
        probability_map("probability", labels).alias("probabilities"),
    ]
    if expected_col:
        cols += [F.col(expected_col).alias("expected"),
                 (predicted_name("prediction", labels) == F.col(expected_col)).alias("hit")]
    return df.select(*cols)
