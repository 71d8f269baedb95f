"""Class names and ids. The class list is an argument, so both directions are literal maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textloom.fixed_values import EMOTIONS, UNKNOWN, UNKNOWN_ID

# Classes are columns and literals in several plans.
MAX_CLASSES = 1_000


def check_labels(labels: Sequence[str]) -> list[str]:
    labels = list(labels)
    if not labels or len(set(labels)) != len(labels):
        raise ValueError("class names must be given and distinct")
    if len(labels) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return labels


def label_dim(spark: SparkSession, labels: Sequence[str] = EMOTIONS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(check_labels(labels))), "label int, emotion string")


def observed_labels(df: DataFrame, col: str = "emotion") -> list[str]:
    """Class names met in the data, sorted; a column of free text is refused, not truncated."""
    names = df.where(F.col(col).isNotNull()).select(col).distinct().limit(MAX_CLASSES + 1).collect()
    return check_labels(sorted(r[0] for r in names))


def name_to_id(name: Column | str, labels: Sequence[str] = EMOTIONS) -> Column:
    """Exact match only; anything else is null."""
    col = F.col(name) if isinstance(name, str) else name
    position = F.array_position(F.array(*map(F.lit, check_labels(labels))), col) - 1
    return F.when(position >= 0, position).cast("int")


def id_to_name(label: Column | str, labels: Sequence[str] = EMOTIONS) -> Column:
    """Null outside the class list."""
    col = F.col(label) if isinstance(label, str) else label
    names = F.array(*map(F.lit, check_labels(labels)))
    return F.when(col >= 0, F.get(names, col.cast("int")))


def predicted_name(prediction: Column | str, labels: Sequence[str] = EMOTIONS) -> Column:
    """As `id_to_name`, with the id of an unknown text shown as such."""
    col = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.when(col == UNKNOWN_ID, F.lit(UNKNOWN)).otherwise(id_to_name(col, labels))


def encode_labels(
    df: DataFrame, labels: Sequence[str] = EMOTIONS, name_col: str = "emotion", label_col: str = "label"
) -> DataFrame:
    """The name decides, whatever label came with it; a name outside the list fails the job."""
    label = name_to_id(name_col, labels)
    message = F.concat(F.lit("unknown class name: "), F.coalesce(F.col(name_col), F.lit("null")))
    return df.withColumn(label_col, F.when(label.isNull(), F.raise_error(message)).otherwise(label).cast("int"))
