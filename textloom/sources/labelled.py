"""Labelled corpora: text, label, emotion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from textloom.fixed_values import EMOTIONS
from textloom.operators.lookups import id_to_name, name_to_id
from textloom.sources.delimited import read_csv
from textloom.sources.synthetic import synthetic_corpus

COLUMNS = ["text", "label", "emotion"]
SPLIT_NAMES = ["train", "validation", "test"]


def read_labels(label: Column, labels: Sequence[str]) -> Column:
    """Class ids from text: a class name, or a whole number in any notation (3, 3.0). Null and blank stay null;
    anything else fails the job, so no row is lost without a word."""
    text = F.trim(label)
    number = F.expr("try_cast(trim(label) AS double)")
    message = F.concat(F.lit("neither a class name nor a whole number: "), label)
    return (
        F.when(label.isNull() | (text == ""), F.lit(None).cast("int"))
        .when(name_to_id(text, labels).isNotNull(), name_to_id(text, labels))
        .when((number == F.floor(number)) & (F.abs(number) < 2 ** 31), number.cast("int"))
        .otherwise(F.raise_error(message).cast("int"))
    )


def _complete(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Derive whichever of label and emotion is missing, drop rows without text or label."""
    if dict(df.dtypes).get("label") == "string":
        df = df.withColumn("label", read_labels(F.col("label"), labels))
    if "label" not in df.columns:
        df = df.withColumn("label", name_to_id("emotion", labels))
    if "emotion" not in df.columns:
        df = df.withColumn("emotion", id_to_name(F.col("label").cast("int"), labels))
    return df.dropna(subset=["text", "label"])


def normalise_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def check_columns(df: DataFrame) -> None:
    if "text" not in df.columns:
        raise ValueError("the file needs a 'text' column")
    if "label" not in df.columns and "emotion" not in df.columns:
        raise ValueError("the file needs a 'label' or an 'emotion' column")


def load_labelled_csv(
    spark: SparkSession,
    path: str,
    labels: Sequence[str] = EMOTIONS,
    null_value: str | None = None,
) -> DataFrame:
    """Header in any case and padding; every column is read as text, so there is no inference pass.

    `label` holds class names or whole numbers. Fields may hold line breaks, and large files are split all the same.
    Carried columns: text, label, emotion, and id where the file has one.
    """
    df = normalise_header(read_csv(spark, path, null_value))
    check_columns(df)
    df = _complete(df, labels)
    keep = (["id"] if "id" in df.columns else []) + COLUMNS
    return df.select(*keep)


def union_splits(splits: Mapping[str, DataFrame], labels: Sequence[str] = EMOTIONS) -> DataFrame:
    """Bag union of those of train, validation and test that are present."""
    present = [splits[name] for name in SPLIT_NAMES if name in splits]
    if not present:
        raise ValueError(f"none of {SPLIT_NAMES} given")
    df = present[0]
    for other in present[1:]:
        df = df.unionByName(other)
    df = df.withColumn("emotion", id_to_name(F.col("label").cast("int"), labels))
    return df.dropna(subset=["text", "label"]).withColumn("label", F.col("label").cast("int"))


def load_splits(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", labels: Sequence[str] = EMOTIONS,
) -> DataFrame:
    """Splits with the columns text and label (a whole number). In a CSV they go by its header, and labels may be class
    names too, as in `load_labelled_csv`."""
    if fmt == "csv":
        splits = {n: load_labelled_csv(spark, p, labels).select("text", "label") for n, p in paths.items()}
    else:
        schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.LongType())])
        splits = {n: spark.read.schema(schema).format(fmt).load(p) for n, p in paths.items()}
    return union_splits(splits, labels).select(*COLUMNS)


def load_corpus(
    spark: SparkSession,
    csv_path: str | None = None,
    split_paths: Mapping[str, str] | None = None,
    samples_per_class: int = 800,
    labels: Sequence[str] = EMOTIONS,
) -> DataFrame:
    """A CSV if named, else prepared splits, else generated sentences. A named path must exist."""
    if csv_path:
        return load_labelled_csv(spark, csv_path, labels)
    if split_paths:
        return load_splits(spark, split_paths, labels=labels)
    ids = spark.range(samples_per_class * len(EMOTIONS))
    return synthetic_corpus(ids).select(*COLUMNS)


def write_labelled_csv(df: DataFrame, path: str) -> None:
    """Fields come back as they were: white space at their ends is kept, unlike by the writer's default."""
    df.write.csv(
        path, header=True, escape='"', quoteAll=True, emptyValue="", lineSep="\n",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
