"""One sentence per line, from files, pasted texts or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textloom.fixed_values import LINE_END, WHITE_SPACE

#: Of a file, or of a folder that Spark wrote in place of one.
CLASS_OF_FILE = r"([^/]*)_samples[^/]*(?:/[^/]*)?$"


def strip(text: Column) -> Column:
    """All Unicode white space off both ends; `trim` takes spaces only."""
    return F.regexp_replace(text, f"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", "")


def _lines(df: DataFrame) -> DataFrame:
    return (
        df.select(
            strip(F.col("value")).alias("text"),
            F.nullif(F.regexp_extract(F.col("_metadata.file_path"), CLASS_OF_FILE, 1), F.lit("")).alias("expected"),
        ).where(F.col("text") != "")
    )


def read_line_files(spark: SparkSession, path: str) -> DataFrame:
    """All files in one scan; the expected class is the part of the file or folder name before `_samples`."""
    return _lines(spark.read.text(path))


def stream_line_files(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark.readStream.schema("value string").text(path))


def line_rows(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per non-blank line of a pasted text, with its line number."""
    others = [c for c in df.columns if c != text_col]
    return (
        df.select(*others, F.posexplode(F.split(text_col, LINE_END)).alias("line_no", "line"))
        .withColumn("line", strip(F.col("line")))
        .where(F.col("line") != "")
    )
