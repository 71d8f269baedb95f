"""Scoring and counting on unbounded sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textloom.cluster import scratch_path
from textloom.operators.evaluate import accuracy_by_class


def score_stream(stream: DataFrame, model: PipelineModel, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Stateless: clean, featurise and classify each row as it comes, append to a table."""
    scored = model.transform(stream)
    return (
        scored.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def accuracy_stream(outcomes: DataFrame, labels: Sequence[str], path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Running hits per class, read by `accuracy_table`. The state is one row per class.

    Each batch is a table of its own, named by its number, in one file, which appears whole or not at all. A batch that is
    run again after a failure writes the same table again, and what was there before is left alone.
    """

    def append(batch: DataFrame, epoch: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")  # a row for each class

    return (
        accuracy_by_class(outcomes, labels).writeStream.outputMode("complete").foreachBatch(append)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def accuracy_table(spark: SparkSession, path: str) -> DataFrame:
    """The table of the newest batch of an `accuracy_stream` that has been written whole."""
    found = spark.read.parquet(path)
    newest = found.agg(F.max("epoch")).first()[0]
    return found.where(F.col("epoch") == newest).drop("epoch")


def running_accuracy(spark: SparkSession, folder: str, schema: StructType, labels: Sequence[str]) -> DataFrame:
    """Drain a folder of stored outcomes through the stream and return the table it leaves."""
    stream = spark.readStream.schema(schema).parquet(folder)
    path = scratch_path(spark, "accuracy")
    accuracy_stream(stream, labels, path, scratch_path(spark, "accuracy-state")).awaitTermination()
    return accuracy_table(spark, path)
