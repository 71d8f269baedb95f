import os

import pytest
from pyspark.errors import StreamingQueryException

from textloom.streaming.score import accuracy_stream, accuracy_table

SCHEMA = "actual int, predicted int"


def outcomes(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    accuracy_stream(stream, ["a", "b"], str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()


def table(spark, tmp_path):
    return {r.expected: (r.correct, r.total) for r in accuracy_table(spark, str(tmp_path / "out")).collect()}


def test_batches_replace_each_other_whole(spark, tmp_path):
    outcomes(spark, str(tmp_path / "in"), [(0, 0), (0, 1), (1, 1)])
    run(spark, tmp_path)
    assert table(spark, tmp_path) == {"a": (1, 2), "b": (1, 1)}
    outcomes(spark, str(tmp_path / "in"), [(0, 0), (1, 0)])
    outcomes(spark, str(tmp_path / "in"), [(1, 1)])
    run(spark, tmp_path)
    assert table(spark, tmp_path) == {"a": (2, 3), "b": (2, 3)}


def test_a_batch_that_failed_is_run_again(spark, tmp_path, monkeypatch):
    """It fails after its table is written and before the stream knows: run again, it counts nothing twice, and readers
    have the table of the batch before while its own is gone."""
    outcomes(spark, str(tmp_path / "in"), [(0, 0), (1, 0)])
    run(spark, tmp_path)
    outcomes(spark, str(tmp_path / "in"), [(0, 0), (1, 1)])
    from pyspark.sql.readwriter import DataFrameWriter

    write = DataFrameWriter.parquet

    def fails(self, path, *a, **k):
        write(self, path, *a, **k)
        raise RuntimeError("lost")

    monkeypatch.setattr(DataFrameWriter, "parquet", fails)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path)
    monkeypatch.undo()
    assert table(spark, tmp_path) == {"a": (2, 2), "b": (1, 2)}
    newest = max(os.listdir(tmp_path / "out"))
    os.rename(tmp_path / "out" / newest, tmp_path / "aside")  # as between removing the old table and writing the new one
    assert table(spark, tmp_path) == {"a": (1, 1), "b": (0, 1)}
    run(spark, tmp_path)
    assert table(spark, tmp_path) == {"a": (2, 2), "b": (1, 2)}
