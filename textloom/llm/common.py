"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

#: Characters a Python function handles at a time; a longer text is handled alone.
CHUNK_CHARS = 2_000_000
#: Bytes of a batch that Spark hands to Python. Batches are cut by rows otherwise, and texts have no bound.
BATCH_BYTES = 4 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Keep the batches sent to Python small in bytes, not only in rows. Values set by the caller stay if smaller."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    digits = "".join(c for c in str(now or "") if c.isdigit())
    if now is None or not str(now).isdigit() or int(digits) > most:
        spark.conf.set(key, str(most))


def map_batches(df: DataFrame, fn: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`fn()` is called once per task and returns the function that is applied to every batch."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = fn()
        for batch in batches:
            if batch.num_rows:
                yield apply(batch)

    return df.mapInArrow(run, schema)


def nullable(schema: StructType) -> StructType:
    """What comes back from Python may hold nulls, whatever Spark knows of the column before."""
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def chunks(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of a batch with about `size` characters each."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def remainder_is(column: str, divisor: int, remainder: int) -> Column:
    """crc32 of the column as text, modulo `divisor`; false for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % divisor == remainder, F.lit(False))
