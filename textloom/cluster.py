"""Shared storage, lineage cuts and size-checked joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Limits below which a table may be sent whole to every executor.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
# Rows of a key beyond which it is dealt out to several tasks, one for each so many rows.
HEAVY_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, set here only for a local run."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once, keep in shared storage, drop the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_and_read(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """As `materialise`, but columnar, so later reads prune columns and push filters."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Remove a table of `write_and_read` that nothing reads any more. Spark removes shuffle files of what nothing refers to
    when the driver's garbage is collected, which a loop of large shuffles can't wait for."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    spark._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """Give an input of few partitions to all cores. Large inputs pass through without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measured, not estimated; call it on a materialised table."""
    n, total = df.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    ).first()
    return n <= rows and total <= size


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread_by: str,
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
    size: int = BROADCAST_BYTES,
    heavy: int = HEAVY_ROWS,
) -> DataFrame:
    """Join to a table whose key is unique.

    A lookup within the limits is broadcast. With a larger one both sides are shuffled on the key. Keys of more than
    `heavy` facts, found by counting, get a salt as well: their facts are dealt out by `spread_by`, a task for each
    `heavy` of them, and only their lookup rows are repeated.
    """
    if fits_broadcast(lookup, rows, size):
        return facts.join(F.broadcast(lookup), on, how)
    hot = materialise(facts.groupBy(*on).agg(F.ceil(F.count("*") / heavy).cast("int").alias("_parts")).where("_parts > 1"))
    if hot.isEmpty():
        return facts.join(lookup, on, how)
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot  # at most a key for each `heavy` facts
    parts = F.coalesce("_parts", F.lit(1))
    salted = facts.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), parts).cast("int")).drop("_parts")
    repeated = lookup.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
