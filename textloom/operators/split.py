"""Seeded stratified splits and folds with exact sizes.

Rows of a class are ordered by md5(key, seed) and cut at exact counts. No class is ever sorted in one
task: a histogram of the keys' first four hex digits finds the bucket of each cut, only the rows of
those buckets are ranked, and the key found there becomes the threshold. Assigning a row is then a
comparison with a few thresholds of its class, without a shuffle, so it also works on a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from textloom.cluster import lookup_join, materialise
from textloom.fixed_values import FOLDS, HOLDOUT_SIZE, SEED, TEST_SIZE, VAL_SIZE
from textloom.functions.keys import order_key
from textloom.operators.lookups import MAX_CLASSES

BUCKET_DIGITS = 4


def allocate(draws: int, counts: Mapping[object, int]) -> dict[object, int]:
    """Share draws out in proportion to counts: whole parts first, the rest to the largest
    remainders, ties in class order. Integers throughout."""
    total = sum(counts.values())
    if total == 0:
        return dict(counts)
    shares = {c: draws * n // total for c, n in counts.items()}
    by_remainder = sorted(counts, key=lambda c: (-(draws * counts[c] % total), c))
    for c in by_remainder[: draws - sum(shares.values())]:
        shares[c] += 1
    return shares


def three_way_sizes(counts: Mapping[object, int], test: str, val: str) -> dict[object, list[int]]:
    """Per class [test, val]; the rest is train."""
    total = sum(counts.values())
    kept = total - ceil(Fraction(test) * total)
    rest = allocate(kept, counts)
    n_val = ceil(Fraction(val) / (1 - Fraction(test)) * kept)
    train = allocate(kept - n_val, rest)
    return {c: [counts[c] - rest[c], rest[c] - train[c]] for c in counts}


def holdout_sizes(counts: Mapping[object, int], share: str) -> dict[object, list[int]]:
    total = sum(counts.values())
    kept = allocate(total - ceil(Fraction(share) * total), counts)
    return {c: [counts[c] - kept[c]] for c in counts}


def fold_sizes(counts: Mapping[object, int], folds: int) -> dict[object, list[int]]:
    """Deal the classes, laid end to end in class order, round the folds: fold totals differ by at most 1."""
    sizes, start = {}, 0
    for c in sorted(counts):
        n = counts[c]
        dealt = [len(range((f - start) % folds, n, folds)) for f in range(folds)]
        sizes[c] = dealt[:-1]
        start += n
    return sizes


@dataclass
class SplitModel:
    thresholds: DataFrame  # one row per class: label, cuts array<struct<key, tie>>
    conflicts: DataFrame | None  # contents carrying more than one label: key, label to use
    parts: list
    label_col: str
    key_col: str
    seed: int
    by_content: bool
    limits: dict | None = None  # of `lookup_join`

    def transform(self, df: DataFrame, out: str = "split") -> DataFrame:
        df = df.withColumn("_key", order_key(self.key_col, self.seed))
        df = df.withColumn("_stratum", F.col(self.label_col))
        if self.conflicts is not None:
            # Copies share their content, so they are spread by all their other columns.
            plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType) and f.name != "_key"]
            df = df.withColumn("_row", F.xxhash64(*plain))
            df = lookup_join(df, self.conflicts, ["_key"], "_row", "left", **(self.limits or {})).withColumn(
                "_stratum", F.coalesce("_agreed", F.col("_stratum"))).drop("_agreed", "_row")
        # One row per class, at most MAX_CLASSES.
        df = df.join(F.broadcast(self.thresholds), "_stratum", "left")
        here = F.struct(F.col("_key").alias("key"), _tie(self.key_col, self.by_content).alias("tie"))
        part: Column = F.lit(self.parts[-1])
        for i in reversed(range(len(self.parts) - 1)):
            part = F.when(here <= F.get("_cuts", F.lit(i)), F.lit(self.parts[i])).otherwise(part)
        return df.withColumn(out, part).drop("_key", "_stratum", "_cuts")


def _tie(key_col: str, by_content: bool) -> Column:
    return F.lit("") if by_content else F.col(key_col).cast("string")


def _fit(
    df: DataFrame, sizes, parts: Sequence, label_col: str, key_col: str, seed: int, by_content: bool
) -> SplitModel:
    keyed = df.select(
        F.col(label_col).alias("_stratum"),
        order_key(key_col, seed).alias("key"),
        _tie(key_col, by_content).alias("tie"),
    )
    conflicts = None
    if by_content:
        # Copies count once. The map side merges them first, so a text that makes up a third of
        # the rows is one row per task here.
        contents = materialise(keyed.groupBy("key").agg(
            F.min("_stratum").alias("_stratum"), F.max("_stratum").alias("_other")))
        disputed = contents.where("_stratum <> _other").select(
            F.col("key").alias("_key"), F.col("_stratum").alias("_agreed"))
        conflicts = None if disputed.isEmpty() else materialise(disputed)
        keyed = contents.select("_stratum", "key", F.lit("").alias("tie"))

    keyed = keyed.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    in_class = Window.partitionBy("_stratum").orderBy("bucket")  # at most 16**4 rows per class
    histogram = materialise(
        keyed.groupBy("_stratum", "bucket").agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(in_class)))

    rows = histogram.groupBy("_stratum").agg(F.sum("n")).limit(MAX_CLASSES + 1).collect()
    counts = {c: n for c, n in rows}
    if len(counts) > MAX_CLASSES or None in counts:
        raise ValueError("the label column must be complete and hold a bounded set of classes")
    cuts = []
    for c, ns in sizes(counts).items():
        at = 0
        for i, n in enumerate(ns):
            at += n
            cuts.append((c, i, at))

    spark = df.sparkSession
    stratum = keyed.schema["_stratum"].dataType.simpleString()
    wanted = spark.createDataFrame(cuts, f"_stratum {stratum}, part int, cut bigint")
    located = (
        histogram.join(F.broadcast(wanted), "_stratum")  # classes x parts rows
        .where((F.col("upto") - F.col("n") < F.col("cut")) & (F.col("cut") <= F.col("upto")))
        .select("_stratum", "bucket", "part", (F.col("cut") - F.col("upto") + F.col("n")).alias("rank"))
    )
    in_bucket = Window.partitionBy("_stratum", "part").orderBy("key", "tie")
    found = (
        keyed.join(F.broadcast(located), ["_stratum", "bucket"])  # classes x parts rows
        .withColumn("at", F.row_number().over(in_bucket))
        .where("at = rank")
    )
    keys = {(r["_stratum"], r["part"]): (r["key"], r["tie"])
            for r in found.select("_stratum", "part", "key", "tie").collect()}
    # A part without rows in a class gets a threshold below every key.
    thresholds = spark.createDataFrame(
        [(c, [keys.get((c, i), ("", "")) for i in range(len(parts) - 1)]) for c in counts],
        f"_stratum {stratum}, _cuts array<struct<key:string,tie:string>>",
    )
    return SplitModel(thresholds, conflicts, list(parts), label_col, key_col, seed, by_content)


def fit_split(
    df: DataFrame,
    label_col: str = "label",
    key_col: str = "id",
    test_size: str = TEST_SIZE,
    val_size: str = VAL_SIZE,
    seed: int = SEED,
    group_by_content: bool = False,
) -> SplitModel:
    """Train, val and test. Give the text as `key_col` with `group_by_content` to keep copies together."""
    return _fit(df, lambda n: three_way_sizes(n, test_size, val_size), ["test", "val", "train"],
                label_col, key_col, seed, group_by_content)


def fit_holdout(
    df: DataFrame, label_col: str = "label", key_col: str = "id", share: str = HOLDOUT_SIZE,
    seed: int = SEED, group_by_content: bool = False,
) -> SplitModel:
    return _fit(df, lambda n: holdout_sizes(n, share), ["holdout", "train"],
                label_col, key_col, seed, group_by_content)


def fit_folds(
    df: DataFrame, label_col: str = "label", key_col: str = "id", folds: int = FOLDS,
    seed: int = SEED, group_by_content: bool = False,
) -> SplitModel:
    return _fit(df, lambda n: fold_sizes(n, folds), list(range(folds)),
                label_col, key_col, seed, group_by_content)


def sample_rows(df: DataFrame, n: int, key_col: str = "id", seed: int = SEED) -> DataFrame:
    """A seeded sample of exactly n rows: top n by key, kept per partition first."""
    return (
        df.withColumn("_key", order_key(key_col, seed))
        .orderBy("_key", key_col).limit(n).drop("_key")
    )
