from collections import Counter

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import Window, functions as F

from textloom.functions import order_key
from textloom.operators import split as sp


@given(st.dictionaries(st.integers(0, 8), st.integers(1, 500), min_size=1))
def test_sizes(counts):
    total = sum(counts.values())
    test, val = (sum(s[i] for s in sp.three_way_sizes(counts, "0.20", "0.10").values()) for i in (0, 1))
    assert test == -(-total // 5)
    assert val == -(-(total - test) // 8)
    for c, (t, v) in sp.three_way_sizes(counts, "0.20", "0.10").items():
        assert t >= 0 and v >= 0 and t + v <= counts[c]
    folds = sp.fold_sizes(counts, 5)
    last = {c: counts[c] - sum(folds[c]) for c in counts}
    for c in counts:
        sizes = [*folds[c], last[c]]
        assert max(sizes) - min(sizes) <= 1
    totals = [sum(folds[c][f] for c in counts) for f in range(4)] + [sum(last.values())]
    assert max(totals) - min(totals) <= 1


def test_original_sizes():
    sizes = sp.three_way_sizes({c: 800 for c in range(6)}, "0.20", "0.10")
    assert sum(t for t, _ in sizes.values()) == 960 and sum(v for _, v in sizes.values()) == 480


@pytest.fixture(scope="module")
def rows(spark):
    # One class holds four fifths of the rows, one has a single row.
    label = F.when(F.col("id") == 0, 2).when(F.col("id") % 5 == 1, 1).otherwise(0)
    return spark.range(5_000).withColumn("label", label.cast("int")).cache()


def test_equals_ranking(rows):
    got = sp.fit_split(rows).transform(rows)
    sizes = sp.three_way_sizes({r[0]: r[1] for r in rows.groupBy("label").count().collect()}, "0.20", "0.10")
    ranked = rows.withColumn("r", F.row_number().over(
        Window.partitionBy("label").orderBy(order_key("id"), F.col("id").cast("string"))))
    for c, (t, v) in sizes.items():
        expected = ranked.where(F.col("label") == c).select("id", "label", F.when(
            F.col("r") <= t, "test").when(F.col("r") <= t + v, "val").otherwise("train").alias("split"))
        assert expected.exceptAll(got.where(F.col("label") == c)).isEmpty()
    assert got.count() == rows.count()


def test_assignment_needs_no_shuffle_and_no_order(rows):
    model = sp.fit_split(rows)
    moved = model.transform(rows.repartition(13))
    assert moved.exceptAll(model.transform(rows)).isEmpty()
    plan = model.transform(rows.sparkSession.range(10).withColumn("label", F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan


def test_folds(rows):
    folds = Counter((r.label, r.fold) for r in sp.fit_folds(rows).transform(rows, "fold").collect())
    for c in (0, 1):
        sizes = [folds[c, f] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert sum(folds.values()) == 5_000
    assert sp.fit_holdout(rows).transform(rows).where("split = 'holdout'").count() == 500


def test_copies_stay_together(spark):
    # A third of all rows is one text, and some copies disagree about the class.
    rows = spark.range(3_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.concat(F.lit("t"), F.col("id") % 700)).alias("text"),
        F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("label"))
    model = sp.fit_split(rows, key_col="text", group_by_content=True)
    got = model.transform(rows)
    assert got.count() == 3_000
    assert got.groupBy("text").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()
    assert {r.split for r in got.select("split").distinct().collect()} == {"train", "val", "test"}


def test_unlabelled_rows_are_refused(spark):
    df = spark.createDataFrame([(1, None), (2, 0)], "id bigint, label int")
    with pytest.raises(ValueError):
        sp.fit_split(df)


def test_sample(rows):
    a = sp.sample_rows(rows, 7)
    assert a.count() == 7 and a.exceptAll(sp.sample_rows(rows.repartition(5), 7)).isEmpty()
