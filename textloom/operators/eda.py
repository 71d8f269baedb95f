"""Tables behind the exploratory charts. Each aggregates to something small in its first step."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from textloom.fixed_values import LENGTH_BINS, TOP_WORDS
from textloom.functions.terms import word_count


def class_distribution(df: DataFrame, label_col: str = "emotion") -> DataFrame:
    """emotion, n, percent; most frequent first when sorted by (n desc, emotion)."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("emotion")).agg(
        F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, 4)).orderBy(F.desc("n"), "emotion")


def token_length_stats(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    return df.select(id_col, word_count(text_col).alias("token_count"))


def length_counts(df: DataFrame, text_col: str = "text", by: list[str] | None = None) -> DataFrame:
    """(class,) token_count, n: all the length charts need, one row per length met."""
    return df.groupBy(*(by or []), word_count(text_col).alias("token_count")).agg(F.count("*").alias("n"))


def token_length_histogram(df: DataFrame, text_col: str = "text", bins: int = LENGTH_BINS) -> DataFrame:
    """bin, lower, upper, n over equal widths; the last bin is closed, empty bins are kept.

    If all lengths agree there is a single bin.
    """
    lengths = length_counts(df, text_col)
    ends = lengths.agg(F.min("token_count").alias("lo"), F.max("token_count").alias("hi")).where("lo IS NOT NULL")
    range_ = ends.select(F.struct("lo", "hi")).scalar()  # one row, computed once
    lo, hi = range_["lo"], range_["hi"]
    place = F.floor((F.col("token_count") - lo) * bins / (hi - lo))
    filled = (
        lengths.withColumn("bin", F.when(hi == lo, 0).otherwise(F.least(place, F.lit(bins - 1))).cast("int"))
        .groupBy("bin").agg(F.sum("n").alias("n"))
    )
    lo, hi = F.col("lo"), F.col("hi")
    width = (hi - lo) / F.lit(float(bins))
    last = F.when(lo == hi, 0).otherwise(bins - 1)
    all_bins = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), last)))
    return all_bins.join(filled, "bin", "left").select(
        "bin",
        F.round(lo + F.col("bin") * width, 6).alias("lower"),
        F.round(F.when(lo == hi, hi).otherwise(lo + (F.col("bin") + 1) * width), 6).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def token_length_box(
    df: DataFrame, label_col: str = "emotion", text_col: str = "text", approximate: bool = False
) -> DataFrame:
    """Quartiles, whiskers at 1.5 box lengths and outlier count per class.

    Exact quartiles need one counter per distinct length, and lengths repeat, so they stay cheap;
    `approximate` bounds the memory where they do not.
    """
    lengths = length_counts(df, text_col, [F.col(label_col).alias("emotion")])
    if approximate:
        q = F.percentile_approx(word_count(text_col), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10_000))
        quartiles = df.groupBy(F.col(label_col).alias("emotion")).agg(q.alias("q"), F.count("*").alias("n"))
    else:
        q = F.percentile("token_count", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
        quartiles = lengths.groupBy("emotion").agg(q.alias("q"), F.sum("n").alias("n_rows"))
        quartiles = quartiles.withColumnRenamed("n_rows", "n")
    box = quartiles.select(
        "emotion", F.col("n").alias("n_rows"),
        *[F.get("q", F.lit(i)).cast("double").alias(c) for i, c in enumerate(["q1", "median", "q3"])],
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("token_count").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        lengths.join(box, "emotion")
        .groupBy("emotion", "n_rows", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("token_count"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("token_count"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )


def top_terms_per_class(
    df: DataFrame, label_col: str = "emotion", tokens_col: str = "tokens", k: int = TOP_WORDS
) -> DataFrame:
    """emotion, rank, term, n. The rank filter is applied within each task before the shuffle, so a
    class is never gathered whole."""
    words = df.select(F.col(label_col).alias("emotion"), F.explode_outer(tokens_col).alias("term"))
    counts = words.groupBy("emotion", "term").agg(F.count("*").alias("n")).where(F.col("term").isNotNull())
    best = Window.partitionBy("emotion").orderBy(F.desc("n"), "term")
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "emotion", "rank", "term", "n")
