"""Mixing sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.cluster import write_and_read

#: Sources are ranked in one task; a table with more of them is refused.
MAX_SOURCES = 1_000_000
#: Rows of a source of about the same size that one task orders, about.
RUN_ROWS = 200_000


def word_count(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _draw(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of an md5 as a number: the same on a retry, in any partitioning and engine."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def source_targets(sizes: DataFrame, rate: float, most: float, weights: tuple[int, ...]) -> DataFrame:
    """_source, source_size -> the same with `target`.

    Sources by code point, null last, take the weights in turn. A common level times the weight, but at most `most`
    times the source's size, adds up to `rate` times all sizes. Filling the sources by rising cap per weight, the level
    that the rest could have rises as long as caps are met and falls afterwards, so its maximum is the level.
    """
    # one row per source
    turn = Window.orderBy(F.col("_source").asc_nulls_last())
    picked = F.element_at(F.lit(list(weights)), ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    rising = Window.orderBy(cap / F.col("_weight"), F.col("_source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    rest = rising.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(whole) * F.lit(float(rate)) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
             ) / F.sum("_weight").over(rest)
    return (
        sizes.withColumn("_weight", picked.cast("double")).withColumn("_level", level)
        .withColumn("target", F.least(cap, F.max("_level").over(whole) * F.col("_weight")))
        .drop("_weight", "_level")
    )


def with_copies(df: DataFrame, size: Column, source: Column, key: Column, rate: float = 1.5, most: float = 2.0,
                weights: tuple[int, ...] = (3, 1, 2), seed: int = 42) -> DataFrame:
    """row (all columns of `df` as a struct), size, source_size, target, copies (0 to the ceiling of `most`), taken.

    Every document of a source expects target / source_size copies. In an order by size, documents of a size shuffled
    by `seed`, the expected copies are summed up, one random offset is added, and a document is emitted once per
    integer that the sum crosses. Neighbours in that order have about the same size, so the words taken come to the
    target up to about one document.

    All documents of a source expect the same, so a prefix sum is a rank times that number. No task ranks a source:
    runs of one size class and hash range are ranked, and the rows of the runs before are added.

    A null size counts as 0; sources may be null, keys too. Rows with the same key and size are interchangeable. With
    no words at all, targets and copies are 0. Reruns agree. An empty table gives an empty one.
    """
    spark = df.sparkSession
    rows = write_and_read(df.select(
        F.struct(*[df[c] for c in df.columns]).alias("row") if df.columns else F.lit(None).alias("row"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"), source.cast("string").alias("_source"),
        _draw(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")), 15).alias("_draw"),
        F.coalesce(key.cast("string"), F.lit("")).alias("_key")), "mix")
    # size class: the four highest bits and their place
    bits = F.length(F.bin("size"))
    rows = rows.withColumn("_class", bits * 16 + F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0))"))
    n, sources = rows.agg(F.count("*"), F.approx_count_distinct("_source")).first()
    if sources > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    ranges = 5 + max(0, math.ceil(math.log2(max(n, 1) / (64 * RUN_ROWS))))
    rows = rows.withColumn("_range", F.shiftright("_draw", 60 - ranges)).withColumn(
        "_null", F.col("_source").isNull()).withColumn("_name", F.coalesce("_source", F.lit("")))
    run = ["_null", "_name", "_class", "_range"]

    runs = rows.groupBy(*run).agg(F.count("*").alias("_rows"), F.sum("size").alias("_words"))
    in_order = Window.partitionBy("_null", "_name").orderBy("_class", "_range").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(
        runs.groupBy("_null", "_name").agg(F.sum("_words").alias("source_size"))
        .select(F.when(~F.col("_null"), F.col("_name")).alias("_source"), "source_size"), rate, most, weights,
    ).select(F.col("_source").isNull().alias("_null"), F.coalesce("_source", F.lit("")).alias("_name"), "source_size",
             "target")
    offset = _draw(F.concat(F.lit(f"offset:{seed}:"), F.col("_null").cast("string"), F.lit(":"), F.col("_name")), 13) / F.lit(
        float(2 ** 52))
    runs = runs.withColumn("_before", F.coalesce(F.sum("_rows").over(in_order), F.lit(0))).join(
        targets, ["_null", "_name"]).select(*run, "_before", "source_size", "target", offset.alias("_offset"))

    at = F.col("_before") + F.row_number().over(Window.partitionBy(*run).orderBy("_draw", "_key", "size"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = lambda rank: F.floor(rank * F.col("_expected") + F.col("_offset"))
    return (
        rows.join(runs, run).withColumn("_rank", at).withColumn("_expected", expected)
        .withColumn("copies", (crossed(F.col("_rank")) - crossed(F.col("_rank") - 1)).cast("int"))
        .select("row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mix_sources(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id",
                **settings) -> DataFrame:
    """id, size (words), source_size, target, copies, taken of every row; see `with_copies`. Texts aren't shuffled."""
    sized = df.select(df[id_col].alias("id"), df[source_col].alias("source"), word_count(df[text_col]).alias("size"))
    out = with_copies(sized, F.col("size"), F.col("source"), F.col("id"), **settings)
    return out.select(F.col("row.id").alias(id_col), "size", "source_size", "target", "copies", "taken")


def mixed_rows(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id",
               **settings) -> DataFrame:
    """The mix itself: each row of `df` once per copy, with the columns of `df` and no others."""
    out = with_copies(df, word_count(df[text_col]), df[source_col], df[id_col], **settings)
    return out.where("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")


#: DuckDB SQL for `mix_sources` with its defaults over `documents`.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':42'), 1, 15))::BIGINT AS draw
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY
      length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)::BIGINT), draw,
      coalesce(doc_id::VARCHAR, ''), size) AS rank
  FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
shares AS (SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM sources),
capped AS (
  -- sources that are above 2 times their size when those with less cap per weight are
  SELECT s.*, (total - coalesce((SELECT sum(2.0::DOUBLE * o.source_size) FROM sources o
      WHERE (2.0::DOUBLE * o.source_size / o.weight, coalesce(o.source, chr(1114111))) <
            (2.0::DOUBLE * s.source_size / s.weight, coalesce(s.source, chr(1114111)))), 0)) /
    (SELECT sum(o.weight) FROM sources o
      WHERE (2.0::DOUBLE * o.source_size / o.weight, coalesce(o.source, chr(1114111))) >=
            (2.0::DOUBLE * s.source_size / s.weight, coalesce(s.source, chr(1114111)))) AS level
  FROM shares s),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, max(level) OVER () * weight) AS target,
    ('0x' || substr(md5('offset:42:' || (source IS NULL)::VARCHAR || ':' || coalesce(source, '')), 1, 13))::BIGINT
      / 4503599627370496::DOUBLE AS start
  FROM capped),
counted AS (
  SELECT r.*, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS expected, start
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (floor(rank * expected + start) - floor((rank - 1) * expected + start))::INTEGER AS copies,
  ((floor(rank * expected + start) - floor((rank - 1) * expected + start)) * size)::BIGINT AS taken
FROM counted
"""
