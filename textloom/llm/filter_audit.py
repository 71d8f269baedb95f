"""How filters act together: what each removes at each step of each order, and its Shapley value.

What a set of filters (a coalition) removes depends on the documents' failing filters alone. So the table is reduced to
counts by those, 32 a part, and summed to what each of the 32 coalitions removes. A step's counts are differences of two
coalitions. The Shapley values are the weights of the additive game that fits the coalitions best by least squares, each
weighted by its Shapley kernel, under the constraint that the values add up to what all filters remove. The normal
equations of that fit are solved in rationals, once, as they are linear in the coalitions' values: no figure is rounded.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial, lcm

from pyspark.sql import Column, DataFrame, functions as F

from textloom.cluster import lookup_join, write_and_read

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
#: What separates words.
SPACE = " \t\n\x0b\x0c\r"
#: Rows and bytes of a table that is broadcast.
SMALL = {"rows": 200_000, "size": 16 * 1024 * 1024}


def _solve(a: list[list[Fraction]], b: list[list[Fraction]]) -> list[list[Fraction]]:
    """x of a x = b, by elimination."""
    rows = [list(r) + list(s) for r, s in zip(a, b)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(len(rows)):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k])]
    return [r[len(a):] for r in rows]


def shapley_weights(n: int) -> list[list[Fraction]]:
    """w[i][S]: player i's Shapley value is the sum of w[i][S] times the value of coalition S (a set of bits); the empty
    coalition is worth 0.

    Minimises the sum over S of k(S) (value(S) - sum of S's x)² with k(S) = (n - 1) / (C(n, |S|) |S| (n - |S|)), where the
    x add up to the value of all: the normal equations, bordered by the constraint and its multiplier.
    """
    inner = range(1, (1 << n) - 1)
    kernel = {s: Fraction(n - 1, comb(n, c) * c * (n - c)) for s in inner for c in [s.bit_count()]}
    has = lambda s, i: s >> i & 1
    gram = [[sum((kernel[s] for s in inner if has(s, i) and has(s, j)), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    right = [[kernel[s] if s in kernel and has(s, i) else Fraction(0) for s in range(1 << n)] for i in range(n)]
    gram.append([Fraction(1)] * n + [Fraction(0)])
    right.append([Fraction(int(s == (1 << n) - 1)) for s in range(1 << n)])
    return _solve(gram, right)[:n]


def own_failures(text: Column) -> Column:
    """The filters A to D that a text fails, as bits. A: under 200 words. B: under half of the words are distinct.
    C: over 2 % of the code points are A-Z. D: any of #$%&*|."""
    words = F.split(F.trim(text, F.lit(SPACE)), f"[{SPACE}]+")
    counted = F.when(F.trim(text, F.lit(SPACE)) == "", F.struct(F.lit(0).alias("n"), F.lit(0).alias("distinct"))).otherwise(
        F.struct(F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("distinct")))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [counted["n"] < 200, F.lit(100) * counted["distinct"] < F.lit(50) * counted["n"],
             F.lit(100) * capitals > F.lit(2) * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0)).cast("int")


def failure_counts(df: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "source") -> DataFrame:
    """part, mask (the filters that fail, A = 1 to E = 16), docs, good, toxic: at most 32 rows a part.

    E: the same text as a row of smaller id, anywhere in the table (by sha256). A null id is neither smaller nor has it
    smaller ones. A document is good or toxic if any label of its id says so. A null text is empty, a null part too.
    """
    text = F.coalesce(df[text_col], F.lit(""))
    rows = write_and_read(df.select(
        df[id_col].cast("bigint").alias("id"), F.coalesce(df[part_col].cast("string"), F.lit("")).alias("part"),
        own_failures(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"), F.monotonically_increasing_id().alias("_row")), "failing")
    flagged = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic"))
    flagged = write_and_read(flagged, "flagged")
    again = write_and_read(rows.where("id IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first"), "again")
    rows = lookup_join(lookup_join(rows, flagged, ["id"], "_row", "left", **SMALL), again, ["digest"], "_row", "left", **SMALL)
    mask = F.col("mask") + F.when(F.col("id") > F.col("first"), 16).otherwise(0)
    return rows.groupBy("part", mask.alias("mask")).agg(
        F.count("*").alias("docs"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of all orders of
    the filters, from `failure_counts`: 600 rows a part. `shapley` is the filter's Shapley value times the 120 orders."""
    hit = lambda s: (F.col("mask").bitwiseAND(F.lit(s)) != 0)
    tabulated = lambda c: F.array(*[F.sum(F.when(hit(s), F.col(c)).otherwise(0)) for s in range(COALITIONS)])
    alone = F.array(*[F.sum(F.when(F.col("mask") == 1 << k, F.col("docs")).otherwise(0)) for k in range(len(FILTERS))])
    parts = counts.groupBy("part").agg(
        F.sum("docs").alias("docs"), tabulated("docs").alias("removed"), tabulated("good").alias("good"),
        tabulated("toxic").alias("toxic"), alone.alias("alone"))
    orders = factorial(len(FILTERS))
    weights = shapley_weights(len(FILTERS))
    whole = lcm(*[w.denominator for row in weights for w in row])
    numbers = F.array(*[F.array(*[F.lit(int(w * whole)).cast("bigint") for w in row]) for row in weights])
    parts = parts.withColumn("shapley", F.transform(numbers, lambda row: F.aggregate(
        F.zip_with(row, "removed", lambda w, v: w * v), F.lit(0).cast("bigint"), lambda a, b: a + b) * F.lit(orders)))
    steps = [("".join(o), k + 1, FILTERS.index(f), sum(1 << FILTERS.index(g) for g in o[:k]))
             for o in permutations(FILTERS) for k, f in enumerate(o)]
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(f).alias("f"), F.lit(b).alias("before"))
                      for o, k, f, b in steps])
    rows = parts.withColumn("_at", F.explode(steps)).select("*", "_at.*").drop("_at")
    rows = rows.withColumn("own", F.expr("shiftleft(1, f)")).withColumn("after", F.col("before") + F.col("own"))
    more = lambda c: F.get(c, F.col("after")) - F.get(c, F.col("before"))
    return rows.select(
        "part", "filter_order", "step", (F.col("docs") - F.get("removed", F.col("after"))).alias("kept"), more("removed").alias("removed"),
        (F.get("removed", F.col("own")) - more("removed")).alias("redundant"), F.get("alone", F.col("f")).alias("unique_fails"),
        more("good").alias("good_lost"), more("toxic").alias("toxic_lost"), F.expr(f"shapley[f] div {whole}").alias("shapley"))


def filter_audit(df: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "source") -> DataFrame:
    """The audit of filters A to E over `df`, one for each value of `part_col`. Rows alike in id and text don't fail E for
    each other. An empty table has no parts and gives no rows. Texts of any length are taken whole; other columns of `df`
    are not looked at."""
    return audit(failure_counts(df, labels, text_col, id_col, part_col))


AUDIT_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
flags AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT d.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false) AS e
  FROM docs d LEFT JOIN flags f ON f.doc_id = d.doc_id),
counts AS (
  SELECT part, [a, b, c, d, e] AS fails, list_count(list_filter([a, b, c, d, e], lambda x: x)) AS n_fails,
    count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order FROM letters v, letters w, letters x, letters y, letters z
  WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, ascii(filter_order[step]) - 64 AS f,
    list_transform(range(1, step), lambda k: ascii(filter_order[k]) - 64) AS earlier
  FROM orders, range(1, 6) r(step)),
met AS (
  SELECT part, filter_order, step, f, docs, good, toxic, n_fails, fails[f] AS own,
    len(list_filter(earlier, lambda k: fails[k])) > 0 AS gone FROM counts, steps),
result AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN gone OR own THEN 0 ELSE docs END)::BIGINT AS kept,
    sum(CASE WHEN own AND NOT gone THEN docs ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN own AND gone THEN docs ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN own AND n_fails = 1 THEN docs ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN own AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN own AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM result
"""
