"""Document fingerprints: a homomorphic hash of the multiset of paragraphs. DataFrame functions only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A word of the vector is a sum modulo 2^60: sums of two stay within 64 bits, and a word is 15 hexadecimal digits.
BITS = 60
MASK = (1 << BITS) - 1
EXACT = 4          # words of 60 bits from the sha256 of a paragraph
STEPS = 12         # bits of a counter while a slice of sentences is added up: 12 words of 5 for each 60-bit hash
ONES = sum(1 << (STEPS * f) for f in range(BITS // STEPS))
SLICE = (1 << STEPS) - 1
WIDE = 30          # bits of a counter in the vector: 30 words of 2 for each hash; no array has 2^29 sentences
PAIR = BITS // WIDE
WIDE_ONES = sum(1 << (WIDE * f) for f in range(PAIR))
WORDS = EXACT + 1 + 2 * WIDE
#: Documents of a range that one task puts in order, about; more ranges than MOST_RANGES aren't made.
RANGE_ROWS = 2_000
MOST_RANGES = 10_000


def _number(digits: Column, start: Column | int) -> Column:
    return F.conv(F.substring(digits, start, F.lit(15) if isinstance(start, Column) else 15), 16, 10).cast("long")


def _right(word: Column, bits: Column | int) -> Column:
    return F.call_function("shiftright", word, bits if isinstance(bits, Column) else F.lit(bits))


def _left(word: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", word, bits)


def _field(word: Column, bits: int, f: Column | int) -> Column:
    return _right(word, f * bits).bitwiseAND(F.lit((1 << bits) - 1))


def _each(n: int, value) -> Column:
    """array(value(0), ..., value(n - 1)) with `value` written once: plans of hundreds of such terms take seconds."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), value)


def _part(a: Column, b: int) -> Column:
    return F.floor(a / b).cast("int")


def _total(values: Column, part=lambda x: x) -> Column:
    """Sum modulo 2^60. The sum of two such words can't overflow."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: (acc + part(x)).bitwiseAND(F.lit(MASK)))


def with_fingerprint(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds `name`: array<long> of WORDS words, the sum over the text's paragraphs (lines) of a vector that depends on
    the paragraph alone. So it doesn't depend on their order, equal texts have equal fingerprints, and `insert` and
    `delete` of a paragraph's vector give the fingerprint of the changed text.

    A paragraph's vector: 4 words of its sha256; the number of its sentences; and for each sentence 120 bits of its
    md5, each added to a counter of 30 bits. The first words make different multisets of paragraphs differ; the
    counters, as sums of random signs, also tell how much two texts have in common. A null text counts as empty.
    """
    text = F.coalesce(text, F.lit(""))
    df = df.withColumn("_lines", F.transform(F.split(text, "\n"), lambda p: F.sha2(p, 256)))
    df = df.withColumn("_parts", F.transform(F.split(text, r"[.!?] |\n"), lambda s: F.md5(s)))
    exact = _each(EXACT, lambda k: _total(F.col("_lines"), lambda h: _number(h, 1 + 15 * k)))
    # the sentences of a slice don't run over 12 bits: five counters are added at a time, then made wide. Each step takes
    # the one before as its argument, so none is computed again for every word
    slices = F.transform(F.sequence(F.lit(0), _part(F.size("_parts") - 1, SLICE)), lambda k: F.slice("_parts", k * SLICE + 1, SLICE))
    numbers = F.transform(slices, lambda s: F.array(*[F.transform(s, lambda m: _number(m, at)) for at in (1, 16)]))
    narrow = F.transform(numbers, lambda ab: F.concat(*[_each(STEPS, lambda i: _total(
        F.get(ab, h), lambda x: _right(x, i).bitwiseAND(F.lit(ONES)))) for h in (0, 1)]))
    bit = lambda v, h, p: _field(F.get(v, h * STEPS + p % STEPS), STEPS, _part(p, STEPS))
    both = lambda v, h, p: bit(v, h, p) + _left(bit(v, h, p + WIDE), F.lit(WIDE))
    counters = F.aggregate(narrow, F.array_repeat(F.lit(0).cast("long"), 2 * WIDE), lambda acc, v: insert(
        acc, _each(2 * WIDE, lambda i: both(v, _part(i, WIDE), i % WIDE))))
    return df.withColumn(name, F.concat(exact, F.array(F.size("_parts").cast("long")), counters)).drop("_lines", "_parts")


def insert(fingerprint: Column, paragraphs: Column) -> Column:
    """The fingerprint of a text with more paragraphs, from theirs."""
    return F.zip_with(fingerprint, paragraphs, lambda a, b: (a + b).bitwiseAND(F.lit(MASK)))


def delete(fingerprint: Column, paragraphs: Column) -> Column:
    return F.zip_with(fingerprint, paragraphs, lambda a, b: (a + F.lit(MASK) - b + F.lit(1)).bitwiseAND(F.lit(MASK)))


def as_text(fingerprint: Column) -> Column:
    """Its words, each as 15 hexadecimal digits: all that `likeness` reads."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 15, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the common part of the two multisets of sentences, 0 to 1: for counters x and y,
    1 - |x - y|² / (|x|² + |y|²), which estimates 2 f·g / (f·f + g·g) of the sentence counts f and g, to about 0.1."""
    n = [F.element_at(v, EXACT + 1) for v in (a, b)]
    counters = [F.slice(v, EXACT + 2, 2 * WIDE) for v in (a, b)]

    def squares(values: Column, minus: Column) -> Column:
        sign = lambda w, f: 2 * _field(w, WIDE, f) - minus
        return F.aggregate(values, F.lit(0).cast("long"), lambda acc, w: acc + sum(
            (sign(w, f) * sign(w, f) for f in range(1, PAIR)), sign(w, 0) * sign(w, 0)))

    # counters of the difference: each field is taken apart before it is subtracted
    pairs = F.zip_with(*counters, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    apart = lambda p, f: 2 * (_field(p["x"], WIDE, f) - _field(p["y"], WIDE, f)) - (n[0] - n[1])
    distance = F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, p: acc + sum(
        (apart(p, f) * apart(p, f) for f in range(1, PAIR)), apart(p, 0) * apart(p, 0)))
    lengths = squares(counters[0], n[0]) + squares(counters[1], n[1])
    return (
        F.when(a == b, F.lit(1.0)).when(lengths == 0, F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - distance / lengths)))
    )


def _cuts(ids: DataFrame) -> list[int]:
    """Cuts of the ids into ranges of about RANGE_ROWS."""
    spark = ids.sparkSession
    n = ids.count()
    wanted = min(MOST_RANGES, max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), n // RANGE_ROWS))
    share = [(k + 1) / wanted for k in range(wanted - 1)]
    cuts = ids.agg(F.percentile_approx("id", share, max(10_000, 20 * wanted))).first()[0] if share else []
    return sorted(set(cuts or []))


def _range_of(cuts: list[int]) -> Column:
    """How many cuts are at most the id; the number after all for null. Looked up in two steps."""
    width = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    if not blocks:
        return F.when(F.col("id").isNull(), 1).otherwise(0)
    heads = F.from_json(F.lit(json.dumps([b[0] for b in blocks])), "array<bigint>")
    inner = F.from_json(F.lit(json.dumps(blocks)), "array<array<bigint>>")
    block = F.size(F.filter(heads, lambda c: c <= F.col("id")))
    found = F.when(block == 0, 0).otherwise(
        (block - 1) * width + F.size(F.filter(F.element_at(inner, F.greatest(block, F.lit(1))), lambda c: c <= F.col("id"))))
    return F.when(F.col("id").isNull(), len(cuts) + 1).otherwise(found)


def with_next(df: DataFrame, values: list[str], prefix: str = "next_") -> DataFrame:
    """df(id bigint, ...) with the `values` of the next row by ascending id (null last; after the last row: the first).

    The order is cut into ranges. The first rows of a range are repeated at the end of the range before, so each range
    is ordered for itself and the rows move once. Only the cuts and first ids pass through the driver.
    """
    cuts = _cuts(df.select("id"))
    firsts = df.select("id", _range_of(cuts).alias("_range")).groupBy("_range").agg(F.min("id").alias("first")).collect()
    firsts = sorted((r["_range"], r["first"]) for r in firsts)
    before = {r: firsts[k - 1][0] for k, (r, _) in enumerate(firsts)}
    top = len(cuts) + 2
    first = F.from_json(F.lit(json.dumps([dict(firsts).get(r) for r in range(top)])), "array<bigint>")
    back = F.from_json(F.lit(json.dumps([before.get(r, 0) for r in range(top)])), "array<int>")
    df = df.withColumn("_own", _range_of(cuts))
    at = F.col("_own") + 1
    place = lambda r, tail: F.struct(r.cast("int").alias("range"), F.lit(tail).alias("tail"))
    df = df.withColumn("_at", F.explode(F.when(
        F.element_at(first, at).eqNullSafe(F.col("id")),
        F.array(place(F.col("_own"), False), place(F.element_at(back, at), True)),
    ).otherwise(F.array(place(F.col("_own"), False))))).drop("_own")
    df = df.select("*", F.col("_at.range").alias("_range"), F.col("_at.tail").alias("_tail")).drop("_at")
    # one window, so one exchange: its keys are columns and all values are taken in one step
    order = Window.partitionBy("_range").orderBy(F.col("_tail"), F.col("id").asc_nulls_last(), *values)
    df = df.select("*", *[F.lead(c).over(order).alias(prefix + c) for c in values])
    return df.where("NOT _tail").drop("_range", "_tail")


def fingerprint_edits(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has its last half replaced by the start of the next text by ascending id (null ids last, rows of
    the same id by text; the last row is followed by the first, a single row by itself). Null texts are empty. Ids must
    be whole numbers. Other columns of `df` are not looked at.
    """
    docs = df.select(df[id_col].cast("bigint").alias("id"), F.coalesce(df[text_col], F.lit("")).alias("text"))
    docs = with_next(with_fingerprint(docs, F.col("text"), "fp"), ["text", "fp"])
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    docs = docs.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)))
    docs = docs.select("id", "n_chars", "edited", "fp", "next_fp")
    docs = with_fingerprint(docs, F.col("edited"), "edited_fp")
    return docs.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def sql() -> str:
    """DuckDB SQL for `fingerprint_edits` over `documents`: a row for each line, sentence and counter, summed by document."""
    number = lambda start: f"('0x' || substr(h, {start}, 15))::BIGINT"
    exact = ", ".join(f"(sum({number(1 + 15 * k)}) & {MASK}::HUGEINT)::BIGINT" for k in range(EXACT))
    spread = ", ".join(f"(sum(({x} >> {k}) & {WIDE_ONES}::BIGINT) & {MASK}::HUGEINT)::BIGINT" for x in ("a", "b") for k in range(WIDE))
    square = lambda x: f"sum(({x}) * ({x}))::BIGINT"
    near = lambda d, x, y: (
        f"CASE WHEN {x}.words = {y}.words THEN 1.0::DOUBLE WHEN {x}.length + {y}.length = 0 THEN 0.0::DOUBLE "
        f"ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - {d}.apart::DOUBLE / ({x}.length + {y}.length)::DOUBLE)) END")
    text = lambda v: f"array_to_string(list_transform({v}.words, lambda x: printf('%015x', x)), '')"
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars,
    row_number() OVER (ORDER BY doc_id NULLS LAST, coalesce(text, '')) AS place FROM documents),
pairs AS (
  SELECT d.doc_id, d.place, n.place AS next_place, d.text, d.n_chars,
    substr(d.text, 1, d.n_chars - d.n_chars // 2) || substr(n.text, 1, d.n_chars // 2) AS edited
  FROM docs d JOIN docs n ON n.place = CASE WHEN d.place = (SELECT count(*) FROM docs) THEN 1 ELSE d.place + 1 END),
texts AS MATERIALIZED (SELECT place, 'own' AS kind, text FROM pairs UNION ALL SELECT place, 'edited', edited FROM pairs),
lines AS (SELECT place, kind, sha256(unnest(string_split(text, chr(10)))) AS h FROM texts),
heads AS (SELECT place, kind, [{exact}] AS words FROM lines GROUP BY place, kind),
hashes AS (SELECT place, kind, md5(unnest(regexp_split_to_array(text, '[.!?] |\n'))) AS h FROM texts),
numbers AS MATERIALIZED (SELECT place, kind, {number(1)} AS a, {number(16)} AS b FROM hashes),
spread AS MATERIALIZED (SELECT place, kind, count(*) AS n, [{spread}] AS words FROM numbers GROUP BY place, kind),
counters AS MATERIALIZED (
  SELECT place, kind, n, i, (words[1 + i // {PAIR}] >> ({WIDE} * (i % {PAIR}))) & {(1 << WIDE) - 1} AS c
  FROM spread, range(0, {2 * WIDE * PAIR}) r(i)),
lengths AS (SELECT place, kind, {square('2 * c - n')} AS length FROM counters GROUP BY place, kind),
prints AS (
  SELECT s.place, s.kind, heads.words || [s.n] || s.words AS words, length
  FROM spread s JOIN heads USING (place, kind) JOIN lengths USING (place, kind)),
edits AS (
  SELECT x.place, {square('2 * (x.c - y.c) - (x.n - y.n)')} AS apart FROM counters x
  JOIN counters y ON y.place = x.place AND y.i = x.i WHERE x.kind = 'own' AND y.kind = 'edited' GROUP BY x.place),
after AS MATERIALIZED (
  SELECT p.place, n, i, c FROM counters y JOIN (SELECT place, next_place FROM pairs) p ON p.next_place = y.place WHERE kind = 'own'),
nexts AS (
  SELECT x.place, {square('2 * (x.c - y.c) - (x.n - y.n)')} AS apart FROM counters x
  JOIN after y ON y.place = x.place AND y.i = x.i WHERE x.kind = 'own' GROUP BY x.place)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {text('o')} AS fingerprint, {text('e')} AS edited_fingerprint,
  {near('edits', 'o', 'e')} AS near_edited, {near('nexts', 'o', 'n')} AS near_next
FROM pairs p JOIN prints o ON o.place = p.place AND o.kind = 'own' JOIN prints e ON e.place = p.place AND e.kind = 'edited'
JOIN prints n ON n.place = p.next_place AND n.kind = 'own' JOIN edits ON edits.place = p.place JOIN nexts ON nexts.place = p.place
"""
