"""Personal data: fixed patterns, and contexts learned from what they find (bootstrapped extraction)."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textloom.cluster import write_and_read
from textloom.llm.common import batch, bounded_batches, map_batches, nullable
from textloom.llm.shingles import CHUNK_BYTES, _word_hashes, mixed

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile("[0-9]")
# possessive, and begun only where a run begins: the same matches in linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# what may be an identifier in another form
_NUMBER = re.compile(r"(?<![0-9A-Za-z])\(?[0-9](?:[ ().\-/]{0,2}+[0-9])++")
_SPOKEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(]at[\])] ?| at |@)[A-Za-z0-9-]++(?:(?: ?[\[(]dot[\])] ?| dot |\.)[A-Za-z0-9-]++)*+")
_SPACE = frozenset(" \t\n\x0b\x0c\r")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: A pattern counts from so many different seeds on, and finds new identifiers from this confidence on.
MIN_SEEDS, MIN_CONFIDENCE, ROUNDS = 5, 0.5, 3
#: Patterns that are broadcast at a time; more are counted and applied in several passes.
PATTERNS_AT_ONCE = 4_000_000

Span = tuple[int, int, int]  # start, kind, end


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """As the pattern for e-mail addresses finds them, from one @ to the next."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, EMAIL, m.end()))
            low = m.end()
        at = text.find("@", max(low, at + 1))
    return out


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) in code points, ordered by start, then kind."""
    out = _emails(text)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) < 4 and int(p or "0") < 256 for p in (x.lstrip("0") for x in m.group().split("."))):
                out.append((m.start(), IP, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() > 11:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), CARD, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), PHONE, m.end()))
    out.sort()
    return out


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, list[int]]]:
    """(start, end, kinds by shape) of what looks like an identifier and touches no base span."""
    found = []
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            n = sum(c.isdigit() for c in m.group()) if m.end() - m.start() > 6 else 0
            kinds = [k for k, low, high in ((CARD, 12, 19), (PHONE, 7, 15)) if low <= n <= high]
            if m.group().count(".") == 3 and n <= 12:
                kinds.append(IP)
            if kinds:
                found.append((m.start(), m.end(), kinds))
    if "@" in text or "dot" in text:
        found += [(m.start(), m.end(), [EMAIL]) for m in _SPOKEN.finditer(text) if "@" in m.group() or "dot" in m.group()]
    if not found:
        return []
    starts, ends = [], []  # of the base spans, overlapping ones as one
    for s, _, e in base:
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    free = []
    for f in sorted(found):
        before = bisect_left(starts, f[1]) - 1  # the last that begins before the candidate ends
        if before < 0 or ends[before] <= f[0]:
            free.append(f)
    return free


def _context(text: str, start: int) -> list[str]:
    """The two words before a span, or the one that there is, if white space parts them from it; however long they are."""
    words, at = [], start
    for _ in range(2):
        end = at
        while end and text[end - 1] in _SPACE:
            end -= 1
        if end == at or not end:  # a word that touches the span, or none
            break
        at = end
        while at and text[at - 1] not in _SPACE:
            at -= 1
        words.append(text[at:end].translate(_LOWER))
    return words[::-1]


def _pattern_ids(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the patterns that end with each word: the word alone, and with the one before."""
    pairs = owner[1:] == owner[:-1]
    return mixed(words + np.uint64(11)), mixed(words[:-1][pairs] * np.uint64(0xD1342543DE82EF95) + words[1:][pairs])


def _ids_of(words: list[str]) -> list[int]:
    data = " ".join(words).encode("utf-8", "replace")
    hashes, owner = _word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    one, two = _pattern_ids(hashes, owner)
    return [int(x) for x in np.concatenate([one[-1:], two[-1:]]).astype(np.int64)]


def _sightings(docs: DataFrame) -> DataFrame:
    """pattern, words, instance, kind (of a seed; -1: a candidate), kinds it may have."""
    schema = pa.schema([("pattern", pa.int64()), ("words", pa.string()), ("instance", pa.string()), ("kind", pa.int32()),
                        ("kinds", pa.list_(pa.int32()))])

    def apply(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in b.column(0).to_pylist():
            if not text:
                continue
            base = base_spans(text)
            spans = [(s, e, k, [k]) for s, k, e in base] + [(s, e, -1, kinds) for s, e, kinds in candidates(text, base)]
            for start, end, kind, kinds in spans:
                words = _context(text, start)
                for n, pattern in enumerate(_ids_of(words) if words else []):
                    rows.append((pattern, " ".join(words[-1 - n:]), text[start:end].translate(_LOWER), kind, kinds))
        return batch(schema, list(zip(*rows)) if rows else [[]] * 5)

    return map_batches(docs.select("text"), lambda: apply,
                       "pattern long, words string, instance string, kind int, kinds array<int>")


def _occurrences(docs: DataFrame, patterns: np.ndarray) -> DataFrame:
    """(pattern, total): how often each of the sorted patterns occurs, whatever follows."""
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def run(batches):
        known = shared.value
        total = np.zeros(len(known), np.int64)
        for b in batches:
            column = b.column(0).fill_null("").cast(pa.large_string())
            if not len(column):
                continue
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
            start = 0
            while start < len(column):
                end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, "right")) - 1)
                end = min(end, len(column))
                words, owner = _word_hashes(data[offsets[start]:offsets[end]], offsets[start:end + 1] - offsets[start])
                for ids in _pattern_ids(words, owner) if len(words) else ():
                    ids = ids.astype(np.int64)
                    at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
                    total += np.bincount(at[known[at] == ids], minlength=len(known))
                start = end
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known[some]), pa.array(total[some])], names=["pattern", "total"])

    return docs.select("text").mapInArrow(run, "pattern long, total long").groupBy("pattern").agg(F.sum("total").alias("total"))


def learn_patterns(df: DataFrame, text_col: str = "text", min_seeds: int = MIN_SEEDS,
                   min_confidence: float = MIN_CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind, words, confidence, seeds: contexts that announce an identifier of a kind.

    Seeds are what the fixed patterns find. The words before them are patterns, and what looks like an identifier after
    the same words is an instance too. A pattern's confidence in a kind is the weight of the instances after it over
    all its occurrences in the corpus; an instance that is no seed weighs as much as the other patterns before it,
    taken as independent, make it likely. Both are computed in turn over the graph of patterns and instances. A pattern needs
    `min_seeds` different seeds, so copies of a document add nothing.
    """
    docs = df.select(df[text_col].cast("string").alias("text"))
    seen = write_and_read(_sightings(docs).groupBy("pattern", "words", "instance", "kind", "kinds").count(), "sightings")
    supported = seen.where("kind >= 0").groupBy("pattern", "kind").agg(F.count_distinct("instance").alias("seeds")).where(
        F.col("seeds") >= min_seeds)
    supported = write_and_read(supported, "patterns")
    parts = -(-supported.count() // PATTERNS_AT_ONCE)
    total = None
    for part in range(parts):
        own = supported.where(F.pmod(F.col("pattern"), F.lit(parts)) == part).select("pattern").distinct()
        counted = _occurrences(docs, np.sort(own.toArrow().column("pattern").to_numpy()))
        total = counted if total is None else total.union(counted)
    if total is None:
        return supported.select("pattern", "kind", F.lit("").alias("words"), F.lit(0.0).alias("confidence"), "seeds")
    # edges: a pattern's kind, an instance, how often; seeds of other kinds weigh nothing
    edges = seen.join(supported, "pattern").join(total, "pattern").withColumn("fits", F.array_contains("kinds", supported["kind"]))
    edges = write_and_read(edges.select(
        "pattern", supported["kind"].alias("kind"), "words", "instance", "seeds", "total", seen["count"].alias("n"),
        F.when(seen["kind"] >= 0, F.col("fits").cast("double")).when(~F.col("fits"), 0.0).alias("fixed")), "edges")
    scored = None
    for _ in range(rounds):
        if scored is None:
            known = edges.withColumn("weight", F.coalesce("fixed", F.lit(0.0)))
        else:  # what the other patterns before an instance say of it: none vouches for itself
            doubt = F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))
            loose = edges.where("fixed IS NULL").join(scored.withColumn("doubt", doubt).drop("confidence"), ["pattern", "kind"])
            all_ = loose.groupBy("instance", "kind").agg(F.sum("doubt").alias("doubts"))
            loose = loose.join(all_, ["instance", "kind"]).withColumn("weight", 1 - F.exp(F.col("doubts") - F.col("doubt")))
            known = edges.where("fixed IS NOT NULL").withColumn("weight", F.col("fixed")).unionByName(loose.select(*edges.columns, "weight"))
        scored = write_and_read(known.groupBy("pattern", "kind").agg(
            (F.sum(F.col("n") * F.col("weight")) / (F.first("total") + 1)).alias("confidence")), "scores")
    words = edges.groupBy("pattern", "kind").agg(F.min("words").alias("words"), F.max("seeds").alias("seeds"))
    return scored.join(words, ["pattern", "kind"]).where(F.col("confidence") >= min_confidence).select(
        "pattern", "kind", "words", "confidence", "seeds")


def _best_kinds(patterns: DataFrame) -> list[dict[int, dict[int, float]]]:
    """pattern -> kind -> confidence, in parts of bounded size."""
    patterns = write_and_read(patterns.select("pattern", "kind", "confidence"), "learned")
    parts = max(1, -(-patterns.count() // PATTERNS_AT_ONCE))
    out = []
    for part in range(parts):
        found: dict[int, dict[int, float]] = {}
        for r in patterns.where(F.pmod(F.col("pattern"), F.lit(parts)) == part).toLocalIterator():
            found.setdefault(r["pattern"], {})[r["kind"]] = r["confidence"]
        out.append(found)
    return out


def added_spans(text: str, base: list[Span], learned: dict[int, dict[int, float]]) -> list[Span]:
    """Candidates after a learned pattern, of the kind that fits with most confidence; the earlier of two that overlap."""
    out, last = [], -1
    for start, end, kinds in candidates(text, base) if learned else ():
        words = _context(text, start)
        options = [(c, -k) for p in (_ids_of(words) if words else []) for k, c in learned.get(p, {}).items() if k in kinds]
        if options and start >= last:
            out.append((start, -max(options)[1], end))
            last = end
    return out


def digest_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _one_pass(patterns: DataFrame) -> dict[int, dict[int, float]]:
    merged: dict[int, dict[int, float]] = {}
    parts = _best_kinds(patterns)
    if len(parts) > 1:
        raise ValueError("raise min_seeds: more patterns than one pass can hold")
    merged.update(parts[0])
    return merged


def find_pii(df: DataFrame, patterns: DataFrame | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (of the fixed patterns), base_sha256, spans (all of them), found (as
    structs) of every row; patterns are learned from `df` unless given.

    Spans are in code points, ends exclusive, by start and then kind. A null text is empty and has none. Repeated rows
    and null ids give a row each; other columns of `df` are not looked at.
    """
    bounded_batches(df.sparkSession)
    learned = _one_pass(learn_patterns(df, text_col) if patterns is None else patterns)
    shared = df.sparkSession.sparkContext.broadcast(learned)
    picked = df.select(df[id_col].alias("_id"), df[text_col].cast("string").alias("_text"))
    from pyspark.sql.pandas.types import to_arrow_type

    key = picked.schema[0].dataType
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
    schema = pa.schema([("_id", to_arrow_type(key)), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()),
                        ("spans", pa.string()), ("found", pa.list_(span))])

    def apply(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in b.column(1).to_pylist():
            base = base_spans(text or "")
            spans = sorted(base + added_spans(text or "", base, shared.value))
            rows.append((*[sum(k == kind for _, k, _ in base) for kind in range(4)],
                         hashlib.sha256(digest_text(base).encode()).hexdigest(), digest_text(spans),
                         [{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in spans]))
        return batch(schema, [b.column(0), *zip(*rows)])

    return map_batches(picked, lambda: apply, f"_id {key.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, "
                       "base_sha256 string, spans string, found array<struct<start:int,end:int,kind:string>>"
                       ).withColumnRenamed("_id", id_col)


def redacted(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind in brackets; of overlapping spans the first counts and covers the others."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_pii(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """`df` with the spans of `find_pii` in its texts replaced by [EMAIL], [IP], [CARD] or [PHONE]; `length_col`, if
    there is one, is set to the new number of code points. Null texts stay null; all other columns stay."""
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(_one_pass(learn_patterns(df, text_col)))
    at = df.columns.index(text_col)
    length = df.columns.index(length_col) if length_col in df.columns else None

    def apply(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text in b.column(at).to_pylist():
            base = base_spans(text or "")
            spans = base + added_spans(text or "", base, shared.value)
            texts.append(redacted(text, spans) if spans else text)
        columns = list(b.columns)
        columns[at] = pa.array(texts, b.schema.field(at).type)
        if length is not None:
            columns[length] = pa.array([None if t is None else len(t) for t in texts], b.schema.field(length).type)
        return pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return map_batches(df, lambda: apply, nullable(df.schema))
