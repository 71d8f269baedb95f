"""Near-duplicates by SimHash: fingerprints within a few bits of each other, found by a binary trie joined with itself.

Every node of the trie over all fingerprints stands for those with a common prefix. Starting from the pair (root, root),
pairs of nodes are followed together: a pair's children are the pairs of their children, the bits in which the two
prefixes differ add up, and a pair beyond the allowed number of bits is left with all below it. Pairs of large nodes
are tables, several levels a round; pairs of small nodes are tasks, which go on from there bit by bit in their memory.
A fingerprint has at most 64 + 2,016 others within two bits, so the work grows with the fingerprints, not their square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from textloom.cluster import fits_broadcast, lookup_join, write_and_read
from textloom.llm.common import bounded_batches
from textloom.llm.jaccard import components

BITS = 64
SEED = 42
#: Bytes of a text whose words are hashed at a time; cut between words.
PIECE = 1 << 22
#: Fingerprints of a node that a task takes whole. Levels followed in a round above that.
NODE = 16_384
STEP = 4
#: Pairs of nodes that a task follows at a time.
FRONTIER = 1 << 18
#: Rows and bytes of a table that is broadcast.
SMALL_ROWS, SMALL_BYTES = 200_000, 16 * 1024 * 1024
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = b" \t\n\x0b\x0c\r"


def _pieces(data: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(data):
        end = start + PIECE
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        yield data[start:end]
        start = end


def simhash(text: str | None, words: int = 3) -> int:
    """64 bits. One is set if it is in more than half of the XXH64 (seed 42) of the text's shingles of `words` words,
    repeats included, A-Z as a-z, joined by a space. Fewer words are one shingle; none, or null, give 0."""
    ones, n, before = np.zeros(BITS, np.int64), 0, []
    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)

    def add(hashes: np.ndarray) -> None:
        nonlocal ones, n
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)

    for piece in _pieces(data):
        found = before + piece.split()
        joined = b" ".join(found)
        if len(found) >= words:
            end = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
            starts, ends = np.concatenate([[0], end[:-1] + 1])[:len(found) - words + 1].tolist(), end[words - 1:].tolist()
            digest = xxhash.xxh64_intdigest
            add(np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(starts)))
        before = found[-(words - 1):] if words > 1 else []
    if not n and before:
        add(np.array([xxhash.xxh64_intdigest(b" ".join(before), SEED)], np.uint64))
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_simhash(df: DataFrame, words: int = 3, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id bigint, fingerprint bigint) of every row; the fingerprint's 64 bits as a signed number."""
    bounded_batches(df.sparkSession)
    docs = df.select(df[id_col].cast("bigint").alias("id"), df[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.fromiter((simhash(t.as_py(), words) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values.view(np.int64))], names=["id", "fingerprint"])

    return docs.mapInArrow(run, "id bigint, fingerprint bigint")


def _prefix(depth: int, value: Column) -> Column:
    """The first bits of a fingerprint: a node of the trie at this depth."""
    return F.shiftrightunsigned(value, BITS - depth) if depth else F.lit(0).cast("bigint")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, SMALL_ROWS, SMALL_BYTES) else df


def _tasks(prints: DataFrame, budget: int) -> list[tuple[int, DataFrame]]:
    """(depth, pairs of nodes (a, b, spent)) that are left to tasks: all pairs of nodes of at most NODE fingerprints that
    may still be within `budget` bits. `spent` bits differ so far; a <= b. `prints`: written, distinct fingerprints."""
    spark, depth, tasks = prints.sparkSession, 0, []
    n = prints.count()
    pairs = spark.createDataFrame([(0, 0, 0, n, n)], "a long, b long, spent int, n_a long, n_b long")
    while True:
        large = (F.col("n_a") > NODE) | (F.col("n_b") > NODE)
        tasks.append((depth, pairs.where(~large).select("a", "b", "spent")))
        pairs = pairs.where(large).select("a", "b", "spent")
        if depth == BITS or pairs.isEmpty():
            return tasks
        nodes = write_and_read(pairs.select(F.explode(F.array("a", "b")).alias("parent")).distinct(), "nodes")
        of = F.col("fingerprint")
        children = write_and_read(
            prints.select(_prefix(depth, of).alias("parent"), _prefix(depth + STEP, of).alias("child"))
            .join(_small(nodes), "parent", "left_semi").groupBy("parent", "child").agg(F.count("*").alias("n")), "children")
        children, depth = _small(children), depth + STEP
        first = children.select(F.col("parent").alias("a"), F.col("child").alias("child_a"), F.col("n").alias("n_a"))
        second = children.select(F.col("parent").alias("b"), F.col("child").alias("child_b"), F.col("n").alias("n_b"))
        spent = F.col("spent") + F.bit_count(F.col("child_a").bitwiseXOR(F.col("child_b")).bitwiseAND(F.lit((1 << STEP) - 1)))
        pairs = write_and_read(
            pairs.join(first, "a").join(second, "b")
            .where((spent <= budget) & ((F.col("a") != F.col("b")) | (F.col("child_a") <= F.col("child_b"))))
            .select(F.col("child_a").alias("a"), F.col("child_b").alias("b"), spent.cast("int").alias("spent"), "n_a", "n_b"), "pairs")


class _Side:
    """The trie below a node, over its sorted fingerprints: a node is a range of them, cut where its next bit turns to 1."""

    def __init__(self, values: np.ndarray):
        self.values, self._ones = values, {}

    def cut(self, depth: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if depth not in self._ones:
            bit = (self.values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            self._ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        ones = self._ones[depth]
        return high - (ones[high] - ones[low])


def near_pairs(xs: np.ndarray, ys: np.ndarray | None, depth: int, spent: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of the pairs of xs[i] and ys[j] (of xs, if None) within `budget` bits, where their first `depth` bits
    differ in `spent`. Both are sorted, and each one's first `depth` bits are the same for all. Of itself, each pair of xs
    is given once, and none with itself."""
    left = _Side(xs)
    right = left if ys is None else _Side(ys)
    stack = [(depth, *(np.array([v], np.int64) for v in (0, len(left.values), 0, len(right.values), spent)))]
    while stack:
        d, a0, a1, b0, b1, e = stack.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack += [(d, *(c[s] for c in (a0, a1, b0, b1, e))) for s in (slice(None, half), slice(half, None))]
            continue
        single = ((a1 - a0 == 1) & (b1 - b0 == 1)) if d < BITS else np.ones(len(a0), bool)
        if single.any():  # one fingerprint each: the bits left are added at once
            i, j = a0[single], b0[single]
            near = np.bitwise_count(left.values[i] ^ right.values[j]) <= budget
            if ys is None:
                near &= i != j
            if near.any():
                yield i[near], j[near]
            a0, a1, b0, b1, e = (c[~single] for c in (a0, a1, b0, b1, e))
        if not len(a0):
            continue
        am, bm = left.cut(d, a0, a1), right.cut(d, b0, b1)
        children = [(a0, am, b0, bm, e), (am, a1, bm, b1, e), (a0, am, bm, b1, e + 1), (am, a1, b0, bm, e + 1)]
        parts = []
        for k, (l0, l1, r0, r1, bits) in enumerate(children):
            keep = (l1 > l0) & (r1 > r0) & (bits <= budget)
            if ys is None and k == 3:
                keep &= a0 != b0  # of a node with itself, one of the two
            parts.append([c[keep] for c in (l0, l1, r0, r1, bits)])
        joined = [np.concatenate(c) for c in zip(*parts)]
        if len(joined[0]):
            stack.append((d + 1, *joined))


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Every place's smallest place that links lead to, with the links (i, j) added."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            further = parent[parent]
            if np.array_equal(further, parent):
                break
            parent = further


def _links(budget: int):
    """Of a pair of nodes: links (a, b) that connect what its near pairs connect, one a fingerprint at most."""
    def values(column: pa.Array, row: int) -> np.ndarray:
        return np.sort(column[row].values.to_numpy().view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                depth, a, b, spent = (batch.column(k)[r].as_py() for k in range(4))
                xs = values(batch.column(4), r)
                ys = None if a == b else values(batch.column(5), r)
                both = xs if ys is None else np.concatenate([xs, ys])
                parent = np.arange(len(both))
                for i, j in near_pairs(xs, ys, depth, spent, budget):
                    parent = _unite(parent, i, j if ys is None else j + len(xs))
                linked = np.flatnonzero(parent != np.arange(len(both)))
                if len(linked):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(both[v].view(np.int64)) for v in (linked, parent[linked])], names=["a", "b"])

    return run


def near_links(prints: DataFrame, budget: int = 2) -> DataFrame:
    """Links (a, b) between fingerprints of `prints` (fingerprint bigint, distinct, written): two of them are connected by
    these exactly if they are by pairs of fingerprints that differ in at most `budget` bits."""
    bounded_batches(prints.sparkSession)
    links = None
    for depth, pairs in _tasks(prints, budget):
        if pairs.isEmpty():
            continue
        nodes = write_and_read(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
        members = write_and_read(
            prints.select(_prefix(depth, F.col("fingerprint")).alias("node"), "fingerprint").join(_small(nodes), "node", "left_semi")
            .groupBy("node").agg(F.collect_list("fingerprint").alias("members")), "members")  # NODE at most
        # the larger side of a pair is read with it, the other one is joined; a node with itself is read once
        rows = pairs.join(members.select(F.col("node").alias("a"), F.col("members").alias("xs")), "a")
        other = members.select(F.col("node").alias("b"), F.col("members").alias("ys"))
        itself = rows.where("a = b").withColumn("ys", F.lit(None).cast("array<bigint>"))
        rows = rows.where("a <> b").join(other, "b").unionByName(itself).select(F.lit(depth).alias("depth"), "a", "b", "spent", "xs", "ys")
        found = rows.mapInArrow(_links(budget), "a bigint, b bigint")
        links = found if links is None else links.union(found)
    if links is None:
        return prints.sparkSession.createDataFrame([], "a bigint, b bigint")
    return write_and_read(links, "near")


def simhash_components(
    df: DataFrame, words: int = 3, bits: int = 2, text_col: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """id, fingerprint (16 hexadecimal digits), component_id of every row.

    Fingerprints as in `simhash`; two rows link if theirs differ in at most `bits` bits, those of texts without words (0)
    and of copies included. component_id is the smallest id that can be reached, the row's own included. Rows without an
    id take part and have the component's id, null if no row of it has one. Rows that share an id each have their own
    fingerprint and component. Texts of any length are taken whole. An empty table gives an empty one; other columns of
    `df` are not looked at.
    """
    rows = write_and_read(with_simhash(df, words, text_col, id_col).withColumn("_row", F.monotonically_increasing_id()), "simhash")
    prints = write_and_read(rows.groupBy("fingerprint").agg(F.min("id").alias("low")), "prints")
    labels = components(near_links(prints.select("fingerprint"), bits)).withColumnRenamed("node", "fingerprint")
    named = write_and_read(prints.join(labels, "fingerprint", "left").withColumn(
        "label", F.coalesce("label", "fingerprint")), "labelled")
    names = write_and_read(named.groupBy("label").agg(F.min("low").alias("component_id")), "names")
    limits = {"rows": SMALL_ROWS, "size": SMALL_BYTES}
    named = write_and_read(lookup_join(named, names, ["label"], "fingerprint", **limits).select("fingerprint", "component_id"), "named")
    return lookup_join(rows, named, ["fingerprint"], "_row", **limits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
