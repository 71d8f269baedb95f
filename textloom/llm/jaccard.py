"""Join of documents by Jaccard similarity of their word shingles, with token-combination prefixes.

Shingles are ordered globally: those of few documents first, those in a large share of all documents ("common") last. A
document of n shingles that has similarity t with another misses at most m = n - ceil(t n) of its own. Its prefix is
extended until m missing shingles can't spoil it: each rare shingle in it stands alone, so m + 1 of them suffice; of
common shingles only combinations of two within a class count, so each class spends one more. Two similar documents
then have a rare shingle or a combination of their prefixes in common. Only those are indexed, what they bring together
is filtered by size and position, and what is left is verified on the texts.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.cluster import fits_broadcast, shared_dir, write_and_read
from textloom.llm.common import bounded_batches
from textloom.llm.shingles import mixed, shingle_sets

#: Bytes of text that a worker turns into shingles at a time; these take some thirty times as much.
BATCH_BYTES = 4 * 1024 * 1024
#: A shingle in at least this share of the documents, and in this many, is common.
COMMON_SHARE = 0.005
COMMON_DOCS = 5_000
#: A batch reports a shingle that this share of its documents has, and at least so many.
LOCAL_SHARE, LOCAL_DOCS = 0.002, 4
#: Shingles of a hash range, which one group counts, about.
RANGE_SHINGLES = 1_000_000
#: Classes of common shingles for each shingle of a document: combinations grow with its size, not the square.
CLASSES = 0.05


def _digests(who: np.ndarray, what: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(set sizes, order-free 64-bit digests of the sets)."""
    size = np.bincount(who, minlength=n)
    digest = np.zeros(n, np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        digest[some] = mixed(np.add.reduceat(mixed(what ^ np.uint64(0x243F6A8885A308D3)), np.searchsorted(who, some)))
    return size, digest.astype(np.int64)


def _batch_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of texts: text and hash of every shingle, sizes, digests."""
    parts = [(s + who, what) + _digests(who, what, n) for s, n, who, what in shingle_sets(column, words)]
    return tuple(np.concatenate(p) for p in zip(*parts))


def _first_of_each(sizes: np.ndarray, digests: np.ndarray, ids: pa.Array) -> np.ndarray:
    """Marks one text of each set among the rows with an id, none of empty ones: copies within a batch count once."""
    first = np.zeros(len(sizes), bool)
    some = np.flatnonzero((sizes > 0) & np.array(ids.is_valid()))
    first[some[np.unique(digests[some], return_index=True)[1]]] = True
    return first


def _scan(df: DataFrame, words: int) -> DataFrame:
    """A row per document (id, n, digest), and shingles that many documents of a batch share (token, copies)."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            who, what, size, digest = _batch_sets(b.column(1), words)
            token, count = np.unique(what[_first_of_each(size, digest, b.column(0))[who]], return_counts=True)
            often = count >= max(LOCAL_DOCS, LOCAL_SHARE * b.num_rows)
            rows, tokens = b.num_rows, int(often.sum())
            nulls = pa.nulls(tokens, pa.int64()), pa.nulls(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([b.column(0), nulls[0]]), pa.concat_arrays([pa.array(size.astype("int64")), nulls[0]]),
                pa.concat_arrays([pa.array(digest), nulls[0]]),
                pa.concat_arrays([nulls[1], pa.array(token[often].astype(np.int64))]),
                pa.concat_arrays([nulls[1], pa.array(count[often].astype("int64"))])],
                names=["id", "n", "digest", "token", "copies"])

    return df.mapInArrow(run, "id long, n long, digest long, token long, copies long")


def _missing(n: int, num: int) -> int:
    """How many of its n shingles a document with a partner may miss."""
    return n - -(-num * n // 100)


def _combinations(common: np.ndarray, rare: int, n: int, num: int) -> list[int]:
    """Signatures of a document whose `rare` shingles alone don't fill its prefix.

    The classes of common shingles depend on a size band. Partners are at most one band apart, and a document signs for
    its own band and the next, so two partners have a band of theirs in common.
    """
    common, need, out = np.sort(common), _missing(n, num) + 1 - rare, set()
    band = int(np.log(n) / np.log(100 / num))
    for b in (band, band + 1):
        classes = max(1, int(CLASSES * (100 / num) ** b))
        label = (common % np.uint64(classes)).astype(np.int64)
        groups: dict[int, list[int]] = {}
        left = need
        for token, c in zip(common.tolist(), label.tolist()):
            if left <= 0:
                break
            group = groups.setdefault(c, [])
            left -= bool(group)
            group.append(token)
        pairs = np.array([p for g in groups.values() for p in combinations(g, 2)], np.uint64).reshape(-1, 2)
        out.update((mixed(mixed(pairs[:, 0]) + pairs[:, 1] + np.uint64(b)) | np.uint64(1 << 63)).astype(np.int64).tolist())
    return list(out)


def _planes(values: np.ndarray) -> bytes:
    """Bytes by place: high ones of small numbers become runs, which the shuffle's compression removes."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(data: bytes, kind: str, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, n).T).view(kind).ravel()


TOKENS, SIGNED = 0, 1


def _deal(df: DataFrame, words: int, num: int, ranges: int, common) -> DataFrame:
    """Shingles by hash range, packed: (range, kind, rows, data)."""
    def run(batches):
        heavy = common.value
        for b in batches:
            ids = b.column(0)
            if not b.num_rows:
                continue
            who, what, size, digest = _batch_sets(b.column(1), words)
            keep = _first_of_each(size, digest, ids)
            ids = ids.fill_null(0).to_numpy()
            used = keep[who]
            who, what = who[used], what[used]
            rows = []
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, what), len(heavy) - 1)
                often = heavy[at] == what
                count = np.bincount(who[often], minlength=len(size))
                signed = []
                for i in np.flatnonzero(count):
                    n, rare = int(size[i]), int(size[i] - count[i])
                    signed.append((ids[i], -int(count[i])))  # tells how many are common
                    if n > 1 and rare <= _missing(n, num):
                        s, e = np.searchsorted(who, [i, i + 1])
                        signed += [(ids[i], sig) for sig in _combinations(what[s:e][often[s:e]], rare, n, num)]
                who, what = who[~often], what[~often]
                if signed:
                    table = np.array(signed, np.int64)
                    rows.append((int(table[0, 0]) % ranges, SIGNED, len(table), _planes(table[:, 0].copy()) + _planes(table[:, 1].copy())))
            r = ((what >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            low = what & np.uint64(0xFFFFFFFF)
            order = np.argsort((r << np.uint64(32)) | low)
            r, low, owner = r[order].astype(np.int64), low[order].astype(np.uint32), ids[who[order]]
            cut = np.searchsorted(r, np.arange(ranges + 1))
            for k in np.flatnonzero(np.diff(cut)):
                s, e = cut[k], cut[k + 1]
                steps = np.diff(low[s:e], prepend=np.uint32(0)).astype(np.uint32)
                rows.append((int(k), TOKENS, int(e - s), _planes(steps) + _planes(owner[s:e].copy())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))] if rows else
                [pa.array([], t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.binary())],
                names=["range", "kind", "rows", "data"])

    return df.mapInArrow(run, "range int, kind int, rows int, data binary")


def _count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of one hash range: (id, sig, df) of every shingle that two documents or more share. df is -1 for combinations and
    -2 for the number of a document's common shingles."""
    ids, sigs, dfs, lows, owners = [], [], [], [], []
    for kind, n, data in zip(*(table.column(c).to_pylist() for c in ("kind", "rows", "data"))):
        if kind == TOKENS:
            lows.append(np.cumsum(_from_planes(data[:4 * n], "u4", n), dtype=np.uint32))
            owners.append(_from_planes(data[4 * n:], "i8", n))
        else:
            owner, sig = _from_planes(data[:8 * n], "i8", n), _from_planes(data[8 * n:], "i8", n)
            small = (sig < 0) & (sig > -(1 << 40))
            ids.append(owner)
            sigs.append(np.where(small, -sig, sig))
            dfs.append(np.where(small, -2, -1))
    if lows:
        low, owner = np.concatenate(lows), np.concatenate(owners)
        order = np.argsort(low, kind="stable")
        low, owner = low[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        count = np.diff([*start, len(low)])
        df = np.repeat(count, count)
        shared = df > 1
        ids.append(owner[shared])
        sigs.append((np.int64(key[0].as_py()) << 32) | low[shared].astype(np.int64))
        dfs.append(df[shared])
    join = lambda parts, t: pa.array(np.concatenate(parts) if parts else [], t)
    return pa.table({"id": join(ids, pa.int64()), "sig": join(sigs, pa.int64()), "df": join(dfs, pa.int64())})


def _could_link(n1: Column, n2: Column, most: Column, num: int) -> Column:
    """Whether an intersection of `most` would be enough."""
    return most * F.lit(100) >= (n1 + n2 - most) * F.lit(num)


def _small(df: DataFrame) -> DataFrame:
    """Broadcast if it is measured to be small; else Spark shuffles both sides and splits skewed keys."""
    return F.broadcast(df) if fits_broadcast(df) else df


def _verified(pairs: DataFrame, docs: DataFrame, words: int, num: int) -> DataFrame:
    """The pairs (a, b) of ids whose whole texts have the similarity."""
    wanted = write_and_read(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    texts = docs.join(_small(wanted), "id", "left_semi").dropDuplicates(["id"])
    rows = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            (who_a, what_a, n_a, _), (who_b, what_b, n_b, _) = (_batch_sets(b.column(k), words) for k in (2, 3))
            both, own = np.concatenate([what_a, what_b]), np.concatenate([who_a, who_b])
            order = np.lexsort((both, own))
            both, own = both[order], own[order]
            twice = (both[1:] == both[:-1]) & (own[1:] == own[:-1])
            common = np.bincount(own[1:][twice], minlength=b.num_rows)
            linked = (100 * common >= num * (n_a + n_b - common)) & (n_a > 0) & (n_b > 0)
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(linked)) for k in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b): label is the smallest node that can be reached. Labels spread to
    neighbours and to whoever has the node as label, until none changes; each round is written to shared storage."""
    both = write_and_read(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = write_and_read(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        spread = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        near = labels.join(spread, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("label").alias("further"))
        after = write_and_read(near.join(jump, "now", "left").select(
            "node", "old", F.least("now", F.coalesce("further", "now")).alias("label")), "labels")
        if after.where("old <> label").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def _linked_ids(docs: DataFrame, sizes: DataFrame, heavy: np.ndarray, words: int, num: int) -> DataFrame | None:
    """Labels (node, label) of the documents with links between different sets, over the smallest id of each set.
    `docs`: (id, text); `sizes`: (id, rep, n), n > 0."""
    spark = docs.sparkSession
    total = sizes.agg(F.sum("n")).first()[0] or 0
    ranges = min(1 << 30, max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_SHINGLES + 1))
    shared = spark.sparkContext.broadcast(heavy)
    counted = _deal(docs, words, num, ranges, shared).groupBy("range").applyInArrow(_count, "id long, sig long, df long")

    # positions: unique shingles come first, then shared ones by the number of documents
    of = Window.partitionBy("id")
    rows = counted.join(_small(sizes), "id").withColumn(
        "common", F.coalesce(F.max(F.when(F.col("df") == -2, F.col("sig"))).over(of), F.lit(0))).withColumn(
        "unique", F.col("n") - F.col("common") - F.sum(F.when(F.col("df") > 0, 1).otherwise(0)).over(of)).withColumn(
        "before", F.row_number().over(of.orderBy((F.col("df") < 0).cast("int"), "df", "sig")) - 1)
    prefix = F.col("n") - F.ceil(F.col("n") * num / F.lit(100)) + 1
    alone = (F.col("df") > 0) & (F.col("unique") + F.col("before") < prefix)
    signed = write_and_read(rows.where(alone | (F.col("df") == -1)).select(
        "sig", "rep", "n",
        F.when(F.col("df") > 0, F.col("n") - F.col("unique") - F.col("before") - 1).otherwise(F.col("n")).alias("after"),
    ).distinct(), "signed")

    # the most central document of a signature, with fewest shingles before it (most of them its own), is compared with the others
    under = Window.partitionBy("sig")
    place = F.struct((F.col("n") - F.col("after")).alias("at"), "rep", "n", "after")
    met = write_and_read(
        signed.withColumn("_low", F.min("rep").over(under)).withColumn("_high", F.max("rep").over(under))
        .withColumn("pivot", F.min(place).over(under)).where("_low < _high").drop("_low", "_high"), "met")

    def possible(x: str, y: str) -> Column:
        # The first shingle that two documents share is in the prefixes of both, and none before it is shared. So it is
        # enough to bring documents together where what is left behind the signature can still suffice.
        get = lambda side, c: F.col(f"{side}.{c}")
        most = F.least(F.least(get(x, "after"), get(y, "after")) + 1, get(x, "n"), get(y, "n"))
        return _could_link(get(x, "n"), get(y, "n"), most, num)

    ordered = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    me = met.select("sig", F.struct("rep", "n", "after").alias("x"), F.col("pivot").alias("y"))
    tried = write_and_read(me.where((F.col("x.rep") != F.col("y.rep")) & possible("x", "y")).select(
        *ordered(F.col("x.rep"), F.col("y.rep"))).distinct(), "pairs")
    links = write_and_read(_verified(tried, docs, words, num), "verified")
    if links.isEmpty() and tried.isEmpty():
        return None

    # what is still apart in a signature is compared directly: all of it with all that isn't in its largest component
    labels = components(links)
    member = met.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "sig", F.struct("rep", "n", "after", F.coalesce("label", "rep").alias("label")).alias("x"))
    member = write_and_read(member, "member")
    largest = Window.partitionBy("sig").orderBy(F.col("count").desc(), "label")
    main = member.groupBy("sig", F.col("x.label").alias("label")).count().withColumn(
        "place", F.row_number().over(largest)).withColumn("labels", F.count("*").over(Window.partitionBy("sig"))).where(
        "place = 1 AND labels > 1").select("sig", F.col("label").alias("main"))
    open_ = member.join(main, "sig")
    rest = open_.where("x.label <> main").select("sig", F.col("x").alias("y"))
    apart = open_.join(rest, "sig").where(
        (F.col("x.label") != F.col("y.label")) & ((F.col("x.label") == F.col("main")) | (F.col("x.rep") < F.col("y.rep")))
        & possible("x", "y")).select(*ordered(F.col("x.rep"), F.col("y.rep"))).distinct()
    apart = write_and_read(apart.join(tried, ["a", "b"], "left_anti"), "pairs")
    more = write_and_read(_verified(apart, docs, words, num), "verified")
    return labels if more.isEmpty() else components(links.union(more))


def jaccard_components(df: DataFrame, words: int = 5, percent: int = 80, text_col: str = "text",
                       id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    A document's set has the distinct shingles of `words` words of its whole text, A-Z as a-z; with fewer words, their
    whole sequence; without words (also for a null text) none, and then it links with nothing. Two documents link if
    100 * intersection >= `percent` * union. component_id is the smallest id that can be reached by links, the
    document's own included; null for a null id, which takes no part. Rows that share an id but not a text are told
    apart. Other columns of `df` are not looked at; an empty table gives an empty one.

    Equal sets are merged by size and a 64-bit digest first, so copies cost one row each. Links between different sets
    are verified on the texts. Pairs within a component aren't enumerated: documents are compared with the most central
    one of their signature, and only what is then still apart directly.
    """
    bounded_batches(df.sparkSession, BATCH_BYTES)
    shared_dir(df.sparkSession)
    docs = df.select(df[id_col].cast("bigint").alias("id"), df[text_col].cast("string").alias("text"))
    scan = write_and_read(_scan(docs, words), "scan")
    light = scan.where("token IS NULL").select("id", "n", "digest")
    total, ids, found = light.agg(F.count("id"), F.count_distinct("id"), F.count_distinct("id", "n", "digest")).first()
    if found > ids:  # an id with several texts: number the rows, then name components by the smallest id
        numbered = write_and_read(docs.where("id IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "numbered")
        rows = jaccard_components(numbered.select("row", "text"), words, percent, "text", "row").join(
            numbered.select("row", F.col("id").alias("own")), "row")
        names = rows.groupBy("component_id").agg(F.min("own").alias("name"))
        named = rows.join(names, "component_id").select("own", "n_shingles", "name")
        return named.union(light.where("id IS NULL").select("id", "n", F.lit(None).cast("long"))).toDF(
            id_col, "n_shingles", "component_id")
    least = max(COMMON_DOCS, COMMON_SHARE * total)
    # at most (shingles of all documents) / least of them
    heavy = scan.where("token IS NOT NULL").groupBy("token").agg(F.sum("copies").alias("n")).where(F.col("n") >= least)
    heavy = np.sort(heavy.select("token").toArrow().column("token").to_numpy().astype(np.uint64))
    reps = light.where("n > 0 AND id IS NOT NULL").groupBy("digest", "n").agg(F.min("id").alias("rep"))
    sizes = write_and_read(light.where("id IS NOT NULL").join(reps, ["digest", "n"], "left").select("id", "rep", "n"), "sizes")
    labels = _linked_ids(docs, sizes.where("rep IS NOT NULL").distinct(), heavy, words, percent)
    out = light.where("id IS NULL").select("id", F.lit(None).cast("long").alias("rep"), "n").union(sizes)
    if labels is not None:
        out = out.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    else:
        out = out.withColumn("label", F.lit(None).cast("long"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("label", "rep", "id").alias("component_id"))
