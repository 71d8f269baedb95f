"""Exact top-k search by inner product: branch and bound over dimension blocks in vertical layout."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Rows of a block of candidates and of queries. A task holds one block of each.
CANDIDATE_ROWS = 16_384
QUERY_ROWS = 1_024
#: Dimensions that are accumulated before the next bound.
DIMENSIONS = 8
#: Up to here sums of products are exact in doubles.
EXACT = 2 ** 53
LONG = 2 ** 63 - 1


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > 4 * k:  # drop what is below the k-th score before sorting
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """For each query its k best of the block: lists of ids and scores, in the order of the queries.

    `vectors` has a row per candidate. They are laid out by dimension, those with most mass first. A query first scores
    the longest candidates to get a k-th best score, then adds up all candidates block of dimensions by block; after
    each, the part still to come is at most the product of the remaining lengths (Cauchy-Schwarz), and only candidates
    that can still reach the k-th best score stay.
    """
    if max(np.abs(queries).max(initial=0), 1.0) * max(np.abs(vectors).max(initial=0), 1.0) * max(1, queries.shape[1]) >= EXACT:
        return _search_large(query_ids, queries, ids, vectors, k)
    queries, vectors = queries.astype(np.float64), vectors.astype(np.float64)
    dims = np.argsort(-(vectors ** 2).sum(0), kind="stable")
    by_length = np.argsort(-(vectors ** 2).sum(1), kind="stable")
    ids, columns = ids[by_length], np.ascontiguousarray(vectors[by_length][:, dims].T)
    queries = queries[:, dims]
    starts = list(range(0, len(dims), DIMENSIONS))
    rest = np.sqrt(np.stack([(columns[s:] ** 2).sum(0) for s in starts[1:]])) if len(starts) > 1 else np.zeros((0, len(ids)))
    query_rest = np.sqrt(np.stack([(queries[:, s:] ** 2).sum(1) for s in starts[1:]])) if len(starts) > 1 else None
    out = []
    for n, (own, q) in enumerate(zip(query_ids, queries)):
        first = q @ columns[:, :8 * k]
        sample = first[ids[:8 * k] != own]
        floor = np.partition(sample, len(sample) - k)[len(sample) - k] if len(sample) >= k else -np.inf
        alive, score = None, np.zeros(len(ids))
        for b, s in enumerate(starts):
            part = columns[s:s + DIMENSIONS]
            score = score + q[s:s + DIMENSIONS] @ (part if alive is None else part[:, alive])
            if b == len(starts) - 1:
                break
            bound = score + query_rest[b, n] * (rest[b] if alive is None else rest[b][alive]) + 1e-6 * (1 + abs(floor))
            keep = bound >= floor
            alive = np.flatnonzero(keep) if alive is None else alive[keep]
            score = score[keep]
        found = ids if alive is None else ids[alive]
        other = found != own
        out.append(_top(found[other], score[other].astype(np.int64), k))
    return out


def _search_large(query_ids, queries, ids, vectors, k):
    """The same in integers of any size for vectors whose sums a double can't hold; scores are cut to a long's range."""
    wide = vectors.astype(object)
    out = []
    for own, q in zip(query_ids, queries.astype(object)):
        scores = np.array([max(-LONG - 1, min(LONG, int(x))) for x in wide @ q], np.int64) if len(q) else np.zeros(len(ids), np.int64)
        other = ids != own
        order = np.lexsort((ids[other], [-int(x) for x in scores[other]]))[:k]
        out.append((ids[other][order], scores[other][order]))
    return out


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    values = column.combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def quantised(df: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: floor(scale * x) of each component. Rows with a null id, a null vector or a component that is null,
    not a number or infinite are left out. Components beyond a long are cut to its range."""
    rows = df.select(df[id_col].cast("bigint").alias("vec_id"), df[vector_col].cast("array<double>").alias("x"))
    fit = "vec_id IS NOT NULL AND x IS NOT NULL AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))"
    return rows.where(fit).select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (long) for (vec_id, v array<long>): each query's k largest inner products
    with other rows than its own, ties to the smaller id; all, if fewer.

    Only vectors of one length are compared. Rows of one id are one query, whose results are those of all its rows;
    as candidates each counts. An empty side gives no rows.

    Candidates and queries are dealt out by hash into blocks of bounded size, and every pair of blocks is one group, so
    a task holds one block of either. Its k best per query, not its pairs, are shuffled and ranked.
    """
    candidates = candidates.withColumn("_dim", F.size("v"))
    queries = queries.withColumn("_dim", F.size("v"))
    columns = max(1, -(-candidates.count() // CANDIDATE_ROWS))
    rows = max(1, -(-queries.count() // QUERY_ROWS))
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    left = queries.withColumn("_row", place(rows)).withColumn("_col", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    right = candidates.withColumn("_col", place(columns)).withColumn("_row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    keys = ["_dim", "_row", "_col"]

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        qid, cid = a.column("vec_id").to_numpy(), b.column("vec_id").to_numpy()
        found = []
        if len(qid) and len(cid):
            q, c = _matrix(a.column("v"), len(qid)), _matrix(b.column("v"), len(cid))
            found = search_block(qid, q, cid, c, k)
        return pa.table({
            "query_id": pa.array(np.repeat(qid[:len(found)], [len(i) for i, _ in found]), pa.int64()),
            "vec_id": pa.array(np.concatenate([i for i, _ in found]) if found else [], pa.int64()),
            "score": pa.array(np.concatenate([s for _, s in found]) if found else [], pa.int64())})

    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
