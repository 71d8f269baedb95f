"""Terms of Arrow batches: tokens become numbers once, n-grams are pairs of numbers, and only different ones become strings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from textloom.functions.cleaning import clean_text
from textloom.functions.terms import feature_tokens

#: Bytes of text whose terms are counted at a time; it bounds a worker's memory whatever the length of texts.
SLICE_BYTES = 1 << 21


@dataclass
class Counts:
    """Rows `first` to below `first + n` of a batch: (row, code, tf) ordered by row and code, and the term of each code."""

    first: int
    n: int
    rows: np.ndarray
    codes: np.ndarray
    tf: np.ndarray
    terms: pa.Array


def sizes_of(lists: pa.Array) -> np.ndarray:
    """Lengths of lists, 0 for null."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def lists_of(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def content(df: DataFrame, col: str) -> Column:
    """The text of a column of tokens, or of one that has it already: tokens joined by spaces."""
    return F.col(col) if df.schema[col].dataType == StringType() else clean_text(col)


def n_tokens(df: DataFrame, col: str) -> Column:
    if df.schema[col].dataType != StringType():
        return F.size(col)
    return F.when(F.col(col) == "", 0).otherwise(F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit(""))) + 1)


def feature_text(df: DataFrame, col: str) -> Column:
    """A text whose words of two or more letters, between spaces and apostrophes, are the feature tokens: the content,
    unless it has other characters. One string a row is handed to Python much faster than a list."""
    text = content(df, col)
    return F.when(text.rlike("[^a-z' ]"), F.array_join(feature_tokens(text), " ")).otherwise(text)


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `limit` together."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1
    bounds = [0, *cuts.tolist(), len(sizes)]
    return ((a, b) for a, b in zip(bounds, bounds[1:]) if b > a)


def counted(texts: pa.Array, ngram_range: tuple[int, int]) -> Iterator[Counts]:
    """Counts of the n-grams of each text of `feature_text`, adjacent words joined by a space."""
    texts = pc.fill_null(as_array(texts), "")
    for a, b in slices(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)):
        split = pc.split_pattern(pc.replace_substring(texts.slice(a, b - a), "'", " "), " ")
        row, flat = np.repeat(np.arange(b - a), sizes_of(split)), split.flatten()
        long_enough = pc.greater_equal(pc.binary_length(flat), 2)
        row, encoded = row[long_enough.to_numpy(zero_copy_only=False)], flat.filter(long_enough).dictionary_encode()
        words, word = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found, terms, total, width = [], [], 0, max(1, len(words))
        at, code, text = np.arange(len(word)), word, words
        for n in range(1, ngram_range[1] + 1):
            if n > 1:
                going = at + n - 1 < len(word)
                going[going] = row[at[going]] == row[at[going] + n - 1]
                at, code = at[going], code[going]
                pairs, code = np.unique(code * width + word[at + n - 1], return_inverse=True)
                text = pc.binary_join_element_wise(text.take(pa.array(pairs // width)), words.take(pa.array(pairs % width)), " ")
            if n >= ngram_range[0]:
                found.append((row[at], code + total))
                terms.append(text)
                total += len(text)
        rows, codes = (np.concatenate(x) for x in zip(*found))
        keys, tf = np.unique(rows * max(1, total) + codes, return_counts=True)
        rows, codes = np.divmod(keys, max(1, total))
        yield Counts(a, b - a, rows, codes, tf, pa.concat_arrays(terms))


def places(counts: Counts, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, place in `known`, tf) of the known terms, ordered by row and place; rows count from the slice's first."""
    place = pc.fill_null(pc.index_in(counts.terms, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    at = place[counts.codes]
    some = at >= 0
    rows, at, tf = counts.rows[some], at[some], counts.tf[some]
    order = np.lexsort((at, rows))
    return rows[order], at[order], tf[order]
