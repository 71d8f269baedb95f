"""Hashes of word shingles, computed from the bytes of whole batches of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP, _BASE = np.uint64(0x9E3779B97F4A7C15), 0xD1342543DE82EF95
_VALUES = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
_VALUES[65:91] = _VALUES[97:123]  # A-Z as a-z
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of _BASE and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word. Words are runs of bytes other than white space and end with their text."""
    word = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    start = np.flatnonzero(word & (~before | first[:-1]))
    end = np.flatnonzero(word & (~after | first[1:]))
    power, inverse = _power_tables(len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_VALUES[data] * power[:len(data)])])
    hashes = mixed((sums[end + 1] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _STEP)
    return hashes, np.searchsorted(offsets, start, "right") - 1


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every distinct shingle of `n` words, in this order; text i is data[offsets[i]:offsets[i + 1]].
    A text of fewer words has its whole sequence as one, one without words has none."""
    words, text = _word_hashes(data, offsets)
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if not len(words):
        return none
    count = np.bincount(text, minlength=len(offsets) - 1)
    at = np.concatenate([[0], np.cumsum(count)])
    found_text, found = [], []
    if len(words) >= n:
        whole = text[:len(words) - n + 1] == text[n - 1:]
        h = np.zeros(len(whole), np.uint64)
        for k in range(n):
            h = (h + words[k:k + len(whole)]) * np.uint64(_BASE)
        found_text.append(text[:len(whole)][whole])
        found.append(mixed(h[whole]))
    for i in np.flatnonzero((count > 0) & (count < n)):
        h = int(count[i])
        for w in words[at[i]:at[i + 1]].tolist():
            h = (h + w) * _BASE & _MASK
        found_text.append(np.array([i]))
        found.append(mixed(np.array([h ^ 0x5555], np.uint64)))
    who, what = np.concatenate(found_text), np.concatenate(found)
    order = np.lexsort((what, who))
    who, what = who[order], what[order]
    keep = np.ones(len(who), bool)
    keep[1:] = (who[1:] != who[:-1]) | (what[1:] != what[:-1])
    return who[keep], what[keep]


def shingle_sets(column: pa.Array, n: int):
    """For an Arrow column of strings: (first text, number of texts, text of each hash counted from the first, hashes),
    chunk by chunk. A null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, "right")) - 1)
        end = min(end, len(column))
        who, what = shingle_hashes(data[offsets[start]:offsets[end]], offsets[start:end + 1] - offsets[start], n)
        yield start, end - start, who, what
        start = end
