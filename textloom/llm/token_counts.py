"""Exact token counts at every prefix, by dynamic programming over last-token states (see byte_bpe)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textloom.llm.byte_bpe import ByteBpe, load
from textloom.llm.common import batch, chunks, map_batches
from textloom.llm.patterns import spaced, words

#: Distinct parts of texts whose counts a worker keeps, and the longest that it keeps.
MEMO_WORDS, MEMO_CHARS = 500_000, 64


class WordCounts(dict):
    """Words, or runs of whole words -> the number of tokens."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> int:
        parts = words(word)
        if len(parts) > 1:
            count = sum(map(self.__getitem__, parts))
        else:
            count = prefix_table(self.bpe, word.encode())[-1]
        if len(word) <= MEMO_CHARS:  # a text without spaces is one part
            self[word] = count
        return count


@lru_cache(maxsize=2)
def counts_of(data: bytes) -> WordCounts:
    """Kept by the worker process for all its tasks."""
    return WordCounts(load(data))


def prefix_table(bpe: ByteBpe, word: bytes) -> list[int]:
    """Tokens of word[:i] for i from 0 to the length: one more than the prefix before its last token has."""
    counts = [0]
    for begin in bpe.states(word)[1][1:]:
        counts.append(counts[begin] + 1)
    return counts


def _inside(bpe: ByteBpe, word: str) -> list[int]:
    """Tokens of each prefix of one word, by code points, without the empty one."""
    counts = prefix_table(bpe, word.encode())
    ends, at = [], 0
    for c in word:
        at += len(c.encode())
        ends.append(counts[at])
    if word in ("'re", "'ve", "'ll"):  # cut short, it is an apostrophe and a letter
        ends[1] = 2
    return ends


def _plain_prefixes(bpe: ByteBpe, text: str, known: WordCounts) -> list[int]:
    out, total, before, run = [], 0, 0, ""
    for word in words(text):
        inside = _inside(bpe, word)
        out += [total + n for n in inside]
        if run and word[0].isspace():  # a text that ends here has one longer run of white space
            out[-len(inside)] = before + known[run + word[0]]
        run = word if word.isspace() else ""
        before, total = total, total + known[word]
    return out


def prefix_counts(bpe: ByteBpe, text: str, known: WordCounts | None = None) -> list[int]:
    """Item i: the tokens of text[:i] encoded alone. The list has len(text) + 1 items.

    White space before a word and special strings are cut differently in a text that ends within them; those prefixes
    are counted as such a text would be.
    """
    known = WordCounts(bpe) if known is None else known
    out, total, plain = [0], 0, ""
    for special, piece in bpe.segments(text):
        if special:  # cut short, its characters are ordinary and may join the word before
            base = total - sum(map(known.__getitem__, words(plain)))
            for i in range(1, len(piece)):
                out.append(base + sum(map(known.__getitem__, words(plain + piece[:i]))))
            total += 1
            out.append(total)
            plain = ""
        else:
            out += [total + n for n in _plain_prefixes(bpe, piece, known)]
            total += sum(map(known.__getitem__, words(piece)))
            plain = piece
    return out


def count_tokens(bpe: ByteBpe, text: str, known: WordCounts) -> int:
    if not bpe.special:
        return sum(map(known.__getitem__, spaced(text)))
    return sum(1 if special else sum(map(known.__getitem__, spaced(piece))) for special, piece in bpe.segments(text))


def fitting_chars(bpe: ByteBpe, text: str, limit: int, known: WordCounts) -> int:
    """The longest prefix, in code points, with at most `limit` tokens, read from the table of prefixes."""
    counts = prefix_counts(bpe, text, known)
    return max(i for i in range(len(counts)) if counts[i] <= limit)


def _workers(df: DataFrame, data: bytes, text_col: str, id_col: str, schema: pa.Schema, types: str, row):
    shared = df.sparkSession.sparkContext.broadcast(data)

    def task():
        known = counts_of(shared.value)
        bpe = known.bpe

        def apply(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows = []
            for start, end in chunks(texts):
                if len(known) > MEMO_WORDS:
                    known.clear()
                rows += [row(bpe, t, known) for t in texts[start:end]]
            return batch(schema, [b.column(0), *zip(*rows)])

        return apply

    key = df.select(id_col).schema[0].dataType.simpleString()
    return map_batches(df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")), task, f"doc_id {key}, {types}")


def _schema(df: DataFrame, id_col: str, *fields) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.schema([pa.field("doc_id", to_arrow_type(df.select(id_col).schema[0].dataType)), *fields])


def token_counts(df: DataFrame, tokenizer: bytes, limit: int = 1024, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of `df`. `tokenizer`: the content of its file.

    Each distinct word is counted once by a worker and its prefixes with it; a document's count is a sum. A null text
    is empty and has no tokens. Repeated rows and null ids give a row each; other columns of `df` are not looked at.
    """
    fields = [pa.field("n_bytes", pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("over_limit", pa.bool_())]

    def row(bpe, text, known):
        n = count_tokens(bpe, text, known)
        return len(text.encode()), n, n > limit

    return _workers(df, tokenizer, text_col, id_col, _schema(df, id_col, *fields),
                    "n_bytes long, n_tokens long, over_limit boolean", row)


def prefix_token_counts(df: DataFrame, tokenizer: bytes, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, counts: item i of `counts` is the number of tokens of the first i code points, from 0 to all of them.

    With it, any truncation or budget is a lookup: the longest prefix within n tokens is the last item <= n.
    """
    return _workers(df, tokenizer, text_col, id_col, _schema(df, id_col, pa.field("counts", pa.list_(pa.int32()))),
                    "counts array<int>",
                    lambda bpe, text, known: (np.array(prefix_counts(bpe, text, known), "int32"),))


def truncation_points(df: DataFrame, tokenizer: bytes, limit: int = 1024, text_col: str = "text",
                      id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, fit_chars: how many leading code points have at most `limit` tokens."""
    fields = [pa.field("n_tokens", pa.int64()), pa.field("fit_chars", pa.int64())]

    def row(bpe, text, known):
        n = count_tokens(bpe, text, known)
        return n, len(text) if n <= limit else fitting_chars(bpe, text, limit, known)

    return _workers(df, tokenizer, text_col, id_col, _schema(df, id_col, *fields), "n_tokens long, fit_chars long", row)
