"""BPE encoding and decoding: one walk over a trie of the distinct words."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from textloom.llm.byte_bpe import ByteBpe, load
from textloom.llm.common import batch, chunks, map_batches
from textloom.llm.patterns import spaced, words

#: Distinct parts of texts whose encodings a worker keeps, and the longest that it keeps.
MEMO_WORDS, MEMO_CHARS = 300_000, 64


def encode_words(bpe: ByteBpe, distinct: list[str]) -> dict[str, tuple[int, ...]]:
    """The token ids of each word.

    The words in byte order are the depth-first order of their trie, and the bytes that a word shares with the one
    before are the path down to the node where they part. So the trie is walked with one stack of last-token states:
    going on to the next word pops the states below that node and pushes one for each further byte, and the states of
    a shared prefix are computed once.
    """
    out, last, start, before = {}, [-1], [0], b""
    for word in sorted(w.encode() for w in distinct):
        depth, most = 0, min(len(word), len(before))
        while depth < most and word[depth] == before[depth]:
            depth += 1
        bpe.extend(word, depth, last, start)
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at = start[at]
        out[word.decode()] = tuple(reversed(ids))
        before = word
    return out


class Encoder:
    def __init__(self, bpe: ByteBpe):
        self.bpe, self.known = bpe, {}
        self.names = list(map(str, range(bpe.size)))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text; the words that are new among all of them go through the trie together."""
        if len(self.known) > MEMO_WORDS:
            self.known.clear()
        cut = [[(s, [p] if s else spaced(p)) for s, p in self.bpe.segments(t)] for t in texts]
        new = {w for parts in cut for special, ws in parts if not special for w in ws} - self.known.keys()
        split = {part: words(part) for part in new}
        self.known.update(encode_words(self.bpe, list({w for ws in split.values() for w in ws} - self.known.keys())))
        get, special_ids = self.known.__getitem__, self.bpe.special
        self.known.update({part: tuple(chain.from_iterable(map(get, ws))) for part, ws in split.items() if len(ws) != 1})
        out = [list(chain.from_iterable(
            (special_ids[ws[0]],) if special else chain.from_iterable(map(get, ws)) for special, ws in parts))
            for parts in cut]
        for part, ws in split.items():  # a text without spaces is one part
            if len(part) > MEMO_CHARS:
                for w in (part, *(w for w in ws if len(w) > MEMO_CHARS)):
                    self.known.pop(w, None)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bpe.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder_of(data: bytes) -> Encoder:
    """Kept by the worker process for all its tasks."""
    return Encoder(load(data))


def _run(df: DataFrame, tokenizer: bytes, fields: list[pa.Field], types: str, columns: list, rows) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    picked = df.select(*columns)
    key = picked.schema[0].dataType
    schema = pa.schema([pa.field("doc_id", to_arrow_type(key)), *fields])
    shared = df.sparkSession.sparkContext.broadcast(tokenizer)

    def task():
        encoder = encoder_of(shared.value)

        def apply(b: pa.RecordBatch) -> pa.RecordBatch:
            return batch(schema, [b.column(0), *zip(*rows(encoder, b.column(1).to_pylist()))])

        return apply

    return map_batches(picked, task, f"doc_id {key.simpleString()}, {types}")


def encode(df: DataFrame, tokenizer: bytes, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, ids array<int>, n_tokens of every row, as the tokenizers library gives them without added tokens.

    `tokenizer`: the content of a byte-level BPE .json file. A null text is empty and has no ids. Rows may repeat and
    ids may be null: each row gives a row. Other columns of `df` are not looked at.
    """
    def rows(encoder, texts):
        texts = [t or "" for t in texts]
        for start, end in chunks(texts):
            for ids in encoder.encode_all(texts[start:end]):
                yield ids, len(ids)

    return _run(df, tokenizer, [pa.field("ids", pa.list_(pa.int32())), pa.field("n_tokens", pa.int64())],
                "ids array<int>, n_tokens long", [df[id_col].alias("doc_id"), df[text_col].alias("text")], rows)


def decode(df: DataFrame, tokenizer: bytes, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """doc_id, text of every row of token ids. Null ids give null; bytes that aren't UTF-8 become U+FFFD."""
    def rows(encoder, all_ids):
        for ids in all_ids:
            yield (None if ids is None else encoder.decode(ids),)

    return _run(df, tokenizer, [pa.field("text", pa.string())], "text string",
                [df[id_col].alias("doc_id"), df[ids_col].alias("ids")], rows)


def round_trip_digests(df: DataFrame, tokenizer: bytes, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: `encode`, then `decode` of its ids, without moving the ids."""
    def rows(encoder, texts):
        texts = [t or "" for t in texts]
        names = encoder.names
        for start, end in chunks(texts):
            for ids in encoder.encode_all(texts[start:end]):
                yield (len(ids), hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                       hashlib.sha256(encoder.decode(ids).encode("utf-8", "replace")).hexdigest())

    return _run(df, tokenizer,
                [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()),
                 pa.field("decoded_sha256", pa.string())],
                "n_tokens long, ids_sha256 string, decoded_sha256 string",
                [df[id_col].alias("doc_id"), df[text_col].alias("text")], rows)
