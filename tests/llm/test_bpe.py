"""Tokens against the tokenizers library, and exact round trips."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textloom.llm import bpe, token_counts
from textloom.llm.byte_bpe import ByteBpe, load

PIECES = ["a", "the", " ", "  ", "\n", "\t", "'", "'re", "'l", "<|endoftext|>", "<|", "é", "汉", "1", "23", "!", "\x85", "\x1c",
          "\u3000", "🙂", "ing", "don't", "\U000323b0", "____", "...", "====="]


@pytest.fixture(scope="module")
def data():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def samples(n):
    r = random.Random(7)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 12))) for _ in range(n)] + ["x" * 3000, "a " * 2000]


def test_ids_and_text_match_the_library(data, library):
    encoder = bpe.Encoder(load(data))
    texts = samples(400)
    for text, ids in zip(texts, encoder.encode_all(texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_prefix_has_its_own_count(data, library):
    b = load(data)
    for text in samples(200)[:200]:
        expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert token_counts.prefix_counts(b, text) == expected


def test_words_that_share_prefixes(data):
    b = load(data)
    words = ["in", "inter", "international", "internationally", " in", "x", "é", "éé"]
    assert bpe.encode_words(b, words) == {w: tuple(b.merge(w.encode())) for w in words}


def test_other_kinds_of_files_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f, pytest.raises(ValueError):
        ByteBpe(f.read())


def test_frames(spark, data, library):
    rows = [(1, "hello  world", "x"), (1, "hello  world", "x"), (2, None, None), (3, "", "x"), (None, "abc " * 600, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")  # a clashing name
    got = sorted(token_counts.token_counts(df, data).collect(), key=str)
    expected = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024)
                for i, t, _ in rows]
    assert [tuple(r) for r in got] == sorted(expected, key=lambda r: str(r).replace("(", "Row(doc_id=")) or sorted(
        map(tuple, got), key=str) == sorted(expected, key=str)
    encoded = bpe.encode(df, data)
    decoded = {(r[0], r[1]) for r in bpe.decode(encoded, data).collect()}
    assert decoded == {(i, t or "") for i, t, _ in rows}
    assert bpe.round_trip_digests(df.limit(0), data).count() == 0
    cut = {r["doc_id"]: r for r in token_counts.truncation_points(df, data, 100).collect()}[None]
    assert len(library.encode(("abc " * 600)[:cut["fit_chars"]], add_special_tokens=False).ids) <= 100
    table = {r["doc_id"]: r["counts"] for r in token_counts.prefix_token_counts(df, data).collect()}
    assert table[2] == [0] and table[1][-1] == len(library.encode("hello  world", add_special_tokens=False).ids)


def test_memos_keep_no_text_without_spaces(data):
    texts = ["汉字" * 1000 + str(i) for i in range(20)] + ["=" * 300, "plain words here"]
    encoder = bpe.Encoder(load(data))
    ids = encoder.encode_all(texts)
    assert [encoder.decode(x) for x in ids] == texts and encoder.encode_all(texts) == ids
    known = token_counts.WordCounts(load(data))
    assert [token_counts.count_tokens(known.bpe, t, known) for t in texts] == [len(x) for x in ids]
    assert max(map(len, encoder.known)) <= bpe.MEMO_CHARS and max(map(len, known)) <= token_counts.MEMO_CHARS


def test_which_tokens_may_follow_each_other(data):
    b, r = ByteBpe(data), random.Random(5)
    assert b.by_rank
    tokens = sorted(b.ids.values())
    pairs = [(r.choice(tokens), r.choice(tokens)) for _ in range(3000)]
    pairs += [made[1:] for token, made in b.made.items() if token % 17 == 0]
    for unit in ("a", " ", "=", "-", "0", "\n"):  # merges of equal pieces
        runs = [t for n in range(1, 20) if (t := b.ids.get(unit.encode() * n)) is not None]
        pairs += [(x, y) for x in runs for y in runs]
    for x, y in pairs:
        assert b.follows(x, y) == (b.merge(b.bytes_of[x] + b.bytes_of[y]) == [x, y]), (x, y)


def test_a_megabyte_without_spaces(data, library):
    text = "".join(chr(0x4e00 + (k * 7919 + k * k) % 700) for k in range(350_000))
    encoder = bpe.Encoder(load(data))
    ids = encoder.encode_all([text])[0]
    assert ids == library.encode(text, add_special_tokens=False).ids and encoder.decode(ids) == text
    known = token_counts.WordCounts(load(data))
    assert token_counts.count_tokens(known.bpe, text, known) == len(ids)
