import random

import numpy as np
import pytest
import xxhash

from textloom.llm import simhash as module
from textloom.llm.simhash import near_links, near_pairs, simhash, simhash_components

SCHEMA = "doc_id long, text string"


def plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    label = list(range(len(nodes)))
    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def brute(rows):
    prints = [plain(t) for _, t in rows]
    label = components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, prints, label)), key=repr)


def texts(n, seed):
    """Groups of texts that differ by a word, short ones among them, so that some fingerprints are near each other."""
    rnd = random.Random(seed)
    base = [[f"w{rnd.randrange(500)}" for _ in range(rnd.choice([3, 5, 40, 400]))] for _ in range(n // 10 + 1)]
    out = []
    for k in range(n):
        words = list(base[k // 10])
        if k % 3:
            words[rnd.randrange(len(words))] = "New"
        out.append((k, " ".join(words)))
    return out


def test_fingerprints():
    for t in ["", None, "a", "A b", "a b c", "x y z É é\x1fq a b", " \t\n", "A b\x0bC d\re"]:
        assert simhash(t) == plain(t)


def test_pieces(monkeypatch):
    text = " ".join(f"Word{k % 97}" * (1 + 40 * (k % 50 == 0)) for k in range(3000))
    whole = simhash(text)
    for piece in (1, 7, 100, 5000):
        monkeypatch.setattr(module, "PIECE", piece)
        assert simhash(text) == whole == plain(text)


@pytest.mark.parametrize("node", [16, 16_384])
def test_against_brute_force(spark, monkeypatch, node):
    monkeypatch.setattr(module, "NODE", node)
    rows = texts(500, 1) + [(None, "a b c d"), (None, ""), (9000, None), (9001, " \n"), (3, "a b c d"), (3, "a b c d"),
                            (8, "long " * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS fingerprint", "2 AS label").repartition(6)
    got = sorted((tuple(r) for r in simhash_components(df).collect()), key=repr)
    want = brute(rows)
    assert got == want
    assert any(c is not None and c != i for i, _, c in want)  # links between different texts exist


def test_only_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (4, "x")], SCHEMA)
    assert sorted((r["doc_id"], r["component_id"]) for r in simhash_components(df).where("doc_id IS NULL").collect()) == [(None, None)] * 2
    assert simhash_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("node", [8, 1000])
def test_links_of_dense_fingerprints(spark, monkeypatch, node):
    """Many fingerprints around few centres, so that most nodes hold near ones and links cross them at every level."""
    monkeypatch.setattr(module, "NODE", node)
    rnd = random.Random(node)
    values = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        values |= {centre ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(4))) & (2**64 - 1) for _ in range(60)}
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    links = near_links(spark.createDataFrame([(v,) for v in signed], "fingerprint long")).collect()
    at = {v: k for k, v in enumerate(signed)}
    mine = {frozenset((at[r["a"]], at[r["b"]])) for r in links}
    want = components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    assert components(range(len(values)), lambda a, b: frozenset((a, b)) in mine) == want
    assert len(set(want)) < len(want)


def test_near_pairs_are_all_pairs():
    rnd = random.Random(3)
    xs = np.unique(np.array([rnd.getrandbits(5) << 59 | rnd.getrandbits(3) for _ in range(120)], np.uint64))
    pairs = [p for i, j in near_pairs(xs, None, 0, 0, 2) for p in zip(i.tolist(), j.tolist())]
    want = {frozenset((i, j)) for i in range(len(xs)) for j in range(i) if (int(xs[i]) ^ int(xs[j])).bit_count() <= 2}
    assert len(pairs) == len(want) and {frozenset(p) for p in pairs} == want
