import collections
import random
import re

import pytest

from textloom.llm import jaccard


def word_sets(rows, n):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        whole = [tuple(words)] if words else []
        out.append(frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset(whole))
    return out


def brute(rows, n, percent):
    """(id, set size, smallest id linked) of every row with an id."""
    sets, parent = word_sets(rows, n), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inside = collections.defaultdict(list)
    for i, s in enumerate(sets):
        if rows[i][0] is not None:
            for x in s:
                inside[x].append(i)
    near = {(a, b) for ids in inside.values() for a in ids for b in ids if a < b}
    for a, b in near:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return sorted(((k, len(sets[i]), least[root(i)] if k is not None else None) for i, (k, _) in enumerate(rows)), key=str)


def family(seed):
    r = random.Random(seed)
    word = lambda: "w%d" % r.randint(0, 4000)
    line = " ".join(word() for _ in range(12))
    rows = []
    for g in range(12):
        first = [word() for _ in range(r.randint(3, 90))]
        for _ in range(r.randint(1, 14)):
            text = list(first)
            for _ in range(r.randint(0, 5)):
                text[r.randrange(len(text))] = word()
            rows.append(" ".join(text) + (" " + line if r.random() < 0.5 else ""))
    rows += [rows[0]] * 5 + ["a b", "A  b", "a", "", None, " \n", "one two three four", "x " * 5000]
    order = list(range(len(rows)))
    r.shuffle(order)
    return [(k * 3, t) for k, t in zip(order, rows)]


@pytest.mark.parametrize("seed,n,percent,common", [(1, 4, 85, None), (2, 5, 80, 4), (3, 3, 60, 3), (4, 4, 85, 2)])
def test_against_brute_force(spark, monkeypatch, seed, n, percent, common):
    if common:  # most shared shingles are common, so combinations decide
        monkeypatch.setattr(jaccard, "COMMON_DOCS", common)
        monkeypatch.setattr(jaccard, "COMMON_SHARE", 0.0)
        monkeypatch.setattr(jaccard, "LOCAL_DOCS", 1)
        monkeypatch.setattr(jaccard, "LOCAL_SHARE", 0.0)
    rows = family(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS rep", "2 AS n", "3 AS id")
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df, n, percent).collect()), key=str)
    assert got == brute(rows, n, percent)


def test_repeated_and_missing_ids(spark):
    text = "a b c d e f g h i j k l m n o p q r s t"
    rows = [(5, text), (5, text), (5, "other words for the same id here"), (None, text), (7, text + " u"), (8, "other words for the same id here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.jaccard_components(df, 4, 85).collect()}
    assert got >= {(5, 5), (7, 5), (8, 5)} and len(jaccard.jaccard_components(df, 4, 85).collect()) == len(rows)
    assert jaccard.jaccard_components(df.limit(0), 4, 85).count() == 0


@pytest.mark.parametrize("repeated", [False, True])
def test_null_ids_take_no_part(spark, repeated):
    text = " ".join("w%d" % k for k in range(40))
    far = " ".join("w%d" % k for k in range(8, 40)) + " " + " ".join("v%d" % k for k in range(8))
    bridge = " ".join("w%d" % k for k in range(4, 40)) + " " + " ".join("v%d" % k for k in range(4))
    rows = [(None, text), (5, text), (6, text + " more"), (None, bridge), (7, far), (None, ""), (8, None)]
    rows += [(9, "one text of this id and more"), (9, "quite another text of the same")] if repeated else []
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df, 4, 75).collect()), key=str)
    assert got == brute(rows, 4, 75)
    assert {c for i, _, c in got if i in (5, 6)} == {5} and (7, 37, 7) in got
