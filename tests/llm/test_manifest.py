import hashlib
import zlib

import pytest

from textloom.llm import manifest
from textloom.llm.manifest import fold, manifest_audit, merkle_manifest, siblings

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    """(root, siblings of each leaf as a list of (left, right))."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, k in enumerate(at):
            run = k // 8 * 8
            paths[i].append(("".join(level[run:k]), "".join(level[k + 1:run + 8])))
            at[i] = k // 8
        level = [sha("".join(level[k:k + 8])) for k in range(0, len(level), 8)]
    return level[0], paths


def brute(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    groups = {}
    for r in sorted(rows, key=key):
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in names}
    if not names:
        return []
    root, above = tree([trees[g][0] for g in names])
    out = []
    for g, up in zip(names, above):
        for r, path in zip(groups[g], trees[g][1]):
            path = path + up
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in path:
                node = sha(left + node + right)
            out.append((r[0], leaf(r), trees[g][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return out


def sort(rows):
    return sorted((tuple(r) for r in rows), key=repr)


ODD = [
    (None, "a", "en", 1, "X"), (None, "a", "en", 1, "X"), (7, None, None, None, None), (7, None, None, None, ""),
    (7, "", None, 0, ""), (7, "", "", 0, "É Z"), (-3, "b", "", 3, "Abc"), (-3, "b", "", 3, "Abc"), (12, "a", "é", 9, "Ab " * 300_000),
]


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_against_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "BLOCK", 8 ** levels)
    rows = ODD + [(k, f"s{k % 3}", "en" if k % 10 else f"l{k}", k % 7, f"Text {k % 50}") for k in range(600)] + [(5, "s", "fr", 1, "T")] * 20
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS digest", "2 AS _row", "3 AS root").repartition(5)
    assert sort(manifest_audit(df).collect()) == sort(brute(rows))


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65])
def test_sizes(spark, n):
    rows = [(k, "s", "en", k, "Some Text") for k in range(n)]
    got = manifest_audit(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sort(got) == sort(brute(rows))


def test_proofs_stand_alone(spark):
    rows = [(k, "s", "en" if k % 3 else "fr", k, f"Text {k}") for k in range(100)]
    found = merkle_manifest(spark.createDataFrame(rows, SCHEMA))
    right = found.select((fold(found["leaf"], found["path"]) == found["root"]).alias("right")).distinct().collect()
    assert [r["right"] for r in right] == [True]
    other = found.withColumn("leaf", found["subroot"])
    assert other.where(fold(other["leaf"], other["path"]) == other["root"]).isEmpty()
    assert found.where(siblings(found["path"]).rlike("[^0-9a-f]")).isEmpty()
