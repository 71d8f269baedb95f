import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

from textloom.llm.filter_audit import filter_audit, own_failures, shapley_weights

SCHEMA = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def fails(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return {f for f, x in {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": re.search("[#$%&*|]", text)}.items() if x}


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    texts = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            texts[t or ""].append(i)
    parts = defaultdict(list)
    for i, t, s in rows:
        f = fails(t or "")
        if i is not None and min(texts[t or ""]) < i:
            f.add("E")
        parts[s or ""].append((f, i in good and i is not None, i in toxic and i is not None))
    out, shapley = [], Counter()
    for p, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[p, f] += len(gone)
                out.append((p, order, k + 1, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone),
                            sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_weights_are_shapley_values():
    for n in (2, 3, 5):
        w = shapley_weights(n)
        for i in range(n):
            for s in range(1, 1 << n):
                c = s.bit_count()
                want = (Fraction(factorial(c - 1) * factorial(n - c), factorial(n)) if s >> i & 1
                        else -Fraction(factorial(c) * factorial(n - c - 1), factorial(n)))
                assert w[i][s] == want


def test_edges_of_the_filters(spark):
    texts = ["", " \t\n\x0b\x0c\r", "w", " w " * 199, "w " * 200, " ".join(f"w{k // 2}" for k in range(400)),
             " ".join(f"w{k // 2}" for k in range(401)) + " w0", "A" + "a" * 49, "A" + "a" * 48, "AÉ" + "é" * 48, "a|b", "a b", "a b",
             "long #words " * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r["mask"] for r in df.select("text", own_failures(df["text"]).alias("mask")).collect()}
    assert got == {t: sum(1 << "ABCD".index(f) for f in fails(t)) for t in texts}


def test_against_brute_force(spark):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["a", "B", "c#", f"w{rnd.randrange(999)}"][k % 2:]) for _ in range(rnd.choice([5, 150, 250]))) for k in range(60)]
    rows = [(k, rnd.choice([*texts, None, ""]), rnd.choice(["s", "t", None, ""])) for k in range(300)]
    rows += [(None, texts[0], "s"), (None, texts[0], "s"), (3, texts[0], "s"), (3, texts[0], "s"), (5, None, None)]
    labels = [(k, k % 2, int(k % 7 == 0)) for k in range(200)] + [(8, 1, None), (8, 0, 0), (None, 1, 1), (9, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS mask", "2 AS id", "3 AS good", "4 AS part").repartition(5)
    got = filter_audit(df, spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, labels)


def test_empty_tables(spark):
    df, labels = spark.createDataFrame([(1, "x", "s")], SCHEMA), spark.createDataFrame([(1, 1, 1)], LABELS)
    assert filter_audit(df.limit(0), labels).count() == 0
    got = filter_audit(df, labels.limit(0)).collect()
    assert len(got) == 600 and {(r["good_lost"], r["toxic_lost"]) for r in got} == {(0, 0)}
