import math
import random

from textloom.llm import topk


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 100)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    r = random.Random(3)
    rows = [(i, [r.randint(-3, 3) * (i % 5) for _ in range(20)]) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(50)] + [(2000, [1] * 19), (2020, [2] * 19)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = sorted(tuple(x) for x in topk.top_k(df, df.where("vec_id % 20 = 0"), 5).collect())
    assert got == brute(rows, [x for x in rows if x[0] % 20 == 0], 5)


def test_large_numbers_stay_exact(spark):
    big = 2 ** 30
    rows = [(i, [big + i, big - i, 1]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = sorted(tuple(x) for x in topk.top_k(df, df.where("vec_id < 3"), 4).collect())
    assert got == brute(rows, rows[:3], 4)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (None, [1.0, 1.0]), (5, [0.51, -0.001]),
            (6, [0.51, -0.001]), (20, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS v", "2 AS score")
    v = topk.quantised(df)
    assert sorted((r[0], r[1]) for r in v.collect()) == [(0, [64, 32]), (5, [32, -1]), (6, [32, -1]), (20, [])]
    got = [tuple(r) for r in topk.top_k(v, v.where("vec_id % 20 = 0"), 20).orderBy("rank").collect()]
    assert got == [(0, 1, 5, 64 * 32 - 32), (0, 2, 6, 64 * 32 - 32)]  # a tie goes to the smaller id
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0
