from textloom.llm.mixing import mix_sources, mixed_rows


def level(sizes, weights, rate, most):
    """Shares by weight; what is above a cap is shared again."""
    left, target, open_ = rate * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        if not above:
            return [unit * weights[i] if i in open_ else target[i] for i in range(len(sizes))]
        for i in above:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ -= above
    return target


def test_targets_and_copies(spark):
    rows = [(k, "w " * (1 + k % 37), ["b", "a", None, "é", "z"][(k * k) % 5 if k % 3 else 0]) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS target")
    got = mix_sources(df).collect()
    order = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    sizes = [sum(1 + k % 37 for k, _, s in rows if s == o) for o in order]
    targets = dict(zip(order, level(sizes, [3, 1, 2, 3, 1], 1.5, 2.0)))
    source = {k: s for k, _, s in rows}
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert abs(r["target"] - targets[source[r["doc_id"]]]) < 1e-6
        assert r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[o] - targets[o]) <= 2 * 37 + 1 for o in order)
    assert sorted(got) == sorted(mix_sources(df.repartition(7)).collect())  # reruns agree
    mixed = mixed_rows(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in got)


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string"
    df = spark.createDataFrame([(1, None, "a"), (None, "x y", "a"), (None, "x y", "a"), (3, "", None), (4, " \t\u00a0", None)], schema)
    got = mix_sources(df).collect()
    assert sorted(r["size"] for r in got) == [0, 0, 1, 2, 2]
    assert mix_sources(df.limit(0)).count() == 0
    assert {r["taken"] for r in mix_sources(df.where("doc_id = 1")).collect()} == {0}


def test_native(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    assert "Python" not in mix_sources(df)._jdf.queryExecution().executedPlan().toString()
