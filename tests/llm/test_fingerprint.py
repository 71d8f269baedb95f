import hashlib

from pyspark.sql import functions as F

from textloom.llm import fingerprint as fp

LONG = "word. " * 3000


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    rows = fp.with_fingerprint(df, F.col("t"), "f").orderBy("i").collect()
    return [r["f"] for r in rows]


def test_order_free_incremental(spark):
    whole, moved, first, rest, other = prints(spark, ["one a. two.\nthree.\nfour", "four\none a. two.\nthree.", "one a. two.", "three.\nfour", "x"])
    assert whole == moved and whole != other
    df = spark.createDataFrame([(whole, first, rest)], "w array<long>, f array<long>, r array<long>")
    r = df.select(fp.insert(F.col("f"), F.col("r")).alias("sum"), fp.delete(F.col("w"), F.col("f")).alias("rest")).first()
    assert r["sum"] == whole and r["rest"] == rest


def test_edits(spark):
    texts = [(3, "aaaa bb. ccc.\nd"), (1, "é" * 7), (None, "last"), (2, None), (9, ""), (9, ""), (20, LONG)]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS near_next").repartition(3)
    got = fp.fingerprint_edits(df).collect()
    order = sorted(((i, t or "") for i, t in texts), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    expected = []
    for k, (i, t) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(t) // 2
        expected.append((i, len(t), hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(map(str, ((r[0], r[1], r[2]) for r in got))) == sorted(map(str, expected))
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    alone = fp.fingerprint_edits(df.where("doc_id = 3")).first()
    assert alone["near_next"] == 1.0
    assert fp.fingerprint_edits(df.limit(0)).count() == 0


def test_next_over_many_ranges(spark):
    ids = [k * k % 1009 for k in range(1009)] + [5, 5, 5]
    df = spark.createDataFrame([(i, str(i)) for i in ids], "id long, v string").repartition(9)
    got = sorted((r["id"], r["v"], r["next_v"]) for r in fp.with_next(df, ["v"]).collect())
    order = sorted(ids)
    assert got == sorted((i, str(i), str(order[(k + 1) % len(order)])) for k, i in enumerate(order))


def test_likeness_follows_the_common_part(spark):
    parts = [f"sentence number {k} of many." for k in range(400)]
    whole, half, other = prints(spark, [" ".join(parts), " ".join(parts[:200] + [p + "x" for p in parts[200:]]), " ".join(p + "y" for p in parts)])
    df = spark.createDataFrame([(whole, half, other)], "a array<long>, b array<long>, c array<long>")
    r = df.select(fp.likeness(F.col("a"), F.col("b")).alias("half"), fp.likeness(F.col("a"), F.col("c")).alias("none")).first()
    assert 0.3 < r["half"] < 0.7 and r["none"] < 0.3


def test_native(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert "Python" not in fp.fingerprint_edits(df)._jdf.queryExecution().executedPlan().toString()


def test_likeness_of_a_repeated_sentence(spark):
    for k in (400, 3000, 4096, 9000):
        whole, half, most = prints(spark, ["word. " * k, "word. " * (k // 2), "word. " * (k - 300) + "other. " * 300])
        df = spark.createDataFrame([(whole, half, most)], "a array<long>, b array<long>, c array<long>")
        r = df.select(fp.likeness(F.col("a"), F.col("b")).alias("half"), fp.likeness(F.col("a"), F.col("c")).alias("most")).first()
        assert abs(r["half"] - 0.8) < 0.01, k
        assert k < 3000 or r["most"] > 0.9


def test_text_of_a_fingerprint_holds_its_counters(spark):
    parts = ["word"] * 5000 + [f"line {i}" for i in range(700)]
    hashes = [hashlib.md5(p.encode()).hexdigest() for p in parts]
    for n in (1, 30, 4095, 4096, 5700):
        expected = [n]
        for start in (0, 15):
            numbers = [int(h[start:start + 15], 16) for h in hashes[-n:]]
            expected += [sum(x >> k & fp.WIDE_ONES for x in numbers) & fp.MASK for k in range(fp.WIDE)]
        df = spark.createDataFrame([("\n".join(parts[-n:]),)], "t string")
        text = fp.with_fingerprint(df, F.col("t"), "f").select(fp.as_text(F.col("f"))).first()[0]
        assert text[60:] == "".join("%015x" % x for x in expected) and len(text) == fp.WORDS * 15


def test_equals_sql_where_sentences_repeat(spark, tmp_path):
    import duckdb

    texts = ["word. " * 5000, "word. " * 2100 + "other. " * 2900, None, "", "a. b\nc", "word. " * 4500]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents"))
    got = fp.fingerprint_edits(spark.read.parquet(str(tmp_path / "documents"))).orderBy("doc_id").collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents/*.parquet'")
    expected = con.sql(fp.sql() + " ORDER BY doc_id")
    assert [tuple(r[c] for c in expected.columns) for r in got] == expected.fetchall()
    assert got[0]["near_next"] > 0.5  # 2,100 of 5,000 sentences in common, the others one repeated sentence each
