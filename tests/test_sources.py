import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from textloom.fixed_values import EMOTIONS
from textloom.operators.lookups import check_labels, encode_labels, id_to_name, label_dim, name_to_id, observed_labels
from textloom.sources import (
    line_rows, load_corpus, load_labelled_csv, load_splits, read_line_files, synthetic_corpus, union_splits, write_labelled_csv,
)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_headers_and_lookups(spark, tmp_path):
    path = write(tmp_path / "a.csv", ' Text ,EMOTION\n"hi, ""you""",joy\nyo,Joy\nline\none,\n"two\nlines",fear\n')
    rows = load_labelled_csv(spark, path).collect()
    assert {(r.text, r.label, r.emotion) for r in rows} == {('hi, "you"', 1, "joy"), ("two\nlines", 4, "fear")}


def test_csv_label_only_keeps_unknown_ids(spark, tmp_path):
    path = write(tmp_path / "a.csv", "text,label\na,0\nb,7\nc,\n,1\n")
    rows = load_labelled_csv(spark, path).collect()
    assert {(r.text, r.label, r.emotion) for r in rows} == {("a", 0, "sadness"), ("b", 7, None)}


def test_csv_labels_by_name_or_number(spark, tmp_path):
    path = write(tmp_path / "a.csv", "text,label\na, joy \nb,3.0\nc,\n,1\nd,-1\ne,2\n")
    rows = load_labelled_csv(spark, path).collect()
    assert {(r.text, r.label, r.emotion) for r in rows} == {("a", 1, "joy"), ("b", 3, "anger"), ("d", -1, None), ("e", 2, "love")}


@pytest.mark.parametrize("label", ["bliss", "1.5", "99999999999"])
def test_csv_other_labels_fail(spark, tmp_path, label):
    with pytest.raises(PySparkException, match="neither a class name"):
        load_labelled_csv(spark, write(tmp_path / "a.csv", f"text,label\na,joy\nb,{label}\n")).collect()


@pytest.mark.parametrize("header", ["body,label", "text,class"])
def test_csv_missing_columns(spark, tmp_path, header):
    with pytest.raises(ValueError):
        load_labelled_csv(spark, write(tmp_path / "a.csv", f"{header}\nx,1\n"))


def test_named_csv_must_exist(spark, tmp_path):
    with pytest.raises(PySparkException):
        load_corpus(spark, str(tmp_path / "none.csv"))


def test_csv_roundtrip(spark, tmp_path):
    texts = ['a "q" b', "x,y", "two\nlines", "back\\slash", " padded "]
    df = spark.createDataFrame([(t, 1, "joy") for t in texts], "text string, label int, emotion string")
    write_labelled_csv(df, str(tmp_path / "out"))
    assert sorted(r.text for r in load_labelled_csv(spark, str(tmp_path / "out")).collect()) == sorted(texts)


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_splits_from_files(spark, tmp_path, fmt):
    paths = {}
    for name, rows in {"train": [("a", 0), ("b", None)], "test": [("c", 5), (None, 1), ("d", 9)]}.items():
        paths[name] = str(tmp_path / name)
        spark.createDataFrame(rows, "text string, label bigint").write.format(fmt).option("header", True).save(paths[name])
    rows = load_splits(spark, paths, fmt).collect()
    assert {tuple(r) for r in rows} == {("a", 0, "sadness"), ("c", 5, "surprise"), ("d", 9, None)}


def test_union_needs_a_split():
    with pytest.raises(ValueError):
        union_splits({})


def test_synthetic(spark):
    df = synthetic_corpus(spark.range(600))
    again = synthetic_corpus(spark.range(600).repartition(7))
    assert df.exceptAll(again).isEmpty()
    assert {r["n"] for r in df.groupBy("emotion").agg(F.count("*").alias("n")).collect()} == {100}
    assert df.where(F.contains("text", F.lit("{"))).isEmpty()
    assert not df.select("text").exceptAll(synthetic_corpus(spark.range(600), seed=1).select("text")).isEmpty()
    assert load_corpus(spark, samples_per_class=10).count() == 60


def test_lines(spark, tmp_path):
    write(tmp_path / "joy_samples.txt", "one\n\n  two\t\n \n")
    write(tmp_path / "fear_samples.txt", "")
    write(tmp_path / "other.txt", "three")
    rows = read_line_files(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in rows} == {("one", "joy"), ("two", "joy"), ("three", None)}
    pasted = spark.createDataFrame([(1, " a \r\n\n b c\x0bd"), (2, None), (3, " ")], "id int, text string")
    assert [(r.id, r.line_no, r.line) for r in line_rows(pasted).orderBy("id", "line_no").collect()] == [
        (1, 0, "a"), (1, 2, "b"), (1, 3, "c"), (1, 4, "d")]


def test_label_lookup(spark):
    df = spark.createDataFrame([("joy", 1), ("Joy", 7), (None, None), ("fear", -1)], "n string, i int")
    rows = df.select(name_to_id("n").alias("a"), id_to_name("i").alias("b")).collect()
    assert [tuple(r) for r in rows] == [(1, "joy"), (None, None), (None, None), (4, None)]
    assert label_dim(spark).count() == len(EMOTIONS)
    assert observed_labels(df.select(F.col("n").alias("emotion"))) == ["Joy", "fear", "joy"]
    with pytest.raises(ValueError):
        check_labels(["a", "a"])


def test_strict_encoding(spark):
    df = spark.createDataFrame([("a", 5, "joy")], "text string, label int, emotion string")
    assert encode_labels(df).first()["label"] == 1
    with pytest.raises(PySparkException, match="unknown class name"):
        encode_labels(df.withColumn("emotion", F.lit("bliss"))).collect()
