import csv
import random

import pytest
from pyspark.errors import PySparkException

from textloom.sources import delimited
from textloom.sources.delimited import inside_after, read_csv
from textloom.sources.labelled import load_labelled_csv, load_splits

TEXTS = ["plain", "", 'a "b" c', "one\ntwo", "x,y\n\n\nz", '"', '"\n"', 'say ""\n,joy', "é\r\nü", "long " * 300, "a\n" * 100, '\n",\n"', " padded "]


def state(text):
    """Whether it ends inside quotes, a character at a time."""
    inside, start, k = False, True, 0
    while k < len(text):
        c = text[k]
        if inside:
            if c == '"' and text[k + 1:k + 2] == '"':
                k += 1
            elif c == '"':
                inside, start = False, False
        elif c == '"' and start:
            inside = True
        else:
            start = c in ",\n"
        k += 1
    return inside


def test_states():
    rnd = random.Random(1)
    for _ in range(3000):
        line = "".join(rnd.choice('",ab') for _ in range(rnd.randrange(9)))
        assert inside_after(line, False) == state(line), line
        assert inside_after(line, True) == state('"\n' + line), line


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "64"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_of(n, seed):
    rnd = random.Random(seed)
    return [(str(k), rnd.choice(TEXTS), str(k % 6)) for k in range(n)]


def write(path, rows, header=("id", "text", "label"), end="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f, lineterminator=end, quoting=quoting)
        w.writerow(header)
        w.writerows(rows)
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_same_rows_as_one_task(spark, tmp_path, small_splits, monkeypatch, end, broadcast):
    """Splits of 512 bytes, so many records cross one or more of them; against Spark's own reader of whole files."""
    if not broadcast:
        monkeypatch.setattr(delimited, "fits_broadcast", lambda df: False)
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [rows_of(60, 1), rows_of(40, 2), []]
    for k, part in enumerate(rows):
        write(folder / f"{k}.csv", part, end=end, quoting=csv.QUOTE_ALL if k else csv.QUOTE_MINIMAL)
    got = read_csv(spark, str(folder))
    whole = spark.read.csv(str(folder), header=True, multiLine=True, escape='"')
    assert got.columns == whole.columns
    # where lines end in \r\n, Spark makes \n of a field's \r\n too
    same = lambda df: sorted(str(tuple(r)).replace(r"\r\n", r"\n") for r in df.collect())
    assert same(got) == same(whole)
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20
    assert sorted((r.id, r.text or "") for r in got.collect()) == sorted((i, t) for p in rows for i, t, _ in p)


def test_blank_lines_marks_and_open_quotes(spark, tmp_path, small_splits):
    path = tmp_path / "a.csv"
    path.write_bytes('﻿id,text\n\n1,"a\nb"\n   \n2,5" disk\n3,"x" y\nid,text\n4,"open\n\nto the end'.encode())
    got = {r.id: r.text for r in read_csv(spark, str(path)).collect()}
    assert got["1"] == "a\nb" and got["2"] == '5" disk' and got["id"] == "text" and got["4"].endswith("open\n\nto the end")
    assert len(got) == 5


def test_files_need_one_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", [("a\nb", "1")], header=("text", "label"))
    write(folder / "b.csv", [("1", "a\nb")], header=("label", "text"))
    with pytest.raises(ValueError, match="one header"):
        read_csv(spark, str(folder))


def test_no_line_breaks_are_left_to_spark(spark, tmp_path):
    path = write(tmp_path / "a.csv", [("1", 'a "b", c', "2")])
    plan = read_csv(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "Python" not in plan and "MapInArrow" not in plan


def test_labelled_rows_are_whole(spark, tmp_path):
    path = write(tmp_path / "a.csv", [("one\ntwo", "joy"), ("three", "fear")], header=("text", "label"))
    assert {(r.text, r.label) for r in load_labelled_csv(spark, path).collect()} == {("one\ntwo", 1), ("three", 4)}


def test_splits_go_by_their_headers(spark, tmp_path):
    paths = {
        "train": write(tmp_path / "a.csv", [("one\ntwo", "3.0"), ("b", "joy"), ("c", "1")], header=("text", "label")),
        "validation": write(tmp_path / "b.csv", [("2", "d"), ("fear", "e\nf")], header=(" Label", "TEXT ")),
        "test": write(tmp_path / "c.csv", [("x", "love", "g")], header=("other", "emotion", "text"))}
    got = {(r.text, r.label, r.emotion) for r in load_splits(spark, paths, "csv").collect()}
    assert got == {("one\ntwo", 3, "anger"), ("b", 1, "joy"), ("c", 1, "joy"), ("d", 2, "love"), ("e\nf", 4, "fear"), ("g", 2, "love")}
    bad = {"train": write(tmp_path / "d.csv", [("a", "bliss")], header=("text", "label"))}
    with pytest.raises(PySparkException, match="neither a class name"):
        load_splits(spark, bad, "csv").collect()
