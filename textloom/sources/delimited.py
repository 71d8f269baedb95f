"""CSV whose quoted fields may hold line breaks, read by as many tasks as the files have splits.

A line break ends a record unless it is inside quotes, and whether it is depends on all that stands before it. But a split
of a file only turns one of two states (outside, inside) into one of two. So each split is first reduced to that, its
start follows from those before it, and then every task cuts its own lines into records. What crosses splits, at most
two pieces a split, is put together apart.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textloom.cluster import fits_broadcast, materialise, write_and_read

QUOTE, SEPARATOR = '"', ","
BLANK = " \t\r\ufeff"
#: Pieces of records: whole ones, what ends a record of an earlier split, the whole of a split within one, what begins one;
#: and the first record of a file.
WHOLE, END, MIDDLE, BEGIN, HEADER = range(5)


def inside_after(line: str, inside: bool) -> bool:
    """Whether the text after a line is inside a quoted field. Quotes open a field only at its start; within, two of them
    stand for one; what follows a closing one is up to the next separator."""
    at = 0
    if not inside:
        if not line.startswith(QUOTE):
            at = line.find(SEPARATOR + QUOTE) + 1
            if not at:
                return False
        at += 1
    while True:
        close = line.find(QUOTE, at)
        while close >= 0 and line.startswith(QUOTE, close + 1):
            close = line.find(QUOTE, close + 2)
        if close < 0:
            return True
        at = line.find(SEPARATOR + QUOTE, close + 1) + 2
        if at < 2:
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, place, value: the lines, a split's in order of place."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value")


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lines with quotes (file, block, value): what each split turns outside and inside into, and whether a line ends
    inside when the split starts outside."""
    now: tuple | None = None
    states, crossed = [False, True], False

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (now[0], now[1], states[0], states[1], crossed)], names=["file", "block", "outside", "inside", "crossed"])

    for b in batches:
        for file, block, value in zip(*(c.to_pylist() for c in b.columns)):
            if (file, block) != now:
                if now:
                    yield row()
                now, states, crossed = (file, block), [False, True], False
            first = inside_after(value, states[0])
            states = [first, first if states[0] == states[1] else inside_after(value, states[1])]
            crossed = crossed or first
    if now:
        yield row()


def _cutter(starts: dict | None):
    """Lines (file, block, value, start) to pieces (file, block, kind, piece); `starts` says where a split starts inside,
    else the column does."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, inside, open_, headed = None, [], False, False, False

        def rest():
            """What is left at the end of a split: it goes on in the next one, or there is none."""
            return [(*now, MIDDLE if open_ else BEGIN, "\n".join(held))] if held else []

        for b in batches:
            out = []
            columns = [c.to_pylist() for c in b.columns]
            for k, (file, block, value) in enumerate(zip(*columns[:3])):
                if (file, block) != now:
                    out += rest()
                    now, held, headed = (file, block), [], block > 0
                    inside = open_ = (now in starts) if starts is not None else columns[3][k]
                held.append(value)
                inside = inside_after(value, inside) if QUOTE in value else inside
                if not inside:
                    piece = "\n".join(held)
                    kind = END if open_ else WHOLE if headed or not piece.strip(BLANK) else HEADER
                    out.append((file, block, kind, piece))
                    held, open_, headed = [], False, headed or kind == HEADER
            yield _pieces(out)
        if now:
            yield _pieces(rest())

    def _pieces(rows: list) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([],) * 4, kinds)], names=["file", "block", "kind", "piece"])

    return run


def csv_records(lines: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(headers, records), each (file, record): every record as it stands in its file, without the line break that ends it."""
    spark = lines.sparkSession
    splits = lines.groupBy("file", "block").agg(F.count("*").alias("n")).join(turns, ["file", "block"], "left").select(
        "file", "block", F.coalesce("outside", F.lit(False)).alias("outside"), F.coalesce("inside", F.lit(True)).alias("inside"))
    # a file's splits in order: each starts where the one before it leads
    ordered = splits.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("block", "outside", "inside"))).alias("all"))
    states = F.aggregate("all", F.array(F.lit(False)), lambda seen, x: F.concat(
        seen, F.array(F.when(F.element_at(seen, -1), x["inside"]).otherwise(x["outside"]))))
    starts = ordered.withColumn("states", states).select("file", F.posexplode("all").alias("_k", "_x"), "states").select(
        "file", F.col("_x.block").alias("block"), F.get("states", F.col("_k")).alias("start"))
    starts = write_and_read(starts.where("start"), "starts")
    if fits_broadcast(starts):
        shared = {(r["file"], r["block"]) for r in starts.collect()}
        pieces = lines.select("file", "block", "value").mapInArrow(
            _cutter(dict.fromkeys(shared)), "file string, block long, kind int, piece string")
    else:  # so many splits that the lines are joined and put back in order
        rows = lines.join(starts, ["file", "block"], "left").repartition("file", "block").sortWithinPartitions("file", "block", "place")
        pieces = rows.select("file", "block", "value", F.coalesce("start", F.lit(False)).alias("start")).mapInArrow(
            _cutter(None), "file string, block long, kind int, piece string")
    pieces = write_and_read(pieces, "pieces")
    # a record that crosses splits: what begins it, whole splits within it, what ends it
    broken = pieces.where(F.col("kind").isin(END, MIDDLE, BEGIN)).withColumn("number", F.sum((F.col("kind") == BEGIN).cast("int")).over(
        Window.partitionBy("file").orderBy("block", "kind")))
    joined = broken.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "kind", "piece"))).alias("all")).select(
        "file", F.array_join(F.transform("all", lambda x: x["piece"]), "\n").alias("record"))
    of = lambda kind: pieces.where(F.col("kind") == kind).select("file", F.col("piece").alias("record"))
    return of(HEADER), of(WHOLE).union(joined)


def read_csv(spark: SparkSession, path: str, null_value: str | None = None) -> DataFrame:
    """The columns of the CSV files at `path` as text, by the names in their header, which all files must share. Fields may
    hold line breaks, separators and doubled quotes within quotes. Files without any line break inside quotes, as their
    splits tell, are left to Spark's own reader."""
    options = {"escape": QUOTE, **({} if null_value is None else {"nullValue": null_value})}
    lines = _lines(spark, path)
    quoted = lines.where(F.contains("value", F.lit(QUOTE))).select("file", "block", "value")
    turns = materialise(quoted.mapInArrow(_turns, "file string, block long, outside boolean, inside boolean, crossed boolean"))
    if turns.where("crossed").isEmpty():
        return spark.read.csv(path, header=True, **options)
    headers, records = csv_records(lines, turns)
    plain = F.regexp_replace("record", "^\\uFEFF|\\r\\z", "")
    found = [r["record"] for r in headers.select(plain.alias("record")).distinct().limit(100).collect()]
    names = {tuple(next(csv.reader([h]))) for h in found}
    if len(names) != 1 or any("\n" in h for h in found):
        raise ValueError(f"the files at {path} need one header, without line breaks: {found[:3]}")
    names = names.pop()
    fields = ", ".join(f"c{k} string" for k in range(len(names)))
    rows = records.select(plain.alias("record")).where(F.trim("record") != "")
    return rows.select(F.from_csv("record", fields, {**options, "multiLine": "true"}).alias("r")).select("r.*").toDF(*names)
