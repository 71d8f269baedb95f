"""Compare registered queries with their SQL on one scale: python tests/check_oracle.py [sf_dir] [name...]"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_point  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


TYPES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty if equal, else what differs."""
    df = entry_point.queries()[name](spark, sf_dir)
    sn, srows = table_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry_point.oracle_sql()[name])
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cur.description}
    on, orows = table_of([d[0] for d in cur.description], cur.fetchall())
    if sn != on:
        return f"columns {sn} != {on}"
    if types != dict(df.dtypes):
        return f"types {dict(df.dtypes)} != {types}"
    if len(srows) != len(orows):
        return f"{len(srows)} rows != {len(orows)}"
    bad = [(a, b) for a, b in zip(srows, orows) if a != b]
    return f"{len(bad)} of {len(srows)} rows differ, first {bad[0]}" if bad else ""


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("textloom-check")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry_point.oracle_sql())
    spark, con = session(), connect(sf)
    for n in names:
        t = time.time()
        try:
            verdict = compare(spark, con, n, sf) or "ok"
        except Exception as e:
            verdict = "ERROR " + str(e)[:600].replace("\n", " | ")
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{n:26} {time.time() - t:6.1f}s  {verdict[:900]}", flush=True)
