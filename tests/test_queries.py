import pytest

import __spark_entry__ as entry_point
from check_oracle import compare, connect
from textloom.plans import model_queries  # noqa: F401  registers its queries
from textloom.plans.oracle import model_sql, oracle_sql
from textloom.plans.queries import QUERIES

# Models with their full settings take minutes; tests/check_oracle.py compares them, test_models.py tests light ones.
ORACLE = {k: v for k, v in oracle_sql().items() if k not in model_sql()}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) == set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_equals_sql(spark, con, sf, name):
    assert compare(spark, con, name, sf) == ""


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 4


def test_stream_equals_batch(spark, sf):
    queries = entry_point.queries()
    a, b = (queries[n](spark, sf) for n in ("batch_accuracy", "stream_batch_accuracy"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
