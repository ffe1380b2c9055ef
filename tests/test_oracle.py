"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from rivulet.plans.verify import compare_one, duck

#: The warehouse jobs' queries; those of the optional subpackage have their own tests.
NAMES = sorted({**E.BATCH_QUERIES, **E.STREAM_QUERIES})


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())
    assert set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_small, name):
    r = compare_one(spark, con, E.queries()[name], E.oracle_sql().get(name), sf_small)
    assert r["match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"topic", "seq", "mid", "is_new"} <= set(df.columns)
