"""Every query with a SQL twin gives the same rows on Spark and DuckDB."""

import pytest
from check import compare, connect, types_differ

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) >= 85


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(name, spark, duck):
    df = QUERIES[name](spark, SMALL)
    rel = duck.sql(ORACLES[name])
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert compare(df.toPandas(), rel.df()) == "ok"
    assert types_differ(df, types) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 1369
