"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import duck_connect, fingerprint

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    corpus = E._corpus()[0]  # tested in tests/llm, against brute force where SQL can't express one
    assert set(QUERIES) - set(corpus) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    a = QUERIES[name](spark, SF_SMALL).toPandas()
    b = duck.sql(ORACLE[name]).df()
    ca, ra = fingerprint(a)
    cb, rb = fingerprint(b)
    assert ca == cb
    assert len(ra) == len(rb)
    assert ra == rb


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "orders", "revenue_m", "margin_pct"]
    assert df.count() > 0
