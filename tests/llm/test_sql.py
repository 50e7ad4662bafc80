"""Corpus queries against their DuckDB SQL."""

import pytest

from storeloom.llm import queries, sql
from tests.conftest import SF_SMALL
from tools.check_oracle import duck_connect, fingerprint


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_query_matches_sql(spark, name):
    assert fingerprint(queries.queries()[name](spark, SF_SMALL).toPandas()) == fingerprint(duck_connect(SF_SMALL).sql(sql.ORACLE[name]).df())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
