"""Corpus queries against their DuckDB statements."""

import pytest

from compare import compare, duck
from conftest import SF_SMALL
from strata.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    r = compare(spark, duck(SF_SMALL), name, SF_SMALL, queries.QUERIES[name], queries.ORACLE[name])
    assert r["match"], r
