"""Every query with SQL gives the rows that DuckDB computes; the others give rows."""

import os

import pytest
from oracle import DATA, same

from sparkweft.plans import queries

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_like_sql(spark, name):
    assert same(queries.QUERIES[name](spark, DATA), queries.ORACLES[name]) > 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_has_rows(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
