"""Every registered query with SQL gives the SQL's rows; the others give rows."""

import pytest

import oracle
from loadkit.plans import registry

QUERIES, ORACLES = registry.all_queries(), registry.all_oracles()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert oracle.difference(df, con, ORACLES[name]) is None
    else:
        assert len(df.collect()) > 0
