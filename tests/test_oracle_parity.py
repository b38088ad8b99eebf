"""Every registered query equals its DuckDB oracle, value for value, at sf0.001."""

import pytest

from marketlens.plans import registry
from tests.compare import assert_same
from tests.conftest import SF_SMALL

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    assert_same(QUERIES[key](spark, SF_SMALL), duck, ORACLES[key])


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert len(df.columns) == 121
    assert df.count() > 0
