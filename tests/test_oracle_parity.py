"""Every registered query equals its DuckDB oracle (sf0.001; the driver checks sf0.01)."""

import pytest

from helpers import SF_SMALL
from oracle_compare import compare, duck


def _names():
    from runledger.plans.oracle_sql import ORACLE
    from runledger.plans.queries import QUERIES
    return sorted(set(QUERIES) & set(ORACLE))


def test_every_query_has_an_oracle():
    from runledger.plans.oracle_sql import ORACLE
    from runledger.plans.queries import QUERIES
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _names())
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["ok"], r


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
