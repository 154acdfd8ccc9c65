"""Every registered query against its DuckDB twin on the smallest scale."""

import pytest

from harness import SF_SMALL, compare, duck
from marketlake.plans.registry import all_oracles, all_queries

ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, con, name):
    df = all_queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, ORACLES[name], con)
    assert ok, msg


def test_every_query_registered_has_callable():
    qs = all_queries()
    assert len(qs) >= 90
    missing = set(ORACLES) - set(qs)
    assert not missing
