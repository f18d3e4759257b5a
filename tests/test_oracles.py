"""Every bound query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

from tabsmith.plans import catalog
from tests.conftest import SF_CHECK
from tests.oracle_check import compare, duck

ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = catalog.QUERIES[key](spark, SF_CHECK)
    ok, msg = compare(df, con, ORACLES[key])
    assert ok, f"{key}: {msg}"


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(catalog.QUERIES)


def test_only_flagship_lacks_an_oracle():
    # the flagship has an oracle too since it was restated in SQL
    assert set(catalog.QUERIES) - set(ORACLES) <= {"assemble_visits", "visit_errors"}
