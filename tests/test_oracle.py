"""Every registered query against its SQL, on the smallest tables."""

import pytest

from leadchecks.compare import compare, connect
from leadchecks.oracle import ORACLE
from leadchecks.queries import ALL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLE) == set(ALL)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql(spark, connection, name):
    outcome = compare(spark, connection, SF_DIR, name)
    assert outcome["rows"] > 0
    assert outcome["equal"], outcome
