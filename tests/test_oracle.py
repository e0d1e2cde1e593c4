"""Every registered query equals its SQL on the smallest test data."""

import pytest
from compare import database, differences

from ratebook.oracle import ORACLE
from ratebook.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    more, less, count = differences(spark, db, QUERIES[name], ORACLE[name], FOLDER)
    assert not more and not less
    assert count > 0


def test_known_row_counts(spark):
    expected = {
        "raw_contracts": 1500,
        "stg_contracts": 1484,
        "stg_rate_schedules": 5176,
        "stg_amendments": 988,
        "dim_payer": 27,
        "dim_provider": 10,
        "dim_service": 185,
        "fact_contracted_rates": 5311,
    }
    assert {n: QUERIES[n](spark, FOLDER).count() for n in expected} == expected
