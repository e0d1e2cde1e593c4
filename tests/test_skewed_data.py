"""Registered queries on data where single keys hold a third of the rows.

The thresholds are lowered, so that hot keys are found and no dimension is small
enough to broadcast; the results must still equal the SQL.
"""

from functools import partial

import pytest
from compare import TABLES, database, differences

from ratebook import queries
from ratebook.operators import skew
from ratebook.oracle import ORACLE
from ratebook.plans import intermediate, marts
from ratebook.sources import testdata

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = tmp_path_factory.mktemp("skewed")
    db = database(SOURCE)
    changed = {
        # One order, one part and one supplier; every ninth row is the same row.
        "lineitem": """
            SELECT * REPLACE (
              CASE WHEN n % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
              CASE WHEN n % 9 = 0 THEN 8 ELSE l_partkey END AS l_partkey,
              CASE WHEN n % 3 = 1 THEN 3 ELSE l_suppkey END AS l_suppkey,
              CASE WHEN n % 9 = 0 THEN 1 ELSE l_linenumber END AS l_linenumber,
              CASE WHEN n % 9 = 0 THEN 100.0 ELSE l_extendedprice END AS l_extendedprice,
              CASE WHEN n % 9 = 0 THEN 0.5 ELSE l_discount END AS l_discount,
              CASE WHEN n % 9 = 0 THEN 'A' ELSE l_returnflag END AS l_returnflag,
              CASE WHEN n % 9 = 0 THEN 'F' ELSE l_linestatus END AS l_linestatus,
              CASE WHEN n % 9 = 0 THEN TIMESTAMP '1998-01-01' ELSE l_shipdate END AS l_shipdate)
            FROM (SELECT *, row_number() OVER () AS n FROM lineitem)""",
        "orders": """
            SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey)
            FROM orders""",
        "events": """
            SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 21 ELSE event_id END AS event_id)
            FROM events""",
    }
    for name in TABLES:
        sql = changed.get(name, f"SELECT * FROM {name}")
        if name == "lineitem":
            sql = sql.replace("SELECT * REPLACE", "SELECT * EXCLUDE (n) REPLACE", 1)
        db.execute(f"COPY ({sql}) TO '{target}/{name}.parquet' (FORMAT parquet)")
    return str(target)


@pytest.fixture
def lowered(monkeypatch):
    for name in ("hot_rate_contracts", "hot_amendment_contracts"):
        monkeypatch.setattr(testdata, name, partial(getattr(testdata, name), min_rows=100))
    small = partial(skew.lookup_join, max_bytes=3, min_hot_rows=100)
    monkeypatch.setattr(marts, "lookup_join", small)
    monkeypatch.setattr(intermediate, "lookup_join", small)


def test_the_key_is_hot(spark, folder, lowered):
    for hot in (testdata.hot_rate_contracts, testdata.hot_amendment_contracts):
        assert "CON-7" in {r.key for r in hot(spark, folder).table.collect()}


@pytest.mark.parametrize(
    "name",
    [
        "stg_rate_schedules",
        "stg_amendments",
        "int_contracts_enriched",
        "int_rates_normalized",
        "int_rates_normalized_ref",
        "dim_payer_ref",
        "dim_provider",
        "dim_service",
        "fact_contracted_rates",
    ],
)
def test_query_equals_sql(spark, folder, lowered, name):
    db = database(folder)
    more, less, count = differences(spark, db, queries.QUERIES[name], ORACLE[name], folder)
    assert not more and not less
    assert count > 0
