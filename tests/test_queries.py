"""Every registered query with an SQL form agrees with it on the smallest tables."""

import pytest

import __spark_entry__ as contract
from riskframe.plans.catalog import ORACLES, QUERIES
from riskframe.plans.views import Views
from tests.oracle import differences


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, small, name):
    assert differences(QUERIES[name](Views(spark, small)), con, ORACLES[name]) == []


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    rows = contract.entry(spark).collect()
    assert rows and sum(r["n"] for r in rows) == Views(spark, "/root/testdata/sf0.001").customer.count()
