"""Every query equals its SQL counterpart."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_module):
    return connect(sf_module)


@pytest.fixture(scope="module")
def sf_module() -> str:
    return "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, sf_module, name):
    assert difference(QUERIES[name](spark, sf_module), con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_flagship_gives_31_days(spark):
    days = contract.entry(spark).collect()
    assert len(days) == 31
    assert (days[0]["snapshots"], days[0]["total_mrr"]) == (134, 9851.0)
    assert (days[-1]["snapshots"], days[-1]["total_mrr"]) == (133, 10791.0)
