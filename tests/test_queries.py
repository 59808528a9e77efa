"""Every query with equivalent SQL against that SQL on the smallest tables."""

import pytest

import __spark_entry__
from lociflow.plans import ORACLES, REGISTRY
from tests.conftest import against_sql


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    got, want = against_sql(spark, REGISTRY[name], ORACLES[name])
    assert got == want


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(REGISTRY) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["line_id", "reason"]
