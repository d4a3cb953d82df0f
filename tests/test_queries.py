"""Every registered query against its SQL in DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import __spark_entry__ as contract  # noqa: E402
from oracle import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
CHECKS = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    if name in CHECKS:
        assert compare(df, duck, CHECKS[name]) == []
    else:
        assert df.count() >= 0
