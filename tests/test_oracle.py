"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.oracle_check import connect, difference

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", contract.queries())
def test_query_equals_its_sql(spark, db, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    assert len(got)
    if name in contract.oracle_sql():
        assert difference(got, db.execute(contract.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
