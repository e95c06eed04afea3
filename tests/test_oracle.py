"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from testbed.check import compare, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    cursor = con.execute(contract.oracle_sql()[name])
    assert compare(found, df.columns, cursor.fetchall(), [d[0] for d in cursor.description]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_of_the_library_has_its_sql():
    """What SQL cannot express is in the text operators' own tests."""
    without = set(contract.queries()) - set(contract.oracle_sql())
    assert all(name.startswith("op") or name == "pipeline" for name in without)
    assert set(contract.oracle_sql()) <= set(contract.queries())
