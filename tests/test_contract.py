import pytest

import __spark_entry__ as contract
from tidemark.plans.cases import CASES
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(CASES))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_every_query_has_an_oracle():
    assert set(CASES) <= set(contract.queries()) & set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
