import pytest

import __spark_entry__ as entry
import oracle
from tests.compare import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(entry._QUERIES) == set(oracle.statements())


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert differences(spark, duck, SF, entry.queries()[name], entry.oracle_sql()[name]) == []


def test_flagship_query(spark):
    top = entry.entry(spark)
    assert top.columns == ["country_name", "records", "total_sales", "avg_unit_price"]
    assert top.count() == 10
