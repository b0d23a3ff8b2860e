import pytest

pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from coinwharf.checks.oracle import ORACLE  # noqa: E402
from coinwharf.checks.queries import QUERIES  # noqa: E402
from oracle_check import compare, connect  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, views, name):
    problem = compare(spark, views, SF_DIR, contract.queries()[name], contract.oracle_sql()[name])
    assert problem is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["product_id", "total_revenue", "revenue_percentage"] and not df.isEmpty()
