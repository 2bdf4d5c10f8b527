"""Every registered query against its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__
from salesmart.checks.compare import compare, duck
from salesmart.plans import registry as E

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) == set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    res = compare(E.queries()[name](spark, sf_small), con, E.oracle_sql()[name])
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["month_year", "customer_state", "customer_id",
                          "total_products_bought", "total_money_spent"]
    assert df.count() > 0
