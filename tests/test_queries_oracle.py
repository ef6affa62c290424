"""Every registered query against its independent DuckDB formulation (sf0.001; those that sum money also at sf0.01)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from kiln.testing.compare import compare, duck

QUERIES = entry.library_queries()
ORACLE = entry.library_oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert r["match"], r


#: these read amounts that only the larger tables hold (41 digits, fractions below a millionth)
MONEY = ["mart_campaign_summary", "mart_product_performance", "expectation_results", "currency_sales_totals",
         "currency_product_revenue", "currency_division_revenue"]
SF_LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def larger():
    return duck(SF_LARGER)


@pytest.mark.parametrize("name", MONEY)
def test_money_matches_oracle_on_larger_tables(spark, larger, name):
    r = compare(QUERIES[name](spark, SF_LARGER), larger, ORACLE[name])
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "product_sku"
