"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from conftest import SF_SMALL

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


from strata.plans.registry import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF_SMALL, entry.queries()[name], entry.oracle_sql().get(name))
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_number", "product_key", "customer_key", "order_date", "shipping_date", "due_date",
                          "sales", "sls_quantity", "price"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_long_keys_are_not_cut(spark):
    from strata.sources.fixtures import _pad

    got = spark.createDataFrame([(7,), (123456789,), (1234567890,)], "k long").select(_pad(F.col("k"))).collect()
    assert [r[0] for r in got] == ["00000007", "123456789", "1234567890"]
