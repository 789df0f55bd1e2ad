"""Every registered report against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

KEYS = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))  # those have tests of their own


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_every_key_has_an_oracle():
    assert set(entry.oracle_sql()) - set(entry.LLM_ORACLE) == set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, small_dir, key):
    got = entry.queries()[key](spark, small_dir).toPandas()
    want = con.sql(entry.oracle_sql()[key]).df()
    err = compare(got, want, ordered=key in entry.ORDERS)
    assert err is None, err


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["page_id", "page_name", "viewed", "added_to_cart", "abandoned", "purchased",
                          "viewed_to_purchased", "conversion_rate_add_cart", "conversion_purchase"]
