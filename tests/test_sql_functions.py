"""The SQL functions agree with the set-based forms, called from SQL text as the source does."""

import datetime as dt
from decimal import Decimal

import pytest

from tabula.functions import sql_functions
from tabula.plans import bank, mart, subscriptions
from tabula.sources.roles import Roles


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_plan_function(spark, small_dir):
    sub = Roles(spark, small_dir).sub()
    at = dt.date(1998, 12, 31)
    assert rows(sql_functions.plan_snapshot_sql(spark, sub, str(at))) == rows(subscriptions.plan_snapshot(sub, at))
    calls = spark.sql("""SELECT actual_current_plan(DATE '2020-12-31', 4, DATE '2020-12-25', 0), actual_current_plan(DATE '2020-12-31', 4, DATE '2020-12-23', 0),
        actual_current_plan(DATE '2020-12-31', 1, DATE '2020-11-30', 2), actual_current_plan(DATE '2020-12-31', 1, DATE '2020-11-29', 2),
        actual_current_plan(DATE '2020-12-31', 4, DATE '2019-12-31', 3), actual_current_plan(DATE '2020-12-31', 4, NULL, NULL)""").first()
    assert tuple(calls) == (0, 4, 1, 1, 3, None)


def test_balance_function(spark):
    day = lambda m, d: dt.date(2020, m, d)
    txn = spark.createDataFrame([(1, day(1, 2), "deposit", Decimal("10.00"), 1), (1, day(3, 1), "purchase", Decimal("4.00"), 2), (2, day(2, 1), "deposit", Decimal("1.00"), 3),
                                 (None, day(1, 1), "deposit", Decimal("7.00"), 4)], "customer_id bigint, txn_date date, txn_type string, txn_amount decimal(18,2), txn_id int")
    got = {(r.customer_id, r.txn_month): r.closing_balance for r in sql_functions.month_end_balances_sql(spark, txn).collect()}
    assert got == {(1, 1): 10.0, (1, 3): 6.0, (2, 2): 1.0, (None, 1): None}  # = matches no NULL customer
    monthly = {(r.customer_id, r.txn_month): r.closing_balance for r in bank.monthly_closing(txn).collect()}
    assert all(monthly[k] == v for k, v in got.items() if k[0] is not None)
    called = spark.sql("SELECT closing_balance(1, 2) AS a, COALESCE(closing_balance(2, 1), -1) AS b").first()
    assert (called.a, called.b) == (Decimal("10.00"), -1)


def test_sales_functions(spark, small_dir):
    clean = mart.clean_weekly_sales(Roles(spark, small_dir).weekly_sales())
    got = sql_functions.sales_by_year_sql(spark, clean, 4, "-06-15")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in mart.before_after_by_year(clean, 6, 15, 4).collect()]
    scalar = spark.sql("""SELECT calendar_year, calculate_before_sales(4, '-06-15', CAST(calendar_year AS INT)) AS before,
        calculate_after_sales(4, '-06-15', CAST(calendar_year AS INT)) AS after FROM clean_weekly_sales GROUP BY calendar_year ORDER BY calendar_year""")
    assert rows(scalar) == rows(got)


def test_functions_refuse_other_types(spark, small_dir):
    sql_functions.register_plan_function(spark, Roles(spark, small_dir).sub())
    with pytest.raises(Exception):
        spark.sql("SELECT actual_current_plan(ARRAY(1), 1, NULL, 2)").collect()
