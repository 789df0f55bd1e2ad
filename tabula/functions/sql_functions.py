"""The source's functions as SQL functions of the session.

``register_*`` makes temporary views and ``CREATE TEMPORARY FUNCTION``s, so SQL
text can call them as the source does. Their bodies are SQL, so Catalyst
inlines the calls and turns the subqueries into joins over the distinct
arguments: a call per row costs no query per row. Each report has a set-based
form in ``tabula.plans``, too; both give the same results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PLAN_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION actual_current_plan(at DATE, plan INT, previous_date DATE, previous_plan INT)
RETURNS INT COMMENT 'the plan in force at a date: a paid-up previous plan stays until its term ends'
RETURN CASE
  WHEN previous_plan = 0 THEN IF(date_add(previous_date, 7) >= at, previous_plan, plan)
  WHEN previous_plan IN (1, 2) THEN IF(add_months(previous_date, 1) >= at, previous_plan, plan)
  WHEN previous_plan = 3 THEN IF(add_months(previous_date, 12) >= at, previous_plan, plan)
END"""

BALANCE_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION closing_balance(customer BIGINT, month_number INT)
RETURNS DECIMAL(28, 2) COMMENT 'ledger sum of a customer up to a month of the year'
RETURN (SELECT SUM(CASE WHEN t.txn_type = 'deposit' THEN t.txn_amount ELSE -t.txn_amount END)
        FROM customer_transactions t
        WHERE month(t.txn_date) <= month_number AND t.customer_id = customer)"""

SALES_FUNCTIONS = ["""
CREATE OR REPLACE TEMPORARY FUNCTION calculate_before_sales(weeks INT, changing_date STRING, sales_year INT)
RETURNS BIGINT COMMENT 'sales of the weeks before a day (as -MM-dd) of a year'
RETURN (SELECT SUM(sales) FROM clean_weekly_sales
        WHERE week_date >= date_add(to_date(concat(sales_year, changing_date)), -7 * weeks)
          AND week_date < to_date(concat(sales_year, changing_date)))""", """
CREATE OR REPLACE TEMPORARY FUNCTION calculate_after_sales(weeks INT, changing_date STRING, sales_year INT)
RETURNS BIGINT COMMENT 'sales from a day (as -MM-dd) of a year to the end of the weeks after it'
RETURN (SELECT SUM(sales) FROM clean_weekly_sales
        WHERE week_date >= to_date(concat(sales_year, changing_date))
          AND week_date <= date_add(to_date(concat(sales_year, changing_date)), 7 * weeks))""", """
CREATE OR REPLACE TEMPORARY FUNCTION sales_around(weeks INT, changing_date STRING, sales_year INT)
RETURNS TABLE(before BIGINT, after BIGINT) COMMENT 'both sums as a row'
RETURN SELECT calculate_before_sales(weeks, changing_date, sales_year), calculate_after_sales(weeks, changing_date, sales_year)"""]


def register_plan_function(spark: SparkSession, sub: DataFrame) -> None:
    """View ``subscriptions`` and scalar function ``actual_current_plan``."""
    sub.createOrReplaceTempView("subscriptions")
    spark.sql(PLAN_FUNCTION)


def register_balance_function(spark: SparkSession, txn: DataFrame) -> None:
    """View ``customer_transactions`` and scalar function ``closing_balance``
    (the months of all years together, as in the source)."""
    txn.createOrReplaceTempView("customer_transactions")
    spark.sql(BALANCE_FUNCTION)


def register_sales_functions(spark: SparkSession, clean: DataFrame) -> None:
    """View ``clean_weekly_sales``, scalar functions ``calculate_before_sales``
    and ``calculate_after_sales``, and the table function ``sales_around``."""
    clean.createOrReplaceTempView("clean_weekly_sales")
    for sql in SALES_FUNCTIONS:
        spark.sql(sql)


def plan_snapshot_sql(spark: SparkSession, sub: DataFrame, at: str) -> DataFrame:
    """Customers and share per plan in force at the day ``at``, as SQL text."""
    register_plan_function(spark, sub)
    return spark.sql("""
WITH latest AS (
  SELECT customer_id, plan_id, start_date, row_number() OVER (PARTITION BY customer_id ORDER BY start_date DESC, sub_id DESC) AS back
  FROM subscriptions WHERE start_date <= DATE :at),
two AS (
  SELECT customer_id, max(CASE WHEN back = 1 THEN plan_id END) AS plan_id, max(CASE WHEN back = 2 THEN plan_id END) AS previous_plan,
         max(CASE WHEN back = 2 THEN start_date END) AS previous_date
  FROM latest WHERE back <= 2 GROUP BY customer_id)
SELECT current_plan, COUNT(*) AS plan_num, round(CAST(100 * COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 2) AS plan_percent
FROM (SELECT CAST(CASE WHEN plan_id IN (0, 3) THEN plan_id
                       WHEN plan_id = 4 THEN actual_current_plan(DATE :at, plan_id, previous_date, previous_plan)
                       WHEN previous_plan < plan_id THEN plan_id
                       ELSE actual_current_plan(DATE :at, plan_id, previous_date, previous_plan) END AS BIGINT) AS current_plan
      FROM two)
GROUP BY current_plan""".replace(":at", f"'{at}'"))


def month_end_balances_sql(spark: SparkSession, txn: DataFrame) -> DataFrame:
    """``closing_balance`` called for every customer and month of the year."""
    register_balance_function(spark, txn)
    return spark.sql("""
SELECT customer_id, CAST(txn_month AS BIGINT) AS txn_month, CAST(closing_balance(customer_id, txn_month) AS DOUBLE) AS closing_balance
FROM (SELECT DISTINCT customer_id, month(txn_date) AS txn_month FROM customer_transactions)""")


def sales_by_year_sql(spark: SparkSession, clean: DataFrame, weeks: int, changing_date: str) -> DataFrame:
    """The table function called for every year of the sales."""
    register_sales_functions(spark, clean)
    return spark.sql(f"""
SELECT y.calendar_year, s.before, s.after
FROM (SELECT DISTINCT calendar_year FROM clean_weekly_sales) y, LATERAL sales_around({weeks}, '{changing_date}', CAST(y.calendar_year AS INT)) s
ORDER BY y.calendar_year""")
