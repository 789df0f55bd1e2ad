"""Bank reports: node stays per region and the customer ledger.

Ledger balances are built set-based: signed amounts are summed per
(customer, day) first, so every later window runs over at most one row per
calendar day of a customer -- a bound set by the calendar, not by how many
transactions a customer makes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.operators.aggregates import window_aggregate
from tabula.operators.ordered import exact_percentiles, join_on_keys


def nodes_and_customers_by_region(stay: DataFrame, regions: DataFrame) -> DataFrame:
    return (stay.join(regions, "region_id").groupBy("region_name")
            .agg(F.countDistinct("node_id").alias("num_nodes"),
                 F.countDistinct("customer_id").alias("num_customers")))


def unique_nodes(stay: DataFrame) -> DataFrame:
    return stay.agg(F.countDistinct("node_id").alias("num_nodes"))


def _stay_days(stay: DataFrame) -> DataFrame:
    return stay.withColumn("interval_days", F.datediff("end_date", "start_date"))


def average_of_averages(stay: DataFrame) -> DataFrame:
    """AVG over customers of each customer's AVG stay length: exact, and the
    integer-truncated variant integer inputs give (each level truncates)."""
    per = _stay_days(stay).groupBy("customer_id").agg(
        F.avg("interval_days").alias("avg_days"),
        F.expr("sum(interval_days) div count(interval_days)").alias("avg_days_int"))  # exact integer division
    return per.agg(F.round(F.avg("avg_days"), 4).alias("avg_days_reallocated"),
                   F.expr("sum(avg_days_int) div count(avg_days_int)").alias("avg_days_reallocated_int"))


# The percentiles of the reallocation report.
PERCENTILES = {"median": 0.5, "p80": 0.8, "p95": 0.95}


def stay_percentiles(stay: DataFrame, truncate_average: bool = False) -> DataFrame:
    """PERCENTILE_CONT 0.5 / 0.8 / 0.95 of per-(customer, region) average stay,
    per region. ``truncate_average`` uses the integer average (AVG over INT
    days truncates) as the source's numbers do."""
    avg = (F.expr("sum(interval_days) div count(interval_days)") if truncate_average
           else F.avg("interval_days"))
    per = _stay_days(stay).groupBy("customer_id", "region_id").agg(avg.alias("avg_days"))
    out = exact_percentiles(per, ["region_id"], "avg_days", PERCENTILES)
    return out.select("region_id", *[F.round(name, 4).alias(name) for name in PERCENTILES])


def _signed(col_type: str = "txn_type", amount: str = "txn_amount"):
    return F.when(F.col(col_type) == "deposit", F.col(amount)).otherwise(-F.col(amount))


def by_type(txn: DataFrame) -> DataFrame:
    return txn.groupBy("txn_type").agg(F.count(F.lit(1)).alias("num_trans"),
                                       F.sum("txn_amount").cast("double").alias("total_amount"))


def deposit_summary(txn: DataFrame) -> DataFrame:
    d = txn.filter(F.col("txn_type") == "deposit")
    return d.agg(F.count(F.lit(1)).alias("total_deposit_counts"),
                 F.round(F.avg("txn_amount").cast("double"), 4).alias("avg_deposit_amounts"))


def busy_customers_per_month(txn: DataFrame, min_txns: int = 2) -> DataFrame:
    """Per (year, month): customers with at least ``min_txns`` transactions in it.
    (COUNT(*) OVER (PARTITION BY customer, month) > 1, as a grouped count.)"""
    per = txn.groupBy("customer_id", F.year("txn_date").alias("txn_year"),
                      F.month("txn_date").alias("month_transactions")).agg(F.count(F.lit(1)).alias("n"))
    return (per.filter(F.col("n") >= min_txns)
            .groupBy(F.col("txn_year").cast("bigint").alias("txn_year"),
                     F.col("month_transactions").cast("bigint").alias("month_transactions"))
            .agg(F.count(F.lit(1)).alias("num_cus")).orderBy("txn_year", "month_transactions"))


def daily_ledger(txn: DataFrame) -> DataFrame:
    """(customer, day): net amount, row count and balance at the end of the day.
    Transactions without a customer are one group, as in PARTITION BY, and
    those without a date come before all dates."""
    daily = txn.groupBy("customer_id", "txn_date").agg(
        F.sum(_signed()).alias("net"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("customer_id").orderBy("txn_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("balance", F.sum("net").over(w))  # <= one row per calendar day


def _sortable(day: str):
    """The day, or the first of all days for a NULL one (max_by skips NULLs)."""
    return F.coalesce(F.col(day), F.lit("0001-01-01").cast("date"))


def monthly_closing(txn: DataFrame) -> DataFrame:
    """Closing balance per customer at the end of every (year, month) with
    activity; a NULL month holds the transactions without a date."""
    daily = daily_ledger(txn)
    return (daily.groupBy("customer_id", F.year("txn_date").cast("bigint").alias("txn_year"),
                          F.month("txn_date").cast("bigint").alias("txn_month"))
            .agg(F.max_by("balance", _sortable("txn_date")).cast("double").alias("closing_balance")))


# The months pivoted into columns.
PIVOT_MONTHS = (1, 2, 3, 4)


def closing_balance_pivot(txn: DataFrame, months=PIVOT_MONTHS) -> DataFrame:
    """Per (customer, year): balance at the end of each of ``months`` -- the
    ledger sum of everything up to that month, NULL before the first
    transaction; a month without activity carries the earlier balance.
    Transactions without a date come before all years; their own row, whose
    year is NULL, has no months."""
    monthly = txn.groupBy("customer_id", F.year("txn_date").alias("y"), F.month("txn_date").alias("m")).agg(
        F.sum(_signed()).alias("net"))
    per_year = monthly.groupBy("customer_id", "y").agg(
        F.sum("net").alias("year_net"),
        *[F.sum(F.when(F.col("m") <= m, F.col("net"))).alias(f"upto{m}") for m in months])
    # balance carried in from earlier years: a window over one row per (customer, year)
    w = Window.partitionBy("customer_id").orderBy("y").rowsBetween(Window.unboundedPreceding, -1)
    rows = per_year.withColumn("opening", F.sum("year_net").over(w))
    cols = []
    for m in months:
        # no transaction at all up to this month -> NULL; otherwise opening + this year's part
        bal = F.when(F.col("opening").isNull() & F.col(f"upto{m}").isNull(), F.lit(None)).otherwise(
            F.coalesce(F.col("opening"), F.lit(0)) + F.coalesce(F.col(f"upto{m}"), F.lit(0)))
        cols.append(F.when(F.col("y").isNotNull(), bal).cast("double").alias(f"month{m}"))
    return rows.select("customer_id", F.col("y").cast("bigint").alias("txn_year"), *cols)


def month_ratios(txn: DataFrame) -> DataFrame:
    """Month-over-month balance ratio x100 (the source calls it a change)."""
    p = closing_balance_pivot(txn)

    def ratio(a, b):
        return F.round(F.col(b) * 100.0 / F.nullif(F.col(a), F.lit(0.0)), 2)
    return p.select("customer_id", "txn_year",
                    ratio("month1", "month2").alias("change12"), ratio("month2", "month3").alias("change23"),
                    ratio("month3", "month4").alias("change34"), ratio("month1", "month4").alias("changeoverall"))


def running_balance(txn: DataFrame) -> DataFrame:
    """Each transaction with its impact and the running balance; rows of the
    same day share the end-of-day balance (the default RANGE frame)."""
    daily = daily_ledger(txn).select("customer_id", "txn_date", "balance")
    return join_on_keys(txn, daily, ["customer_id", "txn_date"]).select(
        "customer_id", "txn_date", "txn_type", "txn_id",
        _signed().cast("double").alias("impact"), F.col("balance").cast("double").alias("running_balance"))


def running_balance_stats(txn: DataFrame) -> DataFrame:
    """Per customer and month: closing balance and min / avg / max of the
    running balance over the month's transactions (avg weighted by rows)."""
    daily = daily_ledger(txn)
    g = daily.groupBy("customer_id", F.year("txn_date").cast("bigint").alias("txn_year"),
                      F.month("txn_date").cast("bigint").alias("txn_month"))
    return g.agg(
        F.max_by("balance", _sortable("txn_date")).cast("double").alias("closing_balance"),
        F.max("balance").cast("double").alias("max_running_balance_in_month"),
        F.min("balance").cast("double").alias("min_running_balance_in_month"),
        F.round((F.sum(F.col("balance") * F.col("n"))
                 / F.sum(F.when(F.col("balance").isNotNull(), F.col("n")))).cast("double"), 4)
         .alias("avg_running_balance_in_month")).orderBy("customer_id", "txn_year", "txn_month")


def txn_count_window(txn: DataFrame) -> DataFrame:
    """Transactions with their per-(customer, month) count attached."""
    t = txn.withColumn("txn_year", F.year("txn_date")).withColumn("txn_month", F.month("txn_date"))
    return window_aggregate(t, ["customer_id", "txn_year", "txn_month"], F.count(F.lit(1)), "num_in_month")
