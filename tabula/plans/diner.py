"""Restaurant loyalty reports over (sales, menu, members)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.functions.dates import add_term
from tabula.operators.aggregates import ties_for_max, ties_for_min


def spend_per_customer(sale: DataFrame, menu: DataFrame) -> DataFrame:
    """Total spent per customer (inner join + SUM)."""
    return (sale.join(menu, "product_id")
            .groupBy("customer_id")
            .agg(F.sum("price").cast("double").alias("total_amount")))


def visit_days(sale: DataFrame) -> DataFrame:
    """Distinct visit days per customer."""
    return sale.groupBy("customer_id").agg(F.countDistinct("order_date").alias("no_days_visit"))


def global_counts(sale: DataFrame) -> DataFrame:
    """Several COUNT(DISTINCT) in one global row."""
    return sale.agg(F.countDistinct("customer_id").alias("unique_customers"),
                    F.countDistinct("order_id").alias("total_orders"),
                    F.count("product_id").alias("total_items"),
                    F.countDistinct("order_date").alias("distinct_days"))


def first_items(sale: DataFrame, menu: DataFrame) -> DataFrame:
    """Items bought on each customer's first order date (distinct pairs)."""
    dated = sale.select("customer_id", "order_date", "product_id").filter(F.col("order_date").isNotNull())
    first = ties_for_min(dated, ["customer_id"], "order_date")
    return first.join(menu, "product_id").select("customer_id", "product_name").distinct()


def top_items(sale: DataFrame, menu: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most purchased item names (TOP k, name as tiebreak)."""
    per_product = sale.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))  # before the menu join
    counts = per_product.join(menu, "product_id").groupBy("product_name").agg(F.sum("n").alias("no_buy"))
    return counts.orderBy(F.desc("no_buy"), F.asc_nulls_last("product_name")).limit(k)


def favourite_items(sale: DataFrame, menu: DataFrame) -> DataFrame:
    """Each customer's most purchased product(s), ties kept (RANK() = 1)."""
    counts = sale.groupBy("customer_id", "product_id").agg(F.count("product_id").alias("purchase_count"))
    top = ties_for_max(counts, ["customer_id"], "purchase_count")
    return (top.join(menu, "product_id").select("customer_id", "product_id", "product_name", "purchase_count")
            .orderBy("customer_id", "product_id"))


def first_after_joining(sale: DataFrame, member: DataFrame, menu: DataFrame) -> DataFrame:
    """Items bought on the first order date on or after the join date."""
    after = sale.join(member, "customer_id").filter(F.col("order_date") >= F.col("join_date"))
    first = ties_for_min(after.select("customer_id", "join_date", "order_date", "product_id"),
                         ["customer_id"], "order_date")
    return first.join(menu, "product_id").select(
        "customer_id", "join_date", "product_id", "product_name",
        F.col("order_date").alias("first_purchase_date"))


def last_before_joining(sale: DataFrame, member: DataFrame, menu: DataFrame) -> DataFrame:
    """Items bought on the last order date before the join date."""
    before = sale.join(member, "customer_id").filter(F.col("order_date") < F.col("join_date"))
    last = ties_for_max(before.select("customer_id", "join_date", "order_date", "product_id"),
                        ["customer_id"], "order_date")
    return last.join(menu, "product_id").select(
        "customer_id", "join_date", "product_name", F.col("order_date").alias("date_before_join"))


def totals_before_joining(sale: DataFrame, member: DataFrame, menu: DataFrame) -> DataFrame:
    """Items and amount per member before joining."""
    before = (sale.join(menu, "product_id").join(member, "customer_id", "left")
              .filter(F.col("order_date") < F.col("join_date")))
    return before.groupBy("customer_id").agg(
        F.count("product_id").alias("total_items"), F.sum("price").cast("double").alias("total_amount"))


def loyalty_points(sale: DataFrame, menu: DataFrame, member: DataFrame, bonus_category: str = "PROMO",
                   first_week_days: int = 7, until: dt.date | None = None) -> DataFrame:
    """Points: 10 per unit of price, doubled for ``bonus_category``
    (``points_base``); ``points_member`` also doubles everything from the join
    date to join date + ``first_week_days`` inclusive (an 8-day window, as
    BETWEEN is inclusive). Non-members are kept (left join). ``until`` caps
    order dates when given. Most points first."""
    rows = sale.join(menu, "product_id", "left").join(member, "customer_id", "left")
    if until is not None:
        rows = rows.filter(F.col("order_date") <= F.lit(until))
    bonus = F.col("category") == bonus_category
    base = F.when(bonus, F.col("price") * 20).otherwise(F.col("price") * 10)
    in_week = F.col("order_date").between(F.col("join_date"), add_term("join_date", "day", first_week_days))
    member_pts = F.when(in_week, F.col("price") * 20).otherwise(base)
    return rows.groupBy("customer_id").agg(F.sum(base).cast("double").alias("points_base"),
                                           F.sum(member_pts).cast("double").alias("points_member")).orderBy(
        F.desc("points_member"), "customer_id")
