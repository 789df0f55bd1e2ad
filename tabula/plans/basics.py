"""Plain relational building blocks over the driver tables: projection,
date arithmetic, distinct / duplicate checks, chained joins and correlated
counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.functions.dates import add_term
from tabula.sources import sinks
from tabula.sources.roles import PLANS, to_money


def project_net_price(lineitem: DataFrame) -> DataFrame:
    """Projection with aliases and arithmetic (reads three columns only)."""
    return lineitem.select("l_orderkey", "l_linenumber",
                           F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net_price"))


def date_arithmetic(orders: DataFrame) -> DataFrame:
    """DATEADD by day / week / month / year on DATE values, staying DATE."""
    d = F.col("o_orderdate").cast("date")
    return orders.select("o_orderkey", d.alias("order_date"),
                         add_term(d, "day", 7).alias("plus_7d"), add_term(d, "week", 1).alias("plus_1w"),
                         add_term(d, "month", 1).alias("plus_1m"), add_term(d, "year", 1).alias("plus_1y"))


def line_duplicates(lineitem: DataFrame) -> DataFrame:
    """``GROUP BY key, COUNT(*)`` over (order, line number)."""
    return lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("counts"))


def region_revenue(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """orders -> customer -> nation -> region chain; the planner knows the
    tables' sizes and picks the joins."""
    chain = (orders.join(customer, orders.o_custkey == customer.c_custkey)
             .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return chain.groupBy(F.col("r_name").alias("region_name")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(to_money("o_totalprice")).cast("double").alias("total_price"))


def lines_per_part(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``(SELECT COUNT(*) FROM lineitem WHERE l_partkey = p_partkey)`` per part:
    aggregate once, left join, zero for parts without lines."""
    counts = lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return part.join(counts, part.p_partkey == counts.l_partkey, "left").select(
        "p_partkey", F.coalesce(F.col("n"), F.lit(0)).alias("n_lines"))


def catalogue_starts(spark: SparkSession, sub: DataFrame, name: str = "plan_catalogue") -> DataFrame:
    """``CREATE TABLE`` and ``INSERT INTO ... VALUES`` of the plan catalogue's
    literal rows, then the subscriptions started per plan of that table."""
    sinks.create(spark, name, "plan_id INT, plan_name STRING, price DECIMAL(5,2)", replace=True)
    sinks.insert_rows(spark, name, PLANS)
    sinks.expire(spark, name)
    per_plan = sub.groupBy("plan_id").agg(F.count(F.lit(1)).alias("num_subs"))  # before the lookup
    return per_plan.join(sinks.read(spark, name), "plan_id").select("plan_name", F.col("price").cast("double").alias("price"), "num_subs")
