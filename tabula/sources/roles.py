"""Role views: the driver tables dressed as the schemas the reports expect.

Each role is a lazy DataFrame over whole driver tables (no id subsets, no row
caps), so every report's work grows with the data. The same definitions are
written as SQL in ``roles_sql.py`` for the DuckDB oracle; keep the two in step.

Small fixed lookup tables (plan catalogue, event names, pizza names, campaign
windows) are literal rows with a proven size bound and are broadcast.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.sources.tables import Tables, forget_other_sessions

MONEY = T.DecimalType(18, 2)

# --- fixed values -----------------------------------------------------------
# Subscription plan catalogue (plan_id, plan_name, price); churn has no price.
PLANS = [
    (0, "trial", Decimal("0.00")),
    (1, "basic monthly", Decimal("9.90")),
    (2, "pro monthly", Decimal("19.90")),
    (3, "pro annual", Decimal("199.00")),
    (4, "churn", None),
]
# Click-stream event catalogue (event_type, event_name) and the driver's
# event_type text mapped onto it.
EVENT_NAMES = [
    (1, "Page View"),
    (2, "Add to Cart"),
    (3, "Purchase"),
    (4, "Ad Impression"),
    (5, "Ad Click"),
]
EVENT_CODES = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
# Delivery menu (pizza_id, pizza_name).
PIZZA_NAMES = [(1, "Meatlovers"), (2, "Vegetarian")]
# Marketing campaigns (name, start, end): non-overlapping, a gap on 20-21 Jan.
CAMPAIGNS = [
    ("New Year Offer", dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 9, 23, 59, 59)),
    ("Winter Bundle", dt.datetime(2024, 1, 10, 0, 0, 0), dt.datetime(2024, 1, 19, 23, 59, 59)),
    ("Month End Push", dt.datetime(2024, 1, 22, 0, 0, 0), dt.datetime(2024, 1, 31, 23, 59, 59)),
]
# ---------------------------------------------------------------------------


def to_money(col: str) -> Column:
    """DOUBLE amount -> DECIMAL(18,2): rounded to whole cents (half away from
    zero) on the double, then scaled exactly, so every engine gets the same
    cents (a direct cast rounds the printed or the binary value, which differ
    for amounts with more than two decimals)."""
    cents = F.round(F.col(col) * 100).cast("bigint")
    return (cents.cast(T.DecimalType(18, 0)) / 100).cast(MONEY)


def _minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


def _digit(col: str) -> Column:
    return F.substring(F.col(col), 1, 1)


_LITERALS: dict[tuple[int, str], DataFrame] = {}


def _literal(spark: SparkSession, name: str, rows, schema: str) -> DataFrame:
    """A fixed lookup table, created once per session and broadcast (its row
    count is the length of a constant list)."""
    key = (id(spark), name)
    forget_other_sessions(spark, _LITERALS)
    df = _LITERALS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _LITERALS[key] = spark.createDataFrame(rows, schema)
    return F.broadcast(df)


class Roles:
    """Builds every role view for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)

    # -- literal dimensions (bounded by construction) -----------------------
    def plans(self) -> DataFrame:
        return _literal(self.spark, "plans", PLANS, "plan_id INT, plan_name STRING, price DECIMAL(5,2)")

    def event_names(self) -> DataFrame:
        return _literal(self.spark, "event_names", EVENT_NAMES, "event_type INT, event_name STRING")

    def pizza_names(self) -> DataFrame:
        return _literal(self.spark, "pizza_names", PIZZA_NAMES, "pizza_id INT, pizza_name STRING")

    def campaigns(self) -> DataFrame:
        return _literal(self.spark, "campaigns", CAMPAIGNS,
                        "campaign_name STRING, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ")

    # -- restaurant: sales, menu, members ------------------------------------
    def sale(self) -> DataFrame:
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderdate")
        li = self.t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    def menu(self) -> DataFrame:
        return self.t("part", "p_partkey", "p_name", "p_retailprice", "p_type").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            to_money("p_retailprice").alias("price"),
            F.col("p_type").alias("category"),
        )

    def member(self) -> DataFrame:
        o = self.t("orders", "o_custkey", "o_orderdate", "o_orderpriority")
        return (o.filter(F.col("o_orderpriority") == "1-URGENT")
                .groupBy(F.col("o_custkey").alias("customer_id"))
                .agg(F.min(F.col("o_orderdate").cast("date")).alias("join_date")))

    # -- subscriptions --------------------------------------------------------
    def sub(self) -> DataFrame:
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        return o.select(
            F.col("o_custkey").alias("customer_id"),
            (_digit("o_orderpriority").cast("int") - 1).alias("plan_id"),
            F.col("o_orderdate").cast("date").alias("start_date"),
            F.col("o_orderkey").alias("sub_id"),
        )

    # -- bank: node stays, regions, ledger ------------------------------------
    def stay(self) -> DataFrame:
        li = self.t("lineitem", "l_orderkey", "l_suppkey", "l_shipdate")
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderdate")
        c = self.t("customer", "c_custkey", "c_nationkey")
        n = self.t("nation", "n_nationkey", "n_regionkey")
        placed = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
                  .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
        early = F.col("l_shipdate") < F.col("o_orderdate")  # a stay lasts from the earlier date to the later
        first = F.when(early, F.col("l_shipdate")).otherwise(F.col("o_orderdate"))
        last = F.when(early, F.col("o_orderdate")).otherwise(F.col("l_shipdate"))
        return (li.join(placed, li.l_orderkey == placed.o_orderkey)
                .select(F.col("o_custkey").alias("customer_id"),
                        F.col("n_regionkey").alias("region_id"),
                        F.col("l_suppkey").alias("node_id"),
                        first.cast("date").alias("start_date"),
                        last.cast("date").alias("end_date")))

    def regions(self) -> DataFrame:
        return self.t("region", "r_regionkey", "r_name").select(
            F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))

    def txn(self) -> DataFrame:
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
        return o.select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("txn_date"),
            F.when(F.col("o_orderstatus") == "O", "deposit")
             .when(F.col("o_orderstatus") == "F", "purchase")
             .otherwise("withdrawal").alias("txn_type"),
            to_money("o_totalprice").alias("txn_amount"),
            F.col("o_orderkey").alias("txn_id"),
        )

    # -- retail: raw weekly sales ----------------------------------------------
    def weekly_sales(self) -> DataFrame:
        o = self.t("orders", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority")
        c = self.t("customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        n = self.t("nation", "n_nationkey", "n_regionkey")
        r = self.t("region", "r_regionkey", "r_name")
        digit = _digit("o_orderpriority")
        week = F.date_trunc("week", F.col("o_orderdate")).cast("date")
        rows = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
                .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
                .select(
                    week.alias("week"),
                    F.col("r_name").alias("region"),
                    F.col("c_mktsegment").alias("platforms"),
                    F.when(digit == "5", F.lit("null"))
                     .otherwise(F.concat(F.when(F.col("o_orderstatus") == "F", "C").otherwise("F"), digit))
                     .alias("segment"),
                    F.when(F.col("c_acctbal") < 0, "Guest")
                     .when(F.col("c_acctbal") < 5000, "New")
                     .otherwise("Existing").alias("customer_type"),
                    F.floor("o_totalprice").cast("bigint").alias("sale")))
        # group on the DATE (a narrow key); the d/M/yy text is made once per group
        grouped = (rows.groupBy("week", "region", "platforms", "segment", "customer_type")
                   .agg(F.count(F.lit(1)).alias("transactions"), F.sum("sale").alias("sales")))
        return grouped.select(F.date_format("week", "d/M/yy").alias("week_date"), "region", "platforms",
                              "segment", "customer_type", "transactions", "sales")

    def week_texts(self) -> DataFrame:
        """The week column of the raw weekly sales as text, once per week."""
        o = self.t("orders", "o_orderdate")
        weeks = o.select(F.date_trunc("week", "o_orderdate").cast("date").alias("week")).distinct()
        return weeks.select(F.date_format("week", "d/M/yy").alias("week_date"))

    # -- web shop: click stream ---------------------------------------------
    def click(self) -> DataFrame:
        e = self.t("events", "event_id", "ts", "user_id", "event_type", "props")
        code = F.lit(5)
        for name, value in reversed(list(EVENT_CODES.items())):
            code = F.when(F.col("event_type") == name, F.lit(value)).otherwise(code)
        return e.select(
            F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("visit_id"),
            F.col("user_id"),
            self._cookie().alias("cookie_id"),
            # the page number as written; a fractional number is floored, malformed JSON gives NULL
            F.floor(F.get_json_object("props", "$.k").try_cast("double")).cast("bigint").alias("page_id"),
            code.alias("event_type"),
            F.col("ts").alias("event_time"),
            F.col("event_id"),
        )

    @staticmethod
    def _cookie() -> Column:
        """A browser's cookie: a new one every week."""
        return F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd"))

    def users(self) -> DataFrame:
        """Users and their cookies, several a user; a cookie that only ever met
        errors has no user."""
        e = self.t("events", "ts", "user_id", "event_type")
        return (e.filter(F.col("event_type") != "error").groupBy("user_id", self._cookie().alias("cookie_id"))
                .agg(F.min(F.col("ts").cast("date")).alias("start_date")))

    def page_hierarchy(self) -> DataFrame:
        p = self.t("part", "p_partkey", "p_name", "p_type", "p_size")
        product = F.col("p_size") > 5  # small sizes play the non-product pages
        return p.select(
            F.col("p_partkey").alias("page_id"),
            F.col("p_name").alias("page_name"),
            F.when(product, F.col("p_type")).alias("product_category"),
            F.when(product, F.col("p_partkey")).alias("product_id"),
        )

    # -- interests: raw metrics and map (dirty text) ----------------------------
    def interest_metrics(self) -> DataFrame:
        li = self.t("lineitem", "l_partkey", "l_discount", "l_tax", "l_shipdate")
        no_period = F.col("l_tax") == 0
        # MM-yyyy from the parts: a formatter per line costs more than all the rest
        month = F.concat(F.lpad(F.month("l_shipdate").cast("string"), 2, "0"), F.lit("-"), F.year("l_shipdate").cast("string"))
        return li.select(
            F.when(no_period, F.lit("NULL")).otherwise(F.month("l_shipdate").cast("string")).alias("_month"),
            F.when(no_period, F.lit("NULL")).otherwise(F.year("l_shipdate").cast("string")).alias("_year"),
            F.when(no_period, F.lit("NULL")).otherwise(month).alias("month_year"),
            F.when(F.col("l_discount") == 0, F.lit("NULL"))
             .otherwise(F.col("l_partkey").cast("string")).alias("interest_id"),
        )

    def interest_map(self) -> DataFrame:
        p = self.t("part", "p_partkey", "p_name", "p_brand", "p_size")
        # sizes 2-3 appear twice: duplicated rows, as in the source data (one scan, no union)
        copies = F.when(F.col("p_size").between(2, 3), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return p.select("*", F.explode(copies).alias("__copy")).select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("interest_name"),
            F.when(F.col("p_size") <= 10, F.lit("")).otherwise(F.col("p_brand")).alias("interest_summary"),
            F.timestamp_add("DAY", F.col("p_size") * 30,
                           F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")).alias("created_at"),
            F.timestamp_add("DAY", F.col("p_size") * 31,
                           F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")).alias("last_modified"),
        )

    # -- delivery: dirty order tables -------------------------------------------
    def customer_orders(self) -> DataFrame:
        li = self.t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
        ln = F.col("l_linenumber")

        def s(c):
            return F.col(c).cast("string")

        exclusions = (F.when(ln == 1, F.lit(None).cast("string")).when(ln == 2, "").when(ln == 3, "null")
                      .when(ln == 4, " ").when(ln == 5, s("l_suppkey"))
                      .otherwise(F.concat(s("l_suppkey"), F.lit(", "), s("l_linenumber"))))
        extras = (F.when(ln == 1, s("l_partkey")).when(ln == 2, "null")
                  .when(ln == 3, F.concat(s("l_linenumber"), F.lit(","), s("l_suppkey")))
                  .when(ln == 4, F.lit(None).cast("string")).when(ln == 5, "").otherwise("NULL"))
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("l_quantity") < 25, 1).otherwise(2).alias("pizza_id"),
            exclusions.alias("exclusions"),
            extras.alias("extras"),
            _minutes(F.col("o_orderdate"), F.floor(F.col("o_totalprice") / 1000).cast("int")).alias("order_time"),
        )

    def runner_orders(self) -> DataFrame:
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                   "o_totalprice", "o_orderpriority")
        cancelled = F.col("o_orderstatus") == "P"
        digit = _digit("o_orderpriority")
        tenths = F.floor(F.col("o_totalprice") / 2000).cast("bigint")
        whole = F.floor(tenths / 10).cast("bigint")
        km = F.concat(whole.cast("string"), F.lit("."), (tenths % 10).cast("string"))
        mins = F.floor(F.col("o_totalprice") / 10000).cast("bigint").cast("string")
        order_time = _minutes(F.col("o_orderdate"), F.floor(F.col("o_totalprice") / 1000).cast("int"))
        distance = (F.when(cancelled, F.lit("null"))
                    .when(digit == "1", F.concat(km, F.lit("km")))
                    .when(digit == "2", F.concat(km, F.lit(" km")))
                    .when(digit == "3", km)
                    .when(digit == "4", F.concat(whole.cast("string"), F.lit("km")))
                    .otherwise(F.concat(km, F.lit("km"))))
        duration = (F.when(cancelled, F.lit("null"))
                    .when(digit == "1", F.concat(mins, F.lit(" mins")))
                    .when(digit == "2", F.concat(mins, F.lit("minutes")))
                    .when(digit == "3", F.concat(mins, F.lit(" minute")))
                    .when(digit == "4", mins)
                    .otherwise(F.concat(mins, F.lit("mins"))))
        cancellation = (F.when(cancelled & (F.col("o_totalprice") > 250000), F.lit("Customer Cancellation"))
                        .when(cancelled, F.lit("Restaurant Cancellation"))
                        .when(digit == "1", F.lit("null"))
                        .when(digit == "2", F.lit(""))
                        .when(digit == "3", F.lit(" ")))
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("runner_id"),
            F.when(~cancelled, _minutes(order_time, F.floor(F.col("o_totalprice") / 5000).cast("int")))
             .alias("pickup_time"),
            distance.alias("distance"),
            duration.alias("duration"),
            cancellation.alias("cancellation"),
        )

    def runners(self) -> DataFrame:
        c = self.t("customer", "c_custkey", "c_acctbal")
        return c.select(
            F.col("c_custkey").alias("runner_id"),
            F.date_add(F.lit(dt.date(2021, 1, 1)), F.floor(F.col("c_acctbal") / 100).cast("int"))
             .alias("registration_date"),
        )

    def recipes(self) -> DataFrame:
        """Recipes: an order's lines as a comma list of topping ids."""
        li = self.t("lineitem", "l_orderkey", "l_linenumber", "l_partkey")
        lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))  # seven lines an order at most
        return li.groupBy(F.col("l_orderkey").alias("pizza_id")).agg(
            F.array_join(F.transform(lines, lambda x: x["l_partkey"].cast("string")), ", ").alias("toppings"))

    def recipe_names(self) -> DataFrame:
        return self.t("orders", "o_orderkey", "o_orderpriority").select(
            F.col("o_orderkey").alias("pizza_id"), F.col("o_orderpriority").alias("pizza_name"))

    def toppings(self) -> DataFrame:
        return self.t("part", "p_partkey", "p_name").select(
            F.col("p_partkey").alias("topping_id"), F.col("p_name").alias("topping_name"))
