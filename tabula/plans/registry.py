"""Every implemented report, keyed by name, with its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame over the whole
driver tables of ``sf_dir``; ``ORACLE[name]`` is the same question in plain
SQL over the raw tables (role views inlined as CTEs). Output columns are
BIGINT, DOUBLE (rounded where arithmetic order could differ), VARCHAR or DATE
on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.functions import sql_functions
from tabula.plans import bank, basics, clicks, delivery, diner, interests, mart, subscriptions
from tabula.sources.roles import Roles
from tabula.sources.roles_sql import with_roles as W
from tabula.sources.sinks import snapshot
from tabula.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

# Report parameters (dates inside the driver data's 1995-2001 span).
STARTS_AFTER_YEAR = 1998
UPGRADE_FROM, UPGRADE_TO = dt.date(1998, 1, 1), dt.date(1999, 1, 1)
SNAPSHOT_AT = dt.date(1998, 12, 31)
TRANSITION_YEAR = 1998
BASELINE = dt.date(1998, 6, 15)  # a Monday, like the weekly dates
RETAIL, SHOPIFY = "AUTOMOBILE", "BUILDING"
BONUS_CATEGORY = "PROMO"

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
DATE_COLUMNS: dict[str, tuple[str, ...]] = {}
INT_COLUMNS: dict[str, tuple[str, ...]] = {}
#: The order contract of the sorted reports: SQL terms over the output columns.
#: Ascending NULLs come first and descending ones last unless a term says
#: otherwise, as in the source's dialect; the last terms make the order total.
ORDERS: dict[str, tuple[str, ...]] = {}


def order_clause(terms: tuple[str, ...]) -> str:
    """ORDER BY with the place of NULLs written out."""
    return "ORDER BY " + ", ".join(t if " NULLS " in t else f"{t} NULLS LAST" if t.endswith(" DESC") else f"{t} NULLS FIRST" for t in terms)


def query(name: str, sql: str | None, dates: tuple[str, ...] = (), ints: tuple[str, ...] = (), order: tuple[str, ...] = ()):
    """Register a report; ``dates`` names its DATE output columns (the driver
    contract renders them as 'yyyy-MM-dd' text on both sides), ``ints`` its
    32-bit integer columns (widened to BIGINT on both sides) and ``order`` the
    order its rows come in."""
    def deco(fn):
        QUERIES[name] = fn
        if order:
            ORDERS[name] = tuple(order)
        if sql is not None:
            ORACLE[name] = sql
        if dates:
            DATE_COLUMNS[name] = tuple(dates)
        if ints:
            INT_COLUMNS[name] = tuple(ints)
        return fn
    return deco


def R(spark, sf) -> Roles:
    return Roles(spark, sf)


# ---------------------------------------------------------------- restaurant
@query("join_inner_spend", W("""
SELECT s.customer_id, CAST(SUM(m.price) AS DOUBLE) AS total_amount
FROM sale s JOIN menu m ON s.product_id = m.product_id GROUP BY s.customer_id""", "sale", "menu"))
def _(spark, sf):
    r = R(spark, sf)
    return diner.spend_per_customer(r.sale(), r.menu())


@query("visit_days", W("""
SELECT customer_id, COUNT(DISTINCT order_date) AS no_days_visit FROM sale GROUP BY customer_id""", "sale"))
def _(spark, sf):
    return diner.visit_days(R(spark, sf).sale())


@query("count_distinct_multi", W("""
SELECT COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT order_id) AS total_orders,
       COUNT(product_id) AS total_items, COUNT(DISTINCT order_date) AS distinct_days FROM sale""", "sale"))
def _(spark, sf):
    return diner.global_counts(R(spark, sf).sale())


@query("first_item_per_customer", W("""
SELECT DISTINCT d.customer_id, mn.product_name
FROM (SELECT customer_id, product_id, order_date,
             MIN(order_date) OVER (PARTITION BY customer_id) AS first_day FROM sale) d
JOIN menu mn USING (product_id)
WHERE d.order_date = d.first_day""", "sale", "menu"))
def _(spark, sf):
    r = R(spark, sf)
    return diner.first_items(r.sale(), r.menu())


@query("top_k", W("""
SELECT m.product_name, COUNT(*) AS no_buy FROM sale s JOIN menu m ON s.product_id = m.product_id
GROUP BY m.product_name ORDER BY no_buy DESC, product_name ASC NULLS LAST LIMIT 3""", "sale", "menu"),
       order=("no_buy DESC", "product_name ASC NULLS LAST"))
def _(spark, sf):
    r = R(spark, sf)
    return diner.top_items(r.sale(), r.menu(), 3)


@query("rank_top_item", W("""
SELECT t.customer_id, t.product_id, mn.product_name, t.purchase_count
FROM tally t
JOIN (SELECT customer_id, MAX(purchase_count) AS most FROM tally GROUP BY customer_id) b
  ON t.customer_id IS NOT DISTINCT FROM b.customer_id AND t.purchase_count = b.most
JOIN menu mn ON mn.product_id = t.product_id""", "sale", "menu",
  extra={"tally": "SELECT customer_id, product_id, COUNT(product_id) AS purchase_count FROM sale GROUP BY 1, 2"}),
       order=("customer_id", "product_id"))
def _(spark, sf):
    r = R(spark, sf)
    return diner.favourite_items(r.sale(), r.menu())


@query("first_after_event", W("""
SELECT a.customer_id, a.join_date, a.product_id, mn.product_name, a.order_date AS first_purchase_date
FROM (SELECT x.customer_id, mb.join_date, x.product_id, x.order_date,
             MIN(x.order_date) OVER (PARTITION BY x.customer_id) AS earliest
      FROM sale x JOIN member mb USING (customer_id)
      WHERE x.order_date >= mb.join_date) a
JOIN menu mn USING (product_id)
WHERE a.order_date = a.earliest""", "sale", "member", "menu"), dates=('join_date', 'first_purchase_date'))
def _(spark, sf):
    r = R(spark, sf)
    return diner.first_after_joining(r.sale(), r.member(), r.menu())


@query("last_before_event", W("""
SELECT a.customer_id, a.join_date, mn.product_name, a.order_date AS date_before_join
FROM (SELECT x.customer_id, mb.join_date, x.product_id, x.order_date,
             MAX(x.order_date) OVER (PARTITION BY x.customer_id) AS latest
      FROM sale x JOIN member mb USING (customer_id)
      WHERE x.order_date < mb.join_date) a
JOIN menu mn USING (product_id)
WHERE a.order_date = a.latest""", "sale", "member", "menu"), dates=('join_date', 'date_before_join'))
def _(spark, sf):
    r = R(spark, sf)
    return diner.last_before_joining(r.sale(), r.member(), r.menu())


@query("totals_before_event", W("""
SELECT x.customer_id, COUNT(*) AS total_items, CAST(SUM(mn.price) AS DOUBLE) AS total_amount
FROM member mb JOIN sale x ON x.customer_id = mb.customer_id AND x.order_date < mb.join_date
JOIN menu mn ON mn.product_id = x.product_id
GROUP BY x.customer_id""", "sale", "menu", "member"))
def _(spark, sf):
    r = R(spark, sf)
    return diner.totals_before_joining(r.sale(), r.member(), r.menu())


@query("points_case", W(f"""
SELECT customer_id, CAST(SUM(price * 10 * base_factor) AS DOUBLE) AS points_base,
       CAST(SUM(price * 10 * greatest(base_factor, week_factor)) AS DOUBLE) AS points_member
FROM (SELECT x.customer_id, mn.price,
             CASE WHEN mn.category = '{BONUS_CATEGORY}' THEN 2 ELSE 1 END AS base_factor,
             CASE WHEN x.order_date >= mb.join_date AND x.order_date - mb.join_date <= 7 THEN 2 ELSE 1 END
               AS week_factor
      FROM sale x LEFT JOIN menu mn USING (product_id) LEFT JOIN member mb USING (customer_id)) f
GROUP BY customer_id""", "sale", "menu", "member"), order=("points_member DESC", "customer_id"))
def _(spark, sf):
    r = R(spark, sf)
    return diner.loyalty_points(r.sale(), r.menu(), r.member(), BONUS_CATEGORY)


# ------------------------------------------------------------------ delivery
_CO_CLEAN = """
SELECT order_id, line_id, customer_id, pizza_id, order_time,
       CASE WHEN lower(trim(exclusions, ' ')) IN ('', 'null') THEN NULL ELSE exclusions END AS exclusions,
       CASE WHEN lower(trim(extras, ' ')) IN ('', 'null') THEN NULL ELSE extras END AS extras
FROM customer_orders"""
_RO_CLEAN = """
SELECT order_id, runner_id, pickup_time,
       CAST(trim(CASE WHEN instr(d, 'km') = 0 THEN d ELSE substr(d, 1, instr(d, 'km') - 1) END, ' ') AS DECIMAL(12,2))
         AS distance,
       CAST(trim(CASE WHEN instr(u, 'min') = 0 THEN u ELSE substr(u, 1, instr(u, 'min') - 1) END, ' ') AS INTEGER)
         AS duration,
       cancellation
FROM (SELECT order_id, runner_id, pickup_time,
             CASE WHEN lower(trim(distance, ' ')) IN ('', 'null') THEN NULL ELSE distance END AS d,
             CASE WHEN lower(trim(duration, ' ')) IN ('', 'null') THEN NULL ELSE duration END AS u,
             CASE WHEN lower(trim(cancellation, ' ')) IN ('', 'null') THEN NULL ELSE cancellation END AS cancellation
      FROM runner_orders) x"""
_DELIVERY = {"co": _CO_CLEAN, "ro": _RO_CLEAN,
             "dl": "SELECT co.*, ro.runner_id, ro.pickup_time, ro.distance, ro.duration "
                   "FROM co JOIN ro ON co.order_id = ro.order_id WHERE ro.cancellation IS NULL"}


def DW(body: str, *more: str) -> str:
    return W(body, "customer_orders", "runner_orders", *more, extra=_DELIVERY)


def _d(spark, sf):
    r = R(spark, sf)
    return r, r.customer_orders(), r.runner_orders()


@query("update_where", DW("SELECT order_id, line_id, exclusions, extras FROM co"), ints=('line_id',))
def _(spark, sf):
    _, co, _ro = _d(spark, sf)
    return delivery.clean_customer_orders(co).select("order_id", "line_id", "exclusions", "extras")


@query("parse_unit_strings", DW(
    "SELECT order_id, CAST(distance AS DOUBLE) AS distance, CAST(duration AS BIGINT) AS duration FROM ro"))
def _(spark, sf):
    _, _co, ro = _d(spark, sf)
    return delivery.clean_runner_orders(ro).select(
        "order_id", F.col("distance").cast("double").alias("distance"),
        F.col("duration").cast("bigint").alias("duration"))


@query("delivery_counts", DW("""
SELECT COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT order_id) AS total_orders,
       COUNT(pizza_id) AS total_pizza FROM dl"""))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.delivery_counts(co, ro)


@query("runner_deliveries", DW("SELECT runner_id, COUNT(pizza_id) AS num_pizzas FROM dl GROUP BY runner_id"))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.deliveries_per_runner(co, ro)


@query("max_pizzas_per_order", DW(
    "SELECT COUNT(pizza_id) AS max_pizzas FROM dl GROUP BY order_id ORDER BY max_pizzas DESC LIMIT 1"))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.largest_order(co, ro)


@query("change_flags", DW("""
SELECT customer_id,
  COUNT(*) FILTER (WHERE num_changes = 0) AS no_change,
  COUNT(*) FILTER (WHERE num_changes > 0) AS changed,
  COUNT(*) FILTER (WHERE num_changes = 2) AS both_changed
FROM (SELECT customer_id, (extras IS NOT NULL)::INTEGER + (exclusions IS NOT NULL)::INTEGER AS num_changes FROM dl) c
GROUP BY customer_id"""))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.change_flags(co, ro)


@query("pivot_count", DW("""
SELECT customer_id, CAST(COUNT(CASE WHEN dl.pizza_id = 1 THEN 1 END) AS BIGINT) AS meatlovers,
       CAST(COUNT(CASE WHEN dl.pizza_id = 2 THEN 1 END) AS BIGINT) AS vegetarian
FROM dl JOIN pizza_names p ON dl.pizza_id = p.pizza_id GROUP BY customer_id""", "pizza_names"))
def _(spark, sf):
    r, co, ro = _d(spark, sf)
    return delivery.pizzas_per_customer_pivot(co, ro, r.pizza_names())


@query("time_parts", DW("""
SELECT dayname(order_time) AS day_of_week, CAST(hour(order_time) AS BIGINT) AS hour_of_day,
       COUNT(pizza_id) AS num_pizzas FROM dl GROUP BY 1, 2"""))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.volume_by_time(co, ro)


@query("volume_by_hour", DW("""
SELECT CAST(hour(order_time) AS BIGINT) AS hour_of_day, COUNT(pizza_id) AS num_pizzas FROM dl GROUP BY 1"""), order=("hour_of_day",))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.volume_by_hour(co, ro)


@query("volume_by_weekday", DW("SELECT dayname(order_time) AS day_of_week, COUNT(pizza_id) AS num_pizzas FROM dl GROUP BY 1"),
       order=("day_of_week",))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.volume_by_weekday(co, ro)


@query("week_boundary_diff", W("""
SELECT runner_id, registration_date, week_number,
       COUNT(*) OVER (PARTITION BY week_number) AS signups
FROM (SELECT runner_id, registration_date,
             CAST((CAST(date_trunc('week', registration_date + 1) AS DATE)
                   - CAST(date_trunc('week', DATE '2021-01-01' + 1) AS DATE)) // 7 AS BIGINT) AS week_number
      FROM runners) r""", "runners"), dates=('registration_date',))
def _(spark, sf):
    return delivery.signups_per_week(R(spark, sf).runners())


@query("interval_minutes", DW("""
SELECT runner_id,
  CAST(SUM(m) // COUNT(m) AS BIGINT) AS avg_pickup_minute,
  round(AVG(total), 4) AS avg_pickup_total_minutes
FROM (SELECT runner_id, CAST(trunc((epoch(pickup_time) - epoch(order_time)) / 60) AS BIGINT) AS total,
             CAST(((floor((epoch(pickup_time) - epoch(order_time)) / 60) % 60) + 60) % 60 AS BIGINT) AS m
      FROM dl) x
GROUP BY runner_id"""))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.pickup_minutes(co, ro)


@query("average_distance", DW(
    "SELECT customer_id, round(CAST(AVG(distance) AS DOUBLE), 4) AS avg_distance FROM dl GROUP BY customer_id"))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.average_distance(co, ro)


@query("minmax_difference", DW(
    "SELECT CAST(MAX(duration) - MIN(duration) AS BIGINT) AS difference FROM ro WHERE cancellation IS NULL"))
def _(spark, sf):
    _, _co, ro = _d(spark, sf)
    return delivery.duration_spread(ro)


@query("window_avg_speed", DW("""
SELECT runner_id, order_id, CAST(distance AS DOUBLE) AS distance, CAST(duration AS BIGINT) AS duration,
  round(AVG(CAST(distance AS DOUBLE) / NULLIF(duration, 0)) OVER (PARTITION BY runner_id, order_id), 4)
    AS avg_speed
FROM ro WHERE cancellation IS NULL"""), order=("runner_id", "order_id"))
def _(spark, sf):
    _, _co, ro = _d(spark, sf)
    return delivery.speed_per_delivery(ro)


@query("success_rate", DW("""
SELECT runner_id, orders AS num_orders, delivered AS success_order,
       round(delivered * 100.0 / NULLIF(orders, 0), 4) AS success
FROM (SELECT ro.runner_id, COUNT(DISTINCT ro.order_id) AS orders,
             COUNT(*) FILTER (WHERE ro.cancellation IS NULL) AS delivered
      FROM runners rn JOIN ro ON rn.runner_id = ro.runner_id GROUP BY ro.runner_id) t""", "runners"))
def _(spark, sf):
    r, _co, ro = _d(spark, sf)
    return delivery.success_rate(ro, r.runners())


_SPLIT = "UNNEST(string_split({col}, ','))"


@query("split_explode_join", DW(f"""
SELECT 'extra' AS kind, t.topping_name, COUNT(*) AS times
FROM (SELECT TRY_CAST(trim(v, ' ') AS BIGINT) AS id FROM (SELECT {_SPLIT.format(col='extras')} AS v FROM co) a) x
JOIN toppings t ON x.id = t.topping_id GROUP BY t.topping_name
UNION ALL
SELECT 'exclusion' AS kind, t.topping_name, COUNT(*) AS times
FROM (SELECT TRY_CAST(trim(v, ' ') AS BIGINT) AS id FROM (SELECT {_SPLIT.format(col='exclusions')} AS v FROM co) a) x
JOIN toppings t ON x.id = t.topping_id GROUP BY t.topping_name""", "toppings"))
def _(spark, sf):
    r, co, _ro = _d(spark, sf)
    return delivery.topping_counts(co, r.toppings())


def _top_topping_sql(col: str, kind: str) -> str:
    return f"""
SELECT t.topping_name, COUNT(*) AS times
FROM (SELECT TRY_CAST(trim(v, ' ') AS BIGINT) AS id FROM (SELECT {_SPLIT.format(col=col)} AS v FROM co) a) x
JOIN toppings t ON x.id = t.topping_id GROUP BY t.topping_name ORDER BY times DESC, topping_name ASC NULLS LAST LIMIT 1"""


@query("most_common_extra", DW(_top_topping_sql("extras", "extra"), "toppings"))
def _(spark, sf):
    r, co, _ro = _d(spark, sf)
    return delivery.most_common_topping(co, r.toppings(), "extra")


@query("most_common_exclusion", DW(_top_topping_sql("exclusions", "exclusion"), "toppings"))
def _(spark, sf):
    r, co, _ro = _d(spark, sf)
    return delivery.most_common_topping(co, r.toppings(), "exclusion")


@query("string_agg_list", DW(f"""
SELECT order_id, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS toppings
FROM (SELECT order_id, TRY_CAST(trim(v, ' ') AS BIGINT) AS id
      FROM (SELECT order_id, {_SPLIT.format(col='extras')} AS v FROM co) a) x
JOIN toppings t ON x.id = t.topping_id GROUP BY order_id""", "toppings"))
def _(spark, sf):
    r, co, _ro = _d(spark, sf)
    return delivery.extras_per_order(co, r.toppings())


@query("recipe_ingredients", W(f"""
SELECT n.pizza_id, n.pizza_name, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS toppings
FROM recipe_names n
JOIN (SELECT pizza_id, TRY_CAST(trim(v, ' ') AS BIGINT) AS id
      FROM (SELECT pizza_id, {_SPLIT.format(col='toppings')} AS v FROM recipes) a) r ON r.pizza_id = n.pizza_id
JOIN toppings t ON t.topping_id = r.id
GROUP BY n.pizza_id, n.pizza_name""", "recipe_names", "recipes", "toppings"))
def _(spark, sf):
    r = R(spark, sf)
    return delivery.standard_ingredients(r.recipe_names(), r.recipes(), r.toppings())


@query("order_description", DW(f"""
SELECT co.order_id, co.line_id,
  COALESCE(p.pizza_name, '')
  || CASE WHEN co.exclusions IS NOT NULL THEN ' - Exclude ' || COALESCE(e.names, '') ELSE '' END
  || CASE WHEN co.extras IS NOT NULL THEN ' - Extra ' || COALESCE(x.names, '') ELSE '' END AS order_description
FROM co LEFT JOIN pizza_names p ON co.pizza_id = p.pizza_id
LEFT JOIN (SELECT lst, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS names
           FROM (SELECT lst, TRY_CAST(trim(v, ' ') AS BIGINT) AS id
                 FROM (SELECT DISTINCT exclusions AS lst FROM co WHERE exclusions IS NOT NULL) d,
                      LATERAL (SELECT {_SPLIT.format(col='lst')} AS v) s) i
           JOIN toppings t ON i.id = t.topping_id GROUP BY lst) e ON co.exclusions = e.lst
LEFT JOIN (SELECT lst, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS names
           FROM (SELECT lst, TRY_CAST(trim(v, ' ') AS BIGINT) AS id
                 FROM (SELECT DISTINCT extras AS lst FROM co WHERE extras IS NOT NULL) d,
                      LATERAL (SELECT {_SPLIT.format(col='lst')} AS v) s) i
           JOIN toppings t ON i.id = t.topping_id GROUP BY lst) x ON co.extras = x.lst""",
                                  "pizza_names", "toppings"), ints=('line_id',))
def _(spark, sf):
    r, co, _ro = _d(spark, sf)
    return delivery.order_descriptions(co, r.pizza_names(), r.toppings())


@query("tiered_revenue", DW("""
SELECT CAST(SUM(CASE WHEN pizza_id = 1 THEN 12 WHEN pizza_id IS NOT NULL THEN 10 END) AS BIGINT) AS total_sales
FROM dl"""))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.revenue(co, ro)


@query("like_surcharge", DW("""
SELECT CAST(SUM(CASE WHEN pizza_id = 1 THEN 12 WHEN pizza_id IS NOT NULL THEN 10 END
                + (COALESCE(extras, '') LIKE '%4%')::INTEGER) AS BIGINT) AS total_sales FROM dl"""))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.revenue_with_surcharge(co, ro)


@query("net_revenue", DW("""
SELECT ro.order_id, s.sales, CAST(ro.distance AS DOUBLE) AS distance,
       CAST(ro.distance * 0.30 AS DOUBLE) AS shipping_fee, CAST(s.sales - ro.distance * 0.30 AS DOUBLE) AS left_over
FROM ro JOIN (SELECT order_id, CAST(SUM(CASE WHEN pizza_id = 1 THEN 12 WHEN pizza_id IS NOT NULL THEN 10 END)
                                      AS BIGINT) AS sales
              FROM co GROUP BY order_id) s ON ro.order_id = s.order_id
WHERE ro.cancellation IS NULL"""))
def _(spark, sf):
    _, co, ro = _d(spark, sf)
    return delivery.net_revenue(co, ro)


# ------------------------------------------------------------- subscriptions
@query("join_chain", """
SELECT r.r_name AS region_name, COUNT(*) AS n_orders,
       CAST(SUM(CAST(CAST(CAST(round(o.o_totalprice * 100) AS BIGINT) AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)))
            AS DOUBLE) AS total_price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name""")
def _(spark, sf):
    t = Tables(spark, sf)
    return basics.region_revenue(t("orders", "o_custkey", "o_totalprice"), t("customer", "c_custkey", "c_nationkey"),
                                 t("nation", "n_nationkey", "n_regionkey"), t("region", "r_regionkey", "r_name"))


@query("customer_journey", W("""
SELECT s.customer_id, s.plan_id, p.plan_name, CAST(p.price AS DOUBLE) AS price, s.start_date FROM sub s JOIN plans p ON s.plan_id = p.plan_id""",
                             "sub", "plans"), dates=('start_date',), ints=('plan_id',))
def _(spark, sf):
    r = R(spark, sf)
    return subscriptions.journey(r.sub(), r.plans())


@query("subscription_customers", W("SELECT COUNT(DISTINCT customer_id) AS num_customers FROM sub", "sub"))
def _(spark, sf):
    return subscriptions.customers(R(spark, sf).sub())


@query("orders_by_month", W("""
SELECT strftime(date_trunc('month', start_date), '%d/%m/%Y') AS month, COUNT(plan_id) AS num_plans
FROM sub GROUP BY date_trunc('month', start_date)""", "sub"), order=("substr(month, 7, 4)", "substr(month, 4, 2)"))
def _(spark, sf):
    return subscriptions.starts_per_month(R(spark, sf).sub())


@query("filter_compare", W(f"""
SELECT p.plan_name, COUNT(s.plan_id) AS num_plans FROM sub s JOIN plans p ON s.plan_id = p.plan_id
WHERE year(s.start_date) > {STARTS_AFTER_YEAR} GROUP BY p.plan_name""", "sub", "plans"))
def _(spark, sf):
    r = R(spark, sf)
    return subscriptions.starts_after_year(r.sub(), r.plans(), STARTS_AFTER_YEAR)


@query("share_of_total", W("""
SELECT everyone AS num_customers, churned AS num_churn,
       round(churned * 100.0 / NULLIF(everyone, 0), 2) AS percent_churn
FROM (SELECT COUNT(DISTINCT customer_id) AS everyone,
             COUNT(DISTINCT customer_id) FILTER (WHERE plan_id = 4) AS churned FROM sub) t""", "sub"))
def _(spark, sf):
    return subscriptions.churn_share(R(spark, sf).sub())


@query("self_join_gap", W("""
SELECT n AS num_customers, round(n * 100.0 / total, 0) AS percentage
FROM (SELECT COUNT(*) AS n FROM sub a JOIN sub b
        ON b.customer_id = a.customer_id AND b.start_date = CAST(a.start_date + INTERVAL 7 DAY AS DATE)
      WHERE a.plan_id = 0 AND b.plan_id = 4) pairs,
     (SELECT COUNT(DISTINCT customer_id) AS total FROM sub) everyone""", "sub"))
def _(spark, sf):
    return subscriptions.gap_pairs(R(spark, sf).sub(), 0, 4, 7, digits=0)


@query("plans_after_trial", W("""
SELECT n AS num_customers, round(n * 100.0 / total, 2) AS percentage
FROM (SELECT COUNT(*) AS n FROM sub a JOIN sub b
        ON b.customer_id = a.customer_id AND b.start_date = CAST(a.start_date + INTERVAL 7 DAY AS DATE)
      WHERE a.plan_id = 0 AND b.plan_id <> 4) pairs,
     (SELECT COUNT(DISTINCT customer_id) AS total FROM sub) everyone""", "sub"))
def _(spark, sf):
    return subscriptions.gap_pairs(R(spark, sf).sub(), 0, None, 7, exclude_second=4)


@query("avg_days_to_plan", W("""
SELECT round(AVG(gap), 4) AS avg_days_to_annual, CAST(SUM(gap) // NULLIF(COUNT(gap), 0) AS BIGINT)
         AS avg_days_to_annual_int, COUNT(*) AS num_pairs
FROM (SELECT annual.start_date - trial.start_date AS gap
      FROM (SELECT customer_id, start_date FROM sub WHERE plan_id = 0) trial
      JOIN (SELECT customer_id, start_date FROM sub WHERE plan_id = 3) annual USING (customer_id)) g""", "sub"))
def _(spark, sf):
    return subscriptions.days_to_plan(R(spark, sf).sub())


@query("day_bucket_breakdown", W("""
SELECT """ + "CASE " + " ".join(f"WHEN gap BETWEEN {lo} AND {hi} THEN '{label}'" for label, lo, hi in subscriptions.DAY_BANDS) + f" ELSE '{subscriptions.OTHER_BAND}' END" + """ AS break_period,
       round(AVG(gap), 4) AS avg_day_between, CAST(SUM(gap) // NULLIF(COUNT(gap), 0) AS BIGINT) AS avg_day_between_int,
       COUNT(*) AS num_cus
FROM (SELECT annual.start_date - trial.start_date AS gap
      FROM (SELECT customer_id, start_date FROM sub WHERE plan_id = 0) trial
      JOIN (SELECT customer_id, start_date FROM sub WHERE plan_id = 3) annual USING (customer_id)) g
GROUP BY 1""", "sub"), order=("num_cus DESC", "break_period"))
def _(spark, sf):
    return subscriptions.day_bucket_breakdown(R(spark, sf).sub())


@query("filter_between", W(f"""
SELECT COUNT(DISTINCT customer_id) AS num_cus FROM sub
WHERE plan_id = 3 AND start_date BETWEEN DATE '{UPGRADE_FROM}' AND DATE '{UPGRADE_TO}'""", "sub"))
def _(spark, sf):
    return subscriptions.upgrades_between(R(spark, sf).sub(), 3, UPGRADE_FROM, UPGRADE_TO)


@query("lag_transition", W(f"""
SELECT COUNT(DISTINCT a.customer_id) AS num_cus_downgraded
FROM seq a JOIN seq b ON b.customer_id = a.customer_id AND b.k = a.k + 1
WHERE a.plan_id = 2 AND b.plan_id = 1""", "sub", extra={"seq": f"""
SELECT customer_id, plan_id, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY start_date, sub_id) AS k
FROM sub WHERE start_date >= DATE '{TRANSITION_YEAR}-01-01' AND start_date < DATE '{TRANSITION_YEAR + 1}-01-01'"""}))
def _(spark, sf):
    return subscriptions.transitions(R(spark, sf).sub(), 2, 1, TRANSITION_YEAR)


@query("latest_row_per_key", W("""
SELECT customer_id, plan_id, start_date FROM sub
QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY start_date DESC NULLS LAST, sub_id DESC NULLS LAST) = 1""",
                             "sub"), dates=('start_date',), ints=('plan_id',))
def _(spark, sf):
    return subscriptions.latest_plan(R(spark, sf).sub())


@query("plan_snapshot_at_date", W(f"""
SELECT current_plan, COUNT(*) AS plan_num,
       round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS plan_percent
FROM (
  SELECT CAST(CASE
           WHEN cur.plan_id IN (0, 3) THEN cur.plan_id
           WHEN cur.plan_id <> 4 AND prev.plan_id < cur.plan_id THEN cur.plan_id
           WHEN prev.plan_id = 0 AND CAST(prev.start_date + INTERVAL 7 DAY AS DATE) >= DATE '{SNAPSHOT_AT}'
             THEN prev.plan_id
           WHEN prev.plan_id IN (1, 2) AND CAST(prev.start_date + INTERVAL 1 MONTH AS DATE) >= DATE '{SNAPSHOT_AT}'
             THEN prev.plan_id
           WHEN prev.plan_id = 3 AND CAST(prev.start_date + INTERVAL 1 YEAR AS DATE) >= DATE '{SNAPSHOT_AT}'
             THEN prev.plan_id
           WHEN prev.plan_id IN (0, 1, 2, 3) THEN cur.plan_id
         END AS BIGINT) AS current_plan
  FROM ordered cur LEFT JOIN ordered prev ON prev.customer_id = cur.customer_id AND prev.back = 2
  WHERE cur.back = 1) snap
GROUP BY current_plan""", "sub", extra={"ordered": f"""
SELECT customer_id, plan_id, start_date,
       ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY start_date DESC, sub_id DESC) AS back
FROM sub WHERE start_date <= DATE '{SNAPSHOT_AT}'"""}))
def _(spark, sf):
    return subscriptions.plan_snapshot(R(spark, sf).sub(), SNAPSHOT_AT)


@query("sql_plan_function", ORACLE["plan_snapshot_at_date"])
def _(spark, sf):
    return sql_functions.plan_snapshot_sql(spark, R(spark, sf).sub(), str(SNAPSHOT_AT))


@query("insert_values_join", W("""
SELECT c.plan_name, CAST(c.price AS DOUBLE) AS price, COUNT(*) AS num_subs
FROM plans c JOIN sub s ON s.plan_id = c.plan_id GROUP BY c.plan_name, c.price""", "plans", "sub"))
def _(spark, sf):
    r = R(spark, sf)
    return basics.catalogue_starts(spark, r.sub())


# ---------------------------------------------------------------------- bank
@query("count_distinct_by_region", W("""
SELECT r.region_name, COUNT(DISTINCT s.node_id) AS num_nodes, COUNT(DISTINCT s.customer_id) AS num_customers
FROM stay s JOIN regions r ON s.region_id = r.region_id GROUP BY r.region_name""", "stay", "regions"))
def _(spark, sf):
    r = R(spark, sf)
    return bank.nodes_and_customers_by_region(r.stay(), r.regions())


@query("unique_nodes", W("SELECT COUNT(DISTINCT node_id) AS num_nodes FROM stay", "stay"))
def _(spark, sf):
    return bank.unique_nodes(R(spark, sf).stay())


@query("avg_of_avg", W("""
SELECT round(AVG(avg_days), 4) AS avg_days_reallocated,
       CAST(SUM(avg_days_int) // COUNT(avg_days_int) AS BIGINT) AS avg_days_reallocated_int
FROM (SELECT customer_id, AVG(date_diff('day', start_date, end_date)) AS avg_days,
             SUM(date_diff('day', start_date, end_date)) // COUNT(date_diff('day', start_date, end_date)) AS avg_days_int
      FROM stay GROUP BY customer_id) x""", "stay"))
def _(spark, sf):
    return bank.average_of_averages(R(spark, sf).stay())


@query("percentiles_by_group", W("""
SELECT region_id,
  round(quantile_cont(avg_days, 0.5), 4) AS median, round(quantile_cont(avg_days, 0.8), 4) AS p80,
  round(quantile_cont(avg_days, 0.95), 4) AS p95
FROM (SELECT customer_id, region_id, AVG(date_diff('day', start_date, end_date)) AS avg_days
      FROM stay GROUP BY customer_id, region_id) x GROUP BY region_id""", "stay"), ints=('region_id',))
def _(spark, sf):
    return bank.stay_percentiles(R(spark, sf).stay())


@query("percentiles_by_group_int", W("""
SELECT region_id,
  round(quantile_cont(avg_days, 0.5), 4) AS median, round(quantile_cont(avg_days, 0.8), 4) AS p80,
  round(quantile_cont(avg_days, 0.95), 4) AS p95
FROM (SELECT customer_id, region_id, SUM(date_diff('day', start_date, end_date)) // COUNT(date_diff('day', start_date, end_date)) AS avg_days
      FROM stay GROUP BY customer_id, region_id) x GROUP BY region_id""", "stay"), ints=("region_id",))
def _(spark, sf):
    return bank.stay_percentiles(R(spark, sf).stay(), truncate_average=True)


@query("count_by_type", W("""
SELECT txn_type, COUNT(*) AS num_trans, CAST(SUM(txn_amount) AS DOUBLE) AS total_amount
FROM txn GROUP BY txn_type""", "txn"))
def _(spark, sf):
    return bank.by_type(R(spark, sf).txn())


@query("deposit_summary", W("""
SELECT COUNT(*) AS total_deposit_counts, round(CAST(AVG(txn_amount) AS DOUBLE), 4) AS avg_deposit_amounts
FROM txn WHERE txn_type = 'deposit'""", "txn"))
def _(spark, sf):
    return bank.deposit_summary(R(spark, sf).txn())


@query("window_count_filter", W("""
SELECT CAST(y AS BIGINT) AS txn_year, CAST(m AS BIGINT) AS month_transactions, COUNT(*) AS num_cus
FROM (SELECT customer_id, year(txn_date) AS y, month(txn_date) AS m FROM txn
      GROUP BY 1, 2, 3 HAVING COUNT(*) >= 2) busy
GROUP BY y, m""", "txn"), order=("txn_year", "month_transactions"))
def _(spark, sf):
    return bank.busy_customers_per_month(R(spark, sf).txn())


@query("window_count_rows", W("""
SELECT customer_id, txn_id, CAST(year(txn_date) AS BIGINT) AS txn_year, CAST(month(txn_date) AS BIGINT) AS txn_month,
       COUNT(*) OVER (PARTITION BY customer_id, year(txn_date), month(txn_date)) AS num_in_month
FROM txn""", "txn"))
def _(spark, sf):
    out = bank.txn_count_window(R(spark, sf).txn())
    return out.select("customer_id", "txn_id", F.col("txn_year").cast("bigint").alias("txn_year"),
                      F.col("txn_month").cast("bigint").alias("txn_month"), "num_in_month")


_SIGNED = "CASE WHEN txn_type = 'deposit' THEN txn_amount ELSE -txn_amount END"


@query("closing_balance", W(f"""
SELECT customer_id, CAST(y AS BIGINT) AS txn_year, CAST(m AS BIGINT) AS txn_month,
       CAST(SUM(net) OVER (PARTITION BY customer_id ORDER BY y NULLS FIRST, m NULLS FIRST) AS DOUBLE) AS closing_balance
FROM (SELECT customer_id, year(txn_date) AS y, month(txn_date) AS m, SUM({_SIGNED}) AS net
      FROM txn GROUP BY 1, 2, 3) monthly""", "txn"))
def _(spark, sf):
    return bank.monthly_closing(R(spark, sf).txn())


_PIVOT_SQL = f"""
SELECT customer_id, CAST(y AS BIGINT) AS txn_year,
  {", ".join(f"CASE WHEN k.y IS NOT NULL THEN CAST((SELECT SUM({_SIGNED.replace('txn_', 't2.txn_')}) FROM txn t2 WHERE t2.customer_id IS NOT DISTINCT FROM k.customer_id AND (t2.txn_date IS NULL OR t2.txn_date < make_date(k.y, {m}, 1) + INTERVAL 1 MONTH)) AS DOUBLE) END AS month{m}" for m in bank.PIVOT_MONTHS)}
FROM (SELECT DISTINCT customer_id, year(txn_date) AS y FROM txn) k"""


@query("closing_balance_pivot", W(_PIVOT_SQL, "txn"))
def _(spark, sf):
    return bank.closing_balance_pivot(R(spark, sf).txn())


@query("month_ratio", W("""
SELECT customer_id, txn_year,
  round(month2 * 100.0 / NULLIF(month1, 0.0), 2) AS change12, round(month3 * 100.0 / NULLIF(month2, 0.0), 2) AS change23,
  round(month4 * 100.0 / NULLIF(month3, 0.0), 2) AS change34,
  round(month4 * 100.0 / NULLIF(month1, 0.0), 2) AS changeoverall
FROM p""", "txn", extra={"p": _PIVOT_SQL}))
def _(spark, sf):
    return bank.month_ratios(R(spark, sf).txn())


@query("running_balance", W(f"""
SELECT t.customer_id, t.txn_date, t.txn_type, t.txn_id, CAST({_SIGNED.replace('txn_', 't.txn_')} AS DOUBLE) AS impact,
       CAST((SELECT SUM({_SIGNED.replace('txn_', 'u.txn_')}) FROM txn u
             WHERE u.customer_id IS NOT DISTINCT FROM t.customer_id AND (u.txn_date IS NULL OR u.txn_date <= t.txn_date)) AS DOUBLE) AS running_balance
FROM txn t""", "txn"), dates=('txn_date',))
def _(spark, sf):
    return bank.running_balance(R(spark, sf).txn())


@query("running_balance_stats", W(f"""
SELECT customer_id, CAST(year(txn_date) AS BIGINT) AS txn_year, CAST(month(txn_date) AS BIGINT) AS txn_month,
       CAST(arg_max_null(rb, COALESCE(txn_date, DATE '0001-01-01')) AS DOUBLE) AS closing_balance,
       CAST(MAX(rb) AS DOUBLE) AS max_running_balance_in_month, CAST(MIN(rb) AS DOUBLE) AS min_running_balance_in_month,
       round(CAST(AVG(rb) AS DOUBLE), 4) AS avg_running_balance_in_month
FROM (SELECT customer_id, txn_date, SUM({_SIGNED}) OVER (PARTITION BY customer_id ORDER BY txn_date NULLS FIRST
                                   RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rb FROM txn) x
GROUP BY customer_id, year(txn_date), month(txn_date)""", "txn"), order=("customer_id", "txn_year", "txn_month"))
def _(spark, sf):
    return bank.running_balance_stats(R(spark, sf).txn())


@query("sql_balance_function", W(f"""
SELECT customer_id, CAST(m AS BIGINT) AS txn_month,
       CAST((SELECT SUM({_SIGNED.replace('txn_', 'u.txn_')}) FROM txn u
             WHERE u.customer_id = k.customer_id AND month(u.txn_date) <= k.m) AS DOUBLE) AS closing_balance
FROM (SELECT DISTINCT customer_id, month(txn_date) AS m FROM txn) k""", "txn"))
def _(spark, sf):
    return sql_functions.month_end_balances_sql(spark, R(spark, sf).txn())


# -------------------------------------------------------------------- retail
_CLEAN_WEEKLY = """
SELECT w.week_date, CAST(day(CAST(date_trunc('week', w.week_date) AS DATE)) // 7 + 1 AS BIGINT) AS week_number,
  CAST(month(w.week_date) AS BIGINT) AS month_number, CAST(year(w.week_date) AS BIGINT) AS calendar_year,
  w.region, w.platforms,
  CASE WHEN lower(trim(w.segment, ' ')) = 'null' THEN 'unknown' ELSE w.segment END AS segment,
  CASE WHEN lower(trim(w.segment, ' ')) = 'null' THEN 'unknown'
       WHEN right(w.segment, 1) = '1' THEN 'Young Adults' WHEN right(w.segment, 1) = '2' THEN 'Middle Aged' ELSE 'Retirees' END AS age_band,
  CASE WHEN lower(trim(w.segment, ' ')) = 'null' THEN 'unknown'
       WHEN left(w.segment, 1) = 'C' THEN 'Couples' ELSE 'Families' END AS demographic,
  w.customer_type, CAST(w.transactions AS BIGINT) AS transactions, CAST(w.sales AS BIGINT) AS sales,
  CAST(w.sales // NULLIF(w.transactions, 0) AS BIGINT) AS avg_transaction
FROM (SELECT make_date(CASE WHEN yy < 50 THEN yy + 2000 ELSE yy + 1900 END, mm, dd) AS week_date, *
      FROM (SELECT CAST(string_split(week_date, '/')[1] AS INTEGER) AS dd,
                   CAST(string_split(week_date, '/')[2] AS INTEGER) AS mm,
                   CAST(string_split(week_date, '/')[3] AS INTEGER) AS yy,
                   region, platforms, segment, customer_type, transactions, sales
            FROM weekly_sales) parts) w"""


def MW(body: str) -> str:
    return W(body, "weekly_sales", extra={"cw": _CLEAN_WEEKLY})


def _cw(spark, sf):
    return mart.clean_weekly_sales(R(spark, sf).weekly_sales())


@query("clean_weekly_sales", MW("SELECT * FROM cw"), dates=('week_date',))
def _(spark, sf):
    return _cw(spark, sf)


@query("insert_clean_weekly_sales", MW("SELECT * FROM cw"), dates=("week_date",))
def _(spark, sf):
    return mart.written_weekly_sales(spark, _cw(spark, sf))


@query("replace_named_table", MW("""
SELECT calendar_year, region, SUM(sales)::BIGINT AS total_sales FROM cw GROUP BY calendar_year, region"""))
def _(spark, sf):
    return mart.replaced_totals(spark, _cw(spark, sf))


_PARSE_WEEKLY = """
SELECT week_date AS text, make_date(CASE WHEN yy < 50 THEN yy + 2000 ELSE yy + 1900 END, mm, dd) AS parsed
FROM (SELECT week_date, CAST(string_split(week_date, '/')[1] AS INTEGER) AS dd, CAST(string_split(week_date, '/')[2] AS INTEGER) AS mm,
             CAST(string_split(week_date, '/')[3] AS INTEGER) AS yy
      FROM week_texts WHERE week_date IS NOT NULL) parts"""
_PARSE_MONTHS = """
SELECT DISTINCT month_year AS text, CAST(strptime('01-' || month_year, '%d-%m-%Y') AS DATE) AS parsed
FROM interest_metrics WHERE lower(trim(month_year, ' ')) <> 'null'"""


@query("parse_dates", W("SELECT * FROM pw UNION ALL SELECT * FROM pm", "week_texts", "interest_metrics",
                        extra={"pw": _PARSE_WEEKLY, "pm": _PARSE_MONTHS}),
       dates=("parsed",))
def _(spark, sf):
    r = R(spark, sf)
    return mart.parsed_week_dates(r.week_texts()).unionByName(
        interests.parsed_month_years(r.interest_metrics()))


@query("transactions_by_year", MW(
    "SELECT calendar_year, SUM(transactions)::BIGINT AS total_transactions FROM cw GROUP BY calendar_year"))
def _(spark, sf):
    return mart.transactions_by_year(_cw(spark, sf))


@query("sales_by_region_month", MW("""
SELECT region, calendar_year, month_number, SUM(sales)::BIGINT AS total_sales FROM cw
GROUP BY region, calendar_year, month_number"""), order=("region", "calendar_year", "month_number"))
def _(spark, sf):
    return mart.sales_by_region_month(_cw(spark, sf))


@query("transactions_by_platform", MW("SELECT platforms, SUM(transactions)::BIGINT AS total FROM cw GROUP BY platforms"))
def _(spark, sf):
    return mart.transactions_by_platform(_cw(spark, sf))


@query("channel_ratio", MW(f"""
SELECT calendar_year, month_number,
       round(SUM(sales) FILTER (WHERE platforms = '{RETAIL}') * 1.0
             / NULLIF(SUM(sales) FILTER (WHERE platforms = '{SHOPIFY}'), 0), 4) AS ratio
FROM cw GROUP BY calendar_year, month_number"""), order=("calendar_year", "month_number"))
def _(spark, sf):
    return mart.channel_ratio(_cw(spark, sf), RETAIL, SHOPIFY)


@query("yearly_share", MW("""
SELECT calendar_year, demographic, total_sales, total_of_year,
       round(total_sales * 100.0 / NULLIF(total_of_year, 0), 2) AS percent_by_demographic
FROM (SELECT calendar_year, demographic, SUM(sales)::BIGINT AS total_sales,
             (SUM(SUM(sales)) OVER (PARTITION BY calendar_year))::BIGINT AS total_of_year
      FROM cw GROUP BY calendar_year, demographic) y"""), order=("calendar_year", "demographic"))
def _(spark, sf):
    return mart.yearly_share(_cw(spark, sf))


@query("segment_bands", MW(f"""
SELECT age_band, demographic, SUM(sales)::BIGINT AS sales FROM cw
WHERE platforms = '{RETAIL}' AND age_band <> 'unknown' GROUP BY age_band, demographic"""))
def _(spark, sf):
    return mart.top_bands(_cw(spark, sf), RETAIL)


@query("integer_division", MW("""
SELECT calendar_year, platforms,
       CAST(SUM(sales // NULLIF(transactions, 0)) // COUNT(sales // NULLIF(transactions, 0)) AS BIGINT) AS avg_transaction_size,
       round(AVG(sales // NULLIF(transactions, 0)), 4) AS avg_transaction_size_exact
FROM cw GROUP BY calendar_year, platforms"""))
def _(spark, sf):
    return mart.average_transaction_size(_cw(spark, sf))


def _period_sql(weeks: int) -> str:
    b = f"DATE '{BASELINE}'"
    lo, hi = f"CAST({b} - INTERVAL {7 * weeks} DAY AS DATE)", f"CAST({b} + INTERVAL {7 * weeks} DAY AS DATE)"
    return f"""
SELECT 'Before' AS period, SUM(sales)::BIGINT AS total_sales FROM cw WHERE week_date >= {lo} AND week_date < {b}
HAVING COUNT(*) > 0
UNION ALL
SELECT 'After' AS period, SUM(sales)::BIGINT AS total_sales FROM cw WHERE week_date >= {b} AND week_date <= {hi}
HAVING COUNT(*) > 0"""


@query("before_after_totals", MW(_period_sql(4)))
def _(spark, sf):
    return mart.before_after_totals(_cw(spark, sf), BASELINE, 4)


@query("before_after_change", MW(" UNION ALL ".join(f"""
SELECT CAST({w} AS BIGINT) AS weeks, b AS before_sales, a AS after_sales, a - b AS sales_difference,
       round((a - b) * 100.0 / NULLIF(b, 0), 4) AS sales_percentage_change
FROM (SELECT ANY_VALUE(total_sales) FILTER (WHERE period = 'Before') AS b,
             ANY_VALUE(total_sales) FILTER (WHERE period = 'After') AS a FROM ({_period_sql(w)}) p) q"""
                                                    for w in (4, 12))))
def _(spark, sf):
    return mart.before_after_change(_cw(spark, sf), BASELINE, (4, 12))


@query("before_after_by_year", MW(f"""
SELECT y.calendar_year,
  (SELECT SUM(sales) FROM cw WHERE week_date >= CAST(make_date(CAST(y.calendar_year AS INTEGER), {BASELINE.month},
          {BASELINE.day}) - INTERVAL 28 DAY AS DATE)
     AND week_date < make_date(CAST(y.calendar_year AS INTEGER), {BASELINE.month}, {BASELINE.day}))::BIGINT AS before,
  (SELECT SUM(sales) FROM cw WHERE week_date >= make_date(CAST(y.calendar_year AS INTEGER), {BASELINE.month},
          {BASELINE.day})
     AND week_date <= CAST(make_date(CAST(y.calendar_year AS INTEGER), {BASELINE.month}, {BASELINE.day})
          + INTERVAL 28 DAY AS DATE))::BIGINT AS after
FROM (SELECT DISTINCT calendar_year FROM cw) y"""), order=("calendar_year",))
def _(spark, sf):
    return mart.before_after_by_year(_cw(spark, sf), BASELINE.month, BASELINE.day, 4)


@query("sql_sales_functions", ORACLE["before_after_by_year"], order=("calendar_year",))
def _(spark, sf):
    return sql_functions.sales_by_year_sql(spark, _cw(spark, sf), 4, f"-{BASELINE.month:02d}-{BASELINE.day:02d}")


# ------------------------------------------------------------------ web shop
def CW(body: str, *more: str) -> str:
    return W(body, "click", *more)


def _c(spark, sf):
    r = R(spark, sf)
    return r, r.click()


@query("user_summary", CW("""
SELECT COUNT(*) AS num_user, round(AVG(n), 4) AS avg_events_per_user,
       CAST(SUM(n) // COUNT(n) AS BIGINT) AS avg_events_per_user_int
FROM (SELECT user_id, COUNT(*) AS n FROM click WHERE user_id IS NOT NULL GROUP BY user_id) x"""))
def _(spark, sf):
    return clicks.user_summary(_c(spark, sf)[1])


@query("cookies_per_user", CW("""
SELECT (SELECT COUNT(DISTINCT user_id) FROM users) AS num_user, round(AVG(n), 4) AS avg_num_cookies,
       CAST(SUM(n) // COUNT(n) AS BIGINT) AS avg_num_cookies_int, round(AVG(cookies), 4) AS avg_distinct_cookies
FROM (SELECT u.user_id, COUNT(e.cookie_id) AS n, COUNT(DISTINCT e.cookie_id) AS cookies
      FROM click e JOIN users u ON e.cookie_id = u.cookie_id GROUP BY u.user_id) x""", "users"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.cookies_per_user(c, r.users())


@query("visits_of_users", CW("""
SELECT e.visit_id, u.user_id, strftime(MIN(e.event_time), '%Y-%m-%d %H:%M:%S.%f') AS visit_start_time,
       COUNT(*) FILTER (WHERE e.event_type = 1) AS page_views, COUNT(*) FILTER (WHERE e.event_type = 2) AS cart_adds
FROM click e JOIN page_hierarchy p ON e.page_id = p.page_id JOIN users u ON u.cookie_id = e.cookie_id
GROUP BY e.visit_id, u.user_id""", "users", "page_hierarchy"), order=("user_id", "visit_id"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.visits_of_users(c, r.page_hierarchy(), r.users())


@query("visits_by_month", CW("""
SELECT CAST(year(event_time) AS BIGINT) AS event_year, CAST(month(event_time) AS BIGINT) AS event_month,
       COUNT(DISTINCT visit_id) AS unique_num_visits
FROM click GROUP BY 1, 2 ORDER BY 1, 2"""), order=("event_year", "event_month"))
def _(spark, sf):
    return clicks.visits_by_month(_c(spark, sf)[1])


@query("events_by_name", CW("""
SELECT i.event_name, COUNT(*) AS num_events FROM click e JOIN event_names i ON e.event_type = i.event_type
GROUP BY i.event_name""", "event_names"), order=("num_events DESC", "event_name"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.events_by_name(c, r.event_names())


@query("visit_purchase_share", CW("""
SELECT visits AS total_visits, buying AS purchased, round(buying * 100.0 / NULLIF(visits, 0), 4) AS percent_purchase
FROM (SELECT COUNT(DISTINCT visit_id) AS visits,
             COUNT(DISTINCT visit_id) FILTER (WHERE event_type = 3) AS buying FROM click) t"""))
def _(spark, sf):
    return clicks.purchase_share(_c(spark, sf)[1])


@query("anti_join_not_in", CW("""
SELECT v.visits AS total_visits, w.n AS checkout_without_purchase,
       round(w.n * 100.0 / NULLIF(v.visits, 0), 4) AS percent_checkout_without_purchase
FROM (SELECT COUNT(DISTINCT visit_id) AS visits FROM click) v,
     (SELECT COUNT(DISTINCT ck.visit_id) AS n FROM click ck
      WHERE ck.page_id = 12 AND ck.visit_id NOT IN (SELECT pu.visit_id FROM click pu WHERE pu.event_type = 3)) w"""))
def _(spark, sf):
    return clicks.checkout_without_purchase(_c(spark, sf)[1], 12)


@query("top_pages", CW("""
SELECT p.page_name, COUNT(*) AS page_views FROM click e JOIN page_hierarchy p ON e.page_id = p.page_id
WHERE e.event_type = 1 GROUP BY p.page_name ORDER BY page_views DESC, page_name ASC NULLS LAST LIMIT 3""", "page_hierarchy"),
       order=("page_views DESC", "page_name ASC NULLS LAST"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.top_pages(c, r.page_hierarchy(), 3)


@query("semi_join_in", CW("""
SELECT pg.page_name, COUNT(*) AS num_purchased
FROM click ev JOIN page_hierarchy pg ON pg.page_id = ev.page_id
WHERE ev.event_type = 2 AND EXISTS (SELECT 1 FROM click pu WHERE pu.visit_id = ev.visit_id AND pu.event_type = 3)
GROUP BY pg.page_name""", "page_hierarchy"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.cart_adds_in_purchase_visits(c, r.page_hierarchy())


@query("top_purchased_products", CW("""
SELECT pg.page_name, COUNT(*) AS num_purchased
FROM click ev JOIN page_hierarchy pg ON pg.page_id = ev.page_id
WHERE ev.event_type = 2 AND EXISTS (SELECT 1 FROM click pu WHERE pu.visit_id = ev.visit_id AND pu.event_type = 3)
GROUP BY pg.page_name ORDER BY num_purchased DESC, page_name ASC NULLS LAST LIMIT 3""", "page_hierarchy"),
       order=("num_purchased DESC", "page_name ASC NULLS LAST"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.top_purchased_products(c, r.page_hierarchy(), 3)


@query("category_views", CW("""
SELECT pg.product_category, COUNT(*) FILTER (WHERE ev.event_type = 1) AS page_views,
       COUNT(*) FILTER (WHERE ev.event_type = 2) AS add_carts
FROM page_hierarchy pg JOIN click ev ON ev.page_id = pg.page_id
WHERE pg.product_category IS NOT NULL GROUP BY pg.product_category""", "page_hierarchy"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.category_views(c, r.page_hierarchy())


_FUNNEL = """
SELECT pg.page_id, pg.page_name, pg.product_category,
       COUNT(*) FILTER (WHERE ev.event_type = 1) AS viewed,
       COUNT(*) FILTER (WHERE ev.event_type = 2) AS added_to_cart,
       COUNT(*) FILTER (WHERE ev.event_type = 2
                          AND ev.visit_id NOT IN (SELECT pu.visit_id FROM click pu WHERE pu.event_type = 3))
         AS abandoned,
       COUNT(*) FILTER (WHERE ev.event_type = 2
                          AND ev.visit_id IN (SELECT pu.visit_id FROM click pu WHERE pu.event_type = 3))
         AS purchased
FROM page_hierarchy pg JOIN click ev ON ev.page_id = pg.page_id
WHERE pg.product_category IS NOT NULL
GROUP BY pg.page_id, pg.page_name, pg.product_category"""
_RATES = """round(purchased * 100.0 / NULLIF(viewed, 0), 4) AS viewed_to_purchased,
  round(added_to_cart * 100.0 / NULLIF(viewed, 0), 4) AS conversion_rate_add_cart,
  round(purchased * 100.0 / NULLIF(added_to_cart, 0), 4) AS conversion_purchase"""


@query("product_funnel", W("SELECT * FROM f", "click", "page_hierarchy", extra={"f": _FUNNEL}), order=("purchased DESC", "page_id"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.product_funnel(c, r.page_hierarchy())


@query("product_funnel_rates", W(
    f"SELECT page_id, page_name, viewed, added_to_cart, abandoned, purchased, {_RATES} "
    "FROM f ORDER BY 8 DESC, 7 DESC, 6 DESC", "click", "page_hierarchy", extra={"f": _FUNNEL}),
       order=("conversion_rate_add_cart DESC", "viewed_to_purchased DESC", "purchased DESC", "page_id"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.product_funnel_rates(c, r.page_hierarchy())


@query("category_funnel", W(f"SELECT *, {_RATES} FROM g", "click", "page_hierarchy", extra={
    "f": _FUNNEL,
    "g": "SELECT product_category, SUM(viewed)::BIGINT AS viewed, SUM(added_to_cart)::BIGINT AS added_to_cart, "
         "SUM(abandoned)::BIGINT AS abandoned, SUM(purchased)::BIGINT AS purchased FROM f GROUP BY product_category"}))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.category_funnel(c, r.page_hierarchy())


_VISIT_STATS = """
WITH seen AS (SELECT ev.visit_id, ev.user_id, MIN(ev.event_time) AS began
              FROM click ev JOIN page_hierarchy pg ON ev.page_id = pg.page_id GROUP BY 1, 2),
     tallies AS (SELECT visit_id,
                        COUNT(*) FILTER (WHERE event_type = 1) AS page_views,
                        COUNT(*) FILTER (WHERE event_type = 2) AS cart_adds,
                        CAST(MAX(CASE WHEN event_type = 3 THEN 1 ELSE 0 END) AS BIGINT) AS purchase,
                        COUNT(*) FILTER (WHERE event_type = 4) AS impression,
                        COUNT(*) FILTER (WHERE event_type = 5) AS click
                 FROM click GROUP BY visit_id),
     carts AS (SELECT ev.visit_id, string_agg(pg.page_name, ', ' ORDER BY ev.event_time, ev.event_id) AS cart_products
               FROM click ev JOIN page_hierarchy pg ON ev.page_id = pg.page_id
               WHERE ev.event_type = 2 AND pg.product_id IS NOT NULL GROUP BY ev.visit_id)
SELECT seen.visit_id, seen.user_id, strftime(seen.began, '%Y-%m-%d %H:%M:%S.%f') AS visit_start_time,
       t.page_views, t.cart_adds, t.purchase, cal.campaign_name, t.impression, t.click, carts.cart_products
FROM seen JOIN tallies t USING (visit_id)
LEFT JOIN campaigns cal ON seen.began BETWEEN cal.start_date AND cal.end_date
LEFT JOIN carts USING (visit_id)"""


def SW(body: str) -> str:
    return W(body, "click", "page_hierarchy", "campaigns", extra={"campaign_stats": _VISIT_STATS})


def _stats(spark, sf):
    r, c = _c(spark, sf)
    return clicks.visit_counts(c, r.page_hierarchy(), r.campaigns())


@query("campaign_range_join", CW("""
SELECT v.visit_id, v.user_id, strftime(v.s, '%Y-%m-%d %H:%M:%S.%f') AS visit_start_time, c.campaign_name
FROM (SELECT visit_id, user_id, MIN(event_time) AS s FROM click GROUP BY visit_id, user_id) v
LEFT JOIN campaigns c ON v.s BETWEEN c.start_date AND c.end_date""", "campaigns"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.campaign_of_visit(c, r.campaigns())


@query("visit_stats", SW("SELECT * FROM campaign_stats"), order=("user_id", "visit_id"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.visit_stats(c, r.page_hierarchy(), r.campaigns())


@query("materialize_visit_stats", SW("SELECT * FROM campaign_stats"))
def _(spark, sf):
    r, c = _c(spark, sf)
    return clicks.materialized_visit_stats(spark, c, r.page_hierarchy(), r.campaigns())


_PURCHASE_RATE = "purchase * 100.0 / NULLIF(page_views, 0)"


@query("campaign_effect", SW(f"""
SELECT impression, SUM(page_views)::BIGINT AS viewed, SUM(cart_adds)::BIGINT AS cart_adds,
       SUM(purchase)::BIGINT AS purchase, round(AVG({_PURCHASE_RATE}), 4) AS purchased_rate
FROM campaign_stats WHERE campaign_name IS NOT NULL GROUP BY impression"""))
def _(spark, sf):
    return clicks.campaign_effect(_stats(spark, sf), ("impression",))


@query("campaign_effect_click", SW(f"""
SELECT impression, click, SUM(page_views)::BIGINT AS viewed, SUM(cart_adds)::BIGINT AS cart_adds,
       SUM(purchase)::BIGINT AS purchase, round(AVG({_PURCHASE_RATE}), 4) AS purchased_rate
FROM campaign_stats WHERE campaign_name IS NOT NULL GROUP BY impression, click"""))
def _(spark, sf):
    return clicks.campaign_effect(_stats(spark, sf), ("impression", "click"))


@query("campaign_summary", SW(f"""
SELECT campaign_name,
  round(COUNT(DISTINCT user_id) * 100.0 / NULLIF(ANY_VALUE(everyone.n), 0), 4) AS impressed_users,
  SUM(page_views)::BIGINT AS page_views, SUM(cart_adds)::BIGINT AS card_adds, SUM(purchase)::BIGINT AS purchased,
  SUM(impression)::BIGINT AS impression, SUM(click)::BIGINT AS click,
  round(SUM(click) * 100.0 / NULLIF(SUM(impression), 0), 4) AS click_rate,
  round(AVG({_PURCHASE_RATE}), 4) AS purchased_rate
FROM campaign_stats, (SELECT COUNT(DISTINCT user_id) AS n FROM campaign_stats) everyone
WHERE impression = 1 AND campaign_name IS NOT NULL GROUP BY campaign_name"""), order=("campaign_name",))
def _(spark, sf):
    return clicks.campaign_summary(_stats(spark, sf), 1)


# ----------------------------------------------------------------- interests
_METRICS = """
SELECT CAST(CASE WHEN lower(trim(_month, ' ')) <> 'null' THEN _month END AS INTEGER) AS _month,
       CAST(CASE WHEN lower(trim(_year, ' ')) <> 'null' THEN _year END AS INTEGER) AS _year,
       CAST(strptime('01-' || CASE WHEN lower(trim(month_year, ' ')) <> 'null' THEN month_year END, '%d-%m-%Y') AS DATE)
         AS month_year,
       CAST(CASE WHEN lower(trim(interest_id, ' ')) <> 'null' THEN interest_id END AS BIGINT) AS interest_id
FROM interest_metrics"""
_CLEAN_MAP = """
SELECT DISTINCT id, interest_name, CASE WHEN trim(interest_summary, ' ') = '' THEN NULL ELSE interest_summary END
  AS interest_summary, created_at, last_modified FROM interest_map"""
_KEPT = "SELECT * FROM m WHERE NOT (month_year IS NULL OR interest_id IS NULL)"


def IW(body: str, **more: str) -> str:
    return W(body, "interest_metrics", "interest_map",
             extra={"m": _METRICS, "cm": _CLEAN_MAP, "k": _KEPT, **more})


def _im(spark, sf):
    r = R(spark, sf)
    return r, interests.typed_metrics(r.interest_metrics())


def _kept(spark, sf):
    r = R(spark, sf)
    return r, interests.kept_metrics(r.interest_metrics())


@query("nulls_first_counts", IW("SELECT month_year, COUNT(*) AS counts FROM m GROUP BY month_year"), dates=('month_year',), order=("month_year",))
def _(spark, sf):
    return interests.counts_per_month(_im(spark, sf)[1])


@query("null_interest_rows", IW(
    "SELECT CAST(_month AS BIGINT) AS _month, CAST(_year AS BIGINT) AS _year, month_year FROM m WHERE interest_id IS NULL"),
       dates=("month_year",))
def _(spark, sf):
    m = _im(spark, sf)[1]
    return interests.rows_without_interest(m).select(
        F.col("_month").cast("bigint").alias("_month"), F.col("_year").cast("bigint").alias("_year"), "month_year")


@query("delete_null_keys", IW("SELECT interest_id, month_year FROM k"), dates=('month_year',))
def _(spark, sf):
    return _kept(spark, sf)[1].select("interest_id", "month_year")


@query("anti_join_orphans", IW("""
SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT interest_id AS i FROM k) a
         WHERE NOT EXISTS (SELECT 1 FROM interest_map mp WHERE mp.id = a.i)) AS metric_not_in_map,
       (SELECT COUNT(*) FROM (SELECT DISTINCT id AS i FROM interest_map WHERE id IS NOT NULL) b
         WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.interest_id = b.i)) AS map_not_in_metric"""))
def _(spark, sf):
    r, k = _kept(spark, sf)
    return interests.orphan_counts(k, r.interest_map())


@query("duplicate_check", "SELECT l_orderkey, l_linenumber, COUNT(*) AS counts FROM lineitem GROUP BY 1, 2", ints=('l_linenumber',))
def _(spark, sf):
    return basics.line_duplicates(Tables(spark, sf)("lineitem", "l_orderkey", "l_linenumber"))


@query("map_duplicate_check", IW("SELECT id, COUNT(*) AS counts FROM interest_map GROUP BY id"))
def _(spark, sf):
    return interests.duplicate_check(R(spark, sf).interest_map(), ["id"])


@query("update_where_map", IW("""
SELECT id, interest_name, CASE WHEN trim(interest_summary, ' ') = '' THEN NULL ELSE interest_summary END AS interest_summary
FROM interest_map"""))
def _(spark, sf):
    return interests.clean_map(R(spark, sf).interest_map()).select("id", "interest_name", "interest_summary")


@query("distinct_rows", IW("""
SELECT id, interest_name, interest_summary, CAST(created_at AS VARCHAR) AS created_at,
       CAST(last_modified AS VARCHAR) AS last_modified FROM cm"""))
def _(spark, sf):
    d = interests.distinct_map(R(spark, sf).interest_map())
    return d.select("id", "interest_name", "interest_summary",
                    F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                    F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss").alias("last_modified"))


_INVALID = """
SELECT k.* FROM k
LEFT JOIN (SELECT DISTINCT v.interest_id, v.month_year
           FROM k v JOIN cm ON cm.id = v.interest_id
           WHERE v.month_year < CAST(cm.created_at AS DATE)) bad
  ON bad.interest_id = k.interest_id AND bad.month_year = k.month_year
WHERE bad.interest_id IS NULL"""


@query("delete_invalid_rows", IW(f"SELECT interest_id, month_year FROM ({_INVALID}) x"), dates=('month_year',))
def _(spark, sf):
    r, k = _kept(spark, sf)
    return interests.drop_invalid(k, interests.distinct_map(r.interest_map())).select("interest_id", "month_year")


@query("snapshot_copy", IW("SELECT interest_id, month_year FROM k"), dates=('month_year',))
def _(spark, sf):
    _, k = _kept(spark, sf)
    return snapshot(spark, k, "interest_metrics").select("interest_id", "month_year")


@query("relational_division", IW("""
SELECT DISTINCT ids.interest_id, cm.interest_name
FROM (SELECT DISTINCT interest_id FROM k) ids JOIN cm ON cm.id = ids.interest_id
WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT month_year FROM k) mo
                  WHERE NOT EXISTS (SELECT 1 FROM k hit
                                    WHERE hit.interest_id = ids.interest_id AND hit.month_year = mo.month_year))"""))
def _(spark, sf):
    r, k = _kept(spark, sf)
    return interests.present_in_all_months(k, interests.distinct_map(r.interest_map()))


@query("relational_division_months", IW("""
SELECT DISTINCT ids.interest_id, cm.interest_name
FROM (SELECT DISTINCT interest_id FROM k) ids JOIN cm ON cm.id = ids.interest_id
WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT _month FROM k) mo
                  WHERE NOT EXISTS (SELECT 1 FROM k hit
                                    WHERE hit.interest_id = ids.interest_id AND hit._month = mo._month))"""))
def _(spark, sf):
    r, k = _kept(spark, sf)
    return interests.present_in_all_months(k, interests.distinct_map(r.interest_map()), "_month")


_MONTH_COUNTS = """
SELECT CAST(months AS BIGINT) AS total_months, COUNT(*) AS number_of_ids
FROM (SELECT interest_id, COUNT(DISTINCT month_year) AS months FROM k
      WHERE interest_id IS NOT NULL GROUP BY interest_id) per_id
GROUP BY months"""


@query("cumulative_share", IW("""
SELECT g.total_months, g.number_of_ids,
       CAST((100 * (SELECT SUM(h.number_of_ids) FROM g h WHERE h.total_months >= g.total_months))
            // (SELECT SUM(number_of_ids) FROM g) AS BIGINT) AS cumulative_percentage
FROM g
WHERE 100 * (SELECT SUM(h.number_of_ids) FROM g h WHERE h.total_months >= g.total_months)
      // (SELECT SUM(number_of_ids) FROM g) >= 90""", g=_MONTH_COUNTS))
def _(spark, sf):
    return interests.cumulative_share(_kept(spark, sf)[1], 90)


@query("exists_rare_keys", IW("""
SELECT COUNT(*) AS rows_removed
FROM k JOIN (SELECT interest_id FROM k GROUP BY interest_id HAVING COUNT(DISTINCT month_year) < 6) rare
  USING (interest_id)"""))
def _(spark, sf):
    return interests.rows_of_rare_ids(_kept(spark, sf)[1], 6)


# ------------------------------------------------------------------- basics
@query("scan_project", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net_price FROM lineitem""", ints=('l_linenumber',))
def _(spark, sf):
    return basics.project_net_price(Tables(spark, sf)("lineitem", "l_orderkey", "l_linenumber",
                                                      "l_extendedprice", "l_discount"))


@query("date_arith", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 7 DAY AS DATE) AS plus_7d,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 7 DAY AS DATE) AS plus_1w,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS plus_1m,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR AS DATE) AS plus_1y
FROM orders""", dates=('order_date', 'plus_7d', 'plus_1w', 'plus_1m', 'plus_1y'))
def _(spark, sf):
    return basics.date_arithmetic(Tables(spark, sf)("orders", "o_orderkey", "o_orderdate"))


@query("corr_counts", """
SELECT p_partkey, (SELECT COUNT(*) FROM lineitem WHERE l_partkey = p_partkey) AS n_lines FROM part""")
def _(spark, sf):
    t = Tables(spark, sf)
    return basics.lines_per_part(t("part", "p_partkey"), t("lineitem", "l_partkey"))
