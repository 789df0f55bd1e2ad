"""Delivery-service reports over dirty order tables.

Cleaning first turns the text columns into typed values once (the source
keeps re-casting text); every metric then runs on the clean frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.functions.cleaning import normalize_nulls, parse_quantity, split_ids
from tabula.functions.dates import minute_component, sunday_weeks_between, whole_minutes_between
from tabula.operators.aggregates import window_aggregate
from tabula.operators.joins import heavy_join


def string_agg_sorted(col: str, sep: str = ", "):
    """STRING_AGG(col, sep) ordered by the value: NULLs skipped, NULL when
    the group has no value (an empty list joins to NULL, not '')."""
    values = F.array_sort(F.collect_list(col))
    return F.when(F.size(values) > 0, F.array_join(values, sep))

# Price per pizza type, extra-topping surcharge, rate per km.
PIZZA_PRICE = {1: 12, 2: 10}
EXTRA_CHARGE = 1
RUNNER_RATE_PER_KM = "0.30"


def clean_customer_orders(customer_orders: DataFrame) -> DataFrame:
    """Blank / 'null' spellings in the list columns become NULL."""
    return normalize_nulls(customer_orders, "exclusions", "extras")


def clean_runner_orders(runner_orders: DataFrame) -> DataFrame:
    """Distance and duration parsed from unit strings; cancellation nulls unified."""
    return (normalize_nulls(runner_orders, "cancellation")
            .withColumn("distance", parse_quantity("distance", "km", "decimal(12,2)"))
            .withColumn("duration", parse_quantity("duration", "min", "int")))


def delivered(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Pizza rows of orders that were not cancelled."""
    co = clean_customer_orders(customer_orders)
    ro = clean_runner_orders(runner_orders).filter(F.col("cancellation").isNull())
    return co.join(ro, "order_id")


def _price(pizza):
    """Price of one pizza; NULL for a NULL pizza id, which then adds nothing
    (the source multiplies COUNT(pizza_id), which skips NULLs)."""
    return F.when(pizza == 1, F.lit(PIZZA_PRICE[1])).when(pizza.isNotNull(), F.lit(PIZZA_PRICE[2]))


def delivery_counts(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    d = delivered(customer_orders, runner_orders)
    return d.agg(F.countDistinct("customer_id").alias("unique_customers"),
                 F.countDistinct("order_id").alias("total_orders"),
                 F.count("pizza_id").alias("total_pizza"))


def deliveries_per_runner(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Delivered pizzas per runner (the source counts pizzas, not orders)."""
    d = delivered(customer_orders, runner_orders)
    return d.groupBy("runner_id").agg(F.count("pizza_id").alias("num_pizzas"))


def largest_order(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Most pizzas delivered in one order (TOP 1 of the per-order counts)."""
    d = delivered(customer_orders, runner_orders)
    per_order = d.groupBy("order_id").agg(F.count("pizza_id").alias("max_pizzas"))
    return per_order.orderBy(F.desc("max_pizzas")).limit(1).select("max_pizzas")


def change_flags(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Per customer: delivered pizzas with no change, with any change, with both."""
    d = delivered(customer_orders, runner_orders)
    exc, ext = F.col("exclusions"), F.col("extras")
    return d.groupBy("customer_id").agg(
        F.sum(F.when(ext.isNull() & exc.isNull(), 1).otherwise(0)).cast("bigint").alias("no_change"),
        F.sum(F.when(ext.isNotNull() | exc.isNotNull(), 1).otherwise(0)).cast("bigint").alias("changed"),
        F.sum(F.when(ext.isNotNull() & exc.isNotNull(), 1).otherwise(0)).cast("bigint").alias("both_changed"))


def pizzas_per_customer_pivot(customer_orders: DataFrame, runner_orders: DataFrame,
                              pizza_names: DataFrame) -> DataFrame:
    """PIVOT (COUNT(pizza_id) FOR pizza_id IN (1, 2)); empty cells are 0."""
    d = delivered(customer_orders, runner_orders).join(pizza_names, "pizza_id")
    wide = d.groupBy("customer_id").pivot("pizza_id", [1, 2]).count().na.fill(0, ["1", "2"])
    return wide.select("customer_id", F.col("1").alias("meatlovers"), F.col("2").alias("vegetarian"))


def volume_by_time(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    d = delivered(customer_orders, runner_orders)
    return d.groupBy(F.date_format("order_time", "EEEE").alias("day_of_week"),
                     F.hour("order_time").cast("bigint").alias("hour_of_day")).agg(
        F.count("pizza_id").alias("num_pizzas"))


def volume_by_hour(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    d = delivered(customer_orders, runner_orders)
    return d.groupBy(F.hour("order_time").cast("bigint").alias("hour_of_day")).agg(
        F.count("pizza_id").alias("num_pizzas")).orderBy("hour_of_day")


def volume_by_weekday(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    d = delivered(customer_orders, runner_orders)
    return d.groupBy(F.date_format("order_time", "EEEE").alias("day_of_week")).agg(
        F.count("pizza_id").alias("num_pizzas")).orderBy("day_of_week")


def signups_per_week(runners: DataFrame, week_zero: str = "2021-01-01") -> DataFrame:
    """One row per runner: week number (Sunday boundaries from ``week_zero``)
    and the number of runners registered in that week (COUNT(*) OVER week)."""
    r = runners.withColumn("week_number",
                           sunday_weeks_between(F.lit(week_zero).cast("date"), F.col("registration_date")))
    return window_aggregate(r, ["week_number"], F.count(F.lit(1)), "signups").select(
        "runner_id", "registration_date", "week_number", "signups")


def pickup_minutes(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Per runner: average minute component of (pickup - order), truncated to an
    integer as integer AVG does, and the exact average of whole minutes."""
    d = delivered(customer_orders, runner_orders)
    total = whole_minutes_between("order_time", "pickup_time")
    d = d.withColumn("__minute", minute_component("pickup_time", "order_time"))
    return d.groupBy("runner_id").agg(
        F.expr("sum(__minute) div count(__minute)").alias("avg_pickup_minute"),  # exact integer division
        F.round(F.avg(total), 4).alias("avg_pickup_total_minutes"))


def average_distance(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    d = delivered(customer_orders, runner_orders)
    return d.groupBy("customer_id").agg(F.round(F.avg("distance").cast("double"), 4).alias("avg_distance"))


def duration_spread(runner_orders: DataFrame) -> DataFrame:
    ro = clean_runner_orders(runner_orders).filter(F.col("cancellation").isNull())
    return ro.agg((F.max("duration") - F.min("duration")).cast("bigint").alias("difference"))


def speed_per_delivery(runner_orders: DataFrame) -> DataFrame:
    """AVG(distance / duration) OVER (PARTITION BY runner, order), per delivery row."""
    ro = clean_runner_orders(runner_orders).filter(F.col("cancellation").isNull())
    speed = F.col("distance").cast("double") / F.nullif(F.col("duration"), F.lit(0))
    out = window_aggregate(ro, ["runner_id", "order_id"], F.avg(speed), "avg_speed")
    return out.select("runner_id", "order_id", F.col("distance").cast("double").alias("distance"),
                      F.col("duration").cast("bigint").alias("duration"),
                      F.round("avg_speed", 4).alias("avg_speed")).orderBy("runner_id", "order_id")


def success_rate(runner_orders: DataFrame, runners: DataFrame) -> DataFrame:
    ro = clean_runner_orders(runner_orders).join(runners, "runner_id")
    ok = F.sum(F.when(F.col("cancellation").isNull(), 1).otherwise(0)).cast("bigint")
    orders = F.countDistinct("order_id")
    return ro.groupBy("runner_id").agg(
        orders.alias("num_orders"), ok.alias("success_order"),
        F.round(ok * 100.0 / F.nullif(orders, F.lit(0)), 4).alias("success"))


def _named_lists(lists: DataFrame, rows: str, toppings: DataFrame, *list_cols: str) -> DataFrame:
    """Distinct list text -> ', '-joined topping names (ordered by name).

    The texts of all ``list_cols`` are counted together in one pass, so each
    distinct list is split and looked up once however many rows (and columns)
    carry it; a row of ``lists`` stands for ``rows`` of them. Returns (lst, names, uses).
    """
    texts = lists.select(F.explode(F.array(*[F.col(c) for c in list_cols])).alias("lst"), rows)
    distinct = texts.where(F.col("lst").isNotNull()).groupBy("lst").agg(F.sum(rows).alias("uses"))
    items = distinct.select("lst", "uses", F.explode(split_ids("lst")).alias("topping_id"))
    named = items.join(toppings, "topping_id")
    return named.groupBy("lst").agg(string_agg_sorted("topping_name").alias("names"), F.max("uses").alias("uses"))


def topping_counts(customer_orders: DataFrame, toppings: DataFrame) -> DataFrame:
    """How often each topping was added as an extra / excluded (CROSS APPLY split)."""
    co = clean_customer_orders(customer_orders)
    both = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(col).alias("lst"))
                     for kind, col in (("extra", "extras"), ("exclusion", "exclusions"))])
    lists = co.select(F.explode(both).alias("one")).select("one.kind", F.col("one.lst").alias("lst")).where(F.col("lst").isNotNull())
    # counted per list, then per topping, before the toppings are met
    per_list = lists.groupBy("kind", "lst").agg(F.count(F.lit(1)).alias("n"))
    per_id = per_list.select("kind", "n", F.explode(split_ids("lst")).alias("topping_id")).groupBy("kind", "topping_id").agg(F.sum("n").alias("n"))
    return (per_id.join(toppings, "topping_id").groupBy("kind", "topping_name").agg(F.sum("n").alias("times"))
            .select("kind", "topping_name", "times"))


def most_common_topping(customer_orders: DataFrame, toppings: DataFrame, kind: str) -> DataFrame:
    """TOP 1 topping added as an extra (``kind='extra'``) or excluded; name breaks ties."""
    counts = topping_counts(customer_orders, toppings).filter(F.col("kind") == kind)
    return counts.orderBy(F.desc("times"), F.asc_nulls_last("topping_name")).limit(1).select("topping_name", "times")


def extras_per_order(customer_orders: DataFrame, toppings: DataFrame) -> DataFrame:
    """STRING_AGG of the extra toppings' names per order, ordered by name."""
    co = clean_customer_orders(customer_orders)
    items = co.select("order_id", F.explode(split_ids("extras")).alias("topping_id"))
    named = items.join(toppings, "topping_id")
    return named.groupBy("order_id").agg(string_agg_sorted("topping_name").alias("toppings"))


def standard_ingredients(names: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """Per pizza: the names of the toppings of its recipe (a comma list of
    topping ids), ordered by name; pizzas without a known topping are left out.
    Recipes are split before they meet the toppings, and a recipe text goes no
    further than its own ids."""
    items = recipes.select("pizza_id", F.explode(split_ids("toppings")).alias("topping_id"))
    named = items.join(toppings, "topping_id").groupBy("pizza_id").agg(string_agg_sorted("topping_name").alias("toppings"))
    return names.join(named, "pizza_id").select("pizza_id", "pizza_name", "toppings")


def order_descriptions(customer_orders: DataFrame, pizza_names: DataFrame, toppings: DataFrame) -> DataFrame:
    """'Name - Exclude a, b - Extra c' per pizza row.

    A text is made once per kind of pizza (its id and list texts) and found by
    the rows, which travel once; rows without a list do not travel. A kind, or
    a list among the kinds, may be the commonest by far, so the joins copy what
    belongs to the commonest keys."""
    co = clean_customer_orders(customer_orders).select("order_id", "line_id", "pizza_id", "exclusions", "extras")
    has_list = F.col("exclusions").isNotNull() | F.col("extras").isNotNull()
    listed = co.filter(has_list)
    kind = ["pizza_id", "exclusions", "extras"]
    kinds = listed.groupBy(*kind).agg(F.count(F.lit(1)).alias("rows"))
    named = _named_lists(kinds, "rows", toppings, "exclusions", "extras")
    texts = kinds.join(pizza_names, "pizza_id", "left")
    for lst, names in (("exclusions", "exc_names"), ("extras", "ext_names")):
        texts = heavy_join(texts, named.select(F.col("lst").alias(lst), F.col("names").alias(names), "uses"), lst, [names], "uses", kind)

    def part(lst, names, label):
        # a non-NULL list always prints its label, even if no id matched a topping
        return F.when(F.col(lst).isNotNull(),
                      F.concat(F.lit(label), F.coalesce(F.col(names), F.lit("")))).otherwise(F.lit(""))
    name = F.coalesce(F.col("pizza_name"), F.lit(""))
    text = F.concat(name,
                    part("exclusions", "exc_names", " - Exclude "),
                    part("extras", "ext_names", " - Extra "))
    texts = texts.select(F.struct(*kind).alias("kind"), text.alias("order_description"), "rows")
    listed = heavy_join(listed.select("order_id", "line_id", F.struct(*kind).alias("kind")), texts, "kind", ["order_description"],
                        "rows", ["order_id", "line_id"], kinds)
    plain = co.filter(~has_list).join(pizza_names, "pizza_id", "left")
    return (plain.select("order_id", "line_id", name.alias("order_description"))
            .unionByName(listed.select("order_id", "line_id", "order_description")))


def revenue(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Revenue of delivered pizzas at fixed prices: COUNT per type x price, summed."""
    d = delivered(customer_orders, runner_orders)
    per_type = d.groupBy("pizza_id").agg((F.count("pizza_id") * _price(F.col("pizza_id"))).alias("sale"))
    return per_type.agg(F.sum("sale").cast("bigint").alias("total_sales"))


def revenue_with_surcharge(customer_orders: DataFrame, runner_orders: DataFrame, pattern: str = "%4%") -> DataFrame:
    """As ``revenue`` plus a surcharge when the extras text matches ``pattern``
    (a text LIKE, so '%4%' also matches 14 or 40)."""
    d = delivered(customer_orders, runner_orders)
    charge = F.when(F.col("extras").like(pattern), F.lit(EXTRA_CHARGE)).otherwise(F.lit(0))
    per_group = d.groupBy("pizza_id", "extras").agg(
        (F.count("pizza_id") * (_price(F.col("pizza_id")) + charge)).alias("sale"))
    return per_group.agg(F.sum("sale").cast("bigint").alias("total_sales"))


def net_revenue(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Per delivered order: pizza sales, distance, runner fee and what is left."""
    co = clean_customer_orders(customer_orders)
    sales = co.groupBy("order_id").agg(F.sum(_price(F.col("pizza_id"))).cast("bigint").alias("sales"))
    ro = clean_runner_orders(runner_orders).filter(F.col("cancellation").isNull())
    fee = F.col("distance") * F.lit(RUNNER_RATE_PER_KM).cast("decimal(3,2)")
    return ro.join(sales, "order_id").select(
        "order_id", "sales", F.col("distance").cast("double").alias("distance"),
        fee.cast("double").alias("shipping_fee"),
        (F.col("sales") - fee).cast("double").alias("left_over"))
