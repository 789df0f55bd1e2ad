"""Subscription reports: journeys, churn, plan snapshots and transitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.functions.dates import add_term, after_year, in_year
from tabula.operators.aggregates import band_pairs, latest_per_key, pair_totals
from tabula.operators.ordered import month_starts, with_previous

TRIAL, BASIC, PRO, ANNUAL, CHURN = 0, 1, 2, 3, 4


def journey(sub: DataFrame, plans: DataFrame) -> DataFrame:
    """Subscriptions with their plan names (inner join to the catalogue)."""
    return sub.join(plans, "plan_id").select("customer_id", "plan_id", "plan_name", F.col("price").cast("double").alias("price"), "start_date")


def customers(sub: DataFrame) -> DataFrame:
    return sub.agg(F.countDistinct("customer_id").alias("num_customers"))


def starts_per_month(sub: DataFrame) -> DataFrame:
    """Plan starts per calendar month, labelled by the month's first day."""
    month = F.trunc("start_date", "MM")
    return (sub.groupBy(month.alias("month_start"))
            .agg(F.count("plan_id").alias("num_plans")).orderBy("month_start")
            .select(F.date_format("month_start", "dd/MM/yyyy").alias("month"), "num_plans"))


def starts_after_year(sub: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    return (sub.filter(after_year("start_date", year)).join(plans, "plan_id")
            .groupBy("plan_name").agg(F.count("plan_id").alias("num_plans")))


def churn_share(sub: DataFrame) -> DataFrame:
    """Customers, churned customers and their share (one global row).

    Both counts come from one aggregate pass; the share is rounded to two
    places as the source's DECIMAL(5,2) cast does."""
    total = F.countDistinct("customer_id")
    churned = F.countDistinct(F.when(F.col("plan_id") == CHURN, F.col("customer_id")))
    return sub.agg(total.alias("num_customers"), churned.alias("num_churn")).select(
        "num_customers", "num_churn",
        F.round(F.col("num_churn") * 100.0 / F.nullif(F.col("num_customers"), F.lit(0)), 2)
         .alias("percent_churn"))


def gap_pairs(sub: DataFrame, first_plan: int, second_plan: int | None, gap_days: int,
              exclude_second: int | None = None, digits: int = 2) -> DataFrame:
    """Count (first, second) subscription pairs of one customer whose start
    dates are exactly ``gap_days`` apart, as the self join would, and their
    share of all customers. Both sides are counted per (customer, date) and
    equi-joined on the shifted date, so no pair list is materialised.
    ``second_plan=None`` with ``exclude_second`` means "any plan but that one";
    ``digits`` is the rounding of the percentage (the source casts one report
    to DECIMAL(5,0), another to DECIMAL(5,2)).
    """
    first = sub.filter(F.col("plan_id") == first_plan).groupBy("customer_id", "start_date").agg(
        F.count(F.lit(1)).alias("n_first"))
    cond = (F.col("plan_id") == second_plan) if second_plan is not None else (F.col("plan_id") != exclude_second)
    second = sub.filter(cond).groupBy("customer_id", "start_date").agg(F.count(F.lit(1)).alias("n_second"))
    first = first.withColumn("start_date", F.date_add("start_date", gap_days))
    pairs = first.join(second, ["customer_id", "start_date"]).agg(
        F.coalesce(F.sum(F.col("n_first") * F.col("n_second")), F.lit(0)).cast("bigint").alias("num_customers"))
    everyone = sub.agg(F.countDistinct("customer_id").alias("__all"))
    return pairs.crossJoin(everyone).select(  # two one-row frames
        "num_customers",
        F.round(F.col("num_customers") * 100.0 / F.nullif(F.col("__all"), F.lit(0)), digits).alias("percentage"))


def days_to_plan(sub: DataFrame, from_plan: int = TRIAL, to_plan: int = ANNUAL) -> DataFrame:
    """Average days from a ``from_plan`` start to a ``to_plan`` start over all
    pairs of one customer (the self join's rows), from per-customer sums;
    exact and truncated to an integer (AVG over INT days)."""
    t = pair_totals(sub.filter(F.col("plan_id") == from_plan), sub.filter(F.col("plan_id") == to_plan),
                    "customer_id", "start_date")
    return t.agg(F.round(F.sum("diff_sum") / F.nullif(F.sum("dated_pairs"), F.lit(0)), 4).alias("avg_days_to_annual"),
                 F.expr("sum(diff_sum) div nullif(sum(dated_pairs), 0)").alias("avg_days_to_annual_int"),
                 F.coalesce(F.sum("pairs"), F.lit(0)).cast("bigint").alias("num_pairs"))


# The 30-day bands of the breakdown (label, low, high).
DAY_BANDS = [("0-30 days", 0, 30), ("31-60 days", 31, 60), ("61-90 days", 61, 90)]
OTHER_BAND = "More than 90 days"


def day_bucket_breakdown(sub: DataFrame, from_plan: int = TRIAL, to_plan: int = ANNUAL) -> DataFrame:
    """Pairs of (from, to) starts per 30-day band of their gap, with the band's
    average gap. Pairs inside 0-90 days come from a band join; the rest
    ('More than 90 days', which also holds negative gaps) is the per-customer
    total minus the banded part -- all pairs are counted, none listed."""
    left = sub.filter(F.col("plan_id") == from_plan)
    right = sub.filter(F.col("plan_id") == to_plan)
    max_gap = DAY_BANDS[-1][2]
    near = band_pairs(left, right, "customer_id", "start_date", max_gap)
    label = F.lit(OTHER_BAND)
    for name, lo, hi in reversed(DAY_BANDS):
        label = F.when(F.col("gap").between(lo, hi), F.lit(name)).otherwise(label)
    banded = near.groupBy(label.alias("break_period")).agg(
        F.sum("pairs").alias("pairs"), F.sum(F.col("pairs") * F.col("gap")).alias("diff_sum"))
    total = pair_totals(left, right, "customer_id", "start_date").agg(
        F.sum("pairs").alias("all_pairs"), F.sum("dated_pairs").alias("all_dated"), F.sum("diff_sum").alias("all_diff"))
    near_total = near.agg(F.sum("pairs").alias("near_pairs"),
                          F.sum(F.col("pairs") * F.col("gap")).alias("near_diff"))
    banded = banded.withColumn("dated", F.col("pairs"))
    # pairs with a missing date fall in the last band (the CASE's ELSE) without a gap
    other = total.crossJoin(near_total).select(  # one-row frames
        F.lit(OTHER_BAND).alias("break_period"),
        (F.col("all_pairs") - F.coalesce(F.col("near_pairs"), F.lit(0))).alias("pairs"),
        (F.col("all_diff") - F.coalesce(F.col("near_diff"), F.lit(0))).alias("diff_sum"),
        (F.col("all_dated") - F.coalesce(F.col("near_pairs"), F.lit(0))).alias("dated"))
    rows = banded.unionByName(other).filter(F.col("pairs") > 0)
    return rows.select("break_period",
                       F.round(F.col("diff_sum") / F.nullif(F.col("dated"), F.lit(0)), 4).alias("avg_day_between"),
                       F.expr("diff_sum div nullif(dated, 0)").alias("avg_day_between_int"),
                       F.col("pairs").cast("bigint").alias("num_cus")).orderBy(F.desc("num_cus"), "break_period")


def upgrades_between(sub: DataFrame, plan: int, start: dt.date, end: dt.date) -> DataFrame:
    """Customers starting ``plan`` with start BETWEEN start AND end (inclusive)."""
    return (sub.filter((F.col("plan_id") == plan) & F.col("start_date").between(F.lit(start), F.lit(end)))
            .agg(F.countDistinct("customer_id").alias("num_cus")))


def transitions(sub: DataFrame, from_plan: int, to_plan: int, year: int) -> DataFrame:
    """Customers whose plan went ``from_plan`` -> ``to_plan`` between consecutive
    subscriptions within ``year`` (LAG over start date, sub id as tiebreak)."""
    rows = sub.filter(in_year("start_date", year))
    lagged = with_previous(rows, ["customer_id"], ["start_date", "sub_id"], ["plan_id"], splits=month_starts(year, year))
    return (lagged.filter((F.col("plan_id") == to_plan) & (F.col("previous_plan_id") == from_plan))
            .agg(F.countDistinct("customer_id").alias("num_cus_downgraded")))


def latest_plan(sub: DataFrame) -> DataFrame:
    """Each customer's latest subscription (ROW_NUMBER() OVER ... DESC = 1)."""
    return latest_per_key(sub, ["customer_id"], ["start_date", "sub_id"], ["plan_id"]).select(
        "customer_id", "plan_id", "start_date")


def plan_in_force(at: Column, plan: Column, previous_date: Column, previous_plan: Column) -> Column:
    """The plan actually in force at ``at``: a paid-up previous plan stays in
    force while its term (trial 7 days, monthly 1 month, annual 1 year) still
    covers ``at``. NULL when there is no previous plan or it was a churn."""
    def keep(until):
        return F.when(until >= at, previous_plan).otherwise(plan)
    return (F.when(previous_plan == TRIAL, keep(add_term(previous_date, "day", 7)))
            .when(previous_plan.isin(BASIC, PRO), keep(add_term(previous_date, "month", 1)))
            .when(previous_plan == ANNUAL, keep(add_term(previous_date, "year", 1))))


def plan_snapshot(sub: DataFrame, at: dt.date) -> DataFrame:
    """Customer count and share per plan in force at ``at``.

    The two latest subscriptions on or before ``at`` come from one ranked scan;
    the rank limit is applied before the shuffle, too, so a hot customer sends
    two rows per task.
    """
    upto = sub.filter(F.col("start_date") <= F.lit(at))
    order = Window.partitionBy("customer_id").orderBy(F.desc("start_date"), F.desc("sub_id"))
    two = upto.withColumn("back", F.row_number().over(order)).filter(F.col("back") <= 2)
    pick = lambda c, back: F.max(F.when(F.col("back") == back, F.col(c)))
    rows = two.groupBy("customer_id").agg(pick("plan_id", 1).alias("plan_id"), pick("plan_id", 2).alias("previous_plan"),
                                          pick("start_date", 2).alias("previous_date"))
    at_c = F.lit(at)
    plan, pp = F.col("plan_id"), F.col("previous_plan")
    rule = plan_in_force(at_c, plan, F.col("previous_date"), pp)
    current = (F.when(plan.isin(TRIAL, ANNUAL), plan)
               .when(plan == CHURN, rule)
               .when(pp < plan, plan)
               .otherwise(rule))
    counts = rows.groupBy(current.cast("bigint").alias("current_plan")).agg(F.count(F.lit(1)).alias("plan_num"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one row per plan
    return counts.select("current_plan", "plan_num",
                         F.round(F.col("plan_num") * 100.0 / F.sum("plan_num").over(everything), 2).alias("plan_percent"))
