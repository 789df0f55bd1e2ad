"""Retail weekly-sales cleaning and before/after comparisons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabula.functions.cleaning import parse_two_digit_year_date
from tabula.functions.dates import week_of_month_of_monday
from tabula.sources import sinks

# Segment code -> age band (by last character) and demographic
# (by first character); 'null' segments become 'unknown'.
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged"}
AGE_BAND_OTHER = "Retirees"
DEMOGRAPHICS = {"C": "Couples"}
DEMOGRAPHIC_OTHER = "Families"
UNKNOWN = "unknown"


def clean_weekly_sales(weekly_sales: DataFrame) -> DataFrame:
    """Typed weekly sales: parsed week date, week-of-month, month, year,
    segment decoded into age band and demographic, and average transaction
    (integer division of sales by transactions, as BIGINT / INT does)."""
    d = parse_two_digit_year_date("week_date")
    seg = F.col("segment")
    is_null = F.lower(F.trim(seg)) == "null"  # D18: case and blanks do not matter
    age = F.lit(AGE_BAND_OTHER)
    for code, band in reversed(list(AGE_BANDS.items())):
        age = F.when(F.substring(seg, -1, 1) == code, F.lit(band)).otherwise(age)
    demo = F.lit(DEMOGRAPHIC_OTHER)
    for code, name in DEMOGRAPHICS.items():
        demo = F.when(F.substring(seg, 1, 1) == code, F.lit(name)).otherwise(demo)
    return weekly_sales.select(
        d.alias("week_date"),
        week_of_month_of_monday(d).cast("bigint").alias("week_number"),
        F.month(d).cast("bigint").alias("month_number"),
        F.year(d).cast("bigint").alias("calendar_year"),
        "region", "platforms",
        F.when(is_null, F.lit(UNKNOWN)).otherwise(seg).alias("segment"),
        F.when(is_null, F.lit(UNKNOWN)).otherwise(age).alias("age_band"),
        F.when(is_null, F.lit(UNKNOWN)).otherwise(demo).alias("demographic"),
        "customer_type",
        F.col("transactions").cast("bigint").alias("transactions"),
        F.col("sales").cast("bigint").alias("sales"),
        F.expr("sales div nullif(transactions, 0)").alias("avg_transaction"),
    )


def parsed_week_dates(weekly_sales: DataFrame) -> DataFrame:
    """Each distinct ``d/M/yy`` week text with its DATE."""
    texts = weekly_sales.select(F.col("week_date").alias("text")).where(F.col("text").isNotNull()).distinct()
    return texts.select("text", parse_two_digit_year_date("text").alias("parsed"))


def transactions_by_year(clean: DataFrame) -> DataFrame:
    return clean.groupBy("calendar_year").agg(F.sum("transactions").alias("total_transactions"))


# The columns of the cleaned table.
CLEAN_SCHEMA = """week_date DATE, week_number BIGINT, month_number BIGINT, calendar_year BIGINT, region STRING,
platforms STRING, segment STRING, age_band STRING, demographic STRING, customer_type STRING, transactions BIGINT,
sales BIGINT, avg_transaction BIGINT"""


def written_weekly_sales(spark: SparkSession, clean: DataFrame, name: str = "clean_weekly_sales_table") -> DataFrame:
    """``DROP TABLE IF EXISTS``, ``CREATE TABLE`` with 13 typed columns and
    ``INSERT INTO ... SELECT``: the cleaned rows as a named table."""
    sinks.drop(spark, name)
    sinks.create(spark, name, CLEAN_SCHEMA)
    sinks.insert(spark, name, clean)
    sinks.expire(spark, name)
    return sinks.read(spark, name)


def replaced_totals(spark: SparkSession, clean: DataFrame, name: str = "sales_totals") -> DataFrame:
    """A named table written twice: the totals by year and region replace the
    rows by year, region and month that they are made from."""
    by_month = sinks.replace(spark, clean.groupBy("calendar_year", "month_number", "region").agg(F.sum("sales").alias("total_sales")), name)
    return sinks.replace(spark, by_month.groupBy("calendar_year", "region").agg(F.sum("total_sales").alias("total_sales")), name)


def sales_by_region_month(clean: DataFrame) -> DataFrame:
    return clean.groupBy("region", "calendar_year", "month_number").agg(F.sum("sales").alias("total_sales")).orderBy("region", "calendar_year", "month_number")


def transactions_by_platform(clean: DataFrame) -> DataFrame:
    return clean.groupBy("platforms").agg(F.sum("transactions").alias("total"))


def channel_ratio(clean: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """Per (year, month): sales of one platform over another's -- one
    conditional aggregate instead of two correlated subqueries."""
    g = clean.groupBy("calendar_year", "month_number").agg(
        F.sum(F.when(F.col("platforms") == numerator, F.col("sales"))).alias("a"),
        F.sum(F.when(F.col("platforms") == denominator, F.col("sales"))).alias("b"))
    return g.select("calendar_year", "month_number",
                    F.round(F.col("a") * 1.0 / F.nullif(F.col("b"), F.lit(0)), 4).alias("ratio")).orderBy("calendar_year", "month_number")


def yearly_share(clean: DataFrame) -> DataFrame:
    """Sales per (year, demographic), the year's total and the percentage."""
    g = clean.groupBy("calendar_year", "demographic").agg(F.sum("sales").alias("total_sales"))
    year = Window.partitionBy("calendar_year")  # a few demographic rows per year
    return g.withColumn("total_of_year", F.sum("total_sales").over(year)).withColumn(
        "percent_by_demographic",
        F.round(F.col("total_sales") * 100.0 / F.nullif(F.col("total_of_year"), F.lit(0)), 2)).orderBy("calendar_year", "demographic")


def top_bands(clean: DataFrame, platform: str) -> DataFrame:
    """Sales per (age band, demographic) on one platform, unknown band excluded."""
    return (clean.filter((F.col("platforms") == platform) & (F.col("age_band") != UNKNOWN))
            .groupBy("age_band", "demographic").agg(F.sum("sales").alias("sales")))


def average_transaction_size(clean: DataFrame) -> DataFrame:
    """AVG(sales / transactions) per (year, platform) with integer division at
    both steps, as BIGINT inputs give."""
    size = F.expr("sales div nullif(transactions, 0)")
    return clean.groupBy("calendar_year", "platforms").agg(
        F.expr("sum(sales div nullif(transactions, 0)) div count(sales div nullif(transactions, 0))").alias("avg_transaction_size"),
        F.round(F.avg(size), 4).alias("avg_transaction_size_exact"))


def _period(baseline):
    return F.when(F.col("week_date") < baseline, F.lit("Before")).otherwise(F.lit("After"))


def before_after_totals(clean: DataFrame, baseline: dt.date, weeks: int) -> DataFrame:
    """Sales in the ``weeks`` weeks before / after ``baseline``, both ends inclusive."""
    b = F.lit(baseline)
    window = F.col("week_date").between(F.date_add(b, -7 * weeks), F.date_add(b, 7 * weeks))
    return clean.filter(window).groupBy(_period(b).alias("period")).agg(F.sum("sales").alias("total_sales"))


def before_after_change(clean: DataFrame, baseline: dt.date, weeks_list=(4, 12)) -> DataFrame:
    """Difference and percentage change After vs Before, for several window
    lengths in one pass (a row is counted in every window that holds it)."""
    b = F.lit(baseline)
    sums = []
    for w in weeks_list:
        inside = F.col("week_date").between(F.date_add(b, -7 * w), F.date_add(b, 7 * w))
        sums.append(F.sum(F.when(inside & (F.col("week_date") < b), F.col("sales"))).alias(f"b{w}"))
        sums.append(F.sum(F.when(inside & (F.col("week_date") >= b), F.col("sales"))).alias(f"a{w}"))
    one = clean.agg(*sums)
    rows = [F.struct(F.lit(w).cast("bigint").alias("weeks"), F.col(f"b{w}").alias("before_sales"),
                     F.col(f"a{w}").alias("after_sales")) for w in weeks_list]
    long = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    diff = F.col("after_sales") - F.col("before_sales")
    return long.select("weeks", "before_sales", "after_sales", diff.alias("sales_difference"),
                       F.round(diff * 100.0 / F.nullif(F.col("before_sales"), F.lit(0)), 4)
                       .alias("sales_percentage_change"))


def before_after_by_year(clean: DataFrame, month: int, day: int, weeks: int) -> DataFrame:
    """For every calendar year present: sales in [Y-month-day - weeks, Y-month-day)
    and [Y-month-day, Y-month-day + weeks]. Each row is tested against the
    baselines of its own and of the years the window can reach, so one scan
    serves all years; a year is listed if it has rows of its own (as is NULL)."""
    reach = weeks * 7 // 365 + 1
    cand = clean.select("week_date", "sales",
                        F.explode(F.array(*[F.year("week_date") + k for k in range(-reach, reach + 1)])).alias("y"))
    base = F.make_date(F.col("y"), F.lit(month), F.lit(day))
    before = (F.col("week_date") >= F.date_add(base, -7 * weeks)) & (F.col("week_date") < base)
    after = (F.col("week_date") >= base) & (F.col("week_date") <= F.date_add(base, 7 * weeks))
    per_year = cand.groupBy(F.col("y").cast("bigint").alias("calendar_year")).agg(
        F.sum(F.when(before, F.col("sales"))).alias("before"),
        F.sum(F.when(after, F.col("sales"))).alias("after"),
        F.max(F.year("week_date") == F.col("y")).alias("own"))
    return per_year.filter(F.col("own") | F.col("calendar_year").isNull()).select("calendar_year", "before", "after").orderBy("calendar_year")
