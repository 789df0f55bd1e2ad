"""Interest-metric cleaning and coverage analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.functions.cleaning import parse_month_year, update_where
from tabula.operators.joins import anti_exists


def clean_map(interest_map: DataFrame) -> DataFrame:
    """Empty summaries become NULL (``UPDATE ... SET x = NULL WHERE x = ''``)."""
    return update_where(interest_map, "interest_summary", F.trim(F.col("interest_summary")) == "",
                        F.lit(None).cast("string"))  # D18: blanks only count as empty


def distinct_map(interest_map: DataFrame) -> DataFrame:
    """The map without duplicate rows (SELECT DISTINCT)."""
    return clean_map(interest_map).distinct()


def _spelled_null(c: str):
    """The text means "no value": NULL, or 'NULL' in any casing / padding (D18)."""
    return F.col(c).isNull() | (F.lower(F.trim(F.col(c))) == "null")


def typed_metrics(interest_metrics: DataFrame) -> DataFrame:
    """'NULL' text to NULL, numbers cast, month_year parsed to the month's first day."""
    def nul(c):
        return F.when(~_spelled_null(c), F.col(c))
    return interest_metrics.select(
        nul("_month").cast("int").alias("_month"),
        nul("_year").cast("int").alias("_year"),
        parse_month_year(nul("month_year")).alias("month_year"),
        nul("interest_id").cast("bigint").alias("interest_id"))


def parsed_month_years(interest_metrics: DataFrame) -> DataFrame:
    """Each distinct ``MM-yyyy`` text (not the 'NULL' spelling) with its DATE."""
    texts = interest_metrics.select(F.col("month_year").alias("text")).where(~_spelled_null("text")).distinct()
    return texts.select("text", parse_month_year("text").alias("parsed"))


def rows_without_interest(metrics: DataFrame) -> DataFrame:
    """``SELECT * ... WHERE interest_id IS NULL`` on typed metrics."""
    return metrics.filter(F.col("interest_id").isNull())


def counts_per_month(metrics: DataFrame) -> DataFrame:
    """Records per month_year, NULL months included (sorted NULLS FIRST)."""
    return (metrics.groupBy("month_year").agg(F.count(F.lit(1)).alias("counts"))
            .orderBy(F.asc_nulls_first("month_year")))


def drop_null_keys(metrics: DataFrame) -> DataFrame:
    """``DELETE WHERE month_year IS NULL OR interest_id IS NULL`` on typed metrics."""
    gone = F.col("month_year").isNull() | F.col("interest_id").isNull()
    return metrics.filter(~F.coalesce(gone, F.lit(False)))


def kept_metrics(interest_metrics: DataFrame) -> DataFrame:
    """``typed_metrics`` then ``drop_null_keys``, deleting on the raw text first.

    A typed key is NULL exactly when its text is NULL or 'NULL', so the rows
    can go before parsing; filtering after typing would make the optimizer
    evaluate the parse twice (in the pushed-down filter and the projection).
    """
    return typed_metrics(interest_metrics.filter(~_spelled_null("month_year") & ~_spelled_null("interest_id")))


def orphan_counts(metrics: DataFrame, interest_map: DataFrame) -> DataFrame:
    """Distinct ids on one side only, both directions (LEFT JOIN ... IS NULL)."""
    m_ids = metrics.select(F.col("interest_id").alias("id")).where(F.col("id").isNotNull()).distinct()
    map_ids = interest_map.select("id").where(F.col("id").isNotNull()).distinct()
    left = anti_exists(m_ids, map_ids, "id").agg(F.count(F.lit(1)).alias("metric_not_in_map"))
    right = anti_exists(map_ids, m_ids, "id").agg(F.count(F.lit(1)).alias("map_not_in_metric"))
    return left.crossJoin(right)  # two one-row frames


def duplicate_check(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("counts"))


def drop_invalid(metrics: DataFrame, clean_interest_map: DataFrame) -> DataFrame:
    """Delete metric rows whose (id, month) has a month before the interest's
    creation date -- the first-of-month date is compared, so a month that
    contains the creation date counts as invalid too.

    The source builds the invalid (id, month) pairs and deletes with EXISTS.
    A pair is invalid exactly when its month is before the latest creation
    date among the interest's map rows, so one left join against a per-id
    aggregate (one row per id) decides every row in a single pass. A NULL
    month never compares as invalid, as in the source.
    """
    created = clean_interest_map.groupBy(F.col("id").alias("__id")).agg(
        F.max(F.col("created_at").cast("date")).alias("__created"))
    joined = metrics.join(created, metrics.interest_id == created.__id, "left")
    invalid = F.coalesce(F.col("month_year") < F.col("__created"), F.lit(False))
    return joined.filter(~invalid).drop("__id", "__created")


def present_in_all_months(metrics: DataFrame, clean_interest_map: DataFrame, months: str = "month_year") -> DataFrame:
    """Interests seen in every month of the data (relational division); the
    month is a column of the metrics, ``month_year`` or ``_month``, the month
    of the year."""
    seen = metrics.select("interest_id", F.col(months).alias("month_year")).distinct()
    months = seen.agg(F.countDistinct("month_year").alias("__all"))
    per = seen.groupBy("interest_id").agg(F.count("month_year").alias("n"))
    full = per.crossJoin(F.broadcast(months)).filter(F.col("n") == F.col("__all")).select("interest_id")
    names = clean_interest_map.select(F.col("id").alias("interest_id"), "interest_name").distinct()
    return full.join(names, "interest_id")


def cumulative_share(metrics: DataFrame, min_percent: int = 90) -> DataFrame:
    """Ids per total-months value with the cumulative share of ids, from the
    highest total down; integer arithmetic as the source's INT expression
    (so the share is truncated). Rows at or above ``min_percent`` are kept.
    The window runs over one row per distinct total (at most the number of
    months in the data)."""
    per = (metrics.filter(F.col("interest_id").isNotNull()).groupBy("interest_id")
           .agg(F.countDistinct("month_year").alias("total_months")))
    g = per.groupBy("total_months").agg(F.count(F.lit(1)).alias("number_of_ids"))
    desc = Window.orderBy(F.desc("total_months")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = g.select(
        F.col("total_months").cast("bigint").alias("total_months"), "number_of_ids",
        ((F.sum("number_of_ids").over(desc) * 100) / F.sum("number_of_ids").over(everything))
        .cast("bigint").alias("cumulative_percentage"))
    return out.filter(F.col("cumulative_percentage") >= min_percent)


def rows_of_rare_ids(metrics: DataFrame, below_months: int = 6) -> DataFrame:
    """Rows whose interest appears in fewer than ``below_months`` months (EXISTS)."""
    per_month = metrics.filter(F.col("interest_id").isNotNull()).groupBy("interest_id", "month_year").agg(F.count(F.lit(1)).alias("rows"))
    per = per_month.groupBy("interest_id").agg(F.count("month_year").alias("n"), F.sum("rows").alias("rows"))
    return per.filter(F.col("n") < below_months).agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows_removed"))
