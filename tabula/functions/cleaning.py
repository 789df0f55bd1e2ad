"""Cleaning dirty text columns into typed values (Catalyst expressions only)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings that mean "no value" once blanks are trimmed and case is folded.
NULL_SPELLINGS = ("", "null")
# Fixed value: two-digit years up to this year's last two digits are 20xx, the
# rest 19xx (the usual default cutoff of style-3 date conversions).
TWO_DIGIT_YEAR_CUTOFF = 2049


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_if_blank(col: str | Column) -> Column:
    """NULL for NULL, '', blanks and any casing of 'null'; the text otherwise."""
    c = _c(col)
    return F.when(~F.lower(F.trim(c)).isin(*NULL_SPELLINGS), c)


def update_where(df: DataFrame, column: str, predicate: Column, value: Column) -> DataFrame:
    """``UPDATE t SET column = value WHERE predicate`` on an immutable frame."""
    return df.withColumn(column, F.when(predicate, value).otherwise(F.col(column)))


def normalize_nulls(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, null_if_blank(c))
    return df


def number_before(col: str | Column, unit: str) -> Column:
    """Text before the first ``unit`` (whole text when absent), trimmed.

    ``'23km' -> '23'``, ``'23 km' -> '23'``, ``'23' -> '23'``.
    """
    c = null_if_blank(col)
    return F.trim(F.when(F.instr(c, unit) == 0, c).otherwise(F.substring_index(c, unit, 1)))


def parse_quantity(col: str | Column, unit: str, to_type: str) -> Column:
    """Strip a unit suffix and cast, e.g. ``parse_quantity('distance', 'km', 'decimal(5,2)')``.
    Raises on text that is not a number (ANSI cast), like the source does."""
    return number_before(col, unit).cast(to_type)


def split_ids(col: str | Column) -> Column:
    """A comma list ``'4, 12'`` as an array of BIGINT; elements that are not
    integers become NULL (TRY_CAST), a NULL list stays NULL."""
    parts = F.split(_c(col), ",")
    return F.transform(parts, lambda x: F.trim(x).try_cast("bigint"))


def parse_two_digit_year_date(col: str | Column, sep: str = "/") -> Column:
    """``d/M/yy`` text as DATE with the two-digit-year window 1950-2049
    (``TWO_DIGIT_YEAR_CUTOFF``). Spark's ``yy`` pattern would map every
    two-digit year to 20xx.
    """
    parts = F.split(_c(col), re.escape(sep))  # split takes a regex
    day, month, yy = (F.get(parts, i).cast("int") for i in range(3))  # NULL when a part is missing
    year = F.when(yy <= TWO_DIGIT_YEAR_CUTOFF % 100, yy + 2000).otherwise(yy + 1900)
    return F.make_date(year, month, day)


def parse_month_year(col: str | Column) -> Column:
    """``MM-yyyy`` text as the DATE of the first day of that month (built from
    the integer parts; text that is not MM-yyyy raises under ANSI casts)."""
    c = _c(col)
    return F.make_date(F.substring_index(c, "-", -1).cast("int"), F.substring_index(c, "-", 1).cast("int"), F.lit(1))
