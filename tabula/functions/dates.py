"""Date arithmetic with the calendar rules the reports rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_start(col) -> Column:
    return F.trunc(_c(col), "MM")


def week_start_monday(col) -> Column:
    return F.date_trunc("week", _c(col)).cast("date")


def sunday_weeks_between(start, end) -> Column:
    """Number of week boundaries (Saturday -> Sunday) crossed from ``start`` to
    ``end``: the calendar-week difference with weeks starting on Sunday.
    Shifting both dates by one day turns Sunday-start weeks into Monday-start
    weeks, which ``date_trunc('week')`` knows."""
    s = F.date_trunc("week", F.date_add(_c(start), 1)).cast("date")
    e = F.date_trunc("week", F.date_add(_c(end), 1)).cast("date")
    # both are Mondays, so the day difference is an exact multiple of 7
    return (F.datediff(e, s) / 7).cast("bigint")


def week_of_month_of_monday(col) -> Column:
    """Day-of-month of the week's Monday, integer-divided by 7, plus one."""
    return (F.floor(F.dayofmonth(week_start_monday(col)) / 7) + 1).cast("int")


def seconds_between(earlier, later) -> Column:
    """``later - earlier`` in seconds (DECIMAL, microsecond precision).

    Subtracting TIMESTAMP_NTZ values gives a wall-clock interval, so the result
    does not depend on the session time zone (``timestamp_diff`` converts to
    local instants first and shifts across daylight-saving gaps).
    """
    iv = _c(later) - _c(earlier)

    def part(unit):
        return F.extract(F.lit(unit), iv)
    return part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")


def whole_minutes_between(earlier, later) -> Column:
    """Elapsed whole minutes, truncated toward zero."""
    return (seconds_between(earlier, later) / 60).cast("bigint")


def minute_component(later, earlier) -> Column:
    """Minute part (0-59) of the interval ``later - earlier``, read like a clock:
    130 minutes -> 10; half a second early -> 59."""
    return F.pmod(F.floor(seconds_between(earlier, later) / 60), F.lit(60)).cast("bigint")


def add_term(col, unit: str, n: int | Column) -> Column:
    """DATEADD for DATE values, staying DATE (``dateadd`` would give a timestamp)."""
    c = _c(col)
    n = n if isinstance(n, Column) else F.lit(n)
    if unit == "day":
        return F.date_add(c, n)
    if unit == "week":
        return F.date_add(c, n * 7)
    if unit == "month":
        return F.add_months(c, n)
    if unit == "year":
        return F.add_months(c, n * 12)
    raise ValueError(unit)


def in_year(col, year: int) -> Column:
    """``YEAR(col) = year`` written as a date range, so the bound reaches the
    Parquet scan (a cast of the stored timestamp is unwrapped by Catalyst)."""
    import datetime as dt
    c = _c(col)
    return (c >= F.lit(dt.date(year, 1, 1))) & (c < F.lit(dt.date(year + 1, 1, 1)))


def after_year(col, year: int) -> Column:
    """``YEAR(col) > year`` as a pushable date bound."""
    import datetime as dt
    return _c(col) >= F.lit(dt.date(year + 1, 1, 1))
