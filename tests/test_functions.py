"""Column functions on hand-made rows: null spellings, unit strings, dates."""

import datetime as dt

from pyspark.sql import functions as F

from tabula.functions import cleaning, dates


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_null_spellings(spark):
    got = one(spark, cleaning.null_if_blank("s"), [(None,), ("",), (" ",), ("null",), ("NULL",), (" Null ",),
                                                   ("4, 5",)], "s string")
    assert got == [None, None, None, None, None, None, "4, 5"]


def test_unit_strings(spark):
    rows = [("12km",), ("12 km",), ("12",), ("12.5km",), ("null",), (None,)]
    got = one(spark, cleaning.parse_quantity("s", "km", "decimal(5,2)").cast("double"), rows, "s string")
    assert got == [12.0, 12.0, 12.0, 12.5, None, None]
    rows = [("15 mins",), ("15minutes",), ("15 minute",), ("15",), ("15mins",)]
    assert one(spark, cleaning.parse_quantity("s", "min", "int"), rows, "s string") == [15] * 5


def test_split_ids_try_cast(spark):
    got = one(spark, cleaning.split_ids("s"), [("4, 12",), ("4",), ("x, 7",), (None,)], "s string")
    assert got == [[4, 12], [4], [None, 7], None]


def test_two_digit_years(spark):
    got = one(spark, cleaning.parse_two_digit_year_date("s"),
              [("5/6/98",), ("31/8/20",), ("1/1/49",), ("1/1/50",)], "s string")
    assert got == [dt.date(1998, 6, 5), dt.date(2020, 8, 31), dt.date(2049, 1, 1), dt.date(1950, 1, 1)]


def test_month_year(spark):
    assert one(spark, cleaning.parse_month_year("s"), [("07-2021",)], "s string") == [dt.date(2021, 7, 1)]


def test_sunday_week_boundaries(spark):
    # 2021-01-01 is a Friday: Sat 2nd is the same week, Sun 3rd is week 1.
    rows = [(dt.date(2021, 1, 2),), (dt.date(2021, 1, 3),), (dt.date(2021, 1, 9),),
            (dt.date(2021, 1, 10),), (dt.date(2020, 12, 26),), (dt.date(2020, 12, 27),)]
    got = one(spark, dates.sunday_weeks_between(F.lit(dt.date(2021, 1, 1)), F.col("d")), rows, "d date")
    assert got == [0, 1, 1, 2, -1, 0]


def test_week_of_month_of_monday(spark):
    rows = [(dt.date(2020, 6, 15),), (dt.date(2020, 6, 14),), (dt.date(2020, 6, 1),)]
    assert one(spark, dates.week_of_month_of_monday("d"), rows, "d date") == [3, 2, 1]


def test_minute_component(spark):
    rows = [(dt.datetime(2021, 1, 1, 10, 0), dt.datetime(2021, 1, 1, 12, 10))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert df.select(dates.minute_component("b", "a")).first()[0] == 10


def test_add_term_stays_date_and_clamps(spark):
    rows = [(dt.date(2020, 1, 31),)]
    df = spark.createDataFrame(rows, "d date")
    out = df.select(dates.add_term("d", "month", 1).alias("m"), dates.add_term("d", "year", 1).alias("y"),
                    dates.add_term("d", "week", 1).alias("w"))
    assert dict(out.dtypes)["m"] == "date"
    assert out.first() == (dt.date(2020, 2, 29), dt.date(2021, 1, 31), dt.date(2020, 2, 7))


def test_minutes_are_wall_clock_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2001-04-01 02:58:00' AS a, timestamp_ntz'2001-04-01 03:33:00' AS b, "
                       "timestamp_ntz'2001-04-01 02:57:59.5' AS c")
        row = df.select(dates.whole_minutes_between("a", "b"), dates.minute_component("b", "a"),
                        dates.minute_component("c", "a")).first()
        assert tuple(row) == (35, 35, 59)   # DST gap ignored; half a second early reads 59
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
