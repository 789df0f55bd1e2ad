"""Property tests: random inputs against plain-Python / pandas definitions."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabula.functions import cleaning, dates
from tabula.operators import aggregates, ordered

FAST = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
day = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))


def sunday_weeks(a: dt.date, b: dt.date) -> int:
    """Week boundaries crossed, weeks starting on Sunday (Python definition)."""
    def week_start(d):
        return d - dt.timedelta(days=(d.weekday() + 1) % 7)
    return (week_start(b) - week_start(a)).days // 7


@FAST
@given(st.lists(st.tuples(day, day), min_size=1, max_size=40))
def test_sunday_weeks_between(spark, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r[0] for r in df.select(dates.sunday_weeks_between("a", "b")).collect()]
    assert got == [sunday_weeks(a, b) for a, b in pairs]


@FAST
@given(st.lists(day, min_size=1, max_size=40))
def test_week_of_month_and_two_digit_years(spark, days):
    df = spark.createDataFrame([(d, f"{d.day}/{d.month}/{d.year % 100:02d}") for d in days], "d date, s string")
    rows = df.select(dates.week_of_month_of_monday("d"), cleaning.parse_two_digit_year_date("s")).collect()
    for d, (wk, parsed) in zip(days, rows):
        monday = d - dt.timedelta(days=d.weekday())
        assert wk == monday.day // 7 + 1
        yy = d.year % 100
        assert parsed == dt.date(2000 + yy if yy < 50 else 1900 + yy, d.month, d.day)


keyed_rows = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30), st.integers(-20, 20)),
                      min_size=1, max_size=80)


@FAST
@given(keyed_rows)
def test_running_sum_and_lag(spark, rows):
    data = [(k, d, i, v) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, d int, id int, v int")
    pdf = pd.DataFrame(data, columns=["k", "d", "id", "v"]).sort_values(["k", "d", "id"])
    pdf["cum"] = pdf.groupby("k")["v"].cumsum()
    pdf["prev"] = pdf.groupby("k")["v"].shift(1)
    got = {r.id: r.cum for r in ordered.running_sum(df, ["k"], ["d", "id"], "v", "cum", splits=[-2, 0, 3]).collect()}
    assert got == dict(zip(pdf.id, pdf.cum))
    lag = {r.id: r.previous_v for r in ordered.with_previous(df, ["k"], ["d", "id"], ["v"]).collect()}
    assert lag == {i: (None if pd.isna(p) else int(p)) for i, p in zip(pdf.id, pdf.prev)}


@FAST
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-5, 5)), min_size=1, max_size=60))
def test_percentiles(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    got = {r.k: (r.a, r.b) for r in ordered.exact_percentiles(df, ["k"], "v", {"a": 0.5, "b": 0.95}).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    for k, g in pdf.groupby("k"):
        assert got[k][0] == np.percentile(g.v, 50)
        assert abs(got[k][1] - np.percentile(g.v, 95)) < 1e-9


@FAST
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200)), min_size=1, max_size=40),
       st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200)), min_size=1, max_size=40))
def test_pairs_without_pairs(spark, left, right):
    base = dt.date(2020, 1, 1)
    L = spark.createDataFrame([(c, base + dt.timedelta(days=d)) for c, d in left], "c int, d date")
    R = spark.createDataFrame([(c, base + dt.timedelta(days=d)) for c, d in right], "c int, d date")
    gaps = [r - l for cl, l in left for cr, r in right if cl == cr]
    tot = aggregates.pair_totals(L, R, "c", "d").agg(F.sum("pairs"), F.sum("diff_sum")).first()
    assert (tot[0] or 0, tot[1] or 0) == (len(gaps), sum(gaps))
    band = aggregates.band_pairs(L, R, "c", "d", 30).agg(F.sum("pairs")).first()[0] or 0
    assert band == sum(1 for g in gaps if 0 <= g <= 30)


maybe_int = st.one_of(st.none(), st.integers(0, 5))


@FAST
@given(st.lists(maybe_int, min_size=0, max_size=12), st.lists(maybe_int, min_size=0, max_size=6))
def test_not_in_matches_sql(spark, left, right):
    import duckdb
    from tabula.operators import joins
    L = spark.createDataFrame([(v,) for v in left], "v int")
    R = spark.createDataFrame([(v,) for v in right], "v int")
    got = sorted((r.v for r in joins.anti_not_in(L, R, "v").collect()), key=lambda x: (x is None, x))
    con = duckdb.connect()
    con.execute("CREATE TABLE l(v INTEGER)")
    con.execute("CREATE TABLE r(v INTEGER)")
    if left:
        con.executemany("INSERT INTO l VALUES (?)", [[v] for v in left])
    if right:
        con.executemany("INSERT INTO r VALUES (?)", [[v] for v in right])
    want = sorted((row[0] for row in con.execute("SELECT v FROM l WHERE v NOT IN (SELECT v FROM r)").fetchall()),
                  key=lambda x: (x is None, x))
    assert got == want
