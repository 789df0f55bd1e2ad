"""Skew-safe operators against brute force, on data with one very hot key."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.operators import aggregates, joins, ordered


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 60)  # key 0 holds a third of all rows
        rows.append((key, rnd.randint(0, 400), i, rnd.randint(-50, 50)))
    return spark.createDataFrame(rows, "k int, d int, id int, v int")


def test_running_sum_matches_cumsum(spark, skewed):
    got = (ordered.running_sum(skewed, ["k"], ["d", "id"], "v", "cum", splits=[50, 100, 150, 200, 300, 390])
           .toPandas().sort_values(["k", "d", "id"]).reset_index(drop=True))
    want = skewed.toPandas().sort_values(["k", "d", "id"]).reset_index(drop=True)
    want["cum"] = want.groupby("k")["v"].cumsum()
    assert got["cum"].tolist() == want["cum"].tolist()


def test_hot_key_spans_several_slices(spark, skewed):
    """No task of the final window holds more than a slice of the hot key."""
    points = ordered.split_points(skewed, "d", 8)
    assert len(points) == 7
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ordered.with_previous(skewed, ["k"], ["d", "id"], ["v"], splits=points).where("k = 0")
        per_task = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 1000


def test_building_a_plan_runs_no_job(spark, skewed):
    sc = spark.sparkContext
    sc.setJobGroup("building", "")
    try:
        plans = [ordered.with_previous(skewed, ["k"], ["d", "id"], ["v"], splits=[100, 200]),
                 ordered.running_sum(skewed, ["k"], ["d", "id"], "v", "cum", splits=[100, 200]),
                 ordered.exact_percentiles(skewed, ["k"], "v", {"m": 0.5})]
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
        assert all("checkpoint" not in p._jdf.queryExecution().optimizedPlan().toString().lower() for p in plans)
    finally:
        sc._jsc.clearJobGroup()


def test_previous_matches_lag(spark, skewed):
    got = (ordered.with_previous(skewed, ["k"], ["d", "id"], ["v"]).toPandas()
           .sort_values(["k", "d", "id"]).reset_index(drop=True))
    want = skewed.toPandas().sort_values(["k", "d", "id"]).reset_index(drop=True)
    want["previous_v"] = want.groupby("k")["v"].shift(1)
    assert got["previous_v"].fillna(-999).tolist() == want["previous_v"].fillna(-999).tolist()


def test_exact_percentiles_match_linear_interpolation(spark, skewed):
    got = ordered.exact_percentiles(skewed, ["k"], "v", {"p50": 0.5, "p80": 0.8, "p95": 0.95}).toPandas()
    pdf = skewed.toPandas()
    for _, row in got.iterrows():
        vals = pdf[pdf.k == row.k].v.to_numpy()
        for name, p in (("p50", 0.5), ("p80", 0.8), ("p95", 0.95)):
            assert row[name] == pytest.approx(np.percentile(vals, p * 100), abs=1e-9)


def test_ties_for_max_is_rank_one(spark, skewed):
    counts = skewed.groupBy("k", "d").agg(F.count(F.lit(1)).alias("n"))
    got = {tuple(r) for r in aggregates.ties_for_max(counts, ["k"], "n").select("k", "d", "n").collect()}
    pdf = counts.toPandas()
    best = pdf.groupby("k")["n"].transform("max")
    want = {tuple(r) for r in pdf[pdf.n == best][["k", "d", "n"]].itertuples(index=False)}
    assert got == want


def test_latest_per_key(spark, skewed):
    got = {r.k: (r.d, r.id, r.v) for r in aggregates.latest_per_key(skewed, ["k"], ["d", "id"], ["v"]).collect()}
    pdf = skewed.toPandas().sort_values(["k", "d", "id"])
    want = {k: (g.d.iloc[-1], g.id.iloc[-1], g.v.iloc[-1]) for k, g in pdf.groupby("k")}
    assert got == want


def test_pair_counts_without_pairs(spark):
    import datetime as dt
    base = dt.date(2020, 1, 1)
    rnd = random.Random(3)
    left = [(rnd.randint(0, 3), base + dt.timedelta(days=rnd.randint(0, 300))) for _ in range(200)]
    right = [(rnd.randint(0, 3), base + dt.timedelta(days=rnd.randint(0, 300))) for _ in range(150)]
    L = spark.createDataFrame(left, "c int, d date")
    Rt = spark.createDataFrame(right, "c int, d date")
    brute = [((r[1] - l[1]).days) for l in left for r in right if l[0] == r[0]]
    tot = aggregates.pair_totals(L, Rt, "c", "d").agg(F.sum("pairs"), F.sum("diff_sum")).first()
    assert (tot[0], tot[1]) == (len(brute), sum(brute))
    band = aggregates.band_pairs(L, Rt, "c", "d", 90).groupBy("gap").agg(F.sum("pairs").alias("n")).toPandas()
    want = pd.Series([g for g in brute if 0 <= g <= 90]).value_counts()
    assert dict(zip(band.gap, band.n)) == {int(k): int(v) for k, v in want.items()}


def test_not_in_with_null_is_empty(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    right = spark.createDataFrame([("a",)], "v string")
    assert sorted(r.v for r in joins.anti_not_in(left, right, "v").collect()) == ["b"]
    right_null = spark.createDataFrame([("a",), (None,)], "v string")
    assert joins.anti_not_in(left, right_null, "v").count() == 0
    empty = spark.createDataFrame([], "v string")
    assert sorted(map(str, (r.v for r in joins.anti_not_in(left, empty, "v").collect()))) == ["None", "a", "b"]


@pytest.mark.parametrize("points", [[], [200], [0, 1, 2, 3, 100, 399, 400, 401]])
def test_slices_do_not_change_results(spark, skewed, points):
    lag = ordered.with_previous(skewed, ["k"], ["d", "id"], ["v", "d"], splits=points)
    got = sorted((r.id, r.previous_v, r.previous_d) for r in lag.collect())
    pdf = skewed.toPandas().sort_values(["k", "d", "id"])
    p, d = pdf.groupby("k")["v"].shift(1), pdf.groupby("k")["d"].shift(1)
    assert got == sorted((int(i), *((None, None) if pd.isna(x) else (int(x), int(y)))) for i, x, y in zip(pdf.id, p, d))
    numbered = ordered.position(skewed, ["k"], ["d", "id"], splits=points)
    pdf["n"] = pdf.groupby("k").cumcount() + 1
    assert {r.id: r.pos for r in numbered.collect()} == dict(zip(pdf.id, pdf.n))


def test_slices_by_date(spark):
    import datetime as dt
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    rows = [(1, day(i * 3 % 366), i, i) for i in range(300)] + [(None, None, 900, 5), (None, day(40), 901, 6), (1, None, 902, 7)]
    df = spark.createDataFrame(rows, "k int, d date, id int, v int")
    got = {r.id: r.previous_v for r in ordered.with_previous(df, ["k"], ["d", "id"], ["v"], splits=ordered.month_starts(2020, 2020)).collect()}
    ordered_rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1] or day(0), r[2]))
    assert got == {r[2]: (q[3] if q and q[0] == r[0] else None) for q, r in zip([None, *ordered_rows], ordered_rows)}
    assert ordered.split_points(df, "d", 4)[1] in {day(n) for n in range(110, 220)}


def test_percentiles_of_difficult_values(spark):
    rnd = random.Random(11)
    wide = [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300) for _ in range(400)] + [0.0, -0.0, 5e-324, -5e-324] * 3
    close = [1.0 + i * 2.0 ** -52 for i in range(500)]  # neighbours among the doubles
    tied = [7.25] * 900 + [7.5] * 5 + [None] * 40
    groups = {1: wide, 2: close, 3: tied, 4: [None], 5: [3.5], 6: [1e308, -1e308, 1e-308]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k int, v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    for r in ordered.exact_percentiles(df, ["k"], "v", probs).collect():
        values = sorted(v for v in groups[r.k] if v is not None)
        for name, p in probs.items():
            h = p * (len(values) - 1)
            want = None if not values else values[int(h)] + (h - int(h)) * (values[-(-int(h * 2**40) // 2**40)] - values[int(h)])
            assert r[name] == want, (r.k, name)


def test_percentiles_of_large_integers(spark):
    base = 2**62
    values = [base + i * 3 for i in range(-700, 700)]  # alike as doubles
    df = spark.createDataFrame([(1, v) for v in values] * 2, "k int, v bigint")
    (r,) = ordered.exact_percentiles(df, ["k"], "v", {"low": 0.0, "high": 1.0}).collect()
    assert (r.low, r.high) == (float(values[0]), float(values[-1]))
    from tabula.operators.ordered import _octave_part
    spread = [-1e300, -2.0, -1.0, -1e-9, 0.0, 5e-324, 1e-9, 1.0, 1.5, 2.0, 1e300, float("inf"), float("nan")]
    parts = [r.p for r in spark.createDataFrame([(i, v) for i, v in enumerate(spread)], "i int, v double").orderBy("i").select(_octave_part(F.col("v")).alias("p")).collect()]
    assert parts == sorted(parts)


def test_null_keys_and_values_like_sql(spark):
    rows = [(None, i, i, (None if i % 10 == 0 else 1)) for i in range(40)] + [(1, i, 100 + i, 2) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, o int, id int, v int")
    got = ordered.running_sum(df, ["k"], ["o", "id"], "v", "rs", splits=[3, 15, 30])
    assert got.columns == ["k", "o", "id", "v", "rs"]
    pdf = df.toPandas().sort_values(["o", "id"])
    want = {}
    for k, g in pdf.groupby(pdf.k.fillna(-1)):
        seen = None
        for i, v in zip(g.id, g.v):
            if not pd.isna(v):
                seen = (seen or 0) + int(v)
            want[i] = seen
    assert {r.id: r.rs for r in got.collect()} == want
    lag = ordered.with_previous(df, ["k"], ["o", "id"], ["v"])
    assert lag.columns == ["k", "o", "id", "v", "previous_v"] and lag.count() == len(rows)
    pct = ordered.exact_percentiles(spark.createDataFrame([(None, 1.0), (None, 3.0), (2, None)], "k int, v double"),
                                    ["k"], "v", {"m": 0.5})
    assert {r.k: r.m for r in pct.collect()} == {None: 2.0, 2: None}


def test_aggregate_operators_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (2, None), (2, None)], "k int, v int")
    n = {(r.k, r.v): r.n for r in aggregates.window_aggregate(df, ["k"], F.count(F.lit(1)), "n").collect()}
    assert n == {(None, 1): 2, (None, 2): 2, (1, 3): 1, (2, None): 2}
    top = sorted(map(tuple, aggregates.ties_for_max(df, ["k"], "v").collect()), key=str)
    assert top == sorted([(None, 2), (1, 3), (2, None), (2, None)], key=str)
    low = sorted(map(tuple, aggregates.ties_for_min(df, ["k"], "v").collect()), key=str)
    assert low == sorted([(None, 1), (1, 3), (2, None), (2, None)], key=str)


def test_heavy_join_spreads_hot_keys(spark):
    """70% of the rows have one key, 15% none; no task of the shuffle gets them."""
    rnd = random.Random(2)
    rows = [(i, "hot" if rnd.random() < 0.7 else None if rnd.random() < 0.5 else f"k{rnd.randrange(3000)}") for i in range(20000)]
    left = spark.createDataFrame(rows, "id int, k string").repartition(4)
    counts = left.where("k IS NOT NULL AND k <> 'k7'").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    right = counts.select("k", "n", F.concat(F.lit("name of "), "k").alias("name"))
    out = joins.heavy_join(left, right, "k", ["name"], "n", ["id"])
    assert out.columns == ["id", "k", "name"]
    assert {(r.id, r.k, r.name) for r in out.collect()} == {(i, k, None if k in (None, "k7") else f"name of {k}") for i, k in rows}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows_of = lambda df: [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("name")).collect()]
        per_task = rows_of(joins.heavy_join(left, right, "k", ["name"], "n", ["id"]))
        plain = rows_of(left.join(right.drop("n"), "k", "left"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(per_task) < 2 * 20000 / 16 and max(plain) > 0.6 * 20000


def test_range_lookup_by_day(spark):
    import datetime as dt
    rnd = random.Random(8)
    t = lambda h: dt.datetime(2023, 12, 20) + dt.timedelta(hours=h)
    bounds = sorted(rnd.sample(range(20000), 400))
    ranges = [(f"r{i}", t(a), t(b)) for i, (a, b) in enumerate(zip(bounds[::2], bounds[1::2]))] + [("empty", t(9), t(5)), ("open", None, t(7))]
    points = [(i, t(rnd.randrange(-100, 20500)) if i % 50 else None) for i in range(1500)]
    R = spark.createDataFrame(ranges, "name string, s timestamp_ntz, e timestamp_ntz")
    P = spark.createDataFrame(points, "id int, p timestamp_ntz")
    want = {(i, next((n for n, a, b in ranges if p and a and a <= p <= b), None)) for i, p in points}
    for days in (1, 32, 400):
        out = joins.range_lookup_by_day(P, R, "p", "s", "e", days)
        assert out.columns == ["id", "p", "name", "s", "e"] and {(r.id, r.name) for r in out.collect()} == want and out.count() == len(points)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
