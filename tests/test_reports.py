"""Report semantics on small invented fixtures (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tabula.plans import bank, clicks, delivery, diner, interests, mart, subscriptions
from tabula.sources.roles import Roles

D = dt.date


def test_running_balance_ties_share_value(spark):
    txn = spark.createDataFrame([
        (1, D(2020, 1, 2), "deposit", Decimal("100.00"), 1),
        (1, D(2020, 1, 2), "purchase", Decimal("30.00"), 2),   # same day: both rows see 70
        (1, D(2020, 1, 5), "withdrawal", Decimal("90.00"), 3),  # negative balance
    ], "customer_id int, txn_date date, txn_type string, txn_amount decimal(18,2), txn_id int")
    got = {r.txn_id: r.running_balance for r in bank.running_balance(txn).collect()}
    assert got == {1: 70.0, 2: 70.0, 3: -20.0}


def test_closing_balance_month_grid(spark):
    txn = spark.createDataFrame([
        (1, D(2020, 2, 10), "deposit", Decimal("50.00"), 1),    # nothing in January -> NULL
        (1, D(2020, 4, 1), "purchase", Decimal("20.00"), 2),    # March carries February
        (1, D(2021, 1, 3), "deposit", Decimal("5.00"), 3),      # second year opens at 30
    ], "customer_id int, txn_date date, txn_type string, txn_amount decimal(18,2), txn_id int")
    rows = {r.txn_year: r for r in bank.closing_balance_pivot(txn).collect()}
    assert (rows[2020].month1, rows[2020].month2, rows[2020].month3, rows[2020].month4) == (None, 50.0, 50.0, 30.0)
    assert (rows[2021].month1, rows[2021].month4) == (35.0, 35.0)
    ratios = {r.txn_year: r for r in bank.month_ratios(txn).collect()}
    assert ratios[2020].change12 is None and ratios[2020].change34 == 60.0


SUB = "customer_id int, plan_id int, start_date date, sub_id int"


def test_plan_snapshot_rules(spark):
    at = D(2020, 12, 31)
    sub = spark.createDataFrame([
        (1, 0, D(2020, 12, 28), 1), (1, 4, D(2020, 12, 30), 2),   # churn inside trial: still trial
        (2, 1, D(2020, 11, 1), 3), (2, 2, D(2020, 12, 1), 4),     # upgrade: pro now
        (3, 2, D(2020, 12, 10), 5), (3, 1, D(2020, 12, 20), 6),   # downgrade within the paid month: pro
        (4, 1, D(2020, 12, 1), 7),                                 # single row: no previous plan -> NULL
        (5, 3, D(2021, 1, 5), 8),                                  # after the snapshot: ignored
    ], SUB)
    got = {r.current_plan: r.plan_num for r in subscriptions.plan_snapshot(sub, at).collect()}
    assert got == {0: 1, 2: 2, None: 1}


def test_transitions_and_gaps(spark):
    sub = spark.createDataFrame([
        (1, 2, D(2020, 1, 1), 1), (1, 1, D(2020, 2, 1), 2),       # pro -> basic
        (2, 1, D(2020, 1, 1), 3), (2, 2, D(2020, 2, 1), 4),       # basic -> pro
        (3, 0, D(2020, 1, 1), 5), (3, 4, D(2020, 1, 8), 6),       # churn exactly 7 days after trial
        (4, 0, D(2020, 1, 1), 7), (4, 3, D(2020, 3, 1), 8), (4, 3, D(2019, 12, 1), 9),
    ], SUB)
    assert subscriptions.transitions(sub, 2, 1, 2020).first()[0] == 1
    assert subscriptions.gap_pairs(sub, 0, 4, 7).first().num_customers == 1
    rows = {r.break_period: (r.num_cus, r.avg_day_between) for r in subscriptions.day_bucket_breakdown(sub).collect()}
    assert rows == {"31-60 days": (1, 60.0), "More than 90 days": (1, -31.0)}


def test_loyalty_first_week_is_inclusive(spark):
    sale = spark.createDataFrame([("A", D(2021, 1, 7), 1), ("A", D(2021, 1, 14), 1), ("A", D(2021, 1, 15), 1),
                                  ("B", D(2021, 1, 1), 1)], "customer_id string, order_date date, product_id int")
    menu = spark.createDataFrame([(1, "ramen", Decimal("12.00"), "NOODLE")],
                                 "product_id int, product_name string, price decimal(18,2), category string")
    member = spark.createDataFrame([("A", D(2021, 1, 7))], "customer_id string, join_date date")
    got = {r.customer_id: (r.points_base, r.points_member)
           for r in diner.loyalty_points(sale, menu, member, "SUSHI").collect()}
    assert got == {"A": (360.0, 600.0), "B": (120.0, 120.0)}  # day 0 and day 7 doubled, day 8 not


def test_before_after_bounds_are_inclusive(spark):
    base = D(2020, 6, 15)
    rows = [(base + dt.timedelta(weeks=w), w) for w in range(-5, 6)]
    clean = spark.createDataFrame(rows, "week_date date, sales bigint")
    got = {r.period: r.total_sales for r in mart.before_after_totals(clean, base, 4).collect()}
    assert got == {"Before": -10, "After": 10}  # -4..-1 and 0..4
    by_year = {r.calendar_year: (r.before, r.after)
               for r in mart.before_after_by_year(clean.withColumn("calendar_year", F.year("week_date")), 6, 15, 4)
               .collect()}
    assert by_year == {2020: (-10, 10)}


def test_clean_weekly_sales_decoding(spark):
    raw = spark.createDataFrame([("15/6/20", "EU", "Retail", "C1", "New", 10, 1005),
                                 ("14/6/20", "EU", "Retail", "null", "New", 4, 9)],
                                "week_date string, region string, platforms string, segment string, "
                                "customer_type string, transactions int, sales bigint")
    got = {r.segment: r for r in mart.clean_weekly_sales(raw).collect()}
    c1 = got["C1"]
    assert (c1.week_date, c1.week_number, c1.age_band, c1.demographic, c1.avg_transaction) == \
        (D(2020, 6, 15), 3, "Young Adults", "Couples", 100)
    assert (got["unknown"].age_band, got["unknown"].week_number) == ("unknown", 2)


def test_order_description_text(spark):
    co = spark.createDataFrame([(1, 1, 1, "2, 3", "3"), (1, 2, 2, " ", "null"), (2, 1, 1, None, "9")],
                               "order_id int, line_id int, pizza_id int, exclusions string, extras string")
    names = spark.createDataFrame([(1, "Meatlovers"), (2, "Vegetarian")], "pizza_id int, pizza_name string")
    tops = spark.createDataFrame([(2, "Beef"), (3, "Bacon")], "topping_id bigint, topping_name string")
    got = {(r.order_id, r.line_id): r.order_description
           for r in delivery.order_descriptions(co, names, tops).collect()}
    assert got == {(1, 1): "Meatlovers - Exclude Bacon, Beef - Extra Bacon", (1, 2): "Vegetarian",
                   (2, 1): "Meatlovers - Extra "}


def _shuffled_records(node) -> int:
    own = node.metrics().apply("shuffleRecordsWritten").value() if node.nodeName() == "Exchange" else 0
    return own + sum(_shuffled_records(node.children().apply(i)) for i in range(node.children().size()))


def test_order_description_rows_travel_once(spark):
    """Rows without a list do not travel, others once, whatever their lists; a hot kind of pizza is spread."""
    rows = []
    for i in range(20000):
        exc, ext = [(None, "null"), ("5, 4", None), (" ", ""), (None, f"{i % 90},77"), (f"{i % 70}", None),
                    ("5, 4", None), ("5, 4", None), (f"{i % 30}", f"{i % 20}")][i % 8]
        rows.append((None if i % 1001 == 0 else i // 3, i % 3, [1, 2, 3, None][i // 8 % 4], exc, ext))
    rows += rows[:16]
    names, tops = {1: "Meatlovers", 2: "Vegetarian"}, {i: f"topping {(i * 7) % 61:02}" for i in range(60)}

    def listed(label, text):
        if text is None or text.strip() in ("", "null"):
            return ""
        return label + ", ".join(sorted(tops[int(x)] for x in text.split(",") if int(x) in tops))
    want = sorted((str(o), n, names.get(p, "") + listed(" - Exclude ", e) + listed(" - Extra ", x)) for o, n, p, e, x in rows)
    co = spark.createDataFrame(rows, "order_id int, line_id int, pizza_id int, exclusions string, extras string").repartition(4).localCheckpoint()
    menu = spark.createDataFrame(list(names.items()), "pizza_id int, pizza_name string")
    toppings = spark.createDataFrame(list(tops.items()), "topping_id bigint, topping_name string")
    set_to = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in set_to}
    for k, v in set_to.items():
        spark.conf.set(k, v)
    try:
        # the rows without a list stay with the frame, joined with a menu that is copied
        out = delivery.order_descriptions(co, F.broadcast(menu), toppings).withColumn("at", F.spark_partition_id())
        got = out.collect()
        travelled = _shuffled_records(out._jdf.queryExecution().executedPlan())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((str(r.order_id), r.line_id, r.order_description) for r in got) == want
    assert travelled < 20000 * 3 / 4 * 1.5, travelled  # and the kinds and lists
    hot = [r.at for r in got if r.order_description == "Meatlovers - Exclude topping 28, topping 35"]
    assert len(hot) > 1500 and max(map(hot.count, hot)) < 2 * len(hot) / 16


def test_visit_stats_campaign_and_cart(spark):
    ts = dt.datetime
    click = spark.createDataFrame([
        ("v1", 1, 10, 1, ts(2024, 1, 2, 10, 0), 1), ("v1", 1, 10, 2, ts(2024, 1, 2, 10, 5), 2),
        ("v1", 1, 11, 2, ts(2024, 1, 2, 10, 1), 3), ("v1", 1, 0, 3, ts(2024, 1, 2, 10, 9), 4),
        ("v2", 2, 11, 1, ts(2024, 1, 20, 9, 0), 5),                                   # between campaigns
    ], "visit_id string, user_id int, page_id bigint, event_type int, event_time timestamp_ntz, event_id int")
    pages = spark.createDataFrame([(10, "Salmon", "Fish", 10), (11, "Crab", "Shellfish", 11), (0, "Home", None, None)],
                                  "page_id bigint, page_name string, product_category string, product_id bigint")
    camp = Roles(spark, "/unused").campaigns()
    got = {r.visit_id: r for r in clicks.visit_stats(click, pages, camp).collect()}
    assert (got["v1"].cart_adds, got["v1"].purchase, got["v1"].cart_products) == (2, 1, "Crab, Salmon")
    assert got["v1"].campaign_name == "New Year Offer" and got["v2"].campaign_name is None
    funnel = {r.page_name: r for r in clicks.product_funnel(click, pages).collect()}
    assert (funnel["Salmon"].viewed, funnel["Salmon"].purchased, funnel["Crab"].abandoned) == (1, 1, 0)


def test_invalid_months_include_creation_month(spark):
    metrics = spark.createDataFrame([(1, D(2020, 3, 1)), (1, D(2020, 4, 1)), (2, D(2020, 3, 1)),
                                     (3, D(2020, 3, 1)), (4, D(2020, 1, 1)), (None, D(2019, 1, 1)), (1, None)],
                                    "interest_id bigint, month_year date")
    imap = spark.createDataFrame([(1, "a", dt.datetime(2020, 3, 10)), (2, "b", dt.datetime(2020, 3, 1)),
                                  (3, "c", dt.datetime(2020, 1, 5)), (3, "c2", dt.datetime(2020, 5, 1))],
                                 "id bigint, interest_name string, created_at timestamp_ntz")
    kept = sorted(((r.interest_id, r.month_year) for r in interests.drop_invalid(metrics, imap).collect()),
                  key=str)
    # 1/March is before creation (10 March); 3 is invalid through its later map row; 4 has no map row;
    # NULL ids and months never count as invalid.
    assert kept == sorted([(1, D(2020, 4, 1)), (2, D(2020, 3, 1)), (4, D(2020, 1, 1)), (None, D(2019, 1, 1)),
                           (1, None)], key=str)


def test_cumulative_share_truncates(spark):
    metrics = spark.createDataFrame([(i, D(2020, m, 1)) for i in range(3) for m in range(1, 3 - i + 1)],
                                    "interest_id bigint, month_year date")
    got = [(r.total_months, r.cumulative_percentage) for r in
           interests.cumulative_share(metrics, 0).orderBy("total_months").collect()]
    assert got == [(1, 100), (2, 66), (3, 33)]


@pytest.mark.parametrize("weeks", [4, 12])
def test_before_after_change_shape(spark, weeks):
    base = D(2020, 6, 15)
    clean = spark.createDataFrame([(base - dt.timedelta(weeks=1), 100), (base, 150)], "week_date date, sales bigint")
    row = {r.weeks: r for r in mart.before_after_change(clean, base, (weeks,)).collect()}[weeks]
    assert (row.sales_difference, row.sales_percentage_change) == (50, 50.0)


def test_kept_metrics_equals_typed_then_deleted(spark):
    raw = spark.createDataFrame([("1", "2020", "01-2020", "7"), ("NULL", "NULL", "NULL", "8"),
                                 ("1", "2021", "01-2021", "NULL"), (None, None, None, None)],
                                "_month string, _year string, month_year string, interest_id string")
    a = sorted(map(tuple, interests.kept_metrics(raw).collect()))
    b = sorted(map(tuple, interests.drop_null_keys(interests.typed_metrics(raw)).collect()))
    assert a == b == [(1, 2020, D(2020, 1, 1), 7)]


def test_visit_start_ignores_unknown_pages(spark):
    ts = dt.datetime
    click = spark.createDataFrame([
        ("v1", 1, 999, 1, ts(2024, 1, 2, 9, 0), 1),    # unknown page: counted, not the start
        ("v1", 1, 10, 1, ts(2024, 1, 2, 10, 0), 2),
        ("v2", 2, 999, 1, ts(2024, 1, 3, 10, 0), 3),   # only unknown pages: no row
    ], "visit_id string, user_id int, page_id bigint, event_type int, event_time timestamp_ntz, event_id int")
    pages = spark.createDataFrame([(10, "Salmon", "Fish", 10)],
                                  "page_id bigint, page_name string, product_category string, product_id bigint")
    got = {r.visit_id: r for r in clicks.visit_stats(click, pages, Roles(spark, "/unused").campaigns()).collect()}
    assert set(got) == {"v1"}
    assert (got["v1"].visit_start_time, got["v1"].page_views) == ("2024-01-02 10:00:00.000000", 2)


def test_between_includes_last_day(spark):
    sub = spark.createDataFrame([(1, 3, D(2021, 1, 1), 1), (2, 3, D(2021, 1, 2), 2), (3, 3, D(2020, 1, 1), 3)], SUB)
    assert subscriptions.upgrades_between(sub, 3, D(2020, 1, 1), D(2021, 1, 1)).first()[0] == 2


def test_zero_divisors_give_null(spark):
    clean = spark.createDataFrame([(2020, 1, "Retail", 10), (2020, 1, "Shopify", 0), (2020, 2, "Retail", 5)],
                                  "calendar_year bigint, month_number bigint, platforms string, sales bigint")
    got = {r.month_number: r.ratio for r in mart.channel_ratio(clean, "Retail", "Shopify").collect()}
    assert got == {1: None, 2: None}
    stats = spark.createDataFrame([("v1", 1, 0, 0, 1, "A", 1, 0), ("v2", 2, 4, 1, 1, "A", 1, 1)],
                                  "visit_id string, user_id int, page_views bigint, cart_adds bigint, "
                                  "purchase bigint, campaign_name string, impression bigint, click bigint")
    row = clicks.campaign_summary(stats, 1).first()
    assert (row.purchased_rate, row.click_rate, row.impressed_users) == (25.0, 50.0, 100.0)


def test_pivot_counts_empty_cell_as_zero(spark):
    co = spark.createDataFrame([(1, 1, 7, 1, None, None)],
                               "order_id int, line_id int, customer_id int, pizza_id int, exclusions string, "
                               "extras string")
    ro = spark.createDataFrame([(1, 5, None, "10km", "20 mins", None)],
                               "order_id int, runner_id int, pickup_time timestamp_ntz, distance string, "
                               "duration string, cancellation string")
    names = spark.createDataFrame([(1, "Meatlovers"), (2, "Vegetarian")], "pizza_id int, pizza_name string")
    row = delivery.pizzas_per_customer_pivot(co, ro, names).first()
    assert (row.meatlovers, row.vegetarian) == (1, 0)


def test_funnel_null_visits_follow_in_and_not_in(spark):
    import duckdb

    from tabula.plans.registry import _FUNNEL
    ts = dt.datetime
    rows = [("v1", 1, 10, 2, ts(2024, 1, 2, 10, 0), 1), ("v1", 1, 10, 3, ts(2024, 1, 2, 10, 5), 2),
            ("v2", 2, 10, 2, ts(2024, 1, 3, 10, 0), 3), (None, None, 10, 2, ts(2024, 1, 4, 10, 0), 4),
            (None, None, 10, 1, ts(2024, 1, 4, 11, 0), 5)]
    schema = "visit_id string, user_id int, page_id bigint, event_type int, event_time timestamp_ntz, event_id int"
    pages = [(10, "Salmon", "Fish", 10)]
    pschema = "page_id bigint, page_name string, product_category string, product_id bigint"
    for extra_null_purchase in (False, True):
        data = rows + ([(None, None, 10, 3, ts(2024, 1, 5, 9, 0), 6)] if extra_null_purchase else [])
        click = spark.createDataFrame(data, schema)
        page_df = spark.createDataFrame(pages, pschema)
        got = clicks.product_funnel(click, page_df).first()
        con = duckdb.connect()
        con.register("click", click.toPandas())
        con.register("page_hierarchy", page_df.toPandas())
        want = con.sql(_FUNNEL).fetchall()[0]
        assert (got.viewed, got.added_to_cart, got.abandoned, got.purchased) == tuple(want[3:])
    # without a NULL purchase: v2 abandoned, NULL-visit add neither; with one: nothing is abandoned
    assert want[3:] == (1, 3, 0, 1)


def test_weekly_null_segment_decodes_like_source(spark):
    raw = spark.createDataFrame([("15/6/20", "EU", "Retail", None, "New", 10, 100)],
                                "week_date string, region string, platforms string, segment string, "
                                "customer_type string, transactions int, sales bigint")
    row = mart.clean_weekly_sales(raw).first()
    assert (row.segment, row.age_band, row.demographic) == (None, "Retirees", "Families")


def test_null_spellings_in_metrics(spark):
    raw = spark.createDataFrame([(" null ", "Null", "01-2020", "NULL "), ("1", "2020", "01-2020", "7")],
                                "_month string, _year string, month_year string, interest_id string")
    rows = interests.typed_metrics(raw).collect()
    assert [tuple(r) for r in rows] == [(None, None, D(2020, 1, 1), None), (1, 2020, D(2020, 1, 1), 7)]
    assert interests.kept_metrics(raw).count() == 1


def test_users_through_their_cookies(spark):
    """Users with several cookies, a cookie of two users, one of none and a missing one."""
    t = lambda m: dt.datetime(2024, 1, 5, 10, m)
    click = spark.createDataFrame([
        ("v1", "a", 1, 1, t(5)), ("v1", "a", 1, 2, t(3)), ("v1", "b", 1, 1, t(1)), ("v2", "b", 99, 1, t(0)),  # page 99 is unknown
        ("v2", "shared", 2, 1, t(9)), ("v3", "nobody", 1, 1, t(2)), ("v4", None, 1, 1, t(4)),
    ], "visit_id string, cookie_id string, page_id int, event_type int, event_time timestamp_ntz")
    users = spark.createDataFrame([(1, "a"), (1, "b"), (1, "never seen"), (2, "shared"), (3, "shared"), (4, "idle"), (5, None)],
                                  "user_id int, cookie_id string")
    pages = spark.createDataFrame([(1,), (2,)], "page_id int")
    (r,) = clicks.cookies_per_user(click, users).collect()
    assert (r.num_user, r.avg_num_cookies, r.avg_num_cookies_int, r.avg_distinct_cookies) == (5, 2.0, 2, 1.3333)  # 4, 1 and 1 events
    got = [(v.visit_id, v.user_id, v.visit_start_time[11:16], v.page_views, v.cart_adds) for v in clicks.visits_of_users(click, pages, users).collect()]
    assert got == [("v1", 1, "10:01", 2, 1), ("v2", 2, "10:09", 1, 0), ("v2", 3, "10:09", 1, 0)]


def test_ingredients_of_a_recipe(spark):
    names = spark.createDataFrame([(1, "Meat"), (2, "Veg"), (3, "Unknown"), (4, "None")], "pizza_id int, pizza_name string")
    recipes = spark.createDataFrame([(1, "2, 1,x, 2"), (2, "3"), (3, "77, 78"), (4, None)], "pizza_id int, toppings string")
    toppings = spark.createDataFrame([(1, "Bacon"), (2, "Anchovy"), (3, "Corn")], "topping_id bigint, topping_name string")
    got = {r.pizza_id: (r.pizza_name, r.toppings) for r in delivery.standard_ingredients(names, recipes, toppings).collect()}
    assert got == {1: ("Meat", "Anchovy, Anchovy, Bacon"), 2: ("Veg", "Corn")}


def test_ledger_rows_without_customer_or_date(spark):
    txn = spark.createDataFrame([
        (None, D(2020, 1, 2), "deposit", Decimal("10.00"), 1), (None, D(2020, 2, 2), "deposit", Decimal("5.00"), 2),
        (1, None, "deposit", Decimal("100.00"), 3), (1, D(2020, 1, 5), "purchase", Decimal("30.00"), 4), (None, None, "purchase", Decimal("1.00"), 5),
    ], "customer_id int, txn_date date, txn_type string, txn_amount decimal(18,2), txn_id int")
    got = {r.txn_id: r.running_balance for r in bank.running_balance(txn).collect()}
    assert got == {1: 9.0, 2: 14.0, 3: 100.0, 4: 70.0, 5: -1.0}  # a missing date comes before all dates
    closing = {(r.customer_id, r.txn_year, r.txn_month): r.closing_balance for r in bank.monthly_closing(txn).collect()}
    assert closing == {(None, None, None): -1.0, (None, 2020, 1): 9.0, (None, 2020, 2): 14.0, (1, None, None): 100.0, (1, 2020, 1): 70.0}
    grid = {(r.customer_id, r.txn_year): (r.month1, r.month2) for r in bank.closing_balance_pivot(txn).collect()}
    assert grid == {(None, None): (None, None), (None, 2020): (9.0, 14.0), (1, None): (None, None), (1, 2020): (70.0, 70.0)}


def test_present_in_all_months(spark):
    metrics = spark.createDataFrame([(1, m, D(2020, m, 1)) for m in (1, 2, 3)] + [(1, 1, D(2021, 1, 1)), (2, 1, D(2020, 1, 1)), (2, 2, D(2020, 2, 1)),
                                    (2, 3, D(2020, 3, 1)), (3, 1, D(2020, 1, 1)), (None, 1, D(2020, 1, 1))], "interest_id int, _month int, month_year date")
    named = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id int, interest_name string")
    assert [tuple(r) for r in interests.present_in_all_months(metrics, named).collect()] == [(1, "one")]
    assert sorted(tuple(r) for r in interests.present_in_all_months(metrics, named, "_month").collect()) == [(1, "one"), (2, "two")]
