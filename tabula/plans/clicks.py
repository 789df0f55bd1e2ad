"""Web-shop click-stream reports: funnels, visits and campaign effects.

The source answers each funnel column with its own correlated subquery over
the events (four scans per product page). Here the visit-level purchase flag
is one grouped aggregate, joined back once, and every product / visit metric
is a conditional count in a single grouped pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabula.operators.joins import anti_not_in, range_lookup, semi_in
from tabula.sources.sinks import materialize

VIEW, CART_ADD, PURCHASE, IMPRESSION, AD_CLICK = 1, 2, 3, 4, 5


def _count_if(cond):
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def _purchase_visits(click: DataFrame) -> DataFrame:
    return click.filter(F.col("event_type") == PURCHASE).select("visit_id").distinct()


def user_summary(click: DataFrame) -> DataFrame:
    """Users, and average events ('cookies') per user; events without a user
    belong to none."""
    per_user = click.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.agg(F.count(F.lit(1)).alias("num_user"), F.round(F.avg("n"), 4).alias("avg_events_per_user"),
                        F.expr("sum(n) div count(n)").alias("avg_events_per_user_int"))


def cookies_per_user(click: DataFrame, users: DataFrame) -> DataFrame:
    """Users, and how many events and cookies each has on average, through the
    users' cookies: an event belongs to the users that own its cookie, and one
    whose cookie nobody owns to none. Events are counted per cookie before they
    meet the users."""
    per_cookie = click.filter(F.col("cookie_id").isNotNull()).groupBy("cookie_id").agg(F.count(F.lit(1)).alias("n"))
    owned = users.select("user_id", "cookie_id").filter(F.col("cookie_id").isNotNull())
    per_user = per_cookie.join(owned, "cookie_id").groupBy("user_id").agg(
        F.sum("n").alias("n"), F.countDistinct("cookie_id").alias("cookies"))
    all_users = users.agg(F.countDistinct("user_id").alias("num_user"))  # one row, as is the next
    return all_users.crossJoin(per_user.agg(
        F.round(F.avg("n"), 4).alias("avg_num_cookies"), F.expr("sum(n) div count(n)").alias("avg_num_cookies_int"),
        F.round(F.avg("cookies"), 4).alias("avg_distinct_cookies")))


def visits_of_users(click: DataFrame, pages: DataFrame, users: DataFrame) -> DataFrame:
    """One row per visit and user: start and numbers of views and cart adds of
    the visit's events on known pages with a cookie of the user (pages and
    users are inner joins, the latter in two steps through the cookie). A
    cookie with several owners counts for each."""
    is_type = lambda t: _count_if(F.col("event_type") == t)
    per_cookie = click.groupBy("visit_id", "cookie_id", "page_id").agg(
        is_type(VIEW).alias("v"), is_type(CART_ADD).alias("a"), F.min("event_time").alias("first"))
    on_pages = per_cookie.join(pages.select("page_id"), "page_id", "left_semi").groupBy("visit_id", "cookie_id").agg(
        F.sum("v").alias("v"), F.sum("a").alias("a"), F.min("first").alias("first"))
    rows = on_pages.join(users.select("user_id", "cookie_id"), "cookie_id")
    return rows.groupBy("visit_id", "user_id").agg(
        F.date_format(F.min("first"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("visit_start_time"),
        F.sum("v").cast("bigint").alias("page_views"), F.sum("a").cast("bigint").alias("cart_adds")).orderBy("user_id", "visit_id")


def visits_by_month(click: DataFrame) -> DataFrame:
    return click.groupBy(F.year("event_time").cast("bigint").alias("event_year"),
                         F.month("event_time").cast("bigint").alias("event_month")).agg(
        F.countDistinct("visit_id").alias("unique_num_visits")).orderBy("event_year", "event_month")


def events_by_name(click: DataFrame, event_names: DataFrame) -> DataFrame:
    per_type = click.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))  # aggregate before the lookup
    return per_type.join(event_names, "event_type").groupBy("event_name").agg(F.sum("n").alias("num_events")).orderBy(
        F.desc("num_events"), "event_name")


def purchase_share(click: DataFrame) -> DataFrame:
    """Visits, visits with a purchase, and the percentage (one aggregate pass)."""
    g = click.agg(F.countDistinct("visit_id").alias("total_visits"),
                  F.countDistinct(F.when(F.col("event_type") == PURCHASE, F.col("visit_id"))).alias("purchased"))
    return g.select("total_visits", "purchased",
                    F.round(F.col("purchased") * 100.0 / F.nullif(F.col("total_visits"), F.lit(0)), 4)
                    .alias("percent_purchase"))


def checkout_without_purchase(click: DataFrame, checkout_page: int = 12) -> DataFrame:
    """Visits that reached the checkout page but are NOT IN the purchase visits."""
    checkout = click.filter(F.col("page_id") == checkout_page).select("visit_id")
    missing = anti_not_in(checkout, click.filter(F.col("event_type") == PURCHASE).select("visit_id"), "visit_id")
    n = missing.agg(F.countDistinct("visit_id").alias("checkout_without_purchase"))
    total = click.agg(F.countDistinct("visit_id").alias("total_visits"))
    return total.crossJoin(n).select(  # one-row frames
        "total_visits", "checkout_without_purchase",
        F.round(F.col("checkout_without_purchase") * 100.0 / F.nullif(F.col("total_visits"), F.lit(0)), 4)
        .alias("percent_checkout_without_purchase"))


def _per_page(events: DataFrame, *aggs) -> DataFrame:
    """Aggregate events per page_id first: page ids are few and hot, so the
    events never travel to a join keyed by them -- only one row per page does."""
    return events.groupBy("page_id").agg(*aggs)


def top_pages(click: DataFrame, pages: DataFrame, k: int = 3) -> DataFrame:
    views = _per_page(click.filter(F.col("event_type") == VIEW), F.count(F.lit(1)).alias("n"))
    counts = views.join(pages_in_use(click, pages), "page_id").groupBy("page_name").agg(F.sum("n").alias("page_views"))
    return counts.orderBy(F.desc("page_views"), F.asc_nulls_last("page_name")).limit(k)


def cart_adds_in_purchase_visits(click: DataFrame, pages: DataFrame) -> DataFrame:
    """Cart adds per page among visits IN (visits with a purchase)."""
    # one row per (visit, page) meets the visits, so a hot visit brings its pages, not its events
    adds = click.filter(F.col("event_type") == CART_ADD).groupBy("visit_id", "page_id").agg(F.count(F.lit(1)).alias("n"))
    bought = _per_page(semi_in(adds, _purchase_visits(click), "visit_id"), F.sum("n").alias("n"))
    return bought.join(pages, "page_id").groupBy("page_name").agg(F.sum("n").alias("num_purchased"))


def top_purchased_products(click: DataFrame, pages: DataFrame, k: int = 3) -> DataFrame:
    """TOP k pages by cart adds in visits with a purchase; name breaks ties."""
    counts = cart_adds_in_purchase_visits(click, pages)
    return counts.orderBy(F.desc("num_purchased"), F.asc_nulls_last("page_name")).limit(k)


def category_views(click: DataFrame, pages: DataFrame) -> DataFrame:
    per = _per_page(click, _count_if(F.col("event_type") == VIEW).alias("v"),
                    _count_if(F.col("event_type") == CART_ADD).alias("a"))
    rows = per.join(pages, "page_id").filter(F.col("product_category").isNotNull())
    return rows.groupBy("product_category").agg(F.sum("v").cast("bigint").alias("page_views"),
                                                F.sum("a").cast("bigint").alias("add_carts"))


def product_funnel(click: DataFrame, pages: DataFrame) -> DataFrame:
    """Per product page: views, cart adds, abandoned adds (visit without a
    purchase) and purchased adds (visit with a purchase); most purchased first."""
    return _funnel(click, pages).orderBy(F.desc("purchased"), "page_id")


def _funnel(click: DataFrame, pages: DataFrame) -> DataFrame:
    # (visit, page) counts and the visit's purchase flag are both aggregates;
    # only they meet in the join, never the raw events. IN / NOT IN rules of
    # the source: a NULL visit is neither purchased nor abandoned, and a NULL
    # visit among the purchases makes NOT IN unknown, so nothing is abandoned.
    is_purchase = (F.col("event_type") == PURCHASE).cast("int")
    flag = (click.filter(F.col("visit_id").isNotNull()).groupBy("visit_id")
            .agg(F.max(is_purchase).alias("bought")))
    null_buyer = click.agg(F.max(is_purchase * F.col("visit_id").isNull().cast("int")).alias("__nb"),
                           F.max(is_purchase).alias("__any"))
    per_visit_page = click.groupBy("visit_id", "page_id").agg(
        _count_if(F.col("event_type") == VIEW).alias("v"), _count_if(F.col("event_type") == CART_ADD).alias("a"))
    no_purchases = F.coalesce(F.col("__any"), F.lit(0)) == 0  # NOT IN (empty set) holds for every row
    abandon = no_purchases | ((F.col("bought") == 0) & (F.coalesce(F.col("__nb"), F.lit(0)) == 0))
    per_page = (per_visit_page.join(flag, "visit_id", "left")
                .crossJoin(F.broadcast(null_buyer))  # one row by construction
                .groupBy("page_id").agg(
                    F.sum("v").alias("viewed"), F.sum("a").alias("added_to_cart"),
                    F.sum(F.when(abandon, F.col("a")).otherwise(0)).alias("abandoned"),
                    F.sum(F.when(F.col("bought") == 1, F.col("a")).otherwise(0)).alias("purchased")))
    named = per_page.join(pages, "page_id").filter(F.col("product_category").isNotNull())
    return named.select("page_id", "page_name", "product_category",
                        *[F.col(c).cast("bigint").alias(c) for c in ("viewed", "added_to_cart", "abandoned",
                                                                     "purchased")])


def _rates(df: DataFrame) -> DataFrame:
    def pct(a, b):
        return F.round(F.col(a) * 100.0 / F.nullif(F.col(b), F.lit(0)), 4)
    return (df.withColumn("viewed_to_purchased", pct("purchased", "viewed"))
            .withColumn("conversion_rate_add_cart", pct("added_to_cart", "viewed"))
            .withColumn("conversion_purchase", pct("purchased", "added_to_cart")))


def product_funnel_rates(click: DataFrame, pages: DataFrame) -> DataFrame:
    """Sorted by cart-add rate, view-to-purchase rate and purchases, descending."""
    out = _rates(_funnel(click, pages)).drop("product_category")
    return out.orderBy(F.desc("conversion_rate_add_cart"), F.desc("viewed_to_purchased"), F.desc("purchased"), "page_id")


def category_funnel(click: DataFrame, pages: DataFrame) -> DataFrame:
    f = _funnel(click, pages)
    g = f.groupBy("product_category").agg(*[F.sum(c).alias(c) for c in
                                            ("viewed", "added_to_cart", "abandoned", "purchased")])
    return _rates(g)


def visit_starts(click: DataFrame) -> DataFrame:
    return click.groupBy("visit_id", "user_id").agg(F.min("event_time").alias("visit_start_time"))


def campaign_of_visit(click: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Each visit with the campaign running at its first event (NULL if none).
    The source filters the campaign table by an outer aggregate; here the
    visit start is aggregated first and then range-joined."""
    starts = visit_starts(click)
    out = range_lookup(starts, campaigns, "visit_start_time", "start_date", "end_date")
    return out.select("visit_id", "user_id",
                      F.date_format("visit_start_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("visit_start_time"),
                      "campaign_name")


def pages_in_use(click: DataFrame, pages: DataFrame) -> DataFrame:
    """The page rows some event refers to. The distinct event page ids are
    tiny after aggregation, so AQE measures them and broadcasts them into the
    page scan; the result is again small and is broadcast into event joins at
    run time -- or stays a shuffle join if it turns out large."""
    return pages.join(click.select("page_id").distinct(), "page_id", "left_semi")


def visit_stats(click: DataFrame, pages: DataFrame, campaigns: DataFrame) -> DataFrame:
    """``visit_rows`` sorted by user and visit."""
    return visit_rows(click, pages, campaigns).orderBy("user_id", "visit_id")


def visit_counts(click: DataFrame, pages: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row per visit and user: start time, page views, cart adds, purchase
    flag, campaign, impressions and ad clicks.

    A visit is listed, and its start taken, over its events on known pages
    (the source inner-joins the page table); its counts cover all its events
    (the source's correlated subqueries), of all its users. Events are read
    once and counted per (visit, user, page) before they meet the pages.
    """
    per_page = click.filter(F.col("visit_id").isNotNull()).groupBy("visit_id", "user_id", "page_id").agg(
        _count_if(F.col("event_type") == VIEW).alias("v"), _count_if(F.col("event_type") == CART_ADD).alias("a"),
        F.max((F.col("event_type") == PURCHASE).cast("bigint")).alias("p"),
        _count_if(F.col("event_type") == IMPRESSION).alias("i"), _count_if(F.col("event_type") == AD_CLICK).alias("c"),
        F.min("event_time").alias("first"))
    rows = per_page.join(pages.select("page_id", F.lit(True).alias("known")), "page_id", "left")
    per_user = rows.groupBy("visit_id", "user_id").agg(
        *[F.sum(c).alias(c) for c in ("v", "a", "i", "c")], F.max("p").alias("p"), F.min(F.when(F.col("known"), F.col("first"))).alias("visit_start_time"))
    visit = Window.partitionBy("visit_id")  # a row per user of the visit
    g = per_user.select("visit_id", "user_id", "visit_start_time", F.sum("v").over(visit).alias("page_views"), F.sum("a").over(visit).alias("cart_adds"),
                        F.max("p").over(visit).alias("purchase"), F.sum("i").over(visit).alias("impression"), F.sum("c").over(visit).alias("click"))
    return range_lookup(g.filter(F.col("visit_start_time").isNotNull()), campaigns, "visit_start_time", "start_date", "end_date")


def visit_rows(click: DataFrame, pages: DataFrame, campaigns: DataFrame) -> DataFrame:
    """``visit_counts`` and the visit's cart products, in event order; only
    cart adds of product pages are gathered."""
    products = pages.filter(F.col("product_id").isNotNull() & F.col("page_name").isNotNull()).select("page_id", "page_name")
    adds = click.filter((F.col("event_type") == CART_ADD) & F.col("visit_id").isNotNull()).join(products, "page_id")
    items = F.array_sort(F.collect_list(F.struct("event_time", "event_id", "page_name")))
    carts = adds.groupBy("visit_id").agg(F.array_join(F.transform(items, lambda e: e["page_name"]), ", ").alias("cart_products"))
    g = visit_counts(click, pages, campaigns).join(carts, "visit_id", "left")
    return g.select("visit_id", "user_id",
                    F.date_format("visit_start_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("visit_start_time"),
                    "page_views", "cart_adds", "purchase", "campaign_name", "impression", "click", "cart_products")


def materialized_visit_stats(spark: SparkSession, click: DataFrame, pages: DataFrame,
                             campaigns: DataFrame, name: str = "campaign_stats") -> DataFrame:
    """``SELECT ... INTO campaign_stats``: written to the shared table folder and read back."""
    return materialize(spark, visit_rows(click, pages, campaigns), name)


def _with_purchase_rate(stats: DataFrame) -> DataFrame:
    return stats.withColumn("purchased",
                            F.col("purchase") * 100.0 / F.nullif(F.col("page_views"), F.lit(0)))


def campaign_effect(stats: DataFrame, by=("impression",)) -> DataFrame:
    s = _with_purchase_rate(stats).filter(F.col("campaign_name").isNotNull())
    return s.groupBy(*by).agg(F.sum("page_views").alias("viewed"), F.sum("cart_adds").alias("cart_adds"),
                              F.sum("purchase").alias("purchase"),
                              F.round(F.avg("purchased"), 4).alias("purchased_rate"))


def campaign_summary(stats: DataFrame, impressions: int = 1) -> DataFrame:
    """Per campaign, over visits with exactly ``impressions`` impressions:
    share of all users, views, cart adds, purchases, impressions, clicks,
    click rate and average purchase rate.

    The visits are summed per (campaign, user) first; the users of a campaign
    and of all visits are rows of that table.
    """
    s = _with_purchase_rate(stats)
    qualifies = (F.col("impression") == impressions) & F.col("campaign_name").isNotNull()
    sums = {"page_views": "page_views", "cart_adds": "card_adds", "purchase": "purchased", "impression": "impression", "click": "click"}
    per_user = s.groupBy(F.when(qualifies, F.col("campaign_name")).alias("campaign_name"), "user_id").agg(
        *[F.sum(c).alias(name) for c, name in sums.items()], F.sum("purchased").alias("__rates"), F.count("purchased").alias("__n"))
    everyone = per_user.agg(F.countDistinct("user_id").alias("__users"))  # one row
    g = per_user.filter(F.col("campaign_name").isNotNull()).groupBy("campaign_name").agg(
        F.count("user_id").alias("u"), *[F.sum(c).alias(c) for c in sums.values()],
        F.round(F.sum("__rates") / F.nullif(F.sum("__n"), F.lit(0)), 4).alias("purchased_rate")).crossJoin(F.broadcast(everyone))
    return g.select(
        "campaign_name",
        F.round(F.col("u") * 100.0 / F.nullif(F.col("__users"), F.lit(0)), 4).alias("impressed_users"),
        "page_views", "card_adds", "purchased", "impression", "click",
        F.round(F.col("click") * 100.0 / F.nullif(F.col("impression"), F.lit(0)), 4).alias("click_rate"),
        "purchased_rate").orderBy("campaign_name")
