"""Physical-plan properties of every registered report."""

import re

import pytest

import __spark_entry__ as entry

KEYS = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))  # those have tests of their own
# Keys whose plans may hold a nested-loop join: the broadcast campaign range
# lookup (3 literal rows) or a cross join with a one-row aggregate.
NESTED_LOOP_OK = {
    "campaign_range_join", "visit_stats", "campaign_effect", "campaign_effect_click", "campaign_summary",
    "anti_join_not_in", "self_join_gap", "plans_after_trial", "day_bucket_breakdown", "plan_snapshot_at_date",
    "anti_join_orphans", "relational_division", "materialize_visit_stats",
    # SQL functions: the distinct arguments of the calls, as a table, meet the rows they ask for
    "sql_sales_functions", "sql_balance_function",
    # heavy keys: one-row total, see joins.heavy_join
    "order_description", "relational_division_months", "cookies_per_user",
    # the funnel's one-row "a purchase has a NULL visit" flag (NOT IN semantics)
    "product_funnel", "product_funnel_rates", "category_funnel",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_python_and_bounded_nested_loops(spark, small_dir, key):
    plan = plan_of(entry.queries()[key](spark, small_dir))
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", plan), plan
    if key not in NESTED_LOOP_OK:
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, plan


def test_projection_prunes_columns(spark, small_dir):
    plan = plan_of(entry.queries()["scan_project"](spark, small_dir))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == [
        "l_discount", "l_extendedprice", "l_linenumber", "l_orderkey"]


@pytest.mark.parametrize("key, pushed", [
    ("filter_compare", "GreaterThanOrEqual(o_orderdate,1999-01-01"),
    ("filter_between", "GreaterThanOrEqual(o_orderdate,1998-01-01"),
    ("plan_snapshot_at_date", "LessThan(o_orderdate,1999-01-01"),
])
def test_date_filters_reach_scan(spark, small_dir, key, pushed):
    plan = plan_of(entry.queries()[key](spark, small_dir))
    filters = " ".join(re.findall(r"PushedFilters: (.{0,200})", plan))
    assert pushed in filters, filters


def test_campaign_lookup_is_broadcast(spark, small_dir):
    plan = plan_of(entry.queries()["campaign_range_join"](spark, small_dir))
    assert "BroadcastNestedLoopJoin" in plan and "BroadcastExchange" in plan


# Single-partition exchanges not fed by a partial aggregate, each over a
# bounded frame: the cumulative-share window (one row per distinct month
# count) and the share of a plan among all plans (one row per plan).
SINGLE_PARTITION_OK = {"cumulative_share", "plan_snapshot_at_date", "sql_plan_function"}


@pytest.mark.parametrize("key", KEYS)
def test_single_partition_only_after_partial_aggregates(spark, small_dir, key):
    lines = plan_of(entry.queries()[key](spark, small_dir)).split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and key not in SINGLE_PARTITION_OK:
            child = lines[i + 1]
            assert "HashAggregate(keys=[]" in child and "partial_" in child, "\n".join(lines[i:i + 3])


@pytest.mark.parametrize("key", ["first_item_per_customer", "rank_top_item", "split_explode_join"])
def test_lines_are_read_once(spark, small_dir, key):
    plan = plan_of(entry.queries()[key](spark, small_dir))
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1, plan


@pytest.mark.parametrize("key", ["first_after_event", "last_before_event"])
def test_purchases_around_joining_read_lines_once(spark, small_dir, key):
    plan = plan_of(entry.queries()[key](spark, small_dir))
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 2, plan  # sales, and the members


def test_rank_limit_comes_before_the_shuffle(spark, small_dir):
    plan = plan_of(entry.queries()["rank_top_item"](spark, small_dir))
    assert plan.count("WindowGroupLimit") == 2, plan  # partial and final


@pytest.mark.parametrize("key", sorted(entry.ORDERS))
def test_sorted_reports_end_in_a_sort(spark, small_dir, key):
    plan = plan_of(entry.queries()[key](spark, small_dir))
    # a window over all of a few rows leaves them in one partition
    assert "rangepartitioning" in plan or "TakeOrderedAndProject" in plan or key in SINGLE_PARTITION_OK and "], true, 0" in plan, plan
