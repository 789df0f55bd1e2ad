"""Bucketed layout: lineitem and orders joined without an exchange, same results."""

from tabula.plans import diner
from tabula.sources import layout
from tabula.sources.roles import Roles


def test_bucketed_join_has_no_exchange(spark, small_dir):
    names = layout.bucket_orders_and_lines(spark, small_dir, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        want = sorted(map(tuple, diner.spend_per_customer(Roles(spark, small_dir).sale(),
                                                           Roles(spark, small_dir).menu()).collect()))
        layout.use_layout(spark, small_dir, names)
        sale = Roles(spark, small_dir).sale()
        plan = sale._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin"):]
        assert "Exchange" not in join, plan  # both sides read bucket by bucket
        got = sorted(map(tuple, diner.spend_per_customer(sale, Roles(spark, small_dir).menu()).collect()))
        assert got == want
    finally:
        layout.clear_layout(spark, small_dir)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
