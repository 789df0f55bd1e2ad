"""Role views carry the column names and types the reports expect (FIXTURES.md)."""

import pytest

from tabula.sources.roles import Roles

EXPECTED = {
    "sale": {"customer_id": "bigint", "order_date": "date", "product_id": "bigint"},
    "menu": {"product_id": "bigint", "product_name": "string", "price": "decimal(18,2)"},
    "member": {"customer_id": "bigint", "join_date": "date"},
    "plans": {"plan_id": "int", "plan_name": "string", "price": "decimal(5,2)"},
    "sub": {"customer_id": "bigint", "plan_id": "int", "start_date": "date", "sub_id": "bigint"},
    "stay": {"customer_id": "bigint", "region_id": "int", "node_id": "bigint", "start_date": "date",
             "end_date": "date"},
    "regions": {"region_id": "int", "region_name": "string"},
    "txn": {"customer_id": "bigint", "txn_date": "date", "txn_type": "string", "txn_amount": "decimal(18,2)"},
    "weekly_sales": {"week_date": "string", "region": "string", "platforms": "string", "segment": "string",
                     "customer_type": "string", "transactions": "bigint", "sales": "bigint"},
    "click": {"visit_id": "string", "user_id": "bigint", "page_id": "bigint", "event_type": "int",
              "event_time": "timestamp_ntz"},
    "page_hierarchy": {"page_id": "bigint", "page_name": "string", "product_category": "string",
                       "product_id": "bigint"},
    "event_names": {"event_type": "int", "event_name": "string"},
    "campaigns": {"campaign_name": "string", "start_date": "timestamp_ntz", "end_date": "timestamp_ntz"},
    "interest_metrics": {"_month": "string", "_year": "string", "month_year": "string", "interest_id": "string"},
    "interest_map": {"id": "bigint", "interest_name": "string", "interest_summary": "string",
                     "created_at": "timestamp_ntz", "last_modified": "timestamp_ntz"},
    "customer_orders": {"order_id": "bigint", "customer_id": "bigint", "pizza_id": "int", "exclusions": "string",
                        "extras": "string", "order_time": "timestamp_ntz"},
    "runner_orders": {"order_id": "bigint", "runner_id": "bigint", "pickup_time": "timestamp_ntz",
                      "distance": "string", "duration": "string", "cancellation": "string"},
    "runners": {"runner_id": "bigint", "registration_date": "date"},
    "toppings": {"topping_id": "bigint", "topping_name": "string"},
    "pizza_names": {"pizza_id": "int", "pizza_name": "string"},
}


@pytest.mark.parametrize("role", sorted(EXPECTED))
def test_role_schema(spark, small_dir, role):
    df = getattr(Roles(spark, small_dir), role)()
    types = dict(df.dtypes)
    for col, typ in EXPECTED[role].items():
        assert types.get(col) == typ, (role, col, types.get(col))
    assert df.limit(1).count() == 1


def test_dirty_spellings_present(spark, small_dir):
    r = Roles(spark, small_dir)
    ex = {row[0] for row in r.customer_orders().select("exclusions").distinct().collect()}
    assert {None, "", "null", " "} <= ex
    dist = [row[0] for row in r.runner_orders().select("distance").collect()]
    assert any(d.endswith(" km") for d in dist) and any(d.endswith("km") and " " not in d for d in dist)
    assert "null" in dist
    seg = {row[0] for row in r.weekly_sales().select("segment").distinct().collect()}
    assert "null" in seg and any(s.startswith("C") for s in seg)
    mm = {row[0] for row in r.interest_metrics().select("month_year").distinct().collect()}
    assert "NULL" in mm


def test_campaigns_do_not_overlap(spark, small_dir):
    rows = sorted(Roles(spark, small_dir).campaigns().collect(), key=lambda r: r.start_date)
    assert all(a.end_date < b.start_date for a, b in zip(rows, rows[1:]))


def test_a_rewritten_file_is_read_with_its_own_schema(spark, tmp_path):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    from tabula.sources.tables import read_table
    path = f"{tmp_path}/part.parquet"
    pq.write_table(pa.table({"p_partkey": [1, 2]}), path)
    assert [r.p_partkey for r in read_table(spark, str(tmp_path), "part").collect()] == [1, 2]
    assert read_table(spark, str(tmp_path), "part", "p_partkey").count() == 2
    pq.write_table(pa.table({"p_partkey": ["a"], "p_name": ["n"]}), path)
    os.utime(path, (1, 1))
    assert [tuple(r) for r in read_table(spark, str(tmp_path), "part").collect()] == [("a", "n")]
