"""The role views of ``roles.py`` written as DuckDB SQL, for the oracle.

``with_roles(body, "sale", "menu")`` prefixes a query with the CTEs it needs.
Fixed literal tables repeat the values of ``roles.py``.
"""

from __future__ import annotations

from tabula.sources.roles import CAMPAIGNS, EVENT_NAMES, PIZZA_NAMES, PLANS


def _values(rows, cols: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if hasattr(v, "hour"):
            return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"
        if hasattr(v, "isoformat"):
            return f"DATE '{v.isoformat()}'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({cols})"


ROLE_SQL: dict[str, str] = {
    "plans": "SELECT plan_id::INTEGER AS plan_id, plan_name, price::DECIMAL(5,2) AS price FROM ("
             + _values(PLANS, "plan_id, plan_name, price") + ")",
    "event_names": _values(EVENT_NAMES, "event_type, event_name"),
    "pizza_names": _values(PIZZA_NAMES, "pizza_id, pizza_name"),
    "campaigns": _values(CAMPAIGNS, "campaign_name, start_date, end_date"),
    "sale": """
        SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date,
               o.o_orderkey AS order_id, l.l_linenumber AS line_id, l.l_partkey AS product_id,
               l.l_quantity AS quantity, CAST(l.l_shipdate AS DATE) AS ship_date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "menu": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CAST(CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) AS price,
               p_type AS category
        FROM part""",
    "member": """
        SELECT o_custkey AS customer_id, MIN(CAST(o_orderdate AS DATE)) AS join_date
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey""",
    "sub": """
        SELECT o_custkey AS customer_id, CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS plan_id,
               CAST(o_orderdate AS DATE) AS start_date, o_orderkey AS sub_id
        FROM orders""",
    "stay": """
        SELECT o.o_custkey AS customer_id, n.n_regionkey AS region_id, l.l_suppkey AS node_id,
               CAST(CASE WHEN l.l_shipdate < o.o_orderdate THEN l.l_shipdate ELSE o.o_orderdate END AS DATE) AS start_date,
               CAST(CASE WHEN l.l_shipdate < o.o_orderdate THEN o.o_orderdate ELSE l.l_shipdate END AS DATE) AS end_date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "regions": "SELECT r_regionkey AS region_id, r_name AS region_name FROM region",
    "txn": """
        SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
               CASE o_orderstatus WHEN 'O' THEN 'deposit' WHEN 'F' THEN 'purchase' ELSE 'withdrawal' END
                 AS txn_type,
               CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))
                 AS txn_amount, o_orderkey AS txn_id
        FROM orders""",
    "weekly_sales": """
        SELECT week_date, region, platforms, segment, customer_type,
               COUNT(*) AS transactions, SUM(sale) AS sales
        FROM (
          SELECT strftime(CAST(date_trunc('week', o.o_orderdate) AS DATE), '%-d/%-m/%y') AS week_date,
                 r.r_name AS region, c.c_mktsegment AS platforms,
                 CASE WHEN left(o.o_orderpriority, 1) = '5' THEN 'null'
                      ELSE (CASE WHEN o.o_orderstatus = 'F' THEN 'C' ELSE 'F' END) || left(o.o_orderpriority, 1)
                 END AS segment,
                 CASE WHEN c.c_acctbal < 0 THEN 'Guest' WHEN c.c_acctbal < 5000 THEN 'New'
                      ELSE 'Existing' END AS customer_type,
                 CAST(floor(o.o_totalprice) AS BIGINT) AS sale
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
          JOIN nation n ON c.c_nationkey = n.n_nationkey
          JOIN region r ON n.n_regionkey = r.r_regionkey) w
        GROUP BY week_date, region, platforms, segment, customer_type""",
    "week_texts": "SELECT DISTINCT strftime(CAST(date_trunc('week', o_orderdate) AS DATE), '%-d/%-m/%y') AS week_date FROM orders",
    "click": """
        SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS visit_id, user_id,
               CAST(user_id AS VARCHAR) || '/' || strftime(date_trunc('week', ts), '%Y%m%d') AS cookie_id,
               CAST(floor(TRY_CAST(CASE WHEN json_valid(props) THEN json_extract_string(props, '$.k') END AS DOUBLE))
                    AS BIGINT) AS page_id,
               CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                               WHEN 'signup' THEN 4 ELSE 5 END AS event_type,
               ts AS event_time, event_id
        FROM events""",
    "users": """
        SELECT user_id, CAST(user_id AS VARCHAR) || '/' || strftime(date_trunc('week', ts), '%Y%m%d') AS cookie_id,
               MIN(CAST(ts AS DATE)) AS start_date
        FROM events WHERE event_type <> 'error' GROUP BY 1, 2""",
    "recipes": """
        SELECT l_orderkey AS pizza_id, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_linenumber, l_partkey) AS toppings
        FROM lineitem GROUP BY l_orderkey""",
    "recipe_names": "SELECT o_orderkey AS pizza_id, o_orderpriority AS pizza_name FROM orders",
    "page_hierarchy": """
        SELECT p_partkey AS page_id, p_name AS page_name,
               CASE WHEN p_size > 5 THEN p_type END AS product_category,
               CASE WHEN p_size > 5 THEN p_partkey END AS product_id
        FROM part""",
    "interest_metrics": """
        SELECT CASE WHEN l_tax = 0 THEN 'NULL' ELSE CAST(month(l_shipdate) AS VARCHAR) END AS _month,
               CASE WHEN l_tax = 0 THEN 'NULL' ELSE CAST(year(l_shipdate) AS VARCHAR) END AS _year,
               CASE WHEN l_tax = 0 THEN 'NULL' ELSE strftime(l_shipdate, '%m-%Y') END
                 AS month_year,
               CASE WHEN l_discount = 0 THEN 'NULL' ELSE CAST(l_partkey AS VARCHAR) END AS interest_id
        FROM lineitem""",
    "interest_map": """
        SELECT p_partkey AS id, p_name AS interest_name,
               CASE WHEN p_size <= 10 THEN '' ELSE p_brand END AS interest_summary,
               TIMESTAMP '1995-01-01 00:00:00' + to_days(p_size * 30) AS created_at,
               TIMESTAMP '1995-01-01 00:00:00' + to_days(p_size * 31) AS last_modified
        FROM (SELECT * FROM part
              UNION ALL SELECT * FROM part WHERE p_size BETWEEN 2 AND 3) p""",
    "customer_orders": """
        SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_id, o.o_custkey AS customer_id,
               CASE WHEN l.l_quantity < 25 THEN 1 ELSE 2 END AS pizza_id,
               CASE l.l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'null' WHEN 4 THEN ' '
                    WHEN 5 THEN CAST(l.l_suppkey AS VARCHAR)
                    ELSE CAST(l.l_suppkey AS VARCHAR) || ', ' || CAST(l.l_linenumber AS VARCHAR) END
                 AS exclusions,
               CASE l.l_linenumber WHEN 1 THEN CAST(l.l_partkey AS VARCHAR) WHEN 2 THEN 'null'
                    WHEN 3 THEN CAST(l.l_linenumber AS VARCHAR) || ',' || CAST(l.l_suppkey AS VARCHAR)
                    WHEN 4 THEN NULL WHEN 5 THEN '' ELSE 'NULL' END AS extras,
               o.o_orderdate + to_minutes(CAST(floor(o.o_totalprice / 1000) AS BIGINT)) AS order_time
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "runner_orders": """
        SELECT order_id, runner_id,
               CASE WHEN NOT cancelled THEN order_time + to_minutes(CAST(floor(o_totalprice / 5000) AS BIGINT))
               END AS pickup_time,
               CASE WHEN cancelled THEN 'null'
                    WHEN digit = '1' THEN km || 'km' WHEN digit = '2' THEN km || ' km'
                    WHEN digit = '3' THEN km WHEN digit = '4' THEN CAST(CAST(floor(tenths / 10) AS BIGINT) AS VARCHAR) || 'km'
                    ELSE km || 'km' END AS distance,
               CASE WHEN cancelled THEN 'null'
                    WHEN digit = '1' THEN mins || ' mins' WHEN digit = '2' THEN mins || 'minutes'
                    WHEN digit = '3' THEN mins || ' minute' WHEN digit = '4' THEN mins
                    ELSE mins || 'mins' END AS duration,
               CASE WHEN cancelled AND o_totalprice > 250000 THEN 'Customer Cancellation'
                    WHEN cancelled THEN 'Restaurant Cancellation'
                    WHEN digit = '1' THEN 'null' WHEN digit = '2' THEN '' WHEN digit = '3' THEN ' ' END
                 AS cancellation
        FROM (
          SELECT o_orderkey AS order_id, o_custkey AS runner_id, o_totalprice,
                 o_orderstatus = 'P' AS cancelled, left(o_orderpriority, 1) AS digit,
                 CAST(floor(o_totalprice / 2000) AS BIGINT) AS tenths,
                 CAST(CAST(floor(floor(o_totalprice / 2000) / 10) AS BIGINT) AS VARCHAR) || '.'
                   || CAST(CAST(floor(o_totalprice / 2000) AS BIGINT) % 10 AS VARCHAR) AS km,
                 CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) AS VARCHAR) AS mins,
                 o_orderdate + to_minutes(CAST(floor(o_totalprice / 1000) AS BIGINT)) AS order_time
          FROM orders) r""",
    "runners": """
        SELECT c_custkey AS runner_id,
               CAST(DATE '2021-01-01' + CAST(floor(c_acctbal / 100) AS INTEGER) AS DATE) AS registration_date
        FROM customer""",
    "toppings": "SELECT p_partkey AS topping_id, p_name AS topping_name FROM part",
}


def with_roles(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named role CTEs (then ``extra`` CTEs, in order) and ``body``."""
    parts = [f"{n} AS ({ROLE_SQL[n]})" for n in names]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
