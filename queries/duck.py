"""DuckDB side: the logical tables as common table expressions."""

from __future__ import annotations

TABLES = {
    "dwd_orders": """
        SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS stat_date,
               'CH' || substr(o.o_orderpriority, 1, 1) AS channel_code, n.n_regionkey AS region_code,
               o.o_custkey AS customer_id,
               CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) - s.stale AS DECIMAL(18,2)) AS order_amount,
               CASE WHEN o.o_orderstatus = 'F' THEN 'COMPLETED' WHEN o.o_orderstatus = 'O' THEN 'PAID'
                    WHEN o.o_orderkey % 3 = 0 THEN 'CANCELLED' ELSE 'SHIPPED' END AS order_status,
               CASE WHEN o.o_orderkey % 50 = 0 THEN 'Y' ELSE 'N' END AS is_deleted,
               CASE WHEN o.o_orderkey % 97 = 0 THEN 'TEST' ELSE 'NORMAL' END AS order_type,
               CASE WHEN o.o_orderkey % 4 = 0 THEN o.o_orderkey % 10 END AS promotion_id,
               o.o_custkey % 20 AS store_code,
               CASE WHEN o.o_orderkey = f.first_key THEN 'Y' ELSE 'N' END AS is_first_order,
               o.o_orderdate + INTERVAL 2 HOUR - to_hours(s.stale) AS etl_load_time
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN (SELECT o_custkey, o_orderkey AS first_key FROM orders
                   QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1) f
               ON f.o_custkey = o.o_custkey
        JOIN (VALUES (0), (1)) AS s(stale) ON s.stale = 0 OR o.o_orderkey % 7 = 0""",
    "dwd_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               CASE WHEN l_orderkey % 33 = 0 THEN 'N' ELSE 'Y' END AS is_valid, l_shipdate AS etl_load_time
        FROM lineitem""",
    "dwd_refunds": """
        SELECT l_orderkey AS order_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS refund_amount,
               CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'PENDING' END AS refund_status,
               CAST(o_orderdate AS DATE) AS stat_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' AND l_linenumber = 1""",
    "dwd_inventory": """
        SELECT product_id, stat_date,
               CAST((product_id * 7 + l_suppkey + w.warehouse * 13 + day(stat_date)) % 100 AS INTEGER) AS inventory_qty
        FROM (SELECT DISTINCT l_partkey AS product_id, l_suppkey, CAST(o_orderdate AS DATE) AS stat_date
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey % 9 <> 0) sold
        CROSS JOIN (VALUES (0), (1)) AS w(warehouse)""",
    "dwd_payments": """
        SELECT o_orderkey AS order_id, a.attempt,
               CASE WHEN o_orderkey % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS pay_status
        FROM orders JOIN (VALUES (1), (2)) AS a(attempt)
          ON o_orderkey % 6 <> 0 AND (a.attempt = 1 OR o_orderkey % 9 = 1)""",
    "dim_channel": """
        SELECT * FROM (VALUES ('CH1', 'App', 'APP', 'Y'), ('CH2', 'Mini', 'MINI', 'Y'), ('CH3', 'H5', 'H5', 'Y'),
                              ('CH4', 'Store', 'OFFLINE', 'N')) AS t(channel_code, channel_name, channel_type, is_valid)""",
    "dim_customer": """
        SELECT c_custkey AS customer_id, CASE WHEN c_acctbal > 5000 THEN 'MEMBER' ELSE 'NORMAL' END AS customer_type
        FROM customer""",
    "dim_region": """
        SELECT r_regionkey AS region_code, r_name AS region_name,
               CASE WHEN r_regionkey = 4 THEN 'N' ELSE 'Y' END AS is_valid FROM region""",
    "dim_product": """
        SELECT p_partkey AS product_id, p_type AS category_id,
               CASE WHEN p_partkey % 13 = 0 THEN 'N' ELSE 'Y' END AS is_valid FROM part""",
    "dim_category": "SELECT DISTINCT p_type AS category_id, p_type AS category_name, 'Y' AS is_valid FROM part",
    "dim_promotion": "SELECT range AS promotion_id, CASE WHEN range = 6 THEN 'N' ELSE 'Y' END AS is_valid FROM range(10)",
    "dim_store": "SELECT range AS store_code, CASE WHEN range % 5 = 0 THEN 'N' ELSE 'Y' END AS is_valid FROM range(20)",
}

TABLES["dwd_orders_late"] = TABLES["dwd_orders"].replace(
    "AS etl_load_time", "+ to_days(CASE WHEN o.o_orderkey % 11 = 0 THEN 3 ELSE 0 END) AS etl_load_time")

# What the channel flow means, over all days.
MEANINGS = {
    # the version of an order that was loaded last
    "newest_orders": """
        SELECT unnest(arg_max(v, (v.etl_load_time, v.channel_code, v.region_code, v.customer_id, v.order_amount)))
        FROM (SELECT order_id, stat_date, channel_code, region_code, customer_id, order_amount, promotion_id, store_code, is_first_order, etl_load_time
              FROM dwd_orders WHERE list_contains(['COMPLETED', 'PAID', 'SHIPPED'], order_status) AND NOT (is_deleted <> 'N' OR order_type = 'TEST')) v
        GROUP BY v.order_id, v.stat_date""",
    # pieces in the load batch that came last for an order and product
    "sold": """
        SELECT order_id, product_id, CAST(list_sum(map_extract(pieces, last_load)[1]) AS BIGINT) AS quantity
        FROM (SELECT order_id, product_id, max(etl_load_time) AS last_load, map_from_entries(list((etl_load_time, batch))) AS pieces
              FROM (SELECT order_id, product_id, etl_load_time, list(quantity) AS batch FROM dwd_items WHERE is_valid = 'Y' GROUP BY ALL) GROUP BY ALL)""",
    "returned": """
        SELECT order_id, stat_date, CAST(sum(CASE WHEN refund_amount IS NOT NULL THEN refund_amount ELSE 0 END) AS DECIMAL(18,2)) AS refund_amount
        FROM dwd_refunds WHERE refund_status = 'COMPLETED' GROUP BY ALL""",
    # mean stock in millionths, rounded half up like a decimal average
    "stocked": """
        SELECT product_id, stat_date,
               (2 * sum(inventory_qty) * 1000000 + count(*)) // (2 * count(*)) AS stock_micro
        FROM dwd_inventory GROUP BY ALL""",
    # a row for each order and product sold with it
    "order_lines": """
        SELECT newest_orders.* EXCLUDE (etl_load_time), product_id, quantity,
               CAST(ifnull(refund_amount, 0) AS DECIMAL(18,2)) AS refund_amount, CAST(ifnull(stock_micro, 0) AS BIGINT) AS stock_micro
        FROM newest_orders LEFT JOIN returned USING (order_id, stat_date) LEFT JOIN sold USING (order_id) LEFT JOIN stocked USING (product_id, stat_date)""",
    "described_lines": """
        SELECT order_lines.*,
               ifnull((SELECT channel_name FROM dim_channel x WHERE x.channel_code = order_lines.channel_code AND x.is_valid = 'Y'), '未知渠道') AS channel_name,
               ifnull((SELECT channel_type FROM dim_channel x WHERE x.channel_code = order_lines.channel_code AND x.is_valid = 'Y'), 'OTHER') AS channel_type,
               ifnull((SELECT region_name FROM dim_region x WHERE x.region_code = order_lines.region_code AND x.is_valid = 'Y'), '未知地区') AS region_name,
               ifnull((SELECT category_name FROM dim_category x WHERE x.is_valid = 'Y' AND x.category_id = (
                   SELECT category_id FROM dim_product p WHERE p.product_id = order_lines.product_id AND p.is_valid = 'Y')), '未知类目') AS category_name,
               (SELECT customer_type FROM dim_customer x WHERE x.customer_id = order_lines.customer_id) AS customer_type
        FROM order_lines""",
}

_LINES = ["dwd_orders", "dwd_items", "dwd_refunds", "dwd_inventory", "newest_orders", "sold", "returned", "stocked", "order_lines"]
NEEDS = {
    "newest_orders": ["dwd_orders", "newest_orders"],
    "sold": ["dwd_items", "sold"],
    "returned": ["dwd_refunds", "returned"],
    "stocked": ["dwd_inventory", "stocked"],
    "order_lines": _LINES,
    "described_lines": [*_LINES, "dim_channel", "dim_customer", "dim_region", "dim_product", "dim_category", "described_lines"],
}


def with_tables(names: str, body: str, **extra: str) -> str:
    """WITH the named tables and meanings (and what they need) in front of a query body."""
    wanted: list[str] = []
    for name in names.split():
        for need in NEEDS.get(name, [name]):
            if need not in wanted:
                wanted.append(need)
    parts = [f"{n} AS ({(TABLES.get(n) or MEANINGS[n]).strip()})" for n in wanted]
    parts += [f"{n} AS ({sql.strip()})" for n, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def rounded(numerator: str, denominator: str, kind: str = "DECIMAL(18,2)") -> str:
    """Exact numerator / denominator rounded half away from zero to 2 places.

    DuckDB divides decimals as doubles, so the division is done on whole cents.
    `numerator` must be a DECIMAL with 2 places or an integer, `denominator` an integer.
    """
    cents = f"CAST(({numerator}) * 100 AS HUGEINT)"
    quotient = f"sign({cents}) * ((2 * abs({cents}) + ({denominator})) // (2 * ({denominator})))"
    return f"CAST(CAST({quotient} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS {kind})"
