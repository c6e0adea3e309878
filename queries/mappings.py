"""Mapping documents executed, full runs with their log, gates and thresholds."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Window, functions as F

from tidemill.operators.quality import QualityError
from tidemill.plans.builder import build
from tidemill.plans.mapping import load_mapping, parse_mapping
from tidemill.plans.runner import run_mapping
from tidemill.runlog import RunLog, metric_breaches, missing_upstreams
from tidemill.session import work_path
from tidemill.sources import Retail

from .duck import rounded, with_tables
from .flows import LOAD_DAY, LOAD_TS, ORDERS_DAY_SQL, ORDERS_FULL_SQL, ORDERS_LATE_SQL


def sources(spark, sf_dir, late=False):
    r = Retail(spark, sf_dir)
    tables = {
        "dwd_trade_orders_detail_day": lambda: r.orders(late), "dwd_order_items_detail_day": r.items,
        "dwd_payments_detail_day": r.payments, "dwd_refunds_detail_day": r.refunds,
        "dwd_inventory_detail_day": r.inventory, "dim_channel_info": r.channels, "dim_product_info": r.products,
        "dim_customer_info": r.customers, "dim_region_info": r.regions, "dim_promotion_info": r.promotions,
        "dim_store_info": r.stores, "dim_category_info": r.categories,
    }
    return lambda name: tables[name.split(".")[-1]]()


def mapping_orders_summary(spark, sf_dir):
    return build(load_mapping("orders_summary"), sources(spark, sf_dir), load_ts=LOAD_TS).drop("etl_load_time")


def mapping_orders_day(spark, sf_dir):
    return build(load_mapping("orders_summary"), sources(spark, sf_dir, late=True), LOAD_DAY, full=False,
                 load_ts=LOAD_TS).drop("etl_load_time")


def mapping_channel_sales(spark, sf_dir):
    return build(load_mapping("channel_sales"), sources(spark, sf_dir), load_ts=LOAD_TS).drop("etl_load_time")


def _document(tables, joins, attributes, group_by=(), where=(), having=()):
    """A document over raw tables; tables = [(name, alias, role)], joins = [(type, alias, condition)]."""
    return parse_mapping({
        "entity": {
            "mapping_id": "M_QUERY", "target_table": "result",
            "source_tables": [{"table_name": t, "alias": a, "table_type": role} for t, a, role in tables],
            "sql_conditions": {
                "joins": [{"join_sequence": i, "join_type": how, "table_alias": a, "join_condition": on}
                          for i, (how, a, on) in enumerate(joins)],
                "where": list(where), "group_by": [{"sequence": i, "expression": g} for i, g in enumerate(group_by)],
                "having": [{"sequence": i, "condition": h} for i, h in enumerate(having)]},
        },
        "attributes": [{"seq": i, "target_field": n, "target_type": t, "target_precision": "18,2", "gen_type": g,
                        "process_logic": e} for i, (n, t, g, e) in enumerate(attributes)],
    })


def _raw(spark, sf_dir, **more):
    r = Retail(spark, sf_dir)
    return lambda name: more[name] if name in more else r.raw(name)


def mapping_inner_join(spark, sf_dir):
    doc = _document([("lineitem", "l", "PRIMARY"), ("supplier", "s", "LOOKUP")], [("INNER", "s", "l.l_suppkey = s.s_suppkey")],
                    [("s_name", "VARCHAR", "DIRECT", "s.s_name"), ("row_count", "BIGINT", "AGGREGATE", "COUNT(*)"),
                     ("amount", "DECIMAL", "AGGREGATE", "SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)))")],
                    group_by=["s.s_name"], having=["COUNT(*) > 10"])
    return build(doc, _raw(spark, sf_dir))


def mapping_right_join(spark, sf_dir):
    """Customers kept even without an order that was finished."""
    doc = _document([("orders", "o", "PRIMARY"), ("customer", "c", "DETAIL")],
                    [("RIGHT", "c", "o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F'")],
                    [("segment", "VARCHAR", "DIRECT", "c.c_mktsegment"), ("orders", "BIGINT", "AGGREGATE", "COUNT(o.o_orderkey)"),
                     ("customers", "BIGINT", "AGGREGATE", "COUNT(DISTINCT c.c_custkey)"),
                     ("idle", "BIGINT", "AGGREGATE", "COUNT(*) FILTER (WHERE o.o_orderkey IS NULL)")],
                    group_by=["c.c_mktsegment"])
    return build(doc, _raw(spark, sf_dir))


def mapping_full_join(spark, sf_dir):
    doc = _document([("customer", "c", "PRIMARY"), ("supplier", "s", "DETAIL")],
                    [("FULL", "s", "c.c_custkey = s.s_suppkey + 50")],
                    [("c_custkey", "BIGINT", "DIRECT", "c.c_custkey"), ("s_suppkey", "BIGINT", "DIRECT", "s.s_suppkey"),
                     ("name", "VARCHAR", "LOOKUP", "COALESCE(s.s_name, c.c_name)"),
                     ("origin", "VARCHAR", "CONSTANT", "'both'")])
    return build(doc, _raw(spark, sf_dir))


def mapping_ordered(spark, sf_dir):
    """A document's ORDER BY: groups in order, numbered as they come."""
    document = _document([("orders", "o", "PRIMARY")], [], [
        ("priority", "VARCHAR", "DIRECT", "o.o_orderpriority"), ("status", "VARCHAR", "DIRECT", "o.o_orderstatus"),
        ("orders", "BIGINT", "AGGREGATE", "COUNT(*)")], group_by=["o.o_orderpriority", "o.o_orderstatus"])
    document = replace(document, order_by=(("status", "DESC"), ("orders", "ASC"), ("priority", "ASC")))
    # 15 groups, whatever the size of the table
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return build(document, _raw(spark, sf_dir), ordered=True).withColumn("place", place)


def mapping_union(spark, sf_dir):
    """One document, three branches: parties of two kinds and their orders, with widened types and a branch label."""
    def attributes(*rows):
        return [{"seq": i, "target_field": n, "target_type": t, "target_precision": p, "gen_type": g, "process_logic": e}
                for i, (n, t, p, g, e) in enumerate(rows)]

    document = parse_mapping({
        "entity": {"mapping_id": "M_UNION", "target_table": "parties", "sql_conditions": {}},
        "union": {"label_field": "origin", "branches": [
            {"branch_name": "customer", "source_tables": [{"table_name": "customer", "alias": "c"}], "attributes": attributes(
                ("party_key", "BIGINT", "", "DIRECT", "c.c_custkey"), ("party_name", "VARCHAR", "", "DIRECT", "c.c_name"),
                ("amount", "DECIMAL", "12,2", "DIRECT", "CAST(c.c_acctbal AS DECIMAL(12,2))"), ("code", "INTEGER", "", "DIRECT", "c.c_nationkey"))},
            {"branch_name": "supplier", "source_tables": [{"table_name": "supplier", "alias": "s"}], "attributes": attributes(
                ("code", "VARCHAR", "", "DERIVED", "CONCAT('S', s.s_nationkey)"), ("party_key", "INTEGER", "", "DIRECT", "s.s_suppkey"),
                ("party_name", "VARCHAR", "", "DIRECT", "s.s_name"))},
            {"branch_name": "orders", "source_tables": [{"table_name": "orders", "alias": "o"}],
             "sql_conditions": {"group_by": [{"sequence": 1, "expression": "o.o_custkey"}]}, "attributes": attributes(
                ("party_key", "BIGINT", "", "DIRECT", "o.o_custkey"),
                ("amount", "DECIMAL", "24,4", "AGGREGATE", "SUM(CAST(o.o_totalprice AS DECIMAL(18,4)))"))}]},
        "attributes": attributes(
            ("party_key", "BIGINT", "", "DIRECT", "party_key"), ("party_name", "VARCHAR", "", "DIRECT", "party_name"),
            ("amount", "DECIMAL", "24,4", "DIRECT", "amount"), ("code", "VARCHAR", "", "DIRECT", "code"), ("origin", "VARCHAR", "", "DIRECT", "origin"),
            ("label", "VARCHAR", "", "DERIVED", "CONCAT(origin, '-', party_key)"))})
    return build(document, _raw(spark, sf_dir))


def mapping_cross_join(spark, sf_dir):
    """Each segment's orders beside the one-row grand total; the CROSS side is proven small."""
    r = Retail(spark, sf_dir)
    total = r.raw("orders").agg(F.count(F.lit(1)).alias("all_orders"))
    doc = _document([("orders", "o", "PRIMARY"), ("total", "t", "LOOKUP")], [("CROSS", "t", None)],
                    [("priority", "VARCHAR", "DIRECT", "o.o_orderpriority"), ("orders", "BIGINT", "AGGREGATE", "COUNT(*)"),
                     ("all_orders", "BIGINT", "AGGREGATE", "MAX(t.all_orders)"),
                     ("share", "DECIMAL", "CALCULATE", "orders * 100.0 / NULLIF(all_orders, 0)")],
                    group_by=["o.o_orderpriority"])
    return build(doc, _raw(spark, sf_dir, total=total))


def mapping_window(spark, sf_dir):
    """A WINDOW_FUNCTION field: the newest order of each customer and status."""
    doc = _document([("orders", "o", "PRIMARY")], [],
                    [("o_orderkey", "BIGINT", "DIRECT", "o.o_orderkey"), ("o_custkey", "BIGINT", "DIRECT", "o.o_custkey"),
                     ("newest", "BIGINT", "WINDOW_FUNCTION",
                      "ROW_NUMBER() OVER (PARTITION BY o.o_custkey, o.o_orderstatus ORDER BY o.o_orderdate DESC, o.o_orderkey DESC)"),
                     ("is_open", "VARCHAR", "CASE", "CASE WHEN o.o_orderstatus = 'O' THEN 'Y' ELSE 'N' END")],
                    having=["newest = 1"])
    return build(doc, _raw(spark, sf_dir))


def _flow(spark, sf_dir):
    """The orders mapping run twice for one load day, in a scratch database."""
    mapping = load_mapping("orders_summary")
    log = RunLog(spark, work_path(spark, "runlog"))
    for name in mapping.upstreams:
        log.add(proc_name=name, batch_date=LOAD_DAY, step="COMPLETE", status="SUCCESS", start_time=LOAD_TS, end_time=LOAD_TS)
    db = f"flow_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{work_path(spark, db)}'")
    target = f"{db}.{mapping.table}"
    for _ in range(2):
        run_mapping(spark, mapping, sources(spark, sf_dir, late=True), LOAD_DAY, log, target=target, load_ts=LOAD_TS)
    return target, log


def flow_target(spark, sf_dir):
    target, _ = _flow(spark, sf_dir)
    return spark.table(target).drop("etl_load_time")


def flow_run_log(spark, sf_dir):
    _, log = _flow(spark, sf_dir)
    return log.runs().filter(F.col("proc_name").startswith("load_")).select("step", "status", "row_count")


def flow_quality_log(spark, sf_dir):
    _, log = _flow(spark, sf_dir)
    return log.faults().select("rule_id", "table_name", "error_count")


MONTHS = (date(1995, 1, 31), date(1995, 2, 28))
_MONTH = "date_trunc('month', CAST(o_orderdate AS DATE)) = date_trunc('month', DATE '${BATCH_DATE}')"


def _strategy_document(strategy, attributes, condition=_MONTH, group_by=(), rules=(), **entity):
    """A document over raw orders with a loading strategy."""
    return parse_mapping({
        "entity": {"mapping_id": f"M_{strategy}", "target_table": "result", "loading_strategy": strategy,
                   "source_tables": [{"table_name": "orders", "alias": "o", "table_type": "PRIMARY"}],
                   "incremental_config": {"incremental_condition": condition}, "validation_rules": list(rules),
                   "sql_conditions": {"group_by": [{"sequence": i, "expression": g} for i, g in enumerate(group_by)]}, **entity},
        "attributes": [{"seq": i, "target_field": n, "target_type": t, "target_precision": "18,2", "gen_type": g, "process_logic": e,
                        "is_pk": "Y" if n == "o_orderkey" else ""} for i, (n, t, g, e) in enumerate(attributes)],
    })


_ORDER_FIELDS = [("o_orderkey", "BIGINT", "DIRECT", "o.o_orderkey"), ("price", "DECIMAL", "DIRECT", "o.o_totalprice"),
                 ("stat_date", "DATE", "DERIVED", "CAST(o.o_orderdate AS DATE)"), ("batch", "DATE", "SYSTEM", "${BATCH_DATE}")]


def _strategy_runs(spark, sf_dir, *documents):
    """Runs each (document, batch date) twice into one table; a rejected run is left aside."""
    log, db = RunLog(spark, work_path(spark, "runlog")), f"flow_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{work_path(spark, db)}'")
    for document, day in documents:
        for _ in range(2):
            try:
                run_mapping(spark, document, _raw(spark, sf_dir), day, log, target=f"{db}.result", load_ts=LOAD_TS)
            except QualityError:
                pass
    return spark.table(f"{db}.result")


def flow_full(spark, sf_dir):
    doc = _strategy_document("FULL", _ORDER_FIELDS)
    return _strategy_runs(spark, sf_dir, *[(doc, d) for d in MONTHS])


def flow_insert(spark, sf_dir):
    """Each batch's increment lies in the target once, however often it ran."""
    doc = _strategy_document("INCREMENTAL_INSERT", _ORDER_FIELDS)
    return _strategy_runs(spark, sf_dir, *[(doc, d) for d in MONTHS])


def flow_merge(spark, sf_dir):
    """Without a partition key the increment is upserted by the target's keys."""
    doc = _strategy_document("INCREMENTAL_MERGE", _ORDER_FIELDS)
    return _strategy_runs(spark, sf_dir, *[(doc, d) for d in MONTHS])


def flow_update(spark, sf_dir):
    doc = _strategy_document("INCREMENTAL_UPDATE", _ORDER_FIELDS[:3], partition_key="stat_date")
    return _strategy_runs(spark, sf_dir, *[(doc, d) for d in MONTHS])


def flow_scd2(spark, sf_dir):
    """The number of orders of each customer up to the batch date, as a type 2 history."""
    doc = _strategy_document(
        "SCD2", [("o_custkey", "BIGINT", "DIRECT", "o.o_custkey"), ("orders", "BIGINT", "AGGREGATE", "COUNT(*)")],
        "CAST(o_orderdate AS DATE) <= DATE '${BATCH_DATE}'", ["o.o_custkey"],
        scd_config={"effective_date_field": "eff_start_date", "expire_date_field": "eff_end_date", "current_flag_field": "is_current",
                    "natural_keys": ["o_custkey"], "track_fields": ["orders"], "end_date_max": "9999-12-31"})
    return _strategy_runs(spark, sf_dir, *[(doc, d) for d in MONTHS])


_DEAR = {"rule_id": "R1", "rule_name": "price", "rule_type": "RANGE", "field": "price", "max_value": 200000,
         "error_action": "REJECT"}


def flow_allow(spark, sf_dir):
    """Rows that break a rule are loaded with their status."""
    doc = _strategy_document("FULL", _ORDER_FIELDS, rules=[_DEAR], exception_strategy="ALLOW")
    return _strategy_runs(spark, sf_dir, (doc, MONTHS[0])).groupBy("dq_status", "dq_failed").agg(F.count(F.lit(1)).alias("row_count"))


def flow_reject(spark, sf_dir):
    """A rule that rejects leaves the target as the run before it left it, also under LOG."""
    fine = _strategy_document("INCREMENTAL_INSERT", _ORDER_FIELDS)
    bad = _strategy_document("INCREMENTAL_INSERT", _ORDER_FIELDS, rules=[_DEAR], exception_strategy="LOG")
    return _strategy_runs(spark, sf_dir, (fine, MONTHS[0]), (bad, MONTHS[1]))


def _event_runs(spark, sf_dir):
    """A run log read off the events: one run per event, named by its type."""
    events = Retail(spark, sf_dir).raw("events")
    return events.select(
        F.col("event_type").alias("proc_name"), F.to_date("ts").alias("batch_date"),
        F.when(F.col("value") < 20, "SUCCESS").otherwise("FAILED").alias("status"))


def missing_upstream_jobs(spark, sf_dir):
    """Jobs without a success, for each day; 'refund' never runs."""
    runs = _event_runs(spark, sf_dir).filter(F.col("status") == "FAILED").unionByName(
        _event_runs(spark, sf_dir).filter((F.col("status") == "SUCCESS") & (F.dayofmonth("batch_date") % 2 == 0)))
    return missing_upstreams(runs, ["click", "purchase", "refund"])


def missing_upstreams_day(spark, sf_dir):
    return missing_upstreams(_event_runs(spark, sf_dir), ["click", "purchase", "refund"], date(2024, 1, 15))


def metric_threshold_breaches(spark, sf_dir):
    runs = Retail(spark, sf_dir).raw("events").groupBy(F.to_date("ts").alias("batch_date"), "event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.floor(F.max("value")).alias("duration_seconds"),
        F.count_if(F.col("value") > 200).alias("error_rate_percent"))
    return metric_breaches(runs, ["batch_date", "event_type"], {
        "row_count": (50, None), "duration_seconds": (None, 250), "error_rate_percent": (None, 5.0)}).select(
        "batch_date", "event_type", "metric", F.col("value").cast("bigint").alias("value"), "breached")


_CHANNEL_DIMS = "stat_date, channel_code, channel_name, channel_type, region_name, category_name"
_NET = "CAST(total_order_amount - total_refund_amount AS DECIMAL(18,2))"
MAPPING_CHANNEL_SQL = with_tables(
    "dwd_orders dwd_items dwd_payments dwd_refunds dwd_inventory dim_channel dim_product dim_customer dim_region "
    "dim_promotion dim_store dim_category", f"""
    SELECT md5(CAST(stat_date AS VARCHAR) || '_' || channel_code) AS analysis_id, stat_date, channel_code,
           coalesce(channel_name, '未知渠道') AS channel_name, coalesce(channel_type, 'OTHER') AS channel_type,
           coalesce(region_name, '未知地区') AS region_name, coalesce(category_name, '未知类目') AS category_name, total_orders,
           total_order_amount, total_refund_amount, {_NET} AS total_net_amount, total_customers, total_products,
           coalesce(total_quantity, 0) AS total_quantity, member_customers, total_customers - member_customers AS non_member_customers,
           {rounded(_NET, 'total_orders')} AS avg_order_amount, {rounded(_NET, 'total_customers')} AS avg_customer_value,
           CASE WHEN {_NET} >= 1000000 THEN 'HIGH' WHEN {_NET} >= 100000 THEN 'MEDIUM' ELSE 'LOW' END AS channel_value_level,
           CASE WHEN coalesce(stock, 0) > 0 THEN {rounded('total_quantity', 'stock', 'DECIMAL(10,2)')}
                ELSE CAST(0 AS DECIMAL(10,2)) END AS avg_inventory_turnover,
           promotion_order_count, {rounded('promotion_order_count * 100', 'total_orders', 'DECIMAL(5,2)')} AS promotion_order_rate,
           first_time_customers,
           {rounded('(total_customers - first_time_customers) * 100', 'total_customers', 'DECIMAL(5,2)')} AS repurchase_rate
    FROM grouped""", grouped="""
    SELECT ord.stat_date, ord.channel_code, chn.channel_name, chn.channel_type, reg.region_name, cat.category_name,
           count(DISTINCT ord.order_id) AS total_orders, CAST(sum(ord.order_amount) AS DECIMAL(18,2)) AS total_order_amount,
           CAST(coalesce(sum(ref.refund_amount), 0) AS DECIMAL(18,2)) AS total_refund_amount,
           count(DISTINCT ord.customer_id) AS total_customers, count(DISTINCT itm.product_id) AS total_products,
           CAST(sum(itm.quantity) AS BIGINT) AS total_quantity, CAST(sum(inv.inventory_qty) AS BIGINT) AS stock,
           count(DISTINCT CASE WHEN cst.customer_type = 'MEMBER' THEN ord.customer_id END) AS member_customers,
           count(DISTINCT CASE WHEN ord.promotion_id IS NOT NULL THEN ord.order_id END) AS promotion_order_count,
           count(DISTINCT CASE WHEN ord.is_first_order = 'Y' THEN ord.customer_id END) AS first_time_customers
    FROM dwd_orders ord
    LEFT JOIN dwd_items itm ON ord.order_id = itm.order_id AND itm.is_valid = 'Y'
    LEFT JOIN dwd_payments pay ON ord.order_id = pay.order_id AND pay.pay_status = 'SUCCESS'
    LEFT JOIN dwd_refunds ref ON ord.order_id = ref.order_id AND ref.refund_status = 'COMPLETED'
    LEFT JOIN dwd_inventory inv ON itm.product_id = inv.product_id AND inv.stat_date = ord.stat_date
    LEFT JOIN dim_channel chn ON ord.channel_code = chn.channel_code AND chn.is_valid = 'Y'
    LEFT JOIN dim_product prd ON itm.product_id = prd.product_id AND prd.is_valid = 'Y'
    LEFT JOIN dim_customer cst ON ord.customer_id = cst.customer_id
    LEFT JOIN dim_region reg ON ord.region_code = reg.region_code AND reg.is_valid = 'Y'
    LEFT JOIN dim_promotion prm ON ord.promotion_id = prm.promotion_id AND prm.is_valid = 'Y'
    LEFT JOIN dim_store sto ON ord.store_code = sto.store_code AND sto.is_valid = 'Y'
    LEFT JOIN dim_category cat ON prd.category_id = cat.category_id AND cat.is_valid = 'Y'
    WHERE ord.order_status IN ('COMPLETED', 'PAID', 'SHIPPED') AND ord.is_deleted = 'N' AND ord.order_type <> 'TEST'
    GROUP BY 1, 2, 3, 4, 5, 6""")

_LATE_COUNT = f"(SELECT count(*) FROM ({ORDERS_LATE_SQL}) late)"
_LATE_BAD = f"(SELECT count(*) FROM ({ORDERS_LATE_SQL}) late WHERE channel_code IN ('CH4', 'CH5'))"

_ORDERS_SQL = """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price, CAST(o_orderdate AS DATE) AS stat_date{more} FROM orders"""
_TWO_MONTHS = " WHERE date_trunc('month', CAST(o_orderdate AS DATE)) IN (DATE '1995-01-01', DATE '1995-02-01')"
_BATCH = ", last_day(CAST(o_orderdate AS DATE)) AS batch"

QUERIES = {
    "flow_full": (flow_full, _ORDERS_SQL.format(more=", DATE '1995-02-28' AS batch")),
    "flow_insert": (flow_insert, _ORDERS_SQL.format(more=_BATCH) + _TWO_MONTHS),
    "flow_merge": (flow_merge, _ORDERS_SQL.format(more=_BATCH) + _TWO_MONTHS),
    "flow_update": (flow_update, _ORDERS_SQL.format(more="") + _TWO_MONTHS),
    "flow_reject": (flow_reject, _ORDERS_SQL.format(more=_BATCH) + " WHERE date_trunc('month', CAST(o_orderdate AS DATE)) = DATE '1995-01-01'"),
    "flow_allow": (flow_allow, """SELECT CASE WHEN o_totalprice > 200000 THEN 'REJECT' ELSE 'PASS' END AS dq_status,
        CASE WHEN o_totalprice > 200000 THEN 'R1' ELSE '' END AS dq_failed, count(*) AS row_count FROM orders GROUP BY ALL"""),
    "flow_scd2": (flow_scd2, """
        WITH c AS (SELECT o_custkey, count(*) FILTER (CAST(o_orderdate AS DATE) <= DATE '1995-01-31') AS a, count(*) AS b FROM orders
                   WHERE CAST(o_orderdate AS DATE) <= DATE '1995-02-28' GROUP BY o_custkey)
        SELECT o_custkey, a AS orders, DATE '1995-01-31' AS eff_start_date,
               CASE WHEN a = b THEN DATE '9999-12-31' ELSE DATE '1995-02-27' END AS eff_end_date, a = b AS is_current FROM c WHERE a > 0
        UNION ALL SELECT o_custkey, b, DATE '1995-02-28', DATE '9999-12-31', true FROM c WHERE a <> b"""),
    "mapping_orders_summary": (mapping_orders_summary, ORDERS_FULL_SQL),
    "mapping_orders_day": (mapping_orders_day, ORDERS_DAY_SQL),
    "mapping_channel_sales": (mapping_channel_sales, MAPPING_CHANNEL_SQL),
    "mapping_inner_join": (mapping_inner_join, """
        SELECT s_name, count(*) AS row_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name HAVING count(*) > 10"""),
    "mapping_right_join": (mapping_right_join, """
        SELECT c_mktsegment AS segment, count(o_orderkey) AS orders, count(DISTINCT c_custkey) AS customers,
               count(*) FILTER (WHERE o_orderkey IS NULL) AS idle
        FROM orders RIGHT JOIN customer ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_mktsegment"""),
    "mapping_full_join": (mapping_full_join, """
        SELECT c_custkey, s_suppkey, coalesce(s_name, c_name) AS name, 'both' AS origin
        FROM customer FULL JOIN supplier ON c_custkey = s_suppkey + 50"""),
    "mapping_ordered": (mapping_ordered, """
        SELECT *, CAST(row_number() OVER (ORDER BY status DESC, orders, priority) AS INTEGER) AS place
        FROM (SELECT o_orderpriority AS priority, o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 1, 2) t"""),
    "mapping_union": (mapping_union, """
        WITH u AS (SELECT c_custkey AS party_key, c_name AS party_name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DECIMAL(24,4)) AS amount,
                          CAST(c_nationkey AS VARCHAR) AS code, 'customer' AS origin FROM customer
                   UNION ALL SELECT s_suppkey, s_name, NULL, 'S' || s_nationkey, 'supplier' FROM supplier
                   UNION ALL SELECT o_custkey, NULL, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(24,4)), NULL, 'orders' FROM orders GROUP BY 1)
        SELECT *, origin || '-' || party_key AS label FROM u"""),
    "mapping_cross_join": (mapping_cross_join, f"""
        SELECT priority, orders, all_orders, {rounded('orders * 100', 'all_orders')} AS share FROM (
            SELECT o_orderpriority AS priority, count(*) AS orders, (SELECT count(*) FROM orders) AS all_orders
            FROM orders GROUP BY 1) t"""),
    "mapping_window": (mapping_window, """
        SELECT o_orderkey, o_custkey, newest, is_open FROM (
            SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS is_open,
                   row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS newest
            FROM orders) t WHERE newest = 1"""),
    "flow_target": (flow_target, ORDERS_LATE_SQL),
    "flow_run_log": (flow_run_log, f"""
        SELECT step, status, CASE WHEN counted THEN {_LATE_COUNT} END AS row_count
        FROM (VALUES ('INIT', 'RUNNING', false), ('INIT', 'SUCCESS', false), ('DEPENDENCY_CHECK', 'SUCCESS', false),
                     ('PREPROCESS', 'SUCCESS', false), ('DATA_LOAD', 'SUCCESS', true), ('DATA_QUALITY', 'SUCCESS', false),
                     ('STATISTICS', 'SUCCESS', false), ('COMPLETE', 'SUCCESS', true)) s(step, status, counted)
        CROSS JOIN (VALUES (1), (2)) runs(n)"""),
    "flow_quality_log": (flow_quality_log, f"""
        SELECT rule_id, table_name, error_count FROM (
            SELECT 'R003' AS rule_id, 'dws_trade_orders_summary_day' AS table_name, {_LATE_BAD} AS error_count
            FROM (VALUES (1), (2)) runs(n)) t WHERE error_count > 0"""),
    "missing_upstreams": (missing_upstream_jobs, """
        WITH runs AS (SELECT event_type AS proc_name, CAST(ts AS DATE) AS batch_date,
                             CASE WHEN value < 20 THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM events
                      WHERE value >= 20 OR day(ts) % 2 = 0)
        SELECT d.batch_date, n.proc_name FROM (SELECT DISTINCT batch_date FROM runs) d
        CROSS JOIN (VALUES ('click'), ('purchase'), ('refund')) n(proc_name)
        WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.proc_name = n.proc_name AND r.batch_date = d.batch_date
                          AND r.status = 'SUCCESS')"""),
    "missing_upstreams_day": (missing_upstreams_day, """
        SELECT DATE '2024-01-15' AS batch_date, proc_name FROM (VALUES ('click'), ('purchase'), ('refund')) n(proc_name)
        WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = n.proc_name AND CAST(ts AS DATE) = DATE '2024-01-15'
                          AND value < 20)"""),
    "metric_breaches": (metric_threshold_breaches, """
        WITH m AS (SELECT CAST(ts AS DATE) AS batch_date, event_type, count(*) AS n, CAST(floor(max(value)) AS BIGINT) AS s,
                          count(*) FILTER (WHERE value > 200) AS e FROM events GROUP BY 1, 2)
        SELECT batch_date, event_type, 'row_count' AS metric, n AS value, n < 50 AS breached FROM m
        UNION ALL SELECT batch_date, event_type, 'duration_seconds', s, s > 250 FROM m
        UNION ALL SELECT batch_date, event_type, 'error_rate_percent', e, e > 5 FROM m"""),
}
