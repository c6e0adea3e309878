"""Work that must grow no faster than the input: rows that enter a step, and shuffles of a plan."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from queries import expressions
from tidemill.plans import builder, channel_sales as cs
from tidemill.plans.mapping import load_mapping
from tidemill.sinks import tables


def plan_of(df):
    """The plan as it stands with tables too large to be sent to all tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in conf.items():
        df.sparkSession.conf.set(key, value)
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            df.sparkSession.conf.unset(key)


def test_equal_suppliers_meet_the_orders_as_one_row(spark, tmp_path, monkeypatch):
    spark.range(4_000).select(
        F.col("id").alias("s_suppkey"), (F.col("id") % 3).cast("int").alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(4_000).select(
        F.when(F.col("id") % 2 == 0, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority"), (F.col("id") * 10 + 1).alias("o_custkey"),
        F.lit(1.25).alias("o_totalprice"), F.when(F.col("id") % 8 > 0, "F").alias("o_orderstatus")).write.parquet(f"{tmp_path}/orders.parquet")
    seen = []
    join = expressions.hash_join
    monkeypatch.setattr(expressions, "hash_join", lambda left, right, *a, **b: seen.append((left.count(), right.count())) or join(left, right, *a, **b))
    got = expressions.skewed_hash_join(spark, str(tmp_path))
    assert [tuple(map(str, r)) for r in rows(got)] == [
        (str(n), str(copies * 2_000), str(copies * 1_500), f"{copies * 2_500}.00") for n, copies in ((0, 1_334), (1, 1_333), (2, 1_333))]
    assert seen == [(3, 4_000)]


_LINES = """SELECT DATE'2025-01-01' AS stat_date, 'CH1' AS channel_code, 'n' AS channel_name, 't' AS channel_type, 'r' AS region_name,
    concat('c', id % 2) AS category_name, id % 6 AS order_id, id % 3 AS customer_id, id AS product_id, 10.00BD AS order_amount, 1.00BD AS refund_amount,
    2L AS quantity, 3.5BD AS avg_inventory_qty, CASE WHEN id % 6 = 0 THEN 1 END AS promotion_id, 'Y' AS is_first_order, 'MEMBER' AS customer_type FROM range(12)"""


@pytest.mark.parametrize("order_grain", [False, True])
def test_lines_are_sent_to_their_group_once(spark, order_grain):
    by = [d for d in cs.DIMENSIONS if d != "category_name"]
    totals = cs.channel_totals(spark.sql(_LINES), by, order_grain)
    assert [tuple(map(str, r)) for r in totals.select("total_orders", "total_order_amount", "total_customers", "total_products", "total_stock",
                                                      "promotion_order_count").collect()] == [("6", "60.00" if order_grain else "120.00", "3", "12", "42.0", "1")]
    text = plan_of(totals)
    assert text.count("Exchange ") == 1 and "Expand" not in text


def test_category_is_looked_up_before_items_meet_orders(spark):
    from queries.flows import channel_tables
    lines = cs.base_rows(channel_tables(spark, "/root/testdata/sf0.001"), named=True)
    text = plan_of(lines.select("order_id", "category_name", "channel_name"))
    # the join by order holds the category already, so it lies deeper than that join
    depth = {k: min(len(x) - len(x.lstrip(" :+-")) for x in text.splitlines() if "Join" in x and k in x) for k in ("__k_category_id", "[order_id")}
    assert depth["__k_category_id"] > depth["[order_id"]


def test_mapping_looks_up_before_it_multiplies_and_sends_copies_to_their_group(spark):
    from queries.mappings import sources
    mapping = load_mapping("channel_sales")
    assert builder._looked_up(mapping) == {"prd": "itm", "cat": "itm", "cst": "ord", "prm": "ord", "sto": "ord"}
    text = plan_of(builder.build(mapping, sources(spark, "/root/testdata/sf0.001"), ordered=False))
    # no shuffle by what is counted, and none after the one by group
    to_group = [x for x in text.splitlines() if "Exchange hashpartitioning(grp_0" in x]
    assert len(to_group) == 1 and "base_" not in to_group[0].split("ENSURE")[0].split("REPARTITION")[0]


def test_newest_wins_upsert_joins_the_table_once(spark):
    schema = "k int, v string, at int"
    held = spark.createDataFrame([(1, "old", 1), (2, "same", 5), (3, "newer", 9), (4, "none", None), (5, "alone", 1), (7, "known", 3)], schema)
    new = spark.createDataFrame([(1, "new", 2), (2, "again", 5), (3, "late", 4), (4, "first", 0), (6, "added", None), (7, "unknown", None)], schema)
    state = tables._newest_state(held, new, ["k"], "at")
    assert rows(state) == [(1, "new", 2), (2, "again", 5), (3, "newer", 9), (4, "first", 0), (5, "alone", 1), (6, "added", None), (7, "known", 3)]
    text = plan_of(state)
    assert text.count("Join ") == 1 and text.count("Exchange ") == 2
