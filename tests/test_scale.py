"""Hot keys, and plans that must not hold a join of all pairs."""

from decimal import Decimal

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from queries import checks, expressions, flows, history, mappings
from queries.mappings import sources
from tidemill.operators import quality as q
from tidemill.operators import latest_batch_total, latest_row
from tidemill.operators.quality import Rule
from tidemill.plans.builder import build
from tidemill.plans import channel_sales as cs
from tidemill.plans.mapping import load_mapping

WRITES = {"flow_target", "flow_run_log", "flow_quality_log"}
LAZY = {name: pair[0] for module in (flows, checks, history, expressions, mappings)
        for name, pair in module.QUERIES.items() if name not in WRITES}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_query_pairs_everything(spark, name):
    plan = plan_of(LAZY[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    if name != "mapping_cross_join":  # its CROSS side is a single row
        assert "BroadcastNestedLoopJoin" not in plan
    for scan in plan.split("FileScan")[1:]:
        assert "BatchEvalPython" not in scan and "ArrowEvalPython" not in scan


@pytest.fixture(scope="module")
def named(spark):
    """Channel rows where one channel, product and customer hold a third of all rows; some keys are NULL."""
    third = F.col("id") % 3 == 0
    n = F.col("id")
    order = F.when(third, F.lit(1) + n % 50).when(n % 101 == 0, F.lit(None)).otherwise(n % 400)
    return spark.range(6000).select(
        F.date_add(F.lit("2025-01-01").cast("date"), F.when(third, 0).otherwise((n % 3).cast("int"))).alias("stat_date"),
        F.when(third, "CH1").when(n % 7 == 0, None).otherwise(F.concat(F.lit("CH"), (order % 4).cast("string"))).alias("channel_code"),
        F.lit("n").alias("channel_name"), F.lit("t").alias("channel_type"), F.lit("r").alias("region_name"),
        F.when(n % 5 == 0, "c1").otherwise("c2").alias("category_name"),
        order.alias("order_id"),
        F.when(order.isNull(), None).when(order < 40, 7).otherwise(order % 90).alias("customer_id"),
        F.when(third, 3).when(n % 11 == 0, None).otherwise(n % 200).alias("product_id"),
        (order % 10).cast("decimal(18,2)").alias("order_amount"), (order % 3).cast("decimal(18,2)").alias("refund_amount"),
        (n % 6).alias("quantity"), (n % 9).cast("decimal(22,6)").alias("avg_inventory_qty"),
        F.when(order % 4 == 0, order).alias("promotion_id"),
        F.when(order % 2 == 0, "Y").otherwise("N").alias("is_first_order"),
        F.when((order < 40) | (order % 90 < 30), "MEMBER").alias("customer_type"))


@pytest.mark.parametrize("by", [cs.DIMENSIONS, ["stat_date", "channel_code"]])
def test_channel_totals_equal_plain_distinct_counts(named, by):
    plain = named.groupBy(*by).agg(
        F.countDistinct("order_id").alias("total_orders"), F.sum("order_amount").alias("total_order_amount"),
        F.sum("refund_amount").alias("total_refund_amount"), F.countDistinct("customer_id").alias("total_customers"),
        F.countDistinct(F.when(F.col("customer_type") == "MEMBER", F.col("customer_id"))).alias("member_customers"),
        F.countDistinct(F.when(F.col("is_first_order") == "Y", F.col("customer_id"))).alias("first_time_customers"),
        F.countDistinct("product_id").alias("total_products"), F.sum("quantity").alias("total_quantity"),
        F.sum("avg_inventory_qty").alias("total_stock"),
        F.countDistinct(F.when(F.col("promotion_id").isNotNull(), F.col("order_id"))).alias("promotion_order_count"),
    ).filter("total_orders > 0")
    ours = cs.channel_totals(named, list(by)).select(*plain.columns)
    assert rows(ours) == rows(plain) != []


def test_order_grain_counts_an_order_once(spark):
    one = spark.sql("SELECT DATE'2025-01-01' AS stat_date, 'CH1' AS channel_code, 1 AS order_id, 9 AS customer_id, id AS product_id, "
                    "10.00BD AS order_amount, 1.00BD AS refund_amount, 2L AS quantity, 0BD AS avg_inventory_qty, 1 AS promotion_id, "
                    "'Y' AS is_first_order, 'MEMBER' AS customer_type FROM range(5)")
    by = ["stat_date", "channel_code"]
    assert cs.channel_totals(one, by).first()["total_order_amount"] == Decimal("50.00")
    once = cs.channel_totals(one, by, order_grain=True).first()
    assert (once["total_order_amount"], once["total_refund_amount"], once["total_quantity"]) == (Decimal("10.00"), Decimal("1.00"), 10)


def test_hot_key_copies_collapse_before_the_shuffle(spark):
    """A third of the rows are copies of one key: each task may send one of them."""
    df = spark.range(90_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"))
    newest = latest_row(df, ["k"], "ts")
    assert newest.filter("k = -1").first()["v"] == 89_997 and newest.count() == 60_001
    plan = plan_of(newest)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    totals = latest_batch_total(df, ["k"], "ts", "v")
    assert totals.filter("k = -1").first()["v"] == 89_997
    assert "SortAggregate" not in plan_of(totals) and "Window" not in plan_of(totals)


def test_key_rules_join_one_row_per_key(spark):
    facts = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    dim = spark.range(0, 30_000, 2).withColumnRenamed("id", "key")
    rule = Rule("r", "REFERENTIAL", "f", "k", {"ref_table": "d", "ref_field": "key"})
    counted = q.rule_counts({"f": facts, "d": dim}, [rule])
    assert counted.first()["failed_rows"] == facts.filter("k % 2 = 1").count()
    plan = plan_of(counted)
    assert plan.index("Join") < plan.rindex("HashAggregate")


def test_window_field_keeps_its_first_row_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(mappings.mapping_window(spark, SMALL))


def test_touched_day_filter_reaches_a_partitioned_fact(spark, tmp_path):
    sources(spark, SMALL)("dwd_trade_orders_detail_day").filter("stat_date < '1995-02-01'").write.partitionBy("stat_date").parquet(f"{tmp_path}/o")
    at = {"dwd_trade_orders_detail_day": spark.read.parquet(f"{tmp_path}/o"), "dim_channel_info": sources(spark, SMALL)("dim_channel_info")}
    df = build(load_mapping("orders_summary"), at, ordered=False).filter("stat_date IN (DATE'1995-01-03')")
    assert "PartitionFilters: [isnotnull(stat_date" in plan_of(df) or "PartitionFilters: [(stat_date" in plan_of(df)
