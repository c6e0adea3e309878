"""Channel sales analysis per day: deduplicated orders, items, refunds and stock in one summary.

Each stage takes an optional `batch_date`.  With a date it works on that day, as the
daily load does; without one it back-fills all days, and the date becomes a join key.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from ..functions import band, percent, ratio, stamp, surrogate_key
from ..operators import conform, latest_batch_total, latest_row, lookup, valid_rows
from ..schemas import CHANNEL_SALES

# Fixed values.
COUNTED_STATUS = ["COMPLETED", "PAID", "SHIPPED"]
UNKNOWN_CHANNEL = "未知渠道"
UNKNOWN_CHANNEL_TYPE = "OTHER"
UNKNOWN_REGION = "未知地区"
UNKNOWN_CATEGORY = "未知类目"

DIMENSIONS = ["stat_date", "channel_code", "channel_name", "channel_type", "region_name", "category_name"]
ORDER_COLUMNS = ["order_id", "stat_date", "channel_code", "region_code", "customer_id", "order_amount",
                 "promotion_id", "store_code", "is_first_order", "etl_load_time"]


def _on_day(df: DataFrame, batch_date: date | None) -> DataFrame:
    return df if batch_date is None else df.filter(F.col("stat_date") == F.lit(batch_date))


def order_dedup(orders: DataFrame, batch_date: date | None = None) -> DataFrame:
    """Newest version of each counted order of a day."""
    rows = _on_day(orders, batch_date).filter(
        F.col("order_status").isin(COUNTED_STATUS)
        & (F.col("is_deleted") == "N")
        & (F.col("order_type") != "TEST")
    ).select(*ORDER_COLUMNS)
    return latest_row(rows, ["order_id", "stat_date"], "etl_load_time")


def item_latest(items: DataFrame) -> DataFrame:
    """Pieces per order and product, taken from the newest load batch."""
    valid = items.filter(F.col("is_valid") == "Y")
    return latest_batch_total(valid, ["order_id", "product_id"], "etl_load_time", "quantity")


def refund_totals(refunds: DataFrame, batch_date: date | None = None) -> DataFrame:
    done = _on_day(refunds, batch_date).filter(F.col("refund_status") == "COMPLETED")
    return done.groupBy("order_id", "stat_date").agg(
        F.coalesce(F.sum("refund_amount"), F.lit(0)).cast("decimal(18,2)").alias("refund_amount"))


def inventory_means(inventory: DataFrame, batch_date: date | None = None) -> DataFrame:
    """Mean stock as a decimal, so that sums of means do not depend on the order of addition."""
    return _on_day(inventory, batch_date).groupBy("product_id", "stat_date").agg(
        F.avg(F.col("inventory_qty").cast("decimal(18,2)")).alias("avg_inventory_qty"))


def base_rows(tables: Mapping[str, DataFrame], batch_date: date | None = None, *, named: bool = False) -> DataFrame:
    """One row per order and product: orders LEFT refunds LEFT items LEFT stock.  `named` adds the looked-up names.

    What an order's names depend on is looked up once per order, before the items multiply it; the category is looked up on the
    items, whose rows are narrow, so that a large product table does not send the whole joined rows through one more shuffle.

    Every right side is aggregated to its key first.  An order id that holds a large share
    of the item rows is down to one row per product before it is joined, and a product that
    most orders hold is on the left side, where AQE splits its partition.
    """
    orders = order_dedup(tables["orders"], batch_date).drop("etl_load_time")
    if named:
        orders = with_order_names(orders, tables)
    items = tables["items"]
    if batch_date is not None:
        # The item history has no date; keep only the day's orders before aggregating it.
        days_orders = _on_day(tables["orders"], batch_date).select("order_id")
        items = items.join(days_orders, "order_id", "left_semi")
    refunds = refund_totals(tables["refunds"], batch_date)
    stock = inventory_means(tables["inventory"], batch_date)
    items = item_latest(items)
    if named:
        items = with_category(items, tables)
    base = (
        orders.join(refunds, ["order_id", "stat_date"], "left")
        .join(items, "order_id", "left")
        .join(stock, ["product_id", "stat_date"], "left")
        .withColumn("refund_amount", F.coalesce("refund_amount", F.lit(0)).cast("decimal(18,2)"))
        .withColumn("avg_inventory_qty", F.coalesce("avg_inventory_qty", F.lit(0)).cast("decimal(22,6)"))
    )
    # an order without items has no category either
    return base.withColumn("category_name", F.coalesce("category_name", F.lit(UNKNOWN_CATEGORY))) if named else base


def with_order_names(orders: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Channel, region and kind of customer; an invalid or missing dimension row gives the default."""
    named = lookup(orders, valid_rows(tables["channels"]), {"channel_code": "channel_code"}, {
        "channel_name": ("channel_name", UNKNOWN_CHANNEL),
        "channel_type": ("channel_type", UNKNOWN_CHANNEL_TYPE),
    })
    named = lookup(named, valid_rows(tables["regions"]), {"region_code": "region_code"},
                   {"region_name": ("region_name", UNKNOWN_REGION)})
    return lookup(named, tables["customers"], {"customer_id": "customer_id"}, {"customer_type": ("customer_type", None)})


def with_category(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The category of the product; products meet their categories before the rows do."""
    products = lookup(valid_rows(tables["products"]).select("product_id", "category_id"), valid_rows(tables["categories"]),
                      {"category_id": "category_id"}, {"category_name": ("category_name", None)})
    return lookup(rows, products, {"product_id": "product_id"}, {"category_name": ("category_name", UNKNOWN_CATEGORY)})


def channel_totals(named: DataFrame, by: list[str], order_grain: bool = False) -> DataFrame:
    """Totals and distinct counts per group, without expanding a row per distinct measure.

    An order has one customer, so distinct orders, customers, members and first-time
    customers come out of one chain of aggregates: order -> customer -> group.
    Only products need a second set of rows.  `order_grain` takes an order's amounts
    once instead of once per product row.

    The rows are sent to their group once, before they are doubled for the products; all
    aggregates after that find them in place.  A group, a day's part, is one task's, whose
    aggregates spill.
    """
    once = F.max if order_grain else F.sum
    rows = named.select(
        *by, "customer_id", "order_id", "product_id", "order_amount", "refund_amount", "quantity", "avg_inventory_qty",
        F.col("promotion_id").isNotNull().alias("promoted"),
        F.coalesce(F.col("customer_type") == "MEMBER", F.lit(False)).alias("member"),
        F.coalesce(F.col("is_first_order") == "Y", F.lit(False)).alias("first_time"),
    ).repartition(*by)
    twice = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("of_product"))
    as_order = F.col("of_product") == 0
    pieces = twice.select(
        *by, "of_product", F.when(~as_order, F.col("product_id")).alias("product_id"),
        *[F.when(as_order, F.col(c)).alias(c) for c in rows.columns if c not in (*by, "product_id")],
    ).groupBy(*by, "customer_id", "order_id", "product_id", "of_product").agg(
        once("order_amount").alias("order_amount"),
        once("refund_amount").alias("refund_amount"),
        F.sum("quantity").alias("quantity"),
        F.sum("avg_inventory_qty").alias("stock"),
        *[F.max(flag).alias(flag) for flag in ("promoted", "member", "first_time")],
    )
    per_order = F.col("of_product") == 0
    per_customer = pieces.groupBy(*by, "of_product", "customer_id").agg(
        F.count(F.when(per_order, F.col("order_id"))).alias("orders"),
        F.sum(F.when(per_order, F.col("order_amount"))).alias("order_amount"),
        F.sum(F.when(per_order, F.col("refund_amount"))).alias("refund_amount"),
        F.sum(F.when(per_order, F.col("quantity"))).alias("quantity"),
        F.sum(F.when(per_order, F.col("stock"))).alias("stock"),
        F.count_if(per_order & F.col("promoted") & F.col("order_id").isNotNull()).alias("promoted"),
        F.max(per_order & F.col("member")).alias("member"),
        F.max(per_order & F.col("first_time")).alias("first_time"),
        F.count(F.when(~per_order, F.col("product_id"))).alias("products"),
    )
    known = per_order & F.col("customer_id").isNotNull()
    return per_customer.groupBy(*by).agg(
        F.sum("orders").alias("total_orders"),
        F.sum("order_amount").alias("total_order_amount"),
        F.sum("refund_amount").alias("total_refund_amount"),
        F.count_if(known).alias("total_customers"),
        F.count_if(known & F.col("member")).alias("member_customers"),
        F.count_if(known & F.col("first_time")).alias("first_time_customers"),
        F.sum("products").alias("total_products"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("stock").alias("total_stock"),
        F.sum("promoted").alias("promotion_order_count"),
    ).filter(F.col("total_orders") > 0)


def final_metrics(totals: DataFrame, key_parts: list[str], batch_date: date | None, load_ts: datetime | None) -> DataFrame:
    """Derived rates and bands over the totals; each is rounded once, by the target cast."""
    c = F.col
    net = totals.withColumn("total_net_amount", c("total_order_amount") - c("total_refund_amount"))
    return net.select(
        "*",
        surrogate_key(*key_parts).alias("analysis_id"),
        (c("total_customers") - c("member_customers")).alias("non_member_customers"),
        percent(c("total_customers") - c("first_time_customers"), c("total_customers")).alias("repurchase_rate"),
        ratio(c("total_quantity"), c("total_stock")).alias("avg_inventory_turnover"),
        ratio(c("total_net_amount"), c("total_orders")).alias("avg_order_amount"),
        ratio(c("total_net_amount"), c("total_customers")).alias("avg_customer_value"),
        band("total_net_amount").alias("channel_value_level"),
        percent(c("promotion_order_count"), c("total_orders")).alias("promotion_order_rate"),
        (c("stat_date") if batch_date is None else F.lit(batch_date)).alias("etl_batch_date"),
        stamp(load_ts or datetime.now()).alias("etl_load_time"),
    )


def channel_sales(tables: Mapping[str, DataFrame], batch_date: date | None = None, *,
                  order_grain: bool = False, load_ts: datetime | None = None) -> DataFrame:
    """The whole flow.

    As written, amounts repeat per product line and the key hashes day and channel
    only.  `order_grain=True` counts an order's amounts once, leaves the category out of the
    groups and hashes all group columns.
    """
    by = [d for d in DIMENSIONS if not (order_grain and d == "category_name")]
    named = base_rows(tables, batch_date, named=True)
    totals = channel_totals(named, by, order_grain)
    key_parts = by if order_grain else ["stat_date", "channel_code"]
    # at order grain the category is no group, so it stays NULL
    return conform(final_metrics(totals, key_parts, batch_date, load_ts), CHANNEL_SALES, missing_as_null=order_grain)
