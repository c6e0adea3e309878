"""Trade-orders summary per day and channel."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from ..functions import band, day_window, ratio, stamp, surrogate_key
from ..operators import conform, dimension_names, valid_rows
from ..schemas import ORDERS_SUMMARY

# Fixed values.
COUNTED_STATUS = ["COMPLETED", "PAID"]
UNKNOWN_CHANNEL = "未知渠道"


def counted_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status").isin(COUNTED_STATUS) & (F.col("is_deleted") == "N"))


def orders_summary(orders: DataFrame, dim_channel: DataFrame, batch_date: date | None = None, *,
                   full: bool = False, load_ts: datetime | None = None) -> DataFrame:
    """Summary rows of the orders loaded on `batch_date`, or of all orders when `full`.

    The facts are aggregated by (day, channel) first; channel names join one row per
    group afterwards.  The distinct customer count spreads a hot channel over its
    customers, because Spark shuffles by group and customer before it counts.
    """
    rows = counted_orders(orders)
    if not full:
        if batch_date is None:
            raise ValueError("batch_date must not be empty")
        rows = rows.filter(day_window("etl_load_time", batch_date))
    per_channel = rows.groupBy("stat_date", "channel_code").agg(
        F.count("order_id").alias("orders"),
        F.sum("order_amount").alias("amount"),
        F.countDistinct("customer_id").alias("total_customers"),
    )
    names = dimension_names(valid_rows(dim_channel), ["channel_code"], {"channel_name": UNKNOWN_CHANNEL})
    copies = F.coalesce(F.col("name_copies"), F.lit(1))
    totals = per_channel.join(names, "channel_code", "left").select(
        "stat_date", "channel_code",
        F.coalesce("channel_name", F.lit(UNKNOWN_CHANNEL)).alias("channel_name"),
        (F.col("orders") * copies).alias("total_orders"),
        (F.col("amount") * copies).alias("total_amount"),
        "total_customers",
    )
    result = totals.select(
        "*",
        surrogate_key("stat_date", "channel_code").alias("summary_id"),
        F.round(ratio(F.col("total_amount"), F.col("total_orders")), 2).alias("avg_order_amount"),
        band("total_amount").alias("amount_level"),
        stamp(load_ts or datetime.now()).alias("etl_load_time"),
    )
    return conform(result, ORDERS_SUMMARY)


def late_orders_summary(orders: DataFrame, dim_channel: DataFrame, batch_date: date, *,
                        load_ts: datetime | None = None) -> DataFrame:
    """Whole-day rows of every stat_date that the load day touched.

    A row loaded today may belong to an earlier day.  That day is recomputed from all
    of its orders, so its summary can be replaced as a whole.
    """
    touched = counted_orders(orders).filter(day_window("etl_load_time", batch_date)).select("stat_date").distinct()
    return orders_summary(orders.join(touched, "stat_date", "left_semi"), dim_channel, full=True, load_ts=load_ts)
