"""Target and log table schemas.  Names, types and defaults are fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

from .operators.conform import target_field as f

ORDERS_SUMMARY = T.StructType([
    f("summary_id", "string", required=True, comment="MD5(stat_date || '_' || channel_code)"),
    f("stat_date", "date", required=True, comment="statistics date"),
    f("channel_code", "string", required=True, comment="channel code"),
    f("channel_name", "string", comment="channel name"),
    f("total_orders", "bigint", required=True, default=0, comment="orders"),
    f("total_amount", "decimal(18,2)", required=True, default=0, comment="order amount"),
    f("total_customers", "bigint", required=True, default=0, comment="distinct customers"),
    f("avg_order_amount", "decimal(18,2)", comment="amount per order"),
    f("amount_level", "string", comment="HIGH/MEDIUM/LOW"),
    f("etl_load_time", "timestamp_ntz", required=True, comment="load time"),
])

CHANNEL_SALES = T.StructType([
    f("analysis_id", "string", required=True, comment="MD5(stat_date || '_' || channel_code)"),
    f("stat_date", "date", required=True, comment="statistics date"),
    f("channel_code", "string", required=True, comment="channel code"),
    f("channel_name", "string", comment="channel name"),
    f("channel_type", "string", comment="channel type"),
    f("region_name", "string", comment="region name"),
    f("category_name", "string", comment="category name"),
    f("total_orders", "bigint", required=True, default=0, comment="distinct orders"),
    f("total_order_amount", "decimal(18,2)", required=True, default=0, comment="order amount"),
    f("total_refund_amount", "decimal(18,2)", required=True, default=0, comment="refund amount"),
    f("total_net_amount", "decimal(18,2)", required=True, default=0, comment="order amount less refunds"),
    f("total_customers", "bigint", required=True, default=0, comment="distinct customers"),
    f("member_customers", "bigint", required=True, default=0, comment="distinct members"),
    f("non_member_customers", "bigint", required=True, default=0, comment="customers less members"),
    f("first_time_customers", "bigint", required=True, default=0, comment="distinct first-order customers"),
    f("repurchase_rate", "decimal(5,2)", comment="percent of customers who ordered before"),
    f("total_products", "bigint", required=True, default=0, comment="distinct products"),
    f("total_quantity", "bigint", required=True, default=0, comment="pieces"),
    f("avg_inventory_turnover", "decimal(10,2)", comment="pieces per mean stock"),
    f("avg_order_amount", "decimal(18,2)", comment="net amount per order"),
    f("avg_customer_value", "decimal(18,2)", comment="net amount per customer"),
    f("channel_value_level", "string", comment="HIGH/MEDIUM/LOW"),
    f("promotion_order_count", "bigint", required=True, default=0, comment="distinct promotion orders"),
    f("promotion_order_rate", "decimal(5,2)", comment="percent of orders with a promotion"),
    f("etl_batch_date", "date", required=True, comment="batch date"),
    f("etl_load_time", "timestamp_ntz", required=True, comment="load time"),
])

RUN_LOG = T.StructType([
    f("proc_name", "string"), f("mapping_id", "string"), f("batch_date", "date"), f("step", "string"),
    f("status", "string"), f("start_time", "timestamp_ntz"), f("end_time", "timestamp_ntz"),
    f("duration_seconds", "double"), f("row_count", "bigint"), f("error_code", "string"),
    f("error_message", "string"), f("message", "string"), f("error_rate_percent", "double"),
])

QUALITY_LOG = T.StructType([
    f("proc_name", "string"), f("mapping_id", "string"), f("table_name", "string"), f("batch_date", "date"),
    f("rule_id", "string"), f("rule_name", "string"), f("error_count", "bigint"), f("error_sample", "string"),
    f("check_time", "timestamp_ntz"),
])

WATERMARK = T.StructType([
    f("source_table", "string"), f("target_table", "string"), f("last_watermark", "timestamp_ntz"),
    f("last_load_time", "timestamp_ntz"), f("row_count", "bigint"), f("load_seq", "bigint"),
])
