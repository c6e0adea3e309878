"""The warehouse's logical tables, derived from the TPC-H-like test tables.

Every table is a lazy DataFrame over the whole Parquet input; FIXTURES.md part B
lists the derivations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .reader import values_relation

# Fixed rows of the channel dimension: code, name, type, validity flag.
# CH4 is not valid and CH5 is missing, so defaults and referential rules have work.
CHANNEL_ROWS = [
    ("CH1", "App", "APP", "Y"),
    ("CH2", "Mini", "MINI", "Y"),
    ("CH3", "H5", "H5", "Y"),
    ("CH4", "Store", "OFFLINE", "N"),
]


class Retail:
    """Logical tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A test table; its footer is read once per instance."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def orders(self, late: bool = False) -> DataFrame:
        """Order facts with stale copies; `late` delays the load of every eleventh order by 3 days."""
        orders = self.raw("orders")
        first = (
            orders.groupBy("o_custkey")
            .agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("first"))
            .select(F.col("o_custkey").alias("first_custkey"), F.col("first.o_orderkey").alias("first_key"))
        )
        nation = self.raw("nation").select("n_nationkey", "n_regionkey")
        customer = (
            self.raw("customer").select("c_custkey", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(first, F.col("c_custkey") == F.col("first_custkey"), "left")
            .select("c_custkey", "n_regionkey", "first_key")
        )
        key = F.col("o_orderkey")
        lag_days = F.when(key % 11 == 0, 3).otherwise(0) if late else F.lit(0)
        copies = F.when(key % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return (
            orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select("*", F.explode(copies).alias("stale"), lag_days.alias("lag_days"))
            .select(
                key.alias("order_id"),
                F.to_date("o_orderdate").alias("stat_date"),
                F.concat(F.lit("CH"), F.substring("o_orderpriority", 1, 1)).alias("channel_code"),
                F.col("n_regionkey").alias("region_code"),
                F.col("o_custkey").alias("customer_id"),
                (F.col("o_totalprice").cast("decimal(18,2)") - F.col("stale")).cast("decimal(18,2)").alias("order_amount"),
                F.when(F.col("o_orderstatus") == "F", "COMPLETED")
                .when(F.col("o_orderstatus") == "O", "PAID")
                .when(key % 3 == 0, "CANCELLED").otherwise("SHIPPED").alias("order_status"),
                F.when(key % 50 == 0, "Y").otherwise("N").alias("is_deleted"),
                F.when(key % 97 == 0, "TEST").otherwise("NORMAL").alias("order_type"),
                F.when(key % 4 == 0, key % 10).alias("promotion_id"),
                (F.col("o_custkey") % 20).alias("store_code"),
                F.when(key == F.col("first_key"), "Y").otherwise("N").alias("is_first_order"),
                (F.col("o_orderdate") + F.make_dt_interval(F.col("lag_days"), F.lit(2) - F.col("stale")))
                .alias("etl_load_time"),
            )
        )

    def items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.when(F.col("l_orderkey") % 33 == 0, "N").otherwise("Y").alias("is_valid"),
            F.col("l_shipdate").alias("etl_load_time"),
        )

    def _dated_lines(self, *columns: str) -> tuple[DataFrame, DataFrame]:
        dates = self.raw("orders").select("o_orderkey", F.to_date("o_orderdate").alias("stat_date"))
        lines = self.raw("lineitem").select("l_orderkey", *columns)
        return lines, dates

    def refunds(self) -> DataFrame:
        lines, dates = self._dated_lines("l_returnflag", "l_linenumber", "l_extendedprice", "l_linestatus")
        return (
            lines.filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
            .join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_extendedprice").cast("decimal(18,2)").alias("refund_amount"),
                F.when(F.col("l_linestatus") == "F", "COMPLETED").otherwise("PENDING").alias("refund_status"),
                "stat_date",
            )
        )

    def inventory(self) -> DataFrame:
        """Stock of a product in two warehouses per supplier on each day it was sold."""
        lines, dates = self._dated_lines("l_partkey", "l_suppkey")
        return (
            lines.filter(F.col("l_partkey") % 9 != 0)
            .join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_partkey").alias("product_id"), "l_suppkey", "stat_date").distinct()
            .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("warehouse"))
            .select(
                "product_id", "stat_date",
                ((F.col("product_id") * 7 + F.col("l_suppkey") + F.col("warehouse") * 13
                  + F.dayofmonth("stat_date")) % 100).cast("int").alias("inventory_qty"),
            )
        )

    def payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        attempts = (F.when(key % 6 == 0, F.array().cast("array<int>"))
                    .when(key % 9 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        return self.raw("orders").select(
            key.alias("order_id"), F.explode(attempts).alias("attempt"),
            F.when(key % 5 == 0, "FAILED").otherwise("SUCCESS").alias("pay_status"),
        )

    def channels(self) -> DataFrame:
        return values_relation(self.spark, ["channel_code", "channel_name", "channel_type", "is_valid"], CHANNEL_ROWS)

    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.when(F.col("c_acctbal") > 5000, "MEMBER").otherwise("NORMAL").alias("customer_type"),
        )

    def regions(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").alias("region_code"), F.col("r_name").alias("region_name"),
            F.when(F.col("r_regionkey") == 4, "N").otherwise("Y").alias("is_valid"),
        )

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category_id"),
            F.when(F.col("p_partkey") % 13 == 0, "N").otherwise("Y").alias("is_valid"),
        )

    def categories(self) -> DataFrame:
        return self.raw("part").select("p_type").distinct().select(
            F.col("p_type").alias("category_id"), F.col("p_type").alias("category_name"), F.lit("Y").alias("is_valid"),
        )

    def promotions(self) -> DataFrame:
        return self.spark.range(10).select(
            F.col("id").alias("promotion_id"), F.when(F.col("id") == 6, "N").otherwise("Y").alias("is_valid"))

    def stores(self) -> DataFrame:
        return self.spark.range(20).select(
            F.col("id").alias("store_code"), F.when(F.col("id") % 5 == 0, "N").otherwise("Y").alias("is_valid"))
