"""Bulk copy: ordered chunks, equal key ranges, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..session import cut_lineage

BATCH_SIZE = 50_000  # fixed value: rows per reported batch
RANGES = 4  # fixed value: key ranges of a range copy
KEYS_PER_TASK = 5_000_000
ROWS_PER_FILE = 5_000_000


def copy_key(df: DataFrame, key: str | None = None) -> str:
    """The given key, else the first integral column."""
    if key:
        return key
    for f in df.schema.fields:
        if isinstance(f.dataType, T.IntegralType):
            return f.name
    raise ValueError("no integral column to copy by; name a key")


def row_count(df: DataFrame) -> int:
    """Row count; for Parquet Spark answers it from the footers, without reading columns."""
    return df.count()


def chunk_report(df: DataFrame, key: str, batch_size: int = BATCH_SIZE, partitions: int | None = None) -> DataFrame:
    """(chunk_no, row_count, min_key, max_key) of the rows in key order, `batch_size` rows per chunk.

    Rows are counted per key first, so a key that holds a large share of the rows is one
    row from then on.  The keys are range-partitioned and kept by a checkpoint (range
    bounds are sampled, so they must not be drawn again), each partition numbers its own
    keys, and the offset between partitions is a running sum over one row per partition.
    The number of partitions follows the row count, so a task never orders more than a
    few million keys.
    """
    parts = partitions or max(8, -(-row_count(df) // KEYS_PER_TASK))
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    ranged = cut_lineage(
        per_key.repartitionByRange(parts, "k").withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.sum("n").alias("part_rows")).select(
        "part", F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("part_offset"))
    in_part = Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    ends = ranged.withColumn("end_in_part", F.sum("n").over(in_part)).join(offsets, "part").select(
        "k", "n", (F.col("part_offset") + F.col("end_in_part")).alias("end"))
    size = F.lit(batch_size).cast("bigint")
    first = F.expr(f"(end - n) div {int(batch_size)}")
    last = F.expr(f"(end - 1) div {int(batch_size)}")
    spread = ends.select("k", "n", "end", F.explode(F.sequence(first, last)).alias("chunk_no"))
    low = F.greatest(F.col("end") - F.col("n"), F.col("chunk_no") * size)
    high = F.least(F.col("end"), (F.col("chunk_no") + 1) * size)
    return spread.groupBy("chunk_no").agg(
        F.sum(high - low).alias("row_count"), F.min("k").alias("min_key"), F.max("k").alias("max_key"))


def key_ranges(df: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """(range_no, low, high): [min, max] cut in equal integer ranges; `high` is exclusive and the last takes the rest."""
    bounds = df.agg(F.min(key).cast("bigint").alias("min_key"), F.max(key).cast("bigint").alias("max_key"))
    width = F.expr(f"(max_key - min_key + 1) div {int(ranges)}")
    return (
        bounds.filter(F.col("min_key").isNotNull())
        .select("min_key", "max_key", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("range_no"))
        .select(
            "range_no",
            (F.col("min_key") + F.col("range_no") * F.col("width")).alias("low"),
            F.when(F.col("range_no") == ranges - 1, F.col("max_key") + 1)
            .otherwise(F.col("min_key") + (F.col("range_no") + 1) * F.col("width")).alias("high"),
        )
    )


def with_range_number(df: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """Adds range_no, computed from the key and the table's own bounds; NULL for a NULL key.

    The bounds are one row, read from the same plan: for Parquet mostly from the footers.
    """
    low, high = (df.select(f(key).cast("bigint")).scalar() for f in (F.min, F.max))
    width = F.floor((high - low + 1) / ranges)
    number = F.when(width > 0, F.floor((F.col(key).cast("bigint") - low) / width)).otherwise(ranges - 1)
    return df.withColumn("range_no", F.when(F.col(key).isNotNull(), F.least(number, F.lit(ranges - 1))).cast("int"))


def range_load_report(df: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """Rows that each range loads, empty ranges included: one count per range number beside the ranges' bounds."""
    counts = with_range_number(df, key, ranges).filter(F.col(key).isNotNull()).groupBy("range_no").agg(F.count(F.lit(1)).alias("n"))
    return key_ranges(df, key, ranges).join(counts, "range_no", "left").select(
        "range_no", "low", "high", F.coalesce("n", F.lit(0)).alias("row_count"))


def range_filters(df: DataFrame, key: str, ranges: int = RANGES) -> list[DataFrame]:
    """One DataFrame per range, with literal bounds that reach the scan."""
    return [df.filter((F.col(key) >= c["low"]) & (F.col(key) < c["high"]))
            for c in key_ranges(df, key, ranges).orderBy("range_no").collect()]


def ordered_layout(df: DataFrame, key: str, rows_per_part: int = ROWS_PER_FILE) -> DataFrame:
    """Rows range-partitioned by key, about `rows_per_part` per partition and sorted inside.

    A hash of the row is the second range column: rows of one very frequent key spread
    over several partitions.
    """
    parts = max(1, -(-row_count(df) // rows_per_part))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.repartitionByRange(parts, F.col(key), spread).sortWithinPartitions(key)


def reconcile(sides: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Row count, min and max key of each side (UNION ALL)."""
    result = None
    for name, df in sides.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count"), F.min(key).alias("min_id"), F.max(key).alias("max_id"))
        one = one.select(F.lit(name).alias("table_name"), "row_count", "min_id", "max_id")
        result = one if result is None else result.unionByName(one)
    return result


def generated_rows(spark: SparkSession, rows: int) -> DataFrame:
    """Demo rows id 1..n with a repeatable amount below 1000 drawn from the id."""
    return spark.range(1, rows + 1).select(
        "id", F.concat(F.lit("Data_"), F.col("id").cast("string")).alias("data"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).cast("decimal(10,2)").alias("amount"))
