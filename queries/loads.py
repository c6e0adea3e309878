"""Load strategies that really write: scratch tables live in the session's shared folder."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F, types as T

from tidemill.functions import stamp
from tidemill.operators import chunks
from tidemill.operators.scd2 import Scd2Columns, scd2_schema
from tidemill.session import work_path
from tidemill.sinks import copying, incremental, tables as sinks
from tidemill.sources import Retail

from .duck import with_tables

YEARS = ["order_id", "order_status", "order_amount"]
SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("order_status", T.StringType()),
    T.StructField("order_amount", T.DecimalType(18, 2)), T.StructField("stat_year", T.DateType()),
])


def scratch_table(spark, name, schema=SCHEMA, partition_by=("stat_year",)):
    """An empty table in a database of its own below the shared folder."""
    db = f"scratch_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{work_path(spark, db)}'")
    table = f"{db}.{name}"
    sinks.create_target(spark, table, schema, partition_by=partition_by)
    return table


def order_rows(spark, sf_dir):
    """Latest order rows with the first day of their year as partition day."""
    orders = Retail(spark, sf_dir).raw("orders")
    return orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("order_amount"),
        F.trunc("o_orderdate", "year").alias("stat_year"))


ROWS_SQL = """SELECT o_orderkey AS order_id, o_orderstatus AS order_status,
    CAST(o_totalprice AS DECIMAL(18,2)) AS order_amount, CAST(date_trunc('year', o_orderdate) AS DATE) AS stat_year
    FROM orders"""


def _with_rows(body: str) -> str:
    return f"WITH order_rows AS ({ROWS_SQL}) {body}"


def load_append(spark, sf_dir):
    table = scratch_table(spark, "orders")
    rows = order_rows(spark, sf_dir)
    sinks.load(rows, table, "INCREMENTAL_INSERT")
    sinks.load(rows.filter(F.col("order_status") == "P"), table, "INCREMENTAL_INSERT")
    return spark.table(table)


def load_full(spark, sf_dir):
    table = scratch_table(spark, "orders")
    rows = order_rows(spark, sf_dir)
    sinks.load(rows, table, "FULL")
    sinks.load(rows.filter(F.col("order_status") != "P"), table, "FULL")
    return spark.table(table)


def load_force_full(spark, sf_dir):
    """An incremental strategy with the full switch set wipes the other partitions too."""
    table = scratch_table(spark, "orders")
    rows = order_rows(spark, sf_dir)
    day = date(1996, 1, 1)
    sinks.load(rows, table, "FULL")
    sinks.load(rows.filter(F.col("stat_year") == F.lit(day)), table, "INCREMENTAL_UPDATE", day=day,
               day_column="stat_year", force_full=True)
    return spark.table(table)


def load_replace_day(spark, sf_dir):
    """Replace one partition with corrected rows, run it twice, and clear another one with an empty result."""
    table = scratch_table(spark, "orders")
    rows = order_rows(spark, sf_dir)
    sinks.load(rows, table, "FULL")
    day, gone = date(1996, 1, 1), date(1997, 1, 1)
    fixed = rows.filter(F.col("stat_year") == F.lit(day)).withColumn("order_amount", F.col("order_amount") + 1)
    for _ in range(2):
        sinks.load(fixed, table, "INCREMENTAL_UPDATE", day=day, day_column="stat_year")
    sinks.load(rows.limit(0), table, "INCREMENTAL_UPDATE", day=gone, day_column="stat_year")
    return spark.table(table)


def load_replace_days(spark, sf_dir):
    """Replace three partitions in one go; one of them comes out empty."""
    table = scratch_table(spark, "orders")
    rows = order_rows(spark, sf_dir)
    sinks.load(rows, table, "FULL")
    days = [date(1995, 1, 1), date(1998, 1, 1), date(2000, 1, 1)]
    fixed = rows.filter(F.col("stat_year").isin(days[:2])).withColumn("order_status", F.lit("X"))
    sinks.replace_days(fixed, table, days, "stat_year")
    return spark.table(table)


def load_upsert(spark, sf_dir):
    table = scratch_table(spark, "orders")
    rows = order_rows(spark, sf_dir)
    sinks.load(rows.filter(F.col("order_id") % 5 != 0), table, "FULL")
    changed = rows.filter(F.col("stat_year") >= "1999-01-01").withColumn("order_amount", F.col("order_amount") * 2)
    sinks.load(changed.select(*YEARS, "stat_year"), table, "INCREMENTAL_MERGE", keys=["order_id", "stat_year"])
    return spark.table(table)


def upsert_state(spark, sf_dir):
    rows = order_rows(spark, sf_dir)
    changed = rows.filter(F.col("order_status") == "O").withColumn("order_status", F.lit("DONE"))
    return sinks.upsert_state(rows.filter(F.col("order_id") % 5 != 0), changed, ["order_id"])


def load_history(spark, sf_dir):
    """SCD2 strategy on a table: two snapshots of the customers."""
    customers = Retail(spark, sf_dir).raw("customer").select("c_custkey", "c_mktsegment")
    schema = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_mktsegment", T.StringType()),
        T.StructField("effective_date", T.DateType()), T.StructField("expiry_date", T.DateType()),
        T.StructField("is_current", T.BooleanType()), T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("last_updated", T.TimestampNTZType()),
    ])
    table = scratch_table(spark, "customers", schema, partition_by=["expiry_date"])
    moved = customers.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 10 == 0, "MOVED").otherwise(F.col("c_mktsegment")))
    for day, rows in ((date(2024, 1, 1), customers), (date(2024, 2, 1), moved)):
        sinks.load(rows, table, "SCD2", keys=["c_custkey"], compare=["c_mktsegment"], day=day, load_ts=datetime(2024, 2, 1))
    return spark.table(table).drop("created_at", "last_updated")


def retention_partitions(spark, sf_dir):
    """Partitions left, with their rows, after those older than the retention are dropped."""
    table = scratch_table(spark, "orders")
    sinks.load(order_rows(spark, sf_dir), table, "FULL")
    sinks.drop_old_partitions(spark, table, date(2001, 1, 1), 730, "stat_year")
    sinks.refresh_statistics(spark, table)
    return spark.table(table).groupBy("stat_year").agg(F.count(F.lit(1)).alias("row_count"))


def retention_candidates(spark, sf_dir):
    orders = Retail(spark, sf_dir).raw("orders").select(F.to_date("o_orderdate").alias("stat_date"))
    return sinks.old_partitions(orders, "stat_date", date(1998, 1, 1), 730)


def _events(spark, sf_dir):
    return Retail(spark, sf_dir).raw("events")


def incremental_window(spark, sf_dir):
    """Rows above the last watermark, up to the newest one."""
    events = _events(spark, sf_dir)
    last = datetime(2024, 1, 10)
    current = incremental.new_watermark(events, "ts", last)
    return incremental.incremental_window(events, "ts", last, current).select("event_id", "user_id", "event_type")


def _two_loads(spark, sf_dir):
    """A first load of what had arrived by 15 January, then the rest, then a run that finds nothing."""
    events = _events(spark, sf_dir)
    target, store = work_path(spark, "target"), incremental.WatermarkStore(spark, work_path(spark, "watermark"))
    early = events.filter(F.col("ts") <= stamp(datetime(2024, 1, 15)))
    for src in (early, events, events):
        incremental.incremental_load(src, "ods.events", target, "ts", store, load_ts=datetime(2025, 1, 1))
    return target, store


def watermark_state(spark, sf_dir):
    _, store = _two_loads(spark, sf_dir)
    return store.current().select(
        "source_table", F.date_format("last_watermark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_watermark"),
        "row_count", "load_seq")


def watermark_reset(spark, sf_dir):
    """After a reset the next load appends everything once more."""
    target, store = _two_loads(spark, sf_dir)
    store.reset("ods.events", target)
    incremental.incremental_load(_events(spark, sf_dir), "ods.events", target, "ts", store, load_ts=datetime(2025, 1, 1))
    kept = spark.read.parquet(target).groupBy("load_seq").agg(F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("min_id"))
    return store.log().select("load_seq", F.col("row_count").alias("logged")).join(kept.withColumn("load_seq", F.col("load_seq").cast("long")), "load_seq", "left")


def copy_keys(spark, sf_dir):
    """Tables copied by the first integral column they have, with their row counts."""
    r, rows = Retail(spark, sf_dir), None
    for name in ("region", "customer", "lineitem", "events", "documents"):
        df = r.raw(name)
        key = chunks.copy_key(df)
        one = df.agg(F.lit(name).alias("table_name"), F.lit(key).alias("key"), F.count(F.lit(1)).alias("row_count"), F.max(F.col(key).cast("bigint")).alias("max_id"))
        rows = one if rows is None else rows.union(one)
    return rows


def incremental_target(spark, sf_dir):
    target, _ = _two_loads(spark, sf_dir)
    return spark.read.parquet(target).groupBy("load_seq", "event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("min_id"), F.max("event_id").alias("max_id"))


def scalar_subquery_predicate(spark, sf_dir):
    """Orders above the highest customer balance: a scalar subquery in the predicate."""
    r = Retail(spark, sf_dir)
    top = r.raw("customer").agg(F.max("c_acctbal")).scalar()
    return r.raw("orders").filter(F.col("o_totalprice") > top).select("o_orderkey", "o_totalprice")


def chunk_report(spark, sf_dir):
    return chunks.chunk_report(Retail(spark, sf_dir).raw("lineitem"), "l_orderkey", 5000)


def parallel_ranges(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return chunks.range_load_report(r.raw("orders"), "o_orderkey", 7)


def copy_reconcile(spark, sf_dir):
    """Copy line items in key order, then compare source and target."""
    lines = Retail(spark, sf_dir).raw("lineitem")
    target = work_path(spark, "copy")
    copying.copy_table(lines, target, "l_orderkey", truncate=True, rows_per_file=20_000)
    return chunks.reconcile({"Source": lines, "Target": spark.read.parquet(target)}, "l_orderkey")


def range_copy(spark, sf_dir):
    """Copy in four key ranges, one folder per range."""
    orders = Retail(spark, sf_dir).raw("orders")
    target = work_path(spark, "ranges")
    copying.range_copy(orders, target, "o_orderkey")
    return spark.read.parquet(target).groupBy("range_no").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("o_orderkey").alias("min_id"), F.max("o_orderkey").alias("max_id"))


def range_copy_null_keys(spark, sf_dir):
    """Open orders lose their key here: rows without one are copied too, under no range."""
    orders = Retail(spark, sf_dir).raw("orders").withColumn("k", F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey")))
    target = work_path(spark, "ranges")
    copying.range_copy(orders, target, "k")
    return spark.read.parquet(target).groupBy("range_no").agg(F.count(F.lit(1)).alias("row_count"), F.min("k").alias("min_id"))


def _tables(spark):
    """A database of its own below the shared folder."""
    db = f"scratch_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{work_path(spark, db)}'")
    return db


def upsert_null_partition(spark, sf_dir):
    """An upsert into the partition of rows without a day keeps the rows of that partition that it does not name.

    The table holds the orders of the upper priorities, the change set those of the lower ones; one priority is in both.
    """
    orders = Retail(spark, sf_dir).raw("orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") != "O", F.trunc("o_orderdate", "year")).alias("year"), "o_orderpriority")
    table = f"{_tables(spark)}.t"
    sinks.create_target(spark, table, orders.schema, partition_by=["year"])
    sinks.overwrite(orders.filter(F.col("o_orderpriority") <= "3-MEDIUM"), table)
    changed = orders.filter(F.col("o_orderpriority") >= "3-MEDIUM").withColumn("o_orderstatus", F.lit("X"))
    for _ in range(2):
        sinks.upsert(changed, table, ["o_orderkey", "year"])
    return spark.table(table)


def replace_day_two_columns(spark, sf_dir):
    """A table partitioned by year and status: a year comes back with one status only, another one comes back empty, twice each."""
    rows = order_rows(spark, sf_dir)
    table = f"{_tables(spark)}.orders"
    sinks.create_target(spark, table, SCHEMA, partition_by=["stat_year", "order_status"])
    sinks.load(rows, table, "FULL")
    day, gone = date(1996, 1, 1), date(1997, 1, 1)
    fixed = rows.filter((F.col("stat_year") == F.lit(day)) & (F.col("order_status") == "O"))
    for _ in range(2):
        sinks.load(fixed, table, "INCREMENTAL_UPDATE", day=day, day_column="stat_year")
        sinks.load(rows.limit(0), table, "INCREMENTAL_UPDATE", day=gone, day_column="stat_year")
    sinks.replace_days(rows.filter(F.col("order_status") == "F").filter(F.col("stat_year") == "1999-01-01"), table,
                       [date(1999, 1, 1), date(2000, 1, 1)], "stat_year")
    return spark.table(table)


def upsert_key_buckets(spark, sf_dir):
    """Upserts without a partition key: the most expensive orders change, and with them only the key buckets that hold them."""
    rows = order_rows(spark, sf_dir).drop("stat_year")
    table = f"{_tables(spark)}.orders"
    sinks.create_target(spark, table, T.StructType(SCHEMA.fields[:3]), upsert_keys=["order_id"], key_buckets=32)
    sinks.load(rows.filter(F.col("order_status") != "P"), table, "INCREMENTAL_INSERT")
    top = rows.agg(F.max("order_amount")).scalar()
    dear = rows.filter(F.col("order_amount") >= top * F.lit("0.998").cast("decimal(4,3)")).withColumn("order_status", F.lit("DEAR"))
    for _ in range(2):
        sinks.load(dear, table, "INCREMENTAL_MERGE", keys=["order_id"])
    sinks.load(rows.filter(F.col("order_status") == "P"), table, "INCREMENTAL_MERGE", keys=["order_id"])
    return spark.table(table).drop(sinks.KEY_BUCKET)


def load_history_backdated(spark, sf_dir):
    """SCD2 strategy on a table whose batches arrive in the wrong order, one of them twice."""
    customers = Retail(spark, sf_dir).raw("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    named = customers.select("c_custkey", "c_mktsegment")
    moved = customers.select("c_custkey", F.when(F.col("c_nationkey") < 8, "MOVED").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    gone = customers.select("c_custkey", F.when(F.col("c_nationkey") < 4, "GONE").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    names = Scd2Columns(created=None, updated=None, seen="seen_dates")
    schema = scd2_schema(named.schema, ["c_custkey"], ["c_mktsegment"], names)
    table = f"{_tables(spark)}.customers"
    sinks.create_target(spark, table, schema, partition_by=["expiry_date"])
    for day, rows in ((date(2024, 3, 1), gone), (date(2024, 1, 1), named), (date(2024, 2, 1), moved), (date(2024, 1, 1), named)):
        sinks.load(rows, table, "SCD2", keys=["c_custkey"], compare=["c_mktsegment"], day=day, names=names)
    return spark.table(table).withColumn("seen_dates", F.concat_ws(",", F.sort_array("seen_dates")))


_LOADS = """WITH tagged AS (SELECT *, CASE WHEN ts <= TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS load_seq FROM events)"""
_RANGES = """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
    r AS (SELECT CAST(g.range AS INTEGER) AS range_no, lo + g.range * ((hi - lo + 1) // {n}) AS low,
                 CASE WHEN g.range = {n} - 1 THEN hi + 1 ELSE lo + (g.range + 1) * ((hi - lo + 1) // {n}) END AS high
          FROM b CROSS JOIN range({n}) g)"""

QUERIES = {
    "range_copy_null_keys": (range_copy_null_keys, """
        WITH o AS (SELECT CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS k FROM orders),
        b AS (SELECT min(k) AS lo, (max(k) - min(k) + 1) // 4 AS width FROM o)
        SELECT CAST(CASE WHEN k IS NOT NULL THEN least((k - lo) // width, 3) END AS INTEGER) AS range_no, count(*) AS row_count, min(k) AS min_id FROM o, b GROUP BY 1"""),
    "upsert_null_partition": (upsert_null_partition, """
        SELECT o_orderkey, CASE WHEN o_orderpriority >= '3-MEDIUM' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(date_trunc('year', CAST(o_orderdate AS DATE)) AS DATE) END AS "year", o_orderpriority
        FROM orders"""),
    "replace_day_two_columns": (replace_day_two_columns, _with_rows("""
        SELECT * FROM order_rows WHERE year(stat_year) NOT IN (1996, 1997, 1999, 2000)
            OR (year(stat_year) = 1996 AND order_status = 'O') OR (year(stat_year) = 1999 AND order_status = 'F')""")),
    "upsert_key_buckets": (upsert_key_buckets, _with_rows("""
        SELECT order_id, CASE WHEN order_status <> 'P' AND order_amount >= 0.998 * (SELECT max(order_amount) FROM order_rows) THEN 'DEAR'
               ELSE order_status END AS order_status, order_amount FROM order_rows""")),
    "load_history_backdated": (load_history_backdated, """
        WITH points AS (
            SELECT c_custkey, DATE '2024-01-01' AS known, c_mktsegment AS v FROM customer
            UNION ALL SELECT c_custkey, DATE '2024-02-01', CASE WHEN c_nationkey < 8 THEN 'MOVED' ELSE c_mktsegment END FROM customer
            UNION ALL SELECT c_custkey, DATE '2024-03-01', CASE WHEN c_nationkey < 4 THEN 'GONE' ELSE c_mktsegment END FROM customer),
        marked AS (SELECT *, CASE WHEN lag(v) OVER w IS DISTINCT FROM v OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS starts FROM points
                   WINDOW w AS (PARTITION BY c_custkey ORDER BY known)),
        runs AS (SELECT *, sum(starts) OVER (PARTITION BY c_custkey ORDER BY known) AS run FROM marked),
        spans AS (SELECT c_custkey, run, min(v) AS c_mktsegment, min(known) AS effective_date,
                         coalesce(string_agg(CASE WHEN starts = 0 THEN strftime(known, '%Y-%m-%d') END, ',' ORDER BY known), '') AS seen_dates
                  FROM runs GROUP BY 1, 2)
        SELECT c_custkey, c_mktsegment, effective_date, seen_dates,
               coalesce(lead(effective_date) OVER w - 1, DATE '9999-12-31') AS expiry_date, lead(run) OVER w IS NULL AS is_current
        FROM spans WINDOW w AS (PARTITION BY c_custkey ORDER BY run)"""),
    "load_append": (load_append, _with_rows("SELECT * FROM order_rows UNION ALL SELECT * FROM order_rows WHERE order_status = 'P'")),
    "load_full": (load_full, _with_rows("SELECT * FROM order_rows WHERE order_status <> 'P'")),
    "load_force_full": (load_force_full, _with_rows("SELECT * FROM order_rows WHERE stat_year = DATE '1996-01-01'")),
    "load_replace_day": (load_replace_day, _with_rows("""
        SELECT order_id, order_status, CAST(CASE WHEN stat_year = DATE '1996-01-01' THEN order_amount + 1 ELSE order_amount END
               AS DECIMAL(18,2)) AS order_amount, stat_year FROM order_rows WHERE stat_year <> DATE '1997-01-01'""")),
    "load_replace_days": (load_replace_days, _with_rows("""
        SELECT order_id, CASE WHEN year(stat_year) IN (1995, 1998) THEN 'X' ELSE order_status END AS order_status,
               order_amount, stat_year FROM order_rows WHERE year(stat_year) <> 2000""")),
    "load_upsert": (load_upsert, _with_rows("""
        SELECT order_id, order_status, CAST(CASE WHEN year(stat_year) >= 1999 THEN order_amount * 2 ELSE order_amount END
               AS DECIMAL(18,2)) AS order_amount, stat_year FROM order_rows
        WHERE year(stat_year) >= 1999 OR order_id % 5 <> 0""")),
    "upsert_state": (upsert_state, _with_rows("""
        SELECT order_id, CASE WHEN order_status = 'O' THEN 'DONE' ELSE order_status END AS order_status, order_amount, stat_year
        FROM order_rows WHERE order_status = 'O' OR order_id % 5 <> 0""")),
    "load_history": (load_history, """
        SELECT c_custkey, c_mktsegment, DATE '2024-01-01' AS effective_date,
               CASE WHEN c_custkey % 10 = 0 THEN DATE '2024-01-31' ELSE DATE '9999-12-31' END AS expiry_date,
               c_custkey % 10 <> 0 AS is_current FROM customer
        UNION ALL SELECT c_custkey, 'MOVED', DATE '2024-02-01', DATE '9999-12-31', true FROM customer WHERE c_custkey % 10 = 0"""),
    "retention_partitions": (retention_partitions, _with_rows("""
        SELECT stat_year, count(*) AS row_count FROM order_rows
        WHERE stat_year >= DATE '2001-01-01' - 730 GROUP BY stat_year""")),
    "retention_candidates": (retention_candidates, """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS stat_date FROM orders
        WHERE CAST(o_orderdate AS DATE) < DATE '1998-01-01' - 730"""),
    "incremental_window": (incremental_window, """
        SELECT event_id, user_id, event_type FROM events
        WHERE ts > TIMESTAMP '2024-01-10' AND ts <= (SELECT max(ts) FROM events)"""),
    "watermark_state": (watermark_state, _LOADS + """
        SELECT 'ods.events' AS source_table, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_watermark,
               count(*) FILTER (WHERE load_seq = 2) AS row_count, CAST(2 AS BIGINT) AS load_seq FROM tagged"""),
    "watermark_reset": (watermark_reset, _LOADS + """
        , parts AS (SELECT load_seq, event_id FROM tagged UNION ALL SELECT 4, event_id FROM events)
        SELECT CAST(load_seq AS BIGINT) AS load_seq, count(*) AS logged, count(*) AS row_count, min(event_id) AS min_id FROM parts GROUP BY 1
        UNION ALL SELECT CAST(3 AS BIGINT), 0, NULL, NULL"""),
    "copy_keys": (copy_keys, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS key, count(*) AS row_count, CAST(max({k}) AS BIGINT) AS max_id FROM {t}"
        for t, k in (("region", "r_regionkey"), ("customer", "c_custkey"), ("lineitem", "l_orderkey"), ("events", "event_id"), ("documents", "doc_id")))),
    "incremental_target": (incremental_target, _LOADS + """
        SELECT load_seq, event_type, count(*) AS row_count, min(event_id) AS min_id, max(event_id) AS max_id
        FROM tagged GROUP BY 1, 2"""),
    "scalar_subquery_predicate": (scalar_subquery_predicate, """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT max(c_acctbal) FROM customer)"""),
    "chunk_report": (chunk_report, """
        WITH r AS (SELECT l_orderkey, (row_number() OVER (ORDER BY l_orderkey) - 1) // 5000 AS chunk_no FROM lineitem)
        SELECT chunk_no, count(*) AS row_count, min(l_orderkey) AS min_key, max(l_orderkey) AS max_key FROM r GROUP BY chunk_no"""),
    "parallel_ranges": (parallel_ranges, _RANGES.format(n=7) + """
        SELECT range_no, low, high, (SELECT count(*) FROM orders WHERE o_orderkey >= low AND o_orderkey < high) AS row_count
        FROM r"""),
    "copy_reconcile": (copy_reconcile, """
        SELECT 'Source' AS table_name, count(*) AS row_count, min(l_orderkey) AS min_id, max(l_orderkey) AS max_id FROM lineitem
        UNION ALL SELECT 'Target', count(*), min(l_orderkey), max(l_orderkey) FROM lineitem"""),
    "range_copy": (range_copy, _RANGES.format(n=4) + """
        SELECT range_no, count(*) AS row_count, min(o_orderkey) AS min_id, max(o_orderkey) AS max_id
        FROM orders JOIN r ON o_orderkey >= low AND o_orderkey < high GROUP BY range_no"""),
}
