"""Slowly changing dimension and join-driven update."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemill.operators.scd2 import Scd2Columns, current_rows, first_load, scd2_merge, source_key_faults, update_from
from tidemill.sources import Retail

KEYS, COMPARE = ["c_custkey"], ["c_name", "c_mktsegment", "c_nationkey"]
DAYS = [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]
TS = datetime(2024, 3, 1)
VERSIONED = Scd2Columns("eff_start_date", "eff_end_date", created=None, updated=None, version="version_no")


def _snapshots(spark, sf_dir):
    c = Retail(spark, sf_dir).raw("customer")
    key = F.col("c_custkey")
    one = c.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    moved = F.when(key % 10 == 0, F.concat(F.lit("NEW-"), "c_mktsegment")).when(key % 15 == 0, None).otherwise(
        F.col("c_mktsegment"))
    new_key = F.when(key % 40 == 1, key + 10_000_000)
    two = (c.filter(key % 25 != 0)
           .select(F.explode(F.array_compact(F.array(key, new_key))).alias("c_custkey"), "c_name", moved.alias("c_mktsegment"),
                   "c_nationkey"))
    three = c.select("c_custkey", "c_name", F.when(key % 20 == 0, F.col("c_mktsegment")).otherwise(moved).alias("c_mktsegment"),
                     "c_nationkey")
    return one, two, three


_KEY = "c_custkey"
_MOVED = ("CASE WHEN c_custkey % 10 = 0 THEN 'NEW-' || c_mktsegment WHEN c_custkey % 15 = 0 THEN NULL "
          "ELSE c_mktsegment END")
_ONE = "SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer"
_TWO = f"""SELECT c_custkey, c_name, {_MOVED} AS c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 25 <> 0
    UNION ALL SELECT c_custkey + 10000000, c_name, {_MOVED}, c_nationkey FROM customer
    WHERE c_custkey % 25 <> 0 AND c_custkey % 40 = 1"""
_THREE = f"""SELECT c_custkey, c_name, CASE WHEN c_custkey % 20 = 0 THEN c_mktsegment ELSE {_MOVED} END AS c_mktsegment,
    c_nationkey FROM customer"""


def _merge_sql(dim: str, src: str, day: str, out: str) -> str:
    same = " AND ".join(f"d.{c} IS NOT DISTINCT FROM s.{c}" for c in COMPARE)
    return f"""
        {out}_closed AS (
            SELECT d.c_custkey, d.c_name, d.c_mktsegment, d.c_nationkey, d.effective_date, d.version_no,
                   CASE WHEN d.is_current AND s.c_custkey IS NOT NULL AND NOT ({same}) THEN DATE '{day}' - 1
                        ELSE d.expiry_date END AS expiry_date,
                   d.is_current AND NOT (s.c_custkey IS NOT NULL AND NOT ({same})) AS is_current
            FROM {dim} d LEFT JOIN {src} s ON d.c_custkey = s.c_custkey),
        {out} AS (
            SELECT c_custkey, c_name, c_mktsegment, c_nationkey, effective_date, expiry_date, is_current, version_no
            FROM {out}_closed
            UNION ALL
            SELECT s.c_custkey, s.c_name, s.c_mktsegment, s.c_nationkey, DATE '{day}', DATE '9999-12-31', true,
                   1 + (SELECT count(*) FROM {dim} v WHERE v.c_custkey = s.c_custkey)
            FROM {src} s WHERE NOT EXISTS (
                SELECT 1 FROM {out}_closed d WHERE d.c_custkey = s.c_custkey AND d.is_current AND {same}))"""


_HISTORY = f"""WITH snap1 AS ({_ONE}), snap2 AS ({_TWO}), snap3 AS ({_THREE}),
        dim1 AS (SELECT *, DATE '2024-01-01' AS effective_date, DATE '9999-12-31' AS expiry_date, true AS is_current,
                        1 AS version_no FROM snap1),
        {_merge_sql('dim1', 'snap2', '2024-02-01', 'dim2')},
        {_merge_sql('dim2', 'snap3', '2024-03-01', 'dim3')}"""


def _history(spark, sf_dir, names=None):
    more = {"names": names} if names else {}
    one, two, three = _snapshots(spark, sf_dir)
    dim = first_load(one, KEYS, COMPARE, DAYS[0], load_ts=TS, **more)
    dim = scd2_merge(dim, two, KEYS, COMPARE, DAYS[1], load_ts=TS, **more)
    return scd2_merge(dim, three, KEYS, COMPARE, DAYS[2], load_ts=TS, **more)


def scd2_merged(spark, sf_dir):
    return _history(spark, sf_dir).drop("created_at", "last_updated")


def scd2_versions(spark, sf_dir):
    return _history(spark, sf_dir, VERSIONED)


def scd2_current(spark, sf_dir):
    return current_rows(_history(spark, sf_dir)).select("c_custkey", "c_mktsegment", "effective_date")


def scd2_history(spark, sf_dir):
    """Versions per key, with the first and last day each key is known."""
    return _history(spark, sf_dir).groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("versions"), F.min("effective_date").alias("known_from"),
        F.max("expiry_date").alias("known_to"), F.count_if("is_current").alias("open_rows"))


def scd2_backdated(spark, sf_dir):
    """The three snapshots of `scd2_merge`, merged last one first."""
    names = Scd2Columns(created=None, updated=None, seen="seen_dates")
    one, two, three = _snapshots(spark, sf_dir)
    dim = first_load(three, KEYS, COMPARE, DAYS[2], names=names)
    for day, src in ((DAYS[0], one), (DAYS[1], two)):
        dim = scd2_merge(dim, src, KEYS, COMPARE, day, names=names, backdated=True)
    return dim.drop("seen_dates")


def scd2_source_faults(spark, sf_dir):
    """NULL and duplicate keys a merge would refuse, on line items keyed by order and line."""
    lines = Retail(spark, sf_dir).raw("lineitem").withColumn(
        "l_linenumber", F.when(F.col("l_orderkey") % 17 != 0, F.col("l_linenumber")))
    return source_key_faults(lines, ["l_orderkey", "l_linenumber"])


def scd2_delta(spark, sf_dir):
    """The same history when the second snapshot is sent as a delta of changed rows only."""
    one, two, _ = _snapshots(spark, sf_dir)
    dim = first_load(one, KEYS, COMPARE, DAYS[0], load_ts=TS)
    changes = two.join(one, [*KEYS, "c_name", "c_nationkey"], "left_anti").unionByName(
        two.filter((F.col("c_custkey") % 10 == 0) | (F.col("c_custkey") % 15 == 0))).dropDuplicates(KEYS)
    return scd2_merge(dim, changes, KEYS, COMPARE, DAYS[1], load_ts=TS, delta=True).drop("created_at", "last_updated")


def update_from_source(spark, sf_dir):
    """Customers take the largest order of their history as new balance; a partner whose largest order is unknown makes it NULL."""
    r = Retail(spark, sf_dir)
    price = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice"))
    best = r.raw("orders").filter(F.col("o_orderstatus") == "P").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max_by(price, "o_totalprice").alias("c_acctbal"))
    return update_from(r.raw("customer").select("c_custkey", "c_name", "c_acctbal"), best, ["c_custkey"], ["c_acctbal"])


QUERIES = {
    "scd2_merge": (scd2_merged, _HISTORY + """
        SELECT c_custkey, c_name, c_mktsegment, c_nationkey, effective_date, expiry_date, is_current FROM dim3"""),
    "scd2_backdated": (scd2_backdated, _HISTORY + """
        SELECT c_custkey, c_name, c_mktsegment, c_nationkey, effective_date, expiry_date, is_current FROM dim3"""),
    "scd2_delta": (scd2_delta, _HISTORY + """
        SELECT c_custkey, c_name, c_mktsegment, c_nationkey, effective_date, expiry_date, is_current FROM dim2"""),
    "scd2_versions": (scd2_versions, _HISTORY + """
        SELECT c_custkey, c_name, c_mktsegment, c_nationkey, effective_date AS eff_start_date, expiry_date AS eff_end_date,
               is_current, CAST(version_no AS INTEGER) AS version_no FROM dim3"""),
    "scd2_current": (scd2_current, _HISTORY + " SELECT c_custkey, c_mktsegment, effective_date FROM dim3 WHERE is_current"),
    "scd2_history": (scd2_history, _HISTORY + """
        SELECT c_custkey, count(*) AS versions, min(effective_date) AS known_from, max(expiry_date) AS known_to,
               count(*) FILTER (WHERE is_current) AS open_rows FROM dim3 GROUP BY c_custkey"""),
    "scd2_source_faults": (scd2_source_faults, """
        WITH k AS (SELECT l_orderkey, CASE WHEN l_orderkey % 17 <> 0 THEN l_linenumber END AS l_linenumber FROM lineitem)
        SELECT CAST((SELECT count(*) FROM k WHERE l_linenumber IS NULL) AS BIGINT) AS null_keys,
               (SELECT count(*) FROM (SELECT 1 FROM k WHERE l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber
                HAVING count(*) > 1) d) AS duplicate_keys"""),
    "update_from_source": (update_from_source, """
        WITH b AS (SELECT o_custkey, max(o_totalprice) AS top FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
        p AS (SELECT DISTINCT o.o_custkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN top END AS best
              FROM orders o JOIN b ON b.o_custkey = o.o_custkey AND b.top = o.o_totalprice WHERE o_orderstatus = 'P')
        SELECT c.c_custkey, c.c_name, CASE WHEN p.o_custkey IS NOT NULL THEN p.best ELSE c.c_acctbal END AS c_acctbal
        FROM customer c LEFT JOIN p ON p.o_custkey = c.c_custkey"""),
}
