"""Scalar functions, aggregates, joins and sources."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemill import functions as tf
from tidemill.operators import fold_conditions, jsonflat, lookup, valid_rows
from tidemill.operators.joins import hash_join
from tidemill.sources import Retail, read_source, values_relation, view_source

from .duck import rounded, with_tables


def distinct_filter_counts(spark, sf_dir):
    """COUNT(DISTINCT) plain, over a CASE, and with a FILTER clause."""
    lines = Retail(spark, sf_dir).raw("lineitem")
    return lines.groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"),
        F.countDistinct(F.when(F.col("l_discount") > 0.05, F.col("l_orderkey"))).alias("discounted_orders"),
        F.expr("count(DISTINCT l_partkey) FILTER (WHERE l_quantity >= 25)").alias("bulk_parts"),
        F.count(F.lit(1)).alias("row_count"))


def conditional_totals(spark, sf_dir):
    """SUM(CASE), COUNT(CASE), MIN, MAX and HAVING."""
    lines = Retail(spark, sf_dir).raw("lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return lines.groupBy("l_suppkey").agg(
        tf.sum_when(F.col("l_linestatus") == "F", price).cast("decimal(18,2)").alias("finished_amount"),
        tf.count_when(F.col("l_returnflag") == "R").alias("returned"),
        F.min(F.to_date("l_shipdate")).alias("first_ship"), F.max(F.to_date("l_shipdate")).alias("last_ship"),
        F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def string_agg_distinct(spark, sf_dir):
    orders = Retail(spark, sf_dir).raw("orders")
    return orders.groupBy(F.to_date("o_orderdate").alias("stat_date")).agg(
        tf.distinct_text("o_orderpriority").alias("priorities"),
        tf.distinct_text("o_orderstatus", where=F.col("o_orderpriority") != "1-URGENT").alias("calm_statuses"))


def mean_ratio(spark, sf_dir):
    """Aggregate over an aggregate, guarded against zero."""
    lines = Retail(spark, sf_dir).raw("lineitem")
    per_part = lines.groupBy("l_suppkey", "l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("pieces"),
        F.count_if(F.col("l_returnflag") == "R").alias("returns"))
    return per_part.groupBy("l_suppkey").agg(
        F.sum("pieces").alias("pieces"), F.sum("returns").alias("returns")).select(
        "l_suppkey", tf.ratio(F.col("pieces").cast("decimal(18,0)"), F.col("returns")).cast("decimal(18,2)").alias("pieces_per_return"))


def banded_orders(spark, sf_dir):
    orders = Retail(spark, sf_dir).raw("orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount"))
    return orders.select("o_custkey", "amount", tf.band("amount").alias("amount_level"),
                         tf.surrogate_key("o_custkey", F.lit("CUST")).alias("row_key"))


def transform_vocabulary(spark, sf_dir):
    r = Retail(spark, sf_dir)
    t = tf.transform
    parts = r.raw("customer")
    return parts.select(
        t("Direct Map", F.col("c_custkey")).alias("c_custkey"),
        t("UpperCase", F.col("c_name")).alias("upper_name"), t("LowerCase", F.col("c_mktsegment")).alias("lower_segment"),
        t("Trim", F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("trimmed"),
        t("Substring", F.col("c_mktsegment"), 1, 3).alias("short_segment"),
        t("Concat", F.col("c_name"), F.lit("/"), F.col("c_mktsegment")).alias("joined"),
        t("Split", F.col("c_name"), "#", 2).alias("name_number"),
        t("Calculate", "c_custkey * 2 + 1").alias("doubled"),
        t("Custom", "CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE 'OK' END").alias("balance_state"),
        t("Date Format", F.date_add(F.lit(date(2024, 1, 1)), F.pmod("c_custkey", F.lit(365)).cast("int")), "yyyyMMdd").alias("day_text"))


def scalar_dates(spark, sf_dir):
    orders = Retail(spark, sf_dir).raw("orders")
    day = F.to_date("o_orderdate")
    return orders.select(
        "o_orderkey", F.date_sub(day, 1).alias("day_before"), (day + F.expr("INTERVAL '1' DAY")).alias("day_after"),
        tf.stamp_text(F.col("o_orderdate") + F.expr("INTERVAL '90' MINUTE")).alias("stamp"),
        tf.seconds_between(F.lit("1995-01-01 00:00:00").cast("timestamp"), F.col("o_orderdate").cast("timestamp")).alias("seconds"),
        F.trunc(day, "month").alias("month_start"))


def scalar_text(spark, sf_dir):
    """format, split_part, string_to_array, array_to_string, unnest, LIKE, NVL, DECODE, NULLIF."""
    parts = Retail(spark, sf_dir).raw("part")
    return parts.select(
        "p_partkey", F.format_string("%s has %s pieces", "p_name", "p_size").alias("sentence"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_word"),
        F.array_join(F.split("p_name", " "), "+").alias("plus_name"),
        F.col("p_name").like("%ring%").alias("is_ring"),
        F.expr("nvl(nullif(p_type, 'ECONOMY'), 'CHEAP')").alias("type_name"),
        F.expr("decode(p_brand, 'Brand#1', 'one', 'Brand#2', 'two', 'other')").alias("brand_word"),
        F.explode(F.split("p_name", " ")).alias("word"))


def scalar_json(spark, sf_dir):
    events = Retail(spark, sf_dir).raw("events")
    return events.select(
        "event_id", tf.json_field("props", "k").alias("k"),
        tf.row_json("event_id", "event_type").alias("row_text"))


def json_pretty(spark, sf_dir):
    """Rows as indented JSON text."""
    suppliers = Retail(spark, sf_dir).raw("supplier")
    return suppliers.select("s_suppkey", tf.pretty_json(F.struct("s_suppkey", "s_name")).alias("text"))


def _documents(spark, sf_dir):
    """Nested documents built from the events' own JSON."""
    events = Retail(spark, sf_dir).raw("events")
    user = F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("kind")).alias("last"))
    doc = F.to_json(F.struct(
        F.from_json("props", "k int").alias("props"), user.alias("user"),
        F.when(F.col("event_id") % 3 == 0, F.array("event_type", F.lit("x"))).alias("tags")))
    return events.select("event_id", doc.alias("doc"))


def json_paths(spark, sf_dir):
    return jsonflat.json_paths(_documents(spark, sf_dir), "doc")


def json_columns(spark, sf_dir):
    flat = jsonflat.json_columns(_documents(spark, sf_dir), "doc")
    tags = F.col("tags")
    return flat.select("event_id", F.col("`props.k`").alias("props_k"), F.col("`user.id`").alias("user_id"),
                       F.col("`user.last.kind`").alias("kind"), jsonflat.array_as_text(tags).alias("tags_text"),
                       jsonflat.array_as_json(tags).alias("tags_json"))


def json_array_rows(spark, sf_dir):
    flat = jsonflat.json_columns(_documents(spark, sf_dir), "doc").select("event_id", "tags")
    return jsonflat.array_as_rows(flat, F.col("tags"), "tag").select("event_id", "tag")


def json_child_table(spark, sf_dir):
    flat = jsonflat.json_columns(_documents(spark, sf_dir), "doc").select("event_id", "tags")
    return jsonflat.array_as_child(flat, ["event_id"], F.col("tags"), "tag")


def lookup_defaults(spark, sf_dir):
    """Chained lookup order -> customer -> region, with a default for regions that are not valid."""
    r = Retail(spark, sf_dir)
    customers = r.raw("customer").select("c_custkey", F.col("c_nationkey"))
    nations = r.raw("nation").select("n_nationkey", "n_regionkey")
    orders = r.raw("orders").select("o_orderkey", "o_custkey")
    out = lookup(orders, customers, {"o_custkey": "c_custkey"}, {"c_nationkey": ("c_nationkey", None)})
    out = lookup(out, nations, {"c_nationkey": "n_nationkey"}, {"n_regionkey": ("n_regionkey", None)})
    out = lookup(out, valid_rows(r.regions()), {"n_regionkey": "region_code"}, {"region_name": ("region_name", "未知地区")})
    return out.select("o_orderkey", "region_name")


def structured_where(spark, sf_dir):
    """Two condition groups: AND/OR inside, AND between."""
    conditions = [
        {"sequence": 1, "condition_group": 1, "field": "order_status", "operator": "IN", "value": ["COMPLETED", "PAID"],
         "value_type": "ARRAY"},
        {"sequence": 2, "condition_group": 1, "logic": "AND", "field": "is_deleted", "operator": "=", "value": "N",
         "value_type": "STRING"},
        {"sequence": 3, "condition_group": 2, "field": "order_amount", "operator": ">=", "value": 300000, "value_type": "NUMBER"},
        {"sequence": 4, "condition_group": 2, "logic": "OR", "field": "promotion_id", "operator": "IS NOT NULL"},
        {"sequence": 5, "condition_group": 3, "field": "stat_date", "operator": "BETWEEN",
         "value": ["1996-01-01", "1999-12-31"], "value_type": "DATE"},
        {"sequence": 6, "condition_group": 3, "logic": "AND", "field": "order_type", "operator": "!=", "value": "TEST"},
    ]
    orders = Retail(spark, sf_dir).orders()
    return orders.filter(fold_conditions(conditions)).select("order_id", "order_amount", "promotion_id")


def null_safe_changes(spark, sf_dir):
    """IS DISTINCT FROM between an order's promotion and its first line's part bucket."""
    r = Retail(spark, sf_dir)
    orders = r.raw("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderkey") % 10).alias("promo"))
    first = r.raw("lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("part")).select(
        "l_orderkey", F.when(F.col("part") % 2 == 0, F.col("part") % 10).alias("bucket"))
    return orders.join(first, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", tf.differs(F.col("promo"), F.col("bucket")).alias("changed"),
        F.col("promo").eqNullSafe(F.col("bucket")).alias("same"))


def net_amount_faults(spark, sf_dir):
    """ABS(a - (b - c)) above a tolerance."""
    lines = Retail(spark, sf_dir).raw("lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    off = F.when(F.col("l_orderkey") % 19 == 0, F.lit("0.02").cast("decimal(18,2)")).otherwise(F.lit(0).cast("decimal(18,2)"))
    return lines.filter(tf.off_by_more_than(price + off, price)).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("faults"))


def regex_mismatch(spark, sf_dir):
    pages = Retail(spark, sf_dir).raw("pages")
    return pages.filter(~F.col("url").rlike("^https://[a-z.]+/en/")).select("page_id", "url")


def orders_without_items(spark, sf_dir):
    """NOT EXISTS as an anti join: orders without a bulk line."""
    r = Retail(spark, sf_dir)
    bulk = r.raw("lineitem").filter(F.col("l_quantity") >= 45)
    return r.raw("orders").join(bulk, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


def missing_or_changed(spark, sf_dir):
    """LEFT JOIN ... IS NULL OR changed: customers without a supplier namesake, or in another nation."""
    r = Retail(spark, sf_dir)
    c = r.raw("customer").select("c_custkey", "c_nationkey")
    s = r.raw("supplier").select("s_suppkey", "s_nationkey")
    return c.join(s, F.col("c_custkey") == F.col("s_suppkey"), "left").filter(
        F.col("s_suppkey").isNull() | (F.col("c_nationkey") != F.col("s_nationkey"))).select("c_custkey", "c_nationkey")


def hinted_hash_join(spark, sf_dir):
    r = Retail(spark, sf_dir)
    lines = r.raw("lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("pieces"))
    orders = r.raw("orders").select("o_orderkey", "o_orderstatus")
    return lines.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderstatus").agg(
        F.sum("pieces").alias("pieces"))


def skewed_hash_join(spark, sf_dir):
    """Two of five orders share one build key and a third of the suppliers have it: the key is cut, the hash tables stay small.

    Suppliers of one key and nation are equal rows here: they are counted first and meet the orders as one row, so that the pairs
    of the shared key grow with the orders and not with orders times suppliers.
    """
    r = Retail(spark, sf_dir)
    orders = r.raw("orders").select(
        F.when(F.col("o_orderpriority") <= "2-HIGH", 0).otherwise(F.col("o_custkey")).alias("k"), "o_totalprice", "o_orderstatus")
    suppliers = r.raw("supplier").select(
        F.when(F.col("s_nationkey") < 8, 0).when(F.col("s_nationkey") < 12, None).otherwise(F.col("s_suppkey")).alias("k"), "s_nationkey")
    equal = suppliers.groupBy("k", "s_nationkey").agg(F.count(F.lit(1)).alias("copies"))
    joined = hash_join(equal, orders, ["k"], "left", most=1000)
    amount = F.col("o_totalprice").cast("decimal(18,2)") * F.col("copies").cast("decimal(18,0)")
    return joined.groupBy("s_nationkey").agg(
        F.sum("copies").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("o_orderstatus").isNotNull(), F.col("copies"))), F.lit(0)).alias("matched"),
        F.sum(amount).cast("decimal(28,2)").alias("amount"))


def json_paths_data_keys(spark, sf_dir):
    """Documents whose keys are data: one key per user, below a level that only some of them have."""
    events = Retail(spark, sf_dir).raw("events")
    key = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    doc = F.to_json(F.create_map(key, F.create_map(F.col("event_type"), F.struct("value", F.lit(None).alias("none")))))
    return jsonflat.json_paths(events.select(doc.alias("doc")), "doc")


def inline_values(spark, sf_dir):
    """Inline rows joined to facts."""
    labels = values_relation(spark, ["code", "label"], [("F", "finished"), ("O", "open"), ("P", "partly")])
    orders = Retail(spark, sf_dir).raw("orders")
    return orders.groupBy(F.col("o_orderstatus").alias("code")).agg(F.count(F.lit(1)).alias("row_count")).join(labels, "code")


def generated_calendar(spark, sf_dir):
    """Days between the first and last order on which nobody ordered."""
    days = Retail(spark, sf_dir).raw("orders").select(F.to_date("o_orderdate").alias("day"))
    span = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return calendar.join(days.distinct(), "day", "left_anti")


def source_kinds(spark, sf_dir):
    """The same rows read as a file and as a view."""
    as_file = read_source(spark, "File", f"{sf_dir}/orders.parquet", alias="a")
    as_view = read_source(spark, "View", _view_name(as_file))
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"), F.max("o_orderkey").alias("max_id")).select(
        F.lit(kind).alias("kind"), "row_count", "max_id") for kind, df in (("File", as_file), ("View", as_view))]
    return parts[0].unionByName(parts[1])


def _view_name(df) -> str:
    view_source(df, "orders_view")
    return "orders_view"


def union_sources(spark, sf_dir):
    """Union of sources with different columns: missing ones become NULL."""
    r = Retail(spark, sf_dir)
    a = r.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    b = r.raw("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


def top_orders(spark, sf_dir):
    """ORDER BY ... LIMIT: the report of the ten largest days."""
    days = Retail(spark, sf_dir).raw("orders").groupBy(F.to_date("o_orderdate").alias("stat_date")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount"))
    return days.orderBy(F.col("amount").desc(), F.col("stat_date").desc()).limit(10)


_DOCS = """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id, event_type,
    event_id % 3 = 0 AS tagged FROM events"""

QUERIES = {
    "distinct_filter_counts": (distinct_filter_counts, """
        SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders,
               count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_orderkey END) AS discounted_orders,
               count(DISTINCT l_partkey) FILTER (WHERE l_quantity >= 25) AS bulk_parts, count(*) AS row_count
        FROM lineitem GROUP BY l_returnflag"""),
    "conditional_totals": (conditional_totals, """
        SELECT l_suppkey, CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2))
               AS finished_amount, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned,
               CAST(min(l_shipdate) AS DATE) AS first_ship, CAST(max(l_shipdate) AS DATE) AS last_ship, count(*) AS row_count
        FROM lineitem GROUP BY l_suppkey HAVING count(*) > 1"""),
    "string_agg_distinct": (string_agg_distinct, """
        SELECT CAST(o_orderdate AS DATE) AS stat_date,
               string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities,
               string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus) FILTER (WHERE o_orderpriority <> '1-URGENT')
                   AS calm_statuses
        FROM orders GROUP BY 1"""),
    "mean_ratio": (mean_ratio, f"""
        SELECT l_suppkey, CASE WHEN n > 0 THEN {rounded('p', 'n')} ELSE CAST(0 AS DECIMAL(18,2)) END AS pieces_per_return
        FROM (SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS p,
                     count(*) FILTER (WHERE l_returnflag = 'R') AS n FROM lineitem GROUP BY l_suppkey) t"""),
    "banded_orders": (banded_orders, """
        SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount,
               CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 1000000 THEN 'HIGH'
                    WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 100000 THEN 'MEDIUM' ELSE 'LOW' END AS amount_level,
               md5(CAST(o_custkey AS VARCHAR) || '_CUST') AS row_key FROM orders GROUP BY o_custkey"""),
    "transform_vocabulary": (transform_vocabulary, """
        SELECT c_custkey, upper(c_name) AS upper_name, lower(c_mktsegment) AS lower_segment, c_name AS trimmed,
               substr(c_mktsegment, 1, 3) AS short_segment, c_name || '/' || c_mktsegment AS joined,
               split_part(c_name, '#', 2) AS name_number, c_custkey * 2 + 1 AS doubled,
               CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE 'OK' END AS balance_state,
               strftime(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER), '%Y%m%d') AS day_text FROM customer"""),
    "scalar_dates": (scalar_dates, """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1 AS day_before, CAST(o_orderdate AS DATE) + 1 AS day_after,
               strftime(o_orderdate + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS stamp,
               CAST(epoch(o_orderdate) - epoch(TIMESTAMP '1995-01-01') AS BIGINT) AS seconds,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders"""),
    "scalar_text": (scalar_text, """
        SELECT p_partkey, p_name || ' has ' || p_size || ' pieces' AS sentence, split_part(p_name, ' ', 1) AS first_word,
               array_to_string(string_split(p_name, ' '), '+') AS plus_name, p_name LIKE '%ring%' AS is_ring,
               coalesce(nullif(p_type, 'ECONOMY'), 'CHEAP') AS type_name,
               CASE p_brand WHEN 'Brand#1' THEN 'one' WHEN 'Brand#2' THEN 'two' ELSE 'other' END AS brand_word,
               unnest(string_split(p_name, ' ')) AS word FROM part"""),
    "scalar_json": (scalar_json, """
        SELECT event_id, json_extract_string(props, '$.k') AS k,
               '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS row_text FROM events"""),
    "json_pretty": (json_pretty, r"""
        SELECT s_suppkey, '{' || chr(10) || '  "s_suppkey" : ' || s_suppkey || ',' || chr(10) || '  "s_name" : "' || s_name || '"' || chr(10) || '}' AS text
        FROM supplier"""),
    "json_paths": (json_paths, f"""
        WITH d AS ({_DOCS})
        SELECT 'props.k' AS path, 'k' AS name, 'int' AS type, count(k) AS documents FROM d
        UNION ALL SELECT 'tags', 'tags', 'list', count(*) FILTER (WHERE tagged) FROM d
        UNION ALL SELECT 'user.id', 'id', 'int', count(user_id) FROM d
        UNION ALL SELECT 'user.last.kind', 'kind', 'str', count(event_type) FROM d"""),
    "json_columns": (json_columns, f"""
        WITH d AS ({_DOCS})
        SELECT event_id, k AS props_k, user_id, event_type AS kind,
               CASE WHEN tagged THEN event_type || ', x' END AS tags_text,
               CASE WHEN tagged THEN '["' || event_type || '","x"]' END AS tags_json FROM d"""),
    "json_array_rows": (json_array_rows, f"""
        WITH d AS ({_DOCS})
        SELECT event_id, event_type AS tag FROM d WHERE tagged UNION ALL SELECT event_id, 'x' FROM d WHERE tagged
        UNION ALL SELECT event_id, NULL FROM d WHERE NOT tagged"""),
    "json_child_table": (json_child_table, f"""
        WITH d AS ({_DOCS})
        SELECT event_id, 0 AS position, event_type AS tag FROM d WHERE tagged
        UNION ALL SELECT event_id, 1, 'x' FROM d WHERE tagged"""),
    "lookup_defaults": (lookup_defaults, with_tables("dim_region", """
        SELECT o.o_orderkey, coalesce(r.region_name, '未知地区') AS region_name FROM orders o
        LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN dim_region r ON r.region_code = n.n_regionkey AND r.is_valid = 'Y'""")),
    "structured_where": (structured_where, with_tables("dwd_orders", """
        SELECT order_id, order_amount, promotion_id FROM dwd_orders
        WHERE order_status IN ('COMPLETED', 'PAID') AND is_deleted = 'N'
          AND (order_amount >= 300000 OR promotion_id IS NOT NULL)
          AND stat_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND order_type <> 'TEST'""")),
    "null_safe_changes": (null_safe_changes, """
        WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 10 END AS promo FROM orders),
        f AS (SELECT l_orderkey, CASE WHEN min(l_partkey) % 2 = 0 THEN min(l_partkey) % 10 END AS bucket FROM lineitem GROUP BY 1)
        SELECT o_orderkey, promo IS DISTINCT FROM bucket AS changed, promo IS NOT DISTINCT FROM bucket AS same
        FROM o JOIN f ON o_orderkey = l_orderkey"""),
    "net_amount_faults": (net_amount_faults, """
        SELECT l_orderkey, count(*) AS faults FROM lineitem WHERE l_orderkey % 19 = 0 GROUP BY l_orderkey"""),
    "regex_mismatch": (regex_mismatch, "SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https://[a-z.]+/en/')"),
    "orders_without_items": (orders_without_items, """
        SELECT o_orderkey, o_custkey FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_quantity >= 45)"""),
    "missing_or_changed": (missing_or_changed, """
        SELECT c_custkey, c_nationkey FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
        WHERE s_suppkey IS NULL OR c_nationkey <> s_nationkey"""),
    "hinted_hash_join": (hinted_hash_join, """
        SELECT o_orderstatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS pieces
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus"""),
    "skewed_hash_join": (skewed_hash_join, """
        WITH o AS (SELECT CASE WHEN o_orderpriority <= '2-HIGH' THEN 0 ELSE o_custkey END AS k, o_totalprice, o_orderstatus FROM orders),
        s AS (SELECT CASE WHEN s_nationkey < 8 THEN 0 WHEN s_nationkey < 12 THEN NULL ELSE s_suppkey END AS k, s_nationkey FROM supplier)
        SELECT s_nationkey, count(*) AS row_count, count(o_orderstatus) AS matched, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
        FROM s LEFT JOIN o USING (k) GROUP BY 1"""),
    "json_paths_data_keys": (json_paths_data_keys, """
        SELECT 'u' || user_id || '.' || event_type || '.value' AS path, 'value' AS name, 'float' AS type, count(*) AS documents
        FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL GROUP BY user_id, event_type"""),
    "inline_values": (inline_values, """
        SELECT code, label, count(*) AS row_count FROM orders
        JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partly')) v(code, label) ON code = o_orderstatus GROUP BY 1, 2"""),
    "generated_calendar": (generated_calendar, """
        SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
        FROM orders) t WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)"""),
    "source_kinds": (source_kinds, """
        SELECT 'File' AS kind, count(*) AS row_count, max(o_orderkey) AS max_id FROM orders
        UNION ALL SELECT 'View', count(*), max(o_orderkey) FROM orders"""),
    "union_sources": (union_sources, """
        SELECT c_custkey AS id, c_name AS name, c_mktsegment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier"""),
    "top_orders": (top_orders, """
        SELECT CAST(o_orderdate AS DATE) AS stat_date, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
        FROM orders GROUP BY 1 ORDER BY amount DESC, stat_date DESC LIMIT 10"""),
}
