"""Quality rules over the given tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemill.operators import quality as q
from tidemill.operators.quality import Rule
from tidemill.plans import channel_sales as cs
from tidemill.plans.orders_summary import orders_summary
from tidemill.session import work_path
from tidemill.sources import Retail

from .duck import rounded, with_tables
from .flows import LOAD_TS, channel_tables

CHECK_DATE = date(2025, 3, 18)

# Fixed value: the e-mail pattern of the sample rules.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# A test order table with planted faults, the same on both sides.
TEST_ORDERS_SQL = """
    SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_custkey END AS customer_id,
           CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN CAST(-50 AS DECIMAL(18,2))
                ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS order_amount,
           CAST(o_orderdate AS DATE) AS order_date,
           CASE WHEN o_orderkey % 37 = 0 THEN 'invalid-email'
                ELSE concat('customer', CAST(o_custkey AS {text}), '@example.com') END AS email,
           CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'CANCELLED' END AS status
    FROM {orders}"""


def tables(spark, sf_dir):
    r = Retail(spark, sf_dir)
    test_orders = spark.sql(TEST_ORDERS_SQL.format(text="STRING", orders="{orders}"), orders=r.raw("orders"))
    named = {n: r.raw(n) for n in ("lineitem", "customer", "documents", "labels", "pages", "events", "supplier", "nation")}
    return {**named, "test_orders": test_orders, "dwd_orders": r.orders(), "dim_channel": r.channels()}


RULES = [
    Rule("customer_id_not_null", "NOT_NULL", "test_orders", "customer_id", threshold=0.0),
    Rule("no_column_not_null", "NOT_NULL", "test_orders", None),
    Rule("order_amount_positive", "RANGE", "test_orders", "order_amount", {"min": 0.01, "max": 999999.99}),
    Rule("order_amount_required", "RANGE", "test_orders", "order_amount", {"min": 0, "nulls_fail": True}),
    Rule("balance_not_negative", "RANGE", "customer", "c_acctbal", {"min": 0}, threshold=10.0),
    Rule("email_format_valid", "REGEX", "test_orders", "email", {"pattern": EMAIL}, threshold=2.0),
    Rule("url_is_https", "REGEX", "pages", "url", {"pattern": "^https://"}, threshold=50.0),
    Rule("order_id_unique", "UNIQUE", "test_orders", "order_id", threshold=0.0),
    Rule("line_key_unique", "UNIQUE", "lineitem", "l_orderkey,l_linenumber"),
    Rule("big_cheap_order", "CUSTOM", "test_orders", None,
         {"condition": "status = 'CANCELLED' AND order_amount > 200000"}, threshold=20.0),
    Rule("label_has_document", "REFERENTIAL", "labels", "doc_id", {"ref_table": "documents", "ref_field": "doc_id"}),
    Rule("channel_is_valid", "REFERENTIAL", "dwd_orders", "channel_code",
         {"ref_table": "dim_channel", "ref_field": "channel_code"}),
    Rule("language_known", "IN_SET", "documents", "lang", {"values": ["en", "fr"]}),
    Rule("order_in_period", "DATE_RANGE", "test_orders", "order_date", {"min": "1995-06-01", "max": "2001-06-30"}),
    Rule("document_length", "INT_RANGE", "documents", "n_chars", {"min": 50, "max": 20000}),
    Rule("email_length", "TEXT_LENGTH", "test_orders", "email", {"min": 5, "max": 23}),
]

# (table expression, failing-row condition) per row-level rule; the others are whole queries.
_WHERE = {
    "customer_id_not_null": ("test_orders", "customer_id IS NULL"),
    "no_column_not_null": ("test_orders", "1 IS NULL"),
    "order_amount_positive": ("test_orders", "order_amount < 0.01 OR order_amount > 999999.99"),
    "order_amount_required": ("test_orders", "order_amount < 0 OR order_amount IS NULL"),
    "balance_not_negative": ("customer", "c_acctbal < 0"),
    "email_format_valid": ("test_orders", f"NOT regexp_matches(email, '{EMAIL}')"),
    "url_is_https": ("pages", "NOT regexp_matches(url, '^https://')"),
    "big_cheap_order": ("test_orders", "status = 'CANCELLED' AND order_amount > 200000"),
    "language_known": ("documents", "lang NOT IN ('en', 'fr')"),
    "order_in_period": ("test_orders", "order_date < DATE '1995-06-01' OR order_date > DATE '2001-06-30'"),
    "document_length": ("documents", "n_chars < 50 OR n_chars > 20000"),
    "email_length": ("test_orders", "length(email) < 5 OR length(email) > 23"),
}
_WHOLE = {
    "order_id_unique": """(SELECT count(*) FROM test_orders),
        (SELECT count(*) FROM (SELECT order_id FROM test_orders GROUP BY 1 HAVING count(*) > 1) t)""",
    "line_key_unique": """(SELECT count(*) FROM lineitem),
        (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) t)""",
    "label_has_document": """(SELECT count(*) FROM labels),
        (SELECT count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id))""",
    "channel_is_valid": """(SELECT count(*) FROM dwd_orders),
        (SELECT count(*) FROM dwd_orders o WHERE NOT EXISTS (
            SELECT 1 FROM dim_channel c WHERE c.channel_code = o.channel_code AND c.is_valid = 'Y'))""",
}


def _count_sql(rule: Rule) -> str:
    if rule.rule_id in _WHERE:
        table, where = _WHERE[rule.rule_id]
        counts = f"(SELECT count(*) FROM {table}), (SELECT count(*) FROM {table} WHERE {where})"
    else:
        counts = _WHOLE[rule.rule_id]
    column = f"'{rule.column}'" if rule.column else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{rule.rule_id}' AS rule_id, '{rule.table}' AS table_name, {column} AS column_name, "
            f"'{rule.rule_type}' AS rule_type, CAST({rule.threshold} AS DECIMAL(5,2)) AS threshold, "
            f"t.total_rows, t.failed_rows FROM (SELECT {counts}) AS t(total_rows, failed_rows)")


def _results(rules) -> dict[str, str]:
    pct = f"CASE WHEN total_rows > 0 THEN {rounded('failed_rows * 100', 'total_rows', 'DECIMAL(5,2)')} ELSE 0 END"
    return {
        "test_orders": TEST_ORDERS_SQL.format(text="VARCHAR", orders="orders"),
        "counted": " UNION ALL ".join(_count_sql(r) for r in rules),
        "results": f"""SELECT DATE '2025-03-18' AS check_date, rule_id, table_name, column_name, rule_type, total_rows,
            failed_rows, CAST({pct} AS DECIMAL(5,2)) AS failed_percentage,
            CASE WHEN {pct} = 0 THEN 'PASSED' WHEN {pct} <= threshold THEN 'WARNING' ELSE 'FAILED' END AS check_status
            FROM counted""",
    }


def results_sql(rules, body: str = "SELECT * FROM results") -> str:
    return with_tables("dwd_orders dim_channel", body, **_results(rules))


def _check(rules):
    def run(spark, sf_dir):
        return q.check(tables(spark, sf_dir), rules, CHECK_DATE).drop("rule_name", "schema_name")
    return run


def _of_type(kind: str):
    rules = [r for r in RULES if r.rule_type == kind]
    return _check(rules), results_sql(rules)


def dq_status_summary(spark, sf_dir):
    return q.status_summary(q.check(tables(spark, sf_dir), RULES, CHECK_DATE))


def _daily_results(spark, sf_dir):
    """Three rules checked on every day of the events."""
    events = Retail(spark, sf_dir).raw("events")
    wide = events.groupBy(F.to_date("ts").alias("check_date")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("value") > 250).alias("r1"),
        F.count_if(F.col("event_type") == "error").alias("r2"), F.count_if(F.col("user_id").isNull()).alias("r3"))
    long = wide.select("check_date", "total", F.explode(F.array("r1", "r2", "r3")).alias("failed"))
    pct = q.failed_percentage(F.col("failed"), F.col("total"))
    return long.select("check_date", q.check_status(pct, F.lit(5)).alias("check_status"))


def dq_trend(spark, sf_dir):
    return q.status_trend(_daily_results(spark, sf_dir))


DQ_TREND_SQL = f"""
WITH wide AS (SELECT CAST(ts AS DATE) AS check_date, count(*) AS total, count(*) FILTER (WHERE value > 250) AS r1,
                     count(*) FILTER (WHERE event_type = 'error') AS r2, count(*) FILTER (WHERE user_id IS NULL) AS r3
              FROM events GROUP BY 1),
long AS (SELECT check_date, total, r1 AS failed FROM wide UNION ALL SELECT check_date, total, r2 FROM wide
         UNION ALL SELECT check_date, total, r3 FROM wide),
rated AS (SELECT check_date, {rounded('failed * 100', 'total', 'DECIMAL(5,2)')} AS pct FROM long)
SELECT check_date, count(*) AS total_checks, count(*) FILTER (WHERE pct = 0) AS passed,
       count(*) FILTER (WHERE pct > 5) AS failed
FROM rated GROUP BY check_date"""


def dq_stored_trend(spark, sf_dir):
    """Rules read from a table, one check for each week of the events, results stored by its first day; one week is checked again.

    The trend is read from the store.
    """
    rows = [("T1", "RANGE", "value", {"max": "250"}), ("T2", "CUSTOM", None, {"condition": "event_type = 'error'"}),
            ("T3", "NOT_NULL", "user_id", {}), ("T4", "NOT_NULL", "event_id", {})]
    table = spark.createDataFrame([(i, i, "", "events", c, t, f, None, "LOG", i != "T4", i) for i, t, c, f in rows], q.RULE_TABLE)
    rules, path, events = q.rules_from_table(table), work_path(spark, "quality"), Retail(spark, sf_dir).raw("events")
    week = F.to_date(F.date_trunc("week", "ts"))
    weeks = [r[0] for r in events.select(week.alias("w")).distinct().orderBy("w").collect()]
    for day in (*weeks, weeks[0]):
        q.store_results(q.check({"events": events.filter(week == F.lit(day))}, rules, day), path)
    results = q.check({"events": events}, rules, CHECK_DATE)
    return q.status_trend(q.stored_results(spark, path, results.schema))


DQ_STORED_SQL = f"""
WITH wide AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS check_date, count(*) AS total, count(*) FILTER (WHERE value > 250) AS r1,
                     count(*) FILTER (WHERE event_type = 'error') AS r2, count(*) FILTER (WHERE user_id IS NULL) AS r3
              FROM events GROUP BY 1),
long AS (SELECT check_date, total, r1 AS failed FROM wide UNION ALL SELECT check_date, total, r2 FROM wide
         UNION ALL SELECT check_date, total, r3 FROM wide),
rated AS (SELECT check_date, {rounded('failed * 100', 'total', 'DECIMAL(5,2)')} AS pct FROM long)
SELECT check_date, count(*) AS total_checks, count(*) FILTER (WHERE pct = 0) AS passed,
       count(*) FILTER (WHERE pct > 5) AS failed
FROM rated GROUP BY check_date"""


def dq_selected_rules(spark, sf_dir):
    """Rules chosen by table, by id, and as a whole schema, with one of them switched off."""
    rules = [replace(r, schema="sales" if r.table in ("customer", "lineitem") else "web", active=r.rule_id != "url_is_https") for r in RULES]
    named = tables(spark, sf_dir)
    chosen = {"table": q.select_rules(rules, table="documents"), "rule": q.select_rules(rules, rule_id="email_length"),
              "schema": q.select_rules(rules, schema="sales"), "off": q.select_rules(rules, rule_id="url_is_https")}
    parts = [q.check(named, some, CHECK_DATE).select(F.lit(name).alias("chosen_by"), "rule_id", "schema_name", "failed_rows")
             for name, some in chosen.items() if some]
    return reduce(DataFrame.unionByName, parts)


def dq_rule_report(spark, sf_dir):
    """Results joined to their rules' descriptions; the rule table is inline."""
    from tidemill.sources import values_relation
    rules = values_relation(spark, ["rule_id", "description"], [(r.rule_id, f"{r.rule_type} on {r.table}") for r in RULES])
    return q.rule_report(q.check(tables(spark, sf_dir), RULES, CHECK_DATE), rules).select(
        "rule_id", "description", "total_rows", "failed_rows", "failed_percentage", "check_status")


SAMPLE_KEYS = {"test_orders": ["order_id"], "customer": ["c_custkey"], "pages": ["page_id"], "lineitem": ["l_orderkey", "l_linenumber"],
               "labels": ["doc_id"], "dwd_orders": ["order_id"], "documents": ["doc_id"]}


def dq_error_samples(spark, sf_dir):
    """The keys of the rows that are sampled for each rule, in their order; key rules sample rows that may be equal, of which any may be taken."""
    rules = [r for r in RULES if r.rule_type not in ("UNIQUE",) and r.table != "dwd_orders"]
    samples = q.error_samples(tables(spark, sf_dir), rules, 20, SAMPLE_KEYS)
    rows = F.from_json("error_details", "array<struct<order_id: long, c_custkey: long, page_id: long, doc_id: long>>")
    return samples.select("rule_id", F.posexplode(rows).alias("place", "row")).select(
        "rule_id", "place", F.coalesce("row.order_id", "row.c_custkey", "row.page_id", "row.doc_id").alias("key"))


_KEY = {"test_orders": "order_id", "customer": "c_custkey", "pages": "page_id", "labels": "doc_id", "documents": "doc_id"}
_BAD = {r.rule_id: (_WHERE[r.rule_id][0], _WHERE[r.rule_id][1]) for r in RULES if r.rule_id in _WHERE} | {
    "label_has_document": ("labels", "NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = labels.doc_id)")}
SAMPLES_SQL = results_sql(RULES, " UNION ALL ".join(
    f"""SELECT '{rule}' AS rule_id, CAST(p - 1 AS INTEGER) AS place, CAST({_KEY[table]} AS BIGINT) AS key
        FROM (SELECT {_KEY[table]}, row_number() OVER (ORDER BY md5(CAST({_KEY[table]} AS VARCHAR))) AS p FROM {table} WHERE {where}) t WHERE p <= 20"""
    for rule, (table, where) in _BAD.items()))


def dq_rule_ratios(spark, sf_dir):
    lines = Retail(spark, sf_dir).raw("lineitem")
    return q.hit_ratios(lines, {
        "returned": F.col("l_returnflag") == "R", "discounted": F.col("l_discount") > 0.05,
        "bulk": F.col("l_quantity") >= 40, "never": F.col("l_orderkey").isNull(),
    })


DQ_RATIOS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS rule_name, count(*) AS total_rows, count(CASE WHEN {cond} THEN 1 END) AS failed_count, "
    f"{rounded(f'count(CASE WHEN {cond} THEN 1 END) * 100', 'count(*)', 'DECIMAL(5,2)')} AS failed_percentage FROM lineitem"
    for name, cond in (("returned", "l_returnflag = 'R'"), ("discounted", "l_discount > 0.05"),
                       ("bulk", "l_quantity >= 40"), ("never", "l_orderkey IS NULL")))

_MARKED = [r for r in RULES if r.table == "test_orders" and r.rule_type in q.ROW_TYPES]


def dq_row_status(spark, sf_dir):
    """ALLOW strategy: each order with the rules it breaks."""
    return q.mark_rows(tables(spark, sf_dir)["test_orders"], _MARKED).select("order_id", "dq_failed", "dq_status")


_MARK_LIST = ", ".join(f"CASE WHEN {_WHERE[r.rule_id][1]} THEN '{r.rule_id}' END" for r in _MARKED)
DQ_ROW_STATUS_SQL = f"""
WITH test_orders AS ({TEST_ORDERS_SQL.format(text='VARCHAR', orders='orders')}),
marked AS (SELECT order_id, concat_ws(',', {_MARK_LIST}) AS dq_failed FROM test_orders)
SELECT order_id, dq_failed, CASE WHEN dq_failed = '' THEN 'PASS' ELSE 'REJECT' END AS dq_status FROM marked"""

FLOW_RULES = [
    Rule("O1", "NOT_NULL", "orders_summary", "summary_id", {"empty_fails": True}, 0.0),
    Rule("O2", "RANGE", "orders_summary", "total_amount", {"min": 0, "max": 999999999.99, "nulls_fail": True}),
    Rule("O3", "REFERENTIAL", "orders_summary", "channel_code", {"ref_table": "dim_channel", "ref_field": "channel_code"}),
    Rule("C1", "NOT_NULL", "channel_sales", "analysis_id", {"empty_fails": True}, 0.0),
    Rule("C2", "RANGE", "channel_sales", "total_order_amount", {"min": 0}),
    Rule("C3", "CUSTOM", "channel_sales", None,
         {"condition": "abs(total_net_amount - (total_order_amount - total_refund_amount)) > 0.01"}),
    Rule("C4", "UNIQUE", "channel_sales", "analysis_id"),
]


def dq_flow_checks(spark, sf_dir):
    """The load flows' own checks, run over both whole summaries."""
    r = Retail(spark, sf_dir)
    checked = {
        "orders_summary": orders_summary(r.orders(), r.channels(), full=True, load_ts=LOAD_TS),
        "channel_sales": cs.channel_sales(channel_tables(spark, sf_dir), load_ts=LOAD_TS),
        "dim_channel": r.channels(),
    }
    return q.check(checked, FLOW_RULES, CHECK_DATE).select("rule_id", "total_rows", "failed_rows", "failed_percentage",
                                                           "check_status")


_DIMS = ", ".join(cs.DIMENSIONS)
# (rule, table, condition of a failing row, threshold)
_FLOW_FAULTS = [
    ("O1", "orders_summary", "summary_id IS NULL OR summary_id = ''", 0.0),
    ("O2", "orders_summary", "total_amount IS NULL OR total_amount < 0 OR total_amount > 999999999.99", 5.0),
    ("O3", "orders_summary", "channel_code NOT IN (SELECT channel_code FROM dim_channel WHERE is_valid = 'Y')", 5.0),
    ("C1", "channel_sales", "analysis_id IS NULL OR analysis_id = ''", 0.0),
    ("C2", "channel_sales", "total_order_amount < 0", 5.0),
    ("C3", "channel_sales", "abs(total_net_amount - (total_order_amount - total_refund_amount)) > 0.01", 5.0),
]
_CHECKED = {
    "orders_summary": """SELECT md5(CAST(stat_date AS VARCHAR) || '_' || channel_code) AS summary_id, channel_code, sum(order_amount) AS total_amount
        FROM dwd_orders WHERE order_status IN ('COMPLETED', 'PAID') AND is_deleted = 'N' GROUP BY stat_date, channel_code""",
    "channel_sales": f"""SELECT md5(CAST(stat_date AS VARCHAR) || '_' || channel_code) AS analysis_id, sum(order_amount) AS total_order_amount,
               sum(refund_amount) AS total_refund_amount, sum(order_amount - refund_amount) AS total_net_amount
        FROM described_lines GROUP BY {_DIMS}""",
    "counted": " UNION ALL ".join(
        f"SELECT '{rule}' AS rule_id, count(*) AS total_rows, count(*) FILTER (WHERE {fault}) AS failed_rows, {limit} AS threshold FROM {table}"
        for rule, table, fault, limit in _FLOW_FAULTS) + """
        UNION ALL SELECT 'C4', (SELECT count(*) FROM channel_sales),
            (SELECT count(*) FROM (SELECT 1 FROM channel_sales GROUP BY analysis_id HAVING count(*) > 1) d), 5.0""",
}
_PCT = rounded("failed_rows * 100", "total_rows", "DECIMAL(5,2)")
DQ_FLOW_SQL = with_tables("described_lines dim_channel", f"""
    SELECT rule_id, total_rows, CAST(failed_rows AS BIGINT) AS failed_rows, {_PCT} AS failed_percentage,
           CASE WHEN {_PCT} = 0 THEN 'PASSED' WHEN {_PCT} <= threshold THEN 'WARNING' ELSE 'FAILED' END AS check_status
    FROM counted""", **_CHECKED)

QUERIES = {
    "dq_selected_rules": (dq_selected_rules, results_sql(RULES, """
        SELECT 'table' AS chosen_by, rule_id, 'web' AS schema_name, failed_rows FROM results WHERE rule_id IN ('language_known', 'document_length')
        UNION ALL SELECT 'rule', rule_id, 'web', failed_rows FROM results WHERE rule_id = 'email_length'
        UNION ALL SELECT 'schema', rule_id, 'sales', failed_rows FROM results WHERE rule_id IN ('balance_not_negative', 'line_key_unique')""")),
    "dq_stored_trend": (dq_stored_trend, DQ_STORED_SQL),
    "dq_results_long": (_check(RULES), results_sql(RULES)),
    **{f"dq_{kind.lower()}": _of_type(kind) for kind in (
        "NOT_NULL", "UNIQUE", "RANGE", "REGEX", "CUSTOM", "REFERENTIAL", "IN_SET", "DATE_RANGE", "INT_RANGE", "TEXT_LENGTH")},
    "dq_status_summary": (dq_status_summary, results_sql(RULES, """
        SELECT check_date, count(*) AS total_rules, count(*) FILTER (WHERE check_status = 'PASSED') AS passed,
               count(*) FILTER (WHERE check_status = 'WARNING') AS warnings,
               count(*) FILTER (WHERE check_status = 'FAILED') AS failed
        FROM results GROUP BY check_date""")),
    "dq_trend": (dq_trend, DQ_TREND_SQL),
    "dq_rule_report": (dq_rule_report, results_sql(RULES, """
        SELECT rule_id, rule_type || ' on ' || table_name AS description, total_rows, failed_rows, failed_percentage,
               check_status FROM results""")),
    "dq_error_samples": (dq_error_samples, SAMPLES_SQL),
    "dq_rule_ratios": (dq_rule_ratios, DQ_RATIOS_SQL),
    "dq_row_status": (dq_row_status, DQ_ROW_STATUS_SQL),
    "dq_flow_checks": (dq_flow_checks, DQ_FLOW_SQL),
}
