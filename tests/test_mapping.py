import json
from datetime import date, datetime

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from queries.mappings import sources
from tidemill.operators import fold_conditions
from tidemill.operators.quality import QualityError
from tidemill.plans.builder import build
from tidemill.plans.mapping import DOCUMENTS, document_faults, load_mapping, parse_mapping
from tidemill.plans.orders_summary import late_orders_summary, orders_summary
from tidemill.plans.runner import run_mapping
from tidemill.runlog import RunLog, UpstreamError, metric_breaches, missing_upstreams
from tidemill.sources import Retail
from tidemill.sources.reader import typed_rows
from tidemill.schemas import RUN_LOG

TS = datetime(2025, 1, 1)
DAY = date(1998, 4, 2)  # two late orders at this scale


def document(name):
    return json.loads((DOCUMENTS / f"{name}.json").read_text(encoding="utf-8"))


@pytest.mark.parametrize("full, late", [(True, False), (False, True)])
def test_mapping_equals_the_hand_written_flow(spark, full, late):
    r = Retail(spark, SMALL)
    by_hand = orders_summary(r.orders(late), r.channels(), DAY, full=full, load_ts=TS)
    mapped = build(load_mapping("orders_summary"), sources(spark, SMALL, late), DAY, full=full, load_ts=TS)
    assert mapped.columns == by_hand.columns
    assert rows(mapped) == rows(by_hand) != []


def test_order_by(spark):
    got = [(r["stat_date"], r["total_amount"]) for r in
           build(load_mapping("orders_summary"), sources(spark, SMALL), load_ts=TS).collect()]
    assert got == sorted(got, reverse=True)


def test_increment_filter_reaches_the_fact_scan(spark, tmp_path):
    Retail(spark, SMALL).orders().write.parquet(f"{tmp_path}/orders")
    at = {"dwd_trade_orders_detail_day": spark.read.parquet(f"{tmp_path}/orders"), "dim_channel_info": Retail(spark, SMALL).channels()}
    plan = build(load_mapping("orders_summary"), at, DAY, full=False)._jdf.queryExecution().executedPlan().toString()
    assert "etl_load_time" in plan.split("PushedFilters")[1] and "CartesianProduct" not in plan


def test_shipped_documents_pass_the_checklist():
    for name in ("orders_summary", "channel_sales"):
        faults = document_faults(document(name))
        assert faults == ([] if name == "orders_summary" else [])


def test_checklist_finds_faults():
    doc = document("orders_summary")
    doc["entity"].pop("distribution_key")
    doc["entity"]["target_table"] = "x" * 41
    doc["entity"]["validation_rules"] = []
    doc["entity"]["loading_strategy"] = "SCD2"
    doc["entity"]["sql_conditions"]["joins"][0]["table_alias"] = "q"
    for a in doc["attributes"]:
        a.pop("aggregate_config", None), a.pop("lookup_config", None)
    found = " | ".join(document_faults(doc))
    for word in ("distribution_key", "40 characters", "NOT_NULL rule", "scd_config", "alias q", "LOOKUP config", "AGGREGATE config"):
        assert word in found


def test_circular_fields_and_unknown_types_are_refused(spark):
    doc = document("orders_summary")
    doc["attributes"] = [
        {"seq": 1, "target_field": "a", "gen_type": "CALCULATE", "process_logic": "b + 1", "target_type": "BIGINT"},
        {"seq": 2, "target_field": "b", "gen_type": "CALCULATE", "process_logic": "a + 1", "target_type": "BIGINT"}]
    with pytest.raises(ValueError, match="circle"):
        build(parse_mapping(doc), sources(spark, SMALL))
    doc["attributes"] = [{"seq": 1, "target_field": "a", "gen_type": "GUESS"}]
    with pytest.raises(ValueError, match="unknown expression type"):
        parse_mapping(doc)


def test_cross_side_must_be_small(spark):
    doc = document("orders_summary")
    doc["entity"]["sql_conditions"]["joins"] = [{"join_sequence": 1, "join_type": "CROSS", "table_alias": "b"}]
    at = {"dwd_trade_orders_detail_day": Retail(spark, SMALL).orders(), "dim_channel_info": Retail(spark, SMALL).orders()}
    with pytest.raises(ValueError, match="CROSS"):
        build(parse_mapping(doc), at)


def test_formula_template_and_batch_date(spark):
    doc = document("orders_summary")
    avg = next(a for a in doc["attributes"] if a["target_field"] == "avg_order_amount")
    assert next(f for f in parse_mapping(doc).fields if f.name == "avg_order_amount").expression == (
        "COALESCE(total_amount / NULLIF(total_orders, 0), 0)")
    avg["calculation_config"]["zero_division_handling"] = "NULL"
    assert "COALESCE" not in next(f for f in parse_mapping(doc).fields if f.name == "avg_order_amount").expression


@pytest.mark.parametrize("conditions, expected", [
    ([("a", ">", 1, "NUMBER", 1, "AND"), ("a", "<", 4, "NUMBER", 1, "AND")], [2, 3]),
    ([("a", "=", 1, "NUMBER", 1, "AND"), ("a", "=", 5, "NUMBER", 1, "OR"), ("a", "!=", 5, "NUMBER", 2, "AND")], [1]),
    ([("a", "NOT IN", [1, 2, 3], "ARRAY", 1, "AND")], [4, 5]),
    ([("s", "LIKE", "v%", "STRING", 1, "AND"), ("a", "BETWEEN", [2, 4], "ARRAY", 1, "AND")], [2, 3, 4]),
    ([("n", "IS NULL", None, None, 1, "AND")], [5]),
    ([("n", "!=", 1, "NUMBER", 1, "AND")], [2, 3, 4]),
    ([("n", "IS DISTINCT FROM", 1, "NUMBER", 1, "AND")], [2, 3, 4, 5]),
])
def test_conditions(spark, conditions, expected):
    df = spark.sql("SELECT CAST(id AS INT) AS a, 'v' || id AS s, IF(id = 5, NULL, id) AS n FROM range(1, 6)")
    folded = fold_conditions([
        {"sequence": i, "field": f, "operator": op, "value": v, "value_type": t, "condition_group": g, "logic": lg}
        for i, (f, op, v, t, g, lg) in enumerate(conditions)])
    assert [r["a"] for r in df.filter(folded).orderBy("a").collect()] == expected


def test_run_twice_with_gate_log_and_late_days(spark, database, tmp_path):
    mapping, log = load_mapping("orders_summary"), RunLog(spark, f"{tmp_path}/log")
    target, at = f"{database}.summary", sources(spark, SMALL, late=True)
    with pytest.raises(UpstreamError):
        run_mapping(spark, mapping, at, DAY, log, target=target, load_ts=TS)
    assert log.runs().filter("status = 'FAILED'").select("step", "error_code").first()[:] == ("DEPENDENCY_CHECK", "UpstreamError")
    for name in mapping.upstreams:
        log.add(proc_name=name, batch_date=DAY, status="SUCCESS", step="COMPLETE")
    first = run_mapping(spark, mapping, at, DAY, log, target=target, load_ts=TS)
    again = run_mapping(spark, mapping, at, DAY, log, target=target, load_ts=TS)
    r = Retail(spark, SMALL)
    whole_days = late_orders_summary(r.orders(late=True), r.channels(), DAY, load_ts=TS)
    assert rows(spark.table(target).select(*whole_days.columns)) == rows(whole_days)
    assert again.inserted == again.deleted == first.inserted and first.deleted == 0
    steps = [x["step"] for x in log.runs().filter("status = 'SUCCESS' AND mapping_id IS NOT NULL").collect()]
    assert steps.count("COMPLETE") == 2 and steps.count("DATA_LOAD") == 2


def test_reject_publishes_nothing(spark, database, tmp_path):
    doc = document("orders_summary")
    doc["entity"]["exception_strategy"] = "REJECT"
    mapping, log = parse_mapping(doc), RunLog(spark, f"{tmp_path}/log")
    target, at = f"{database}.summary", sources(spark, SMALL, late=True)
    bad_days = [r[0] for r in Retail(spark, SMALL).orders(late=True).filter("channel_code = 'CH5' AND order_status = 'PAID' AND is_deleted = 'N'")
                .select(F.to_date("etl_load_time")).limit(1).collect()]
    with pytest.raises(QualityError):
        run_mapping(spark, mapping, at, bad_days[0], log, target=target, load_ts=TS, check_upstreams=False)
    assert spark.table(target).count() == 0
    assert log.faults().filter("rule_id = 'R003' AND error_count > 0").count() == 1
    assert log.runs().filter("step = 'DATA_LOAD' AND status = 'FAILED'").count() == 1


def test_gate_needs_each_upstream(spark):
    runs = typed_rows(spark, [
        {"proc_name": "a", "batch_date": DAY, "step": s, "status": "SUCCESS"} for s in ("INIT", "COMPLETE")
    ] + [{"proc_name": "b", "batch_date": DAY, "status": "FAILED"}], RUN_LOG)
    assert rows(missing_upstreams(runs, ["a", "b"], DAY)) == [(DAY, "b")]
    assert missing_upstreams(runs, ["a"], DAY).count() == 0


def test_thresholds(spark):
    runs = spark.sql("SELECT 'p' AS proc, 0L AS row_count, 10D AS duration_seconds, 7D AS error_rate_percent "
                     "UNION ALL SELECT 'q', 5L, 4000D, CAST(NULL AS DOUBLE)")
    got = {(r["proc"], r["metric"]): r["breached"] for r in metric_breaches(runs, ["proc"]).collect()}
    assert got == {("p", "row_count"): True, ("p", "duration_seconds"): False, ("p", "error_rate_percent"): True,
                   ("q", "row_count"): False, ("q", "duration_seconds"): True, ("q", "error_rate_percent"): False}
