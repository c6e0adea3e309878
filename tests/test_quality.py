from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from tidemill.operators import quality as q
from tidemill.operators.quality import Rule

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
DAY = date(2025, 3, 18)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([
        (1, 101, Decimal("100.00"), "customer1@example.com", "COMPLETED"),
        (2, 102, None, "customer2@example.com", "PENDING"),
        (3, 103, Decimal("200.00"), "invalid-email", "COMPLETED"),
        (4, None, Decimal("150.00"), "customer4@example.com", "COMPLETED"),
        (5, 101, Decimal("100.00"), "customer5@example.com", "COMPLETED"),
        (6, 106, Decimal("-50.00"), "customer6@example.com", "CANCELLED"),
    ], "order_id int, customer_id int, order_amount decimal(10,2), email string, status string")


RULES = [
    Rule("1", "NOT_NULL", "t", "customer_id", threshold=0.0),
    Rule("2", "RANGE", "t", "order_amount", {"min": 0.01, "max": 999999.99}, 5.0),
    Rule("3", "REGEX", "t", "email", {"pattern": EMAIL}, 2.0),
    Rule("4", "UNIQUE", "t", "order_id", threshold=0.0),
]


def test_sample_orders(orders):
    got = {r["rule_id"]: (r["failed_rows"], r["total_rows"], str(r["failed_percentage"]), r["check_status"])
           for r in q.check({"t": orders}, RULES, DAY).collect()}
    assert got == {"1": (1, 6, "16.67", "FAILED"), "2": (1, 6, "16.67", "FAILED"), "3": (1, 6, "16.67", "FAILED"),
                   "4": (0, 6, "0.00", "PASSED")}


def test_row_rules_share_one_pass(orders):
    counts = q.rule_counts({"t": orders}, RULES[:3])
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


@pytest.mark.parametrize("rule, failed", [
    (Rule("u", "UNIQUE", "t", "customer_id"), 1),
    (Rule("n", "NOT_NULL", "t", None), 0),
    (Rule("o", "RANGE", "t", "order_amount", {"min": 0}), 1),
    (Rule("o", "RANGE", "t", "order_amount", {"min": 0, "nulls_fail": True}), 2),
    (Rule("c", "CUSTOM", "t", None, {"condition": "status = 'PENDING' AND order_amount IS NULL"}), 1),
    (Rule("s", "IN_SET", "t", "status", {"values": ["COMPLETED"]}), 2),
    (Rule("l", "TEXT_LENGTH", "t", "email", {"min": 15}), 1),
])
def test_single_rules(orders, rule, failed):
    assert q.rule_counts({"t": orders}, [rule]).first()["failed_rows"] == failed


def test_empty_table_passes(orders):
    got = q.check({"t": orders.limit(0)}, RULES, DAY).collect()
    assert {(r["total_rows"], r["failed_rows"], r["failed_percentage"], r["check_status"]) for r in got} == {
        (0, 0, Decimal("0.00"), "PASSED")}


def test_warning_below_threshold(orders):
    rule = Rule("w", "NOT_NULL", "t", "customer_id", threshold=20.0)
    assert q.check({"t": orders}, [rule], DAY).first()["check_status"] == "WARNING"


def test_referential_counts_rows_and_skips_null(spark, orders):
    dim = spark.createDataFrame([(101, "Y"), (102, "N"), (103, "Y")], "id int, is_valid string")
    rule = Rule("r", "REFERENTIAL", "t", "customer_id", {"ref_table": "d", "ref_field": "id"})
    assert q.rule_counts({"t": orders, "d": dim}, [rule]).first()["failed_rows"] == 2
    assert rows(q.failing_rows({"t": orders, "d": dim}, rule).select("order_id")) == [(2,), (6,)]


def test_samples_for_every_kind_of_rule(orders):
    results = {r["rule_id"]: r["error_details"] for r in
               q.check_with_samples({"t": orders}, [*RULES, Rule("5", "UNIQUE", "t", "customer_id")], DAY).collect()}
    assert '"order_id":4' in results["1"] and '"order_id":6' in results["2"] and '"order_id":3' in results["3"]
    assert results["4"] == "[]"
    assert '"order_id":1' in results["5"] and '"order_id":5' in results["5"]


def test_sample_size(orders):
    rule = Rule("c", "CUSTOM", "t", None, {"condition": "true"})
    assert q.error_samples({"t": orders}, [rule], 2).first()["error_details"].count("order_id") == 2


def test_rule_selection_and_faults(orders):
    rules = [Rule("a", "NOT_NULL", "t", "x", schema="s"), Rule("b", "NOT_NULL", "u", "x", active=False)]
    assert [r.rule_id for r in q.select_rules(rules)] == ["a"]
    assert q.select_rules(rules, table="u") == []
    assert [r.rule_id for r in q.select_rules(rules, schema="s", rule_id="a")] == ["a"]
    with pytest.raises(ValueError, match="unknown rule type"):
        q.rule_counts({"t": orders}, [Rule("x", "SHAPE", "t", "email")])


def test_micro_format():
    assert q.parse_rule("RULE001:NOT_NULL:summary_id", "t") == Rule("RULE001", "NOT_NULL", "t", "summary_id")
    assert q.parse_rule("R2:RANGE:amount:0:", "t").config == {"min": "0"}
    assert q.parse_rule("R3:REFERENTIAL:code:dim_x:key", "t").config == {"ref_table": "dim_x", "ref_field": "key"}
    assert q.parse_rule("R4:REGEX:url:^https://", "t").config == {"pattern": "^https://"}
    with pytest.raises(ValueError):
        q.parse_rule("R5", "t")


def test_strategies():
    rules = [Rule("a", "NOT_NULL", "t", "x", threshold=5.0), Rule("b", "NOT_NULL", "t", "y", threshold=5.0)]
    few = [{"rule_id": "a", "failed_rows": 1, "failed_percentage": 1}, {"rule_id": "b", "failed_rows": 0, "failed_percentage": 0}]
    many = [{"rule_id": "a", "failed_rows": 9, "failed_percentage": 9}]
    assert q.enforce(few, rules, "LOG") == ["a"]
    assert q.enforce(many, rules, "ALLOW") == ["a"]
    assert q.enforce(few, rules, "REJECT_AFTER_LOG") == ["a"]
    for results, strategy in ((few, "REJECT"), (many, "REJECT_AFTER_LOG")):
        with pytest.raises(q.QualityError):
            q.enforce(results, rules, strategy)
    with pytest.raises(q.QualityError):
        q.enforce(few, [Rule("a", "NOT_NULL", "t", "x", error_action="REJECT"), rules[1]], "LOG")


def test_marked_rows(orders):
    marked = q.mark_rows(orders, RULES[:3])
    assert rows(marked.filter("dq_status = 'REJECT'").select("order_id", "dq_failed")) == [(3, "3"), (4, "1"), (6, "2")]
