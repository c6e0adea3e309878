from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from tidemill.operators import jsonflat, quality as q
from tidemill.operators.joins import hash_join
from tidemill.operators.unions import common_type, union_branches
from tidemill.plans.aggregation import Aggregates, Call, plan
from tidemill.plans.builder import build
from tidemill.plans.mapping import load_mapping, parse_mapping


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hash_join_with_a_key_in_a_third_of_both_sides(spark, how):
    left = spark.range(300).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(600).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 40 != 1, F.col("id") * 2).alias("k"), F.col("id").alias("b"))
    want = left.join(right, "k", how).select("k", "a", "b")
    for most in (10, 1000):
        got = hash_join(left, right, ["k"], how, most)
        assert got.columns == ["k", "a", "b"] and rows(got) == rows(want)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan_text = hash_join(left, right, ["k"], how, 10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan_text and "__salt" in plan_text


def test_common_types():
    assert common_type([T.IntegerType(), T.LongType(), T.ShortType()]) == T.LongType()
    assert common_type([T.LongType(), T.DecimalType(12, 2)]) == T.DecimalType(21, 2)
    assert common_type([T.DecimalType(12, 2), T.DecimalType(10, 4)]) == T.DecimalType(14, 4)
    assert common_type([T.DecimalType(38, 0), T.DecimalType(20, 10)]) == T.StringType()
    assert common_type([T.DateType(), T.TimestampNTZType()]) == T.TimestampNTZType()
    assert common_type([T.NullType(), T.DateType()]) == T.DateType() and common_type([T.NullType()]) == T.StringType()
    assert common_type([T.StringType(), T.IntegerType()]) == T.StringType()


def test_union_by_name(spark):
    a, b = spark.sql("SELECT 1 AS x, 'p' AS y"), spark.sql("SELECT 2.50BD AS x, DATE'2024-01-31' AS z")
    got = union_branches({"a": a, "b": b}, "branch")
    assert got.columns == ["x", "y", "z", "branch"]
    assert [tuple(map(str, r)) for r in got.collect()] == [("1.00", "p", "None", "a"), ("2.50", "None", "2024-01-31", "b")]
    with pytest.raises(ValueError):
        union_branches({})


def test_union_branches_need_names(spark):
    branch = {"branch_name": "a", "source_tables": [], "attributes": []}
    with pytest.raises(ValueError):
        parse_mapping({"entity": {"mapping_id": "m", "target_table": "t"}, "union": {"branches": [branch, branch]}, "attributes": []})


def test_deep_documents_and_data_keys(spark):
    deep = '{"a":' * 11 + "1" + "}" * 11
    df = spark.createDataFrame([(deep,), ('{"e": {}, "x": 1, "m": 1}',), ('{"x": 1.5, "m": "s", "n": null}',), (None,)], "j string")
    assert rows(jsonflat.json_paths(df, "j")) == [
        (".".join("a" * 11), "a", "int", 1), ("m", "m", "variant", 2), ("n", "n", "NoneType", 0), ("x", "x", "float", 2)]
    many = spark.range(100_000).select(F.concat(F.lit('{"k'), "id", F.lit('": {"v": '), "id", F.lit("}}")).alias("j"))
    found = jsonflat.json_paths(many, "j")
    assert found.count() == 100_000 and found.filter("documents <> 1 OR type <> 'int' OR name <> 'v'").count() == 0
    with pytest.raises(ValueError):
        jsonflat.json_paths(spark.createDataFrame([("[1]",)], "j string"), "j")


def test_samples_do_not_depend_on_the_layout(spark):
    df = spark.range(2000).select("id", (F.col("id") % 7).alias("v"))
    rules = [q.Rule("low", "RANGE", "t", "v", {"min": 2}), q.Rule("high", "RANGE", "t", "v", {"max": 3}), q.Rule("none", "RANGE", "t", "v", {"min": 0})]
    first, second = (rows(q.error_samples({"t": t}, rules, 25)) for t in (df.coalesce(1), df.repartition(7, F.rand(3))))
    assert first == second and [r[0] for r in first] == ["high", "low"]
    assert all(len(r[1].split("},{")) == 25 for r in first)
    plan_text = q.error_samples({"t": df}, rules, 25)._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("Range (") == 1 and "WindowGroupLimit" in plan_text


def test_aggregate_calls_are_found():
    found = Aggregates(["o.day", "c.name"])
    text = found.rewrite("CASE WHEN COALESCE(SUM(i.q), 0) > 0 THEN SUM( i.q ) / COUNT(DISTINCT CASE WHEN o.f = ')' THEN o.id END) ELSE 0 END")
    assert text == "CASE WHEN COALESCE(agg_0, 0) > 0 THEN agg_0 / agg_1 ELSE 0 END"
    assert found.calls == [Call("SUM", "i.q"), Call("COUNT", "CASE WHEN o.f = ')' THEN o.id END", True)]
    assert found.calls[1].chosen == ("o.id", "o.f = ')'")
    assert found.rewrite("COALESCE(c.name, 'c.name x')").startswith("COALESCE(grp_1, ")


def test_details_are_reduced_before_their_join(spark):
    mapping = load_mapping("channel_sales")
    found = plan(mapping, [f.expression for f in mapping.fields if f.kind in ("DIRECT", "LOOKUP", "AGGREGATE")])
    assert {a: r.keys for a, r in found.reductions.items()} == {
        "itm": ("order_id", "product_id"), "pay": ("order_id",), "ref": ("order_id",), "inv": ("product_id", "stat_date")}
    assert found.reductions["itm"].filters == ("itm.is_valid = 'Y'",) and found.reductions["pay"].sums == ()


def _shop(spark):
    orders = spark.sql("SELECT id AS order_id, id % 5 AS customer, id % 3 AS shop, CAST(id * 1.25 AS DECIMAL(10,2)) AS amount FROM range(60)")
    items = spark.sql("SELECT id % 50 AS order_id, id % 9 AS product, CAST(id AS DECIMAL(10,2)) AS price, IF(id % 4 = 0, 'N', 'Y') AS ok FROM range(400)")
    notes = spark.sql("SELECT id % 20 AS order_id, id AS note, IF(id % 2 = 0, CAST(id AS INT), NULL) AS stars FROM range(70)")
    return {"orders": orders, "items": items, "notes": notes}


@pytest.mark.parametrize("how", ["LEFT", "INNER"])
def test_eager_aggregation_equals_the_raw_joins(spark, how):
    fields = [("shop", "BIGINT", "DIRECT", "o.shop"), ("n", "BIGINT", "AGGREGATE", "COUNT(*)"), ("amount", "DECIMAL", "AGGREGATE", "SUM(o.amount)"),
              ("price", "DECIMAL", "AGGREGATE", "COALESCE(SUM(i.price), 0)"), ("stars", "BIGINT", "AGGREGATE", "SUM(n.stars)"),
              ("rated", "BIGINT", "AGGREGATE", "COUNT(o.customer)"), ("top", "DECIMAL", "AGGREGATE", "MAX(o.amount)"),
              ("products", "BIGINT", "AGGREGATE", "COUNT(DISTINCT i.product)"), ("customers", "BIGINT", "AGGREGATE", "COUNT(DISTINCT o.customer)"),
              ("some", "BIGINT", "AGGREGATE", "COUNT(DISTINCT CASE WHEN o.amount > 20 THEN o.customer END)")]
    tables = _shop(spark)

    def document(group_by, having):
        return parse_mapping({"entity": {"mapping_id": "m", "target_table": "t", "source_tables": [
            {"table_name": "orders", "alias": "o"}, {"table_name": "items", "alias": "i", "table_type": "DETAIL"},
            {"table_name": "notes", "alias": "n", "table_type": "DETAIL"}], "sql_conditions": {
            "joins": [{"join_sequence": 1, "join_type": how, "table_alias": "i", "join_condition": "o.order_id = i.order_id AND i.ok = 'Y'"},
                      {"join_sequence": 2, "join_type": how, "table_alias": "n", "join_condition": "o.order_id = n.order_id"}],
            "group_by": [{"sequence": 1, "expression": g} for g in group_by], "having": [{"sequence": 1, "condition": h} for h in having]}},
            "attributes": [{"seq": k, "target_field": f, "target_type": t, "target_precision": "28,2", "gen_type": g, "process_logic": e}
                           for k, (f, t, g, e) in enumerate(fields if group_by else fields[1:])]})
    for name, df in tables.items():
        df.createOrReplaceTempView(f"shop_{name}")
    joins = f"FROM shop_orders o {how} JOIN shop_items i ON o.order_id = i.order_id AND i.ok = 'Y' {how} JOIN shop_notes n ON o.order_id = n.order_id"
    for group_by, having in ((["o.shop"], ["COUNT(DISTINCT o.customer) > 0", "SUM(o.amount) > 3"]), ([], [])):
        got = build(document(group_by, having), tables)
        columns = ", ".join(f"{e} AS {f}" for f, _, _, e in (fields if group_by else fields[1:]))
        want = spark.sql(f"SELECT {columns} {joins} " + ("GROUP BY o.shop HAVING SUM(o.amount) > 3" if group_by else ""))
        assert [tuple(Decimal(str(v)) for v in r) for r in sorted(got.collect())] == [tuple(Decimal(str(v)) for v in r) for r in sorted(want.collect())]


def test_one_expand_for_all_distinct_counts(spark):
    from queries.mappings import sources
    mapping = load_mapping("channel_sales")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = build(mapping, sources(spark, "/root/testdata/sf0.001"), ordered=False)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert text.count("Expand [") == 1
    line = next(x for x in text.splitlines() if "Expand [" in x)
    assert line.count("], [") == 3  # the columns, and one copy of a row for each that is counted: orders, customers, products
