import hashlib
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill import functions as tf
from tidemill.operators import dimension_names, jsonflat, latest_batch_total, latest_row, lookup
from tidemill.sources import read_source, values_relation


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_surrogate_key(spark):
    got = one(spark, tf.surrogate_key(F.lit(date(2024, 1, 1)), F.lit("CH1")), tf.surrogate_key(F.lit(date(2024, 1, 1)), F.lit(None)))
    assert tuple(got) == (hashlib.md5(b"2024-01-01_CH1").hexdigest(), None)


def test_bands_and_ratios(spark):
    df = spark.sql("SELECT * FROM VALUES (1000000), (999999), (100000), (99999), (NULL) AS t(a)")
    assert [r[0] for r in df.select(tf.band("a")).collect()] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    got = one(spark, tf.ratio(F.lit(6), F.lit(4)), tf.ratio(F.lit(6), F.lit(0)), tf.ratio(F.lit(6), F.lit(0), None),
              tf.percent(F.lit(1), F.lit(3)).cast("decimal(5,2)"))
    assert (float(got[0]), float(got[1]), got[2], str(got[3])) == (1.5, 0.0, None, "33.33")


def test_day_window_is_half_open(spark):
    df = spark.sql("SELECT explode(array(timestamp_ntz'2025-01-01 00:00:00', timestamp_ntz'2025-01-01 23:59:59.999999', "
                   "timestamp_ntz'2025-01-02 00:00:00')) AS ts")
    assert df.filter(tf.day_window("ts", date(2025, 1, 1))).count() == 2


def test_null_safe_and_tolerance(spark):
    got = one(spark, tf.differs(F.lit(None), F.lit(1)), tf.differs(F.lit(None), F.lit(None)),
              tf.off_by_more_than(F.lit("1.01").cast("decimal(18,2)"), F.lit("1.00").cast("decimal(18,2)")),
              tf.off_by_more_than(F.lit("1.02").cast("decimal(18,2)"), F.lit("1.00").cast("decimal(18,2)")))
    assert tuple(got) == (True, False, False, True)


def test_json_helpers(spark):
    got = one(spark, tf.json_field(F.lit('{"a":{"b":3}}'), "a", "b"), tf.pretty_json(F.struct(F.lit(1).alias("x"))))
    assert got[0] == "3" and "\n" in got[1]


def test_unknown_transform():
    with pytest.raises(ValueError):
        tf.transform("Shuffle")


def test_distinct_text_is_null_when_nothing_is_left(spark):
    df = spark.sql("SELECT * FROM VALUES ('b'), ('a'), ('b'), (NULL) AS t(x)")
    assert tuple(df.agg(tf.distinct_text("x"), tf.distinct_text("x", where=F.col("x") > "z")).first()) == ("a, b", None)


def test_latest_row_takes_null_load_time_as_newest(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2025-01-02', 'new'), (1, TIMESTAMP_NTZ'2025-01-01', 'old'), "
                   "(2, TIMESTAMP_NTZ'2025-01-02', 'x'), (2, NULL, 'open'), (3, TIMESTAMP_NTZ'2025-01-01', 'a'), "
                   "(3, TIMESTAMP_NTZ'2025-01-01', 'b') AS t(k, ts, v)")
    assert rows(latest_row(df, ["k"], "ts").select("k", "v")) == [(1, "new"), (2, "open"), (3, "b")]


def test_latest_batch_total_does_not_sum_over_batches(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2025-01-01', 5), (1, TIMESTAMP_NTZ'2025-01-02', 1), "
                   "(1, TIMESTAMP_NTZ'2025-01-02', 2) AS t(k, ts, q)")
    assert rows(latest_batch_total(df, ["k"], "ts", "q")) == [(1, 3)]


def test_dedup_and_lookup_plans(spark):
    facts = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_row(facts, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    dim = values_relation(spark, ["k", "name"], [(0, "a"), (1, "b")])
    joined = lookup(facts, dim, {"k": "k"}, {"name": ("name", "?")})
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan  # by its known size, not by a hint
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup(facts, dim, {"k": "k"}, {"name": ("name", "?")})._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(joined.groupBy("name").count()) == [("?", 333), ("a", 334), ("b", 333)]


def test_names_after_aggregation_equal_names_before(spark):
    facts = spark.range(100).select((F.col("id") % 4).alias("k"), F.col("id").alias("v"))
    dim = values_relation(spark, ["k", "name"], [(0, "a"), (1, "b"), (1, "b"), (1, None), (2, "?")])
    first = facts.join(dim, "k", "left").groupBy("k", F.coalesce("name", F.lit("?")).alias("name")).agg(
        F.count("v").alias("n"), F.sum("v").alias("s"), F.countDistinct("v").alias("d"))
    names = dimension_names(dim, ["k"], {"name": "?"})
    copies = F.coalesce("name_copies", F.lit(1))
    late = facts.groupBy("k").agg(F.count("v").alias("n"), F.sum("v").alias("s"), F.countDistinct("v").alias("d")).join(
        names, "k", "left").select("k", F.coalesce("name", F.lit("?")).alias("name"), F.col("n") * copies, F.col("s") * copies, "d")
    assert rows(first) == rows(late)


def test_json_sample(spark):
    df = spark.createDataFrame([('{"customer": {"id": 123, "name": "John", "address": {"city": "Shanghai"}}}',)], "j string")
    assert rows(jsonflat.json_paths(df, "j")) == [
        ("customer.address.city", "city", "str", 1), ("customer.id", "id", "int", 1), ("customer.name", "name", "str", 1)]
    assert jsonflat.json_columns(df, "j").columns == ["customer.address.city", "customer.id", "customer.name"]


def test_json_arrays_missing_and_odd_names(spark):
    df = spark.createDataFrame([('{"a b": 1.5, "l": [1, 2], "n": null}',), ('{"l": [], "f": true}',)], "j string")
    assert rows(jsonflat.json_paths(df, "j")) == [("a b", "a b", "float", 1), ("f", "f", "bool", 1), ("l", "l", "list", 2),
                                                  ("n", "n", "NoneType", 0)]
    arrays = spark.sql("SELECT 1 AS k, array(1, 2) AS a UNION ALL SELECT 2, array() UNION ALL SELECT 3, NULL")
    assert rows(arrays.select(jsonflat.array_as_text(F.col("a")))) == [("",), ("1, 2",), (None,)]
    assert rows(jsonflat.array_as_rows(arrays, F.col("a"), "e").select("k", "e")) == [(1, 1), (1, 2), (2, None), (3, None)]
    assert rows(jsonflat.array_as_child(arrays, ["k"], F.col("a"), "e")) == [(1, 0, 1), (1, 1, 2)]


def test_file_formats(spark, tmp_path):
    df = spark.sql("SELECT id, 'v' || id AS v FROM range(3)")
    for fmt in ("parquet", "orc", "json", "csv"):
        df.write.format(fmt).save(f"{tmp_path}/{fmt}")
        back = read_source(spark, "File", f"{tmp_path}/{fmt}", file_format=fmt, schema="id long, v string")
        assert rows(back) == rows(df)
    df.write.saveAsTable("plain_rows")
    assert rows(read_source(spark, "Table", "plain_rows", alias="a").select("a.id")) == [(0,), (1,), (2,)]
    with pytest.raises(ValueError):
        read_source(spark, "Queue", "x")


def test_inline_values_keep_odd_text(spark):
    got = values_relation(spark, ["a", "b", "c"], [("it's \\ odd", None, date(2024, 2, 29)), ("未知", 1, None)])
    assert [tuple(r) for r in got.collect()] == [("it's \\ odd", None, date(2024, 2, 29)), ("未知", 1, None)]


def test_stamp_text(spark):
    assert one(spark, tf.stamp_text(F.lit(datetime(2025, 3, 18, 4, 5, 6))))[0] == "2025-03-18 04:05:06"
