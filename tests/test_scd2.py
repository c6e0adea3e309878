import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st

from tidemill.operators.scd2 import (Scd2Columns, SourceKeyError, current_rows, first_load, is_backdated, key_history, scd2_merge,
                                     scd2_schema, source_key_faults, update_from)
from tidemill.sinks import tables as sinks
from pyspark.sql import functions as F, types as T

SCHEMA = "customer_id int, customer_name string, address string, phone string, email string"
KEYS, COMPARE = ["customer_id"], ["customer_name", "address", "phone", "email"]
PEOPLE = [(1, "张三", "北京", "13800138000", "zhangsan@example.com"), (2, "李四", "上海", "13900139000", "lisi@example.com")]
D1, D2 = date(2025, 3, 1), date(2025, 3, 18)
TS = datetime(2025, 3, 18, 12)
END = date(9999, 12, 31)


def moved(spark, city="深圳"):
    return spark.createDataFrame([(1, "张三", city, *PEOPLE[0][3:]), PEOPLE[1]], SCHEMA)


def test_two_rows_for_the_customer_who_moved(spark):
    dim = first_load(spark.createDataFrame(PEOPLE, SCHEMA), KEYS, COMPARE, D1, load_ts=TS)
    dim = scd2_merge(dim, moved(spark), KEYS, COMPARE, D2, load_ts=TS)
    got = [tuple(r) for r in key_history(dim, F.col("customer_id") == 1).select(
        "address", "effective_date", "expiry_date", "is_current").collect()]
    assert got == [("北京", D1, date(2025, 3, 17), False), ("深圳", D2, END, True)]
    assert rows(current_rows(dim).select("customer_id")) == [(1,), (2,)]


def test_second_run_changes_nothing(spark):
    dim = first_load(spark.createDataFrame(PEOPLE, SCHEMA), KEYS, COMPARE, D1, load_ts=TS)
    once = scd2_merge(dim, moved(spark), KEYS, COMPARE, D2, load_ts=TS)
    assert rows(scd2_merge(once, moved(spark), KEYS, COMPARE, D2, load_ts=TS)) == rows(once)


def test_same_day_change_replaces_in_place(spark):
    names = Scd2Columns(version="version_no")
    dim = first_load(spark.createDataFrame(PEOPLE, SCHEMA), KEYS, COMPARE, D1, load_ts=TS, names=names)
    dim = scd2_merge(dim, moved(spark), KEYS, COMPARE, D2, load_ts=TS, names=names)
    dim = scd2_merge(dim, moved(spark, "广州"), KEYS, COMPARE, D2, load_ts=TS, names=names)
    assert rows(dim.filter("customer_id = 1").select("address", "is_current", "version_no")) == [
        ("北京", False, 1), ("广州", True, 2)]


def test_null_values_are_compared_null_safe(spark):
    dim = first_load(spark.createDataFrame([(1, None, "a", None, "x")], SCHEMA), KEYS, COMPARE, D1, load_ts=TS)
    same = spark.createDataFrame([(1, None, "a", None, "x")], SCHEMA)
    gone = spark.createDataFrame([(1, None, None, None, "x")], SCHEMA)
    assert scd2_merge(dim, same, KEYS, COMPARE, D2).count() == 1
    assert scd2_merge(dim, gone, KEYS, COMPARE, D2).count() == 2


def test_missing_keys_stay_current(spark):
    dim = first_load(spark.createDataFrame(PEOPLE, SCHEMA), KEYS, COMPARE, D1)
    only_new = spark.createDataFrame([(3, "n", "a", "p", "e")], SCHEMA)
    assert rows(current_rows(scd2_merge(dim, only_new, KEYS, COMPARE, D2)).select("customer_id")) == [(1,), (2,), (3,)]


def brute_force(dim, src, day):
    """Row-at-a-time merge of (key, value, from, to, current) tuples."""
    out, source = [], dict(src)
    for k, v, start, end, current in dim:
        if current and k in source and source[k] != v:
            if start != day:
                out.append((k, v, start, date.fromordinal(day.toordinal() - 1), False))
        else:
            out.append((k, v, start, end, current))
    open_now = {k: v for k, v, _, _, c in out if c}
    out += [(k, v, day, END, True) for k, v in src if open_now.get(k, object()) != v or k not in open_now]
    return sorted(out, key=str)


values = st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.sampled_from("ab")), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(values, min_size=2, max_size=3))
def test_against_brute_force(spark, snapshots):
    schema = "k int, v string"
    days = [date(2025, 1, i + 1) for i in range(len(snapshots))]
    dim = first_load(spark.createDataFrame(list(snapshots[0].items()), schema), ["k"], ["v"], days[0], load_ts=TS)
    expected = [(k, v, days[0], END, True) for k, v in snapshots[0].items()]
    for snap, day in zip(snapshots[1:], days[1:]):
        src = spark.createDataFrame(list(snap.items()), schema)
        as_delta = scd2_merge(dim, src, ["k"], ["v"], day, load_ts=TS, delta=True)
        dim = scd2_merge(dim, src, ["k"], ["v"], day, load_ts=TS)
        assert rows(as_delta.drop("created_at")) == rows(dim.drop("created_at"))
        expected = brute_force(expected, list(snap.items()), day)
    got = [tuple(r) for r in dim.select("k", "v", "effective_date", "expiry_date", "is_current").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_table_merge_refuses_bad_keys(spark, database):
    src = spark.createDataFrame(PEOPLE, SCHEMA)
    schema = scd2_schema(src.schema, KEYS, COMPARE)
    table = f"{database}.dim_customer"
    sinks.create_target(spark, table, schema)
    assert sinks.merge_history(src, table, KEYS, COMPARE, D1, load_ts=TS).inserted == 2
    report = sinks.merge_history(moved(spark), table, KEYS, COMPARE, D2, load_ts=TS)
    assert (report.inserted, report.updated) == (1, 1)
    with pytest.raises(SourceKeyError):
        sinks.merge_history(src.union(src), table, KEYS, COMPARE, D2)
    assert spark.table(table).count() == 3


def test_key_faults(spark):
    src = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, v string")
    assert tuple(source_key_faults(src, ["k"]).first()) == (2, 1)


def test_update_from(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, n int")
    source = spark.createDataFrame([(2, None), (3, "z")], "k int, v string")
    assert rows(update_from(target, source, ["k"], ["v"])) == [(1, "a", 1), (2, None, 2)]


def test_history_partitioned_by_expiry_rewrites_two_partitions(spark, database):
    src = spark.createDataFrame(PEOPLE, SCHEMA)
    table = f"{database}.dim_by_expiry"
    sinks.create_target(spark, table, scd2_schema(src.schema, KEYS, COMPARE), partition_by=["expiry_date"])
    days = [date(2025, 3, d) for d in (1, 5, 9)]
    for day, city in zip(days, ("北京", "深圳", "广州")):
        sinks.merge_history(moved(spark, city), table, KEYS, COMPARE, day, load_ts=TS)
    stamp = {r[0]: r[1] for r in spark.table(table).select("expiry_date", F.col("_metadata.file_path")).distinct().collect()}
    again = sinks.merge_history(moved(spark, "广州"), table, KEYS, COMPARE, days[2], load_ts=TS, delta=True)
    assert (again.inserted, again.updated) == (0, 0)
    after = {r[0]: r[1] for r in spark.table(table).select("expiry_date", F.col("_metadata.file_path")).distinct().collect()}
    assert stamp[date(2025, 3, 4)] == after[date(2025, 3, 4)]  # older history kept its file
    assert rows(spark.table(table).filter("customer_id = 1").select("address", "effective_date", "expiry_date", "is_current")) == sorted([
        ("北京", days[0], date(2025, 3, 4), False), ("深圳", days[1], date(2025, 3, 8), False), ("广州", days[2], END, True)])
    assert spark.table(table).count() == 4


def test_small_delta_does_not_shuffle_the_dimension(spark, tmp_path):
    first_load(spark.range(1000).select("id", F.lit("a").alias("v")), ["id"], ["v"], D1, load_ts=TS).write.parquet(f"{tmp_path}/dim")
    spark.range(3).select("id", F.lit("b").alias("v")).write.parquet(f"{tmp_path}/delta")
    dim, delta = spark.read.parquet(f"{tmp_path}/dim"), spark.read.parquet(f"{tmp_path}/delta")
    plan = scd2_merge(dim, delta, ["id"], ["v"], D2, load_ts=TS, delta=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


ANY_ORDER = Scd2Columns(created=None, updated=None, version="version_no", seen="seen_dates")


def plain_history(snapshots):
    """Runs of equal values over the dates at which each key was seen."""
    known = {}
    for day, people in sorted(snapshots.items()):
        for key, value in people.items():
            known.setdefault(key, []).append((day, value))
    out = []
    for key, points in known.items():
        runs = []
        for day, value in points:
            if runs and runs[-1][1] == value:
                runs[-1][2].append(day)
            else:
                runs.append((day, value, []))
        for n, (day, value, seen) in enumerate(runs):
            end = runs[n + 1][0] - timedelta(days=1) if n + 1 < len(runs) else END
            out.append((key, value, day, end, end == END, n + 1, tuple(seen)))
    return sorted(out, key=str)


def history_of(df):
    return sorted(((r.k, r.v, r.effective_date, r.expiry_date, r.is_current, r.version_no, tuple(sorted(r.seen_dates))) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("stored", [False, True])
def test_snapshots_in_any_order_give_one_history(spark, database, seed, stored):
    rng = random.Random(seed)
    days = [date(2024, m, 1) for m in rng.sample(range(1, 13), 5)]
    snapshots = {d: {k: rng.choice(["a", "b", None]) for k in range(8) if rng.random() < .8} for d in days}
    days.append(rng.choice(days))  # a batch that runs twice
    table = f"{database}.h"
    schema = scd2_schema(T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())]), ["k"], ["v"], ANY_ORDER)
    sinks.create_target(spark, table, schema, partition_by=["expiry_date"] if seed % 2 else [])
    dim = spark.createDataFrame([], schema)
    done = {}
    for day in days:
        src = spark.createDataFrame(list(snapshots[day].items()), "k int, v string")
        if stored:
            sinks.merge_history(src, table, ["k"], ["v"], day, names=ANY_ORDER)
            dim = spark.table(table)
        else:
            dim = scd2_merge(dim, src, ["k"], ["v"], day, names=ANY_ORDER, backdated=is_backdated(dim, day, ANY_ORDER))
            dim = spark.createDataFrame(dim.collect(), schema)
        done[day] = snapshots[day]
        assert history_of(dim) == plain_history(done)


def test_late_rows_stop_a_merge_that_does_not_expect_them(spark):
    dim = first_load(spark.createDataFrame(PEOPLE, SCHEMA), KEYS, COMPARE, D2, load_ts=TS)
    with pytest.raises(Exception, match="backdated"):
        scd2_merge(dim, moved(spark), KEYS, COMPARE, D1).collect()


def test_an_earlier_value_holds_until_the_next_known_change(spark):
    dim = first_load(spark.createDataFrame(PEOPLE, SCHEMA), KEYS, COMPARE, D2, load_ts=TS)
    got = scd2_merge(dim, moved(spark), KEYS, COMPARE, D1, load_ts=datetime(2026, 1, 1), backdated=True)
    assert rows(got.select("customer_id", "address", "effective_date", "expiry_date", "is_current", "created_at", "last_updated")) == [
        (1, "北京", D2, END, True, TS, TS), (1, "深圳", D1, date(2025, 3, 17), False, datetime(2026, 1, 1), datetime(2026, 1, 1)),
        (2, "上海", D1, END, True, datetime(2026, 1, 1), datetime(2026, 1, 1))]
    assert got.filter("expiry_date < effective_date").count() == 0


def test_a_past_merge_leaves_older_partitions_alone(spark, database):
    table = f"{database}.h"
    schema = scd2_schema(T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())]), ["k"], ["v"])
    sinks.create_target(spark, table, schema, partition_by=["expiry_date"])
    for month, value in ((1, "a"), (3, "b"), (5, "c"), (7, "d")):
        sinks.merge_history(spark.createDataFrame([(1, value), (2, "z")], "k int, v string"), table, ["k"], ["v"], date(2024, month, 1))
    old = {r[0] for r in spark.table(table).filter("expiry_date = DATE'2024-02-29'").select("_metadata.file_path").collect()}
    report = sinks.merge_history(spark.createDataFrame([(1, "x")], "k int, v string"), table, ["k"], ["v"], date(2024, 6, 1))
    assert report == sinks.LoadReport(inserted=1, updated=1)
    assert rows(spark.table(table).filter("k = 1").select("v", "effective_date")) == [
        ("a", date(2024, 1, 1)), ("b", date(2024, 3, 1)), ("c", date(2024, 5, 1)), ("d", date(2024, 7, 1)), ("x", date(2024, 6, 1))]
    assert old == {r[0] for r in spark.table(table).filter("expiry_date = DATE'2024-02-29'").select("_metadata.file_path").collect()}
