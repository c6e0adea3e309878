import os
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from tidemill.operators import chunks
from tidemill.operators.conform import conform, target_field
from tidemill.sinks import copying, incremental, publish, tables as sinks

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()),
                       T.StructField("stat_date", T.DateType())])
D = [date(2025, 1, i) for i in (1, 2, 3, 4)]


def data(spark, *triples):
    return spark.createDataFrame([(i, v, D[d]) for i, v, d in triples], SCHEMA)


@pytest.fixture
def table(spark, database):
    name = f"{database}.facts"
    sinks.create_target(spark, name, SCHEMA, partition_by=["stat_date"], comment="it's a test")
    sinks.create_target(spark, name, SCHEMA, partition_by=["stat_date"])
    sinks.append(data(spark, (1, "a", 0), (2, "b", 1), (3, "c", 2)), name)
    return name


def content(spark, table):
    return rows(spark.table(table).select("id", "v"))


def test_append_and_full(spark, table):
    assert sinks.load(data(spark, (4, "d", 3)), table, "INCREMENTAL_INSERT") == sinks.LoadReport(inserted=1)
    assert content(spark, table) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert sinks.load(data(spark, (9, "z", 0)), table, "FULL") == sinks.LoadReport(inserted=1, deleted=4)
    assert content(spark, table) == [(9, "z")]


def test_full_load_may_read_its_own_target(spark, table):
    sinks.overwrite(spark.table(table).filter("id > 1"), table)
    assert content(spark, table) == [(2, "b"), (3, "c")]


def test_replace_day_is_idempotent_and_clears(spark, table):
    for deleted in (1, 2):
        report = sinks.load(data(spark, (5, "e", 1), (6, "f", 1)), table, "INCREMENTAL_UPDATE", day=D[1])
        assert report == sinks.LoadReport(inserted=2, deleted=deleted)
        assert content(spark, table) == [(1, "a"), (3, "c"), (5, "e"), (6, "f")]
    sinks.replace_day(data(spark, (1, "x", 1)).limit(0), table, D[1])
    assert content(spark, table) == [(1, "a"), (3, "c")]


def test_replace_days(spark, table):
    sinks.replace_days(data(spark, (7, "g", 0)), table, [D[0], D[1]])
    assert content(spark, table) == [(3, "c"), (7, "g")]
    with pytest.raises(ValueError):
        sinks.replace_days(data(spark, (8, "h", 2)), table, [D[0]])
    assert content(spark, table) == [(3, "c"), (7, "g")]


def test_upsert_by_partition_and_whole(spark, table):
    report = sinks.load(data(spark, (2, "B", 1), (4, "D", 1)), table, "INCREMENTAL_MERGE", keys=["id", "stat_date"])
    assert report == sinks.LoadReport(inserted=1, updated=1)
    assert content(spark, table) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    report = sinks.load(data(spark, (1, "A", 3)), table, "INCREMENTAL_MERGE", keys=["id"])
    assert report == sinks.LoadReport(inserted=0, updated=1)
    assert rows(spark.table(table).filter("id = 1")) == [(1, "A", D[3])]


def test_force_full_and_unknown_strategy(spark, table):
    sinks.load(data(spark, (5, "e", 1)), table, "INCREMENTAL_UPDATE", day=D[1], force_full=True)
    assert content(spark, table) == [(5, "e")]
    with pytest.raises(ValueError):
        sinks.load(data(spark, (5, "e", 1)), table, "SOMETHING")


def test_retention_and_statistics(spark, table):
    assert sinks.drop_old_partitions(spark, table, D[3], 1) == ["2025-01-01", "2025-01-02"]
    assert content(spark, table) == [(3, "c")]
    sinks.refresh_statistics(spark, table, ["id"])
    stats = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Statistics'").first()
    assert "1 rows" in stats["data_type"]


def test_bucketed_target_groups_without_a_shuffle(spark, database):
    name = f"{database}.bucketed"
    sinks.create_target(spark, name, SCHEMA, bucket_by=["id"], buckets=4)
    sinks.append(data(spark, (1, "a", 0), (2, "b", 1)), name)
    plan = spark.table(name).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_conform(spark):
    target = T.StructType([target_field("n", "bigint", default=0, required=True), target_field("amount", "decimal(18,2)"),
                           target_field("extra", "string")])
    short = spark.sql("SELECT 2.345BD AS amount, CAST(NULL AS INT) AS n, 1 AS other")
    with pytest.raises(ValueError):
        conform(short, target)
    got = conform(short, target, missing_as_null=True)
    assert [tuple(map(str, r)) for r in got.collect()] == [("0", "2.35", "None")]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        conform(spark.sql("SELECT 1e20BD AS amount, 1 AS n"), target, missing_as_null=True).collect()


def test_watermark_load(spark, tmp_path):
    src = spark.sql("SELECT id, timestamp_ntz'2025-01-01' + make_interval(0,0,0,CAST(id AS INT)) AS ts FROM range(10) "
                    "UNION ALL SELECT 99L, NULL")
    store, target = incremental.WatermarkStore(spark, f"{tmp_path}/state"), f"{tmp_path}/target"
    assert store.get("s.t", target) == (datetime(1900, 1, 1), 0)
    assert incremental.incremental_load(src.filter("id < 4"), "s.t", target, "ts", store) == 4
    assert incremental.incremental_load(src, "s.t", target, "ts", store) == 6
    assert incremental.incremental_load(src, "s.t", target, "ts", store) == 0
    assert spark.read.parquet(target).count() == 10
    assert store.get("s.t", target) == (datetime(2025, 1, 10), 2)
    assert store.get("s.t", "other") == (datetime(1900, 1, 1), 0)


def test_load_that_died_before_saving_its_state_runs_again(spark, tmp_path):
    src = spark.sql("SELECT id, timestamp_ntz'2025-01-01' AS ts FROM range(5)")
    store, target = incremental.WatermarkStore(spark, f"{tmp_path}/state"), f"{tmp_path}/target"
    src.write.parquet(f"{target}/load_seq=1")
    assert incremental.incremental_load(src, "s.t", target, "ts", store) == 5
    assert spark.read.parquet(target).count() == 5


def test_watermark_reset_loads_again(spark, tmp_path):
    src = spark.sql("SELECT id, timestamp_ntz'2025-01-01' AS ts FROM range(5)")
    store, target = incremental.WatermarkStore(spark, f"{tmp_path}/state"), f"{tmp_path}/target"
    incremental.incremental_load(src, "s.t", target, "ts", store)
    store.reset("s.t", target)
    assert incremental.incremental_load(src, "s.t", target, "ts", store) == 5
    assert spark.read.parquet(target).count() == 10


def test_window_bounds_reach_the_scan(spark, tmp_path):
    spark.sql("SELECT id, timestamp_ntz'2025-01-01' AS ts FROM range(5)").write.parquet(f"{tmp_path}/src")
    df = incremental.incremental_window(spark.read.parquet(f"{tmp_path}/src"), "ts", datetime(2024, 1, 1), datetime(2025, 1, 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def brute_chunks(keys, size):
    keys = sorted(keys)
    parts = [keys[i:i + size] for i in range(0, len(keys), size)]
    return [(i, len(p), p[0], p[-1]) for i, p in enumerate(parts)]


@pytest.mark.parametrize("size", [1, 7, 100, 5000])
def test_chunk_report_with_a_hot_key(spark, size):
    keys = [5] * 700 + [i % 97 - 40 for i in range(1400)]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    got = sorted(tuple(r) for r in chunks.chunk_report(df, "id", size).collect())
    assert got == brute_chunks(keys, size)


def test_key_ranges(spark):
    df = spark.range(-3, 8)
    assert rows(chunks.key_ranges(df, "id", 4)) == [(0, -3, -1), (1, -1, 1), (2, 1, 3), (3, 3, 8)]
    few = spark.range(5, 7)
    assert [r["row_count"] for r in chunks.range_load_report(few, "id", 4).orderBy("range_no").collect()] == [0, 0, 0, 2]
    assert chunks.key_ranges(df.limit(0), "id").count() == 0
    assert chunks.range_load_report(df.limit(0), "id").count() == 0
    assert sum(p.count() for p in chunks.range_filters(df, "id", 3)) == 11


def test_copy_in_key_order(spark, tmp_path):
    src = chunks.generated_rows(spark, 100_000)
    report = copying.copy_table(src, f"{tmp_path}/copy", batch_size=30_000, truncate=True, rows_per_file=20_000)
    assert (report.rows, report.batches) == (100_000, 4) and report.rows_per_second > 0
    files = spark.read.parquet(f"{tmp_path}/copy").groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 5 and max(f["count"] for f in files) <= 20_000
    both = chunks.reconcile({"Source": src, "Target": spark.read.parquet(f"{tmp_path}/copy")}, "id").collect()
    assert tuple(both[0])[1:] == tuple(both[1])[1:] == (100_000, 1, 100_000)
    assert rows(src.exceptAll(spark.read.parquet(f"{tmp_path}/copy"))) == []


def test_copy_keeps_ids_below_one_and_a_filled_target(spark, tmp_path):
    src = spark.range(-5, 5).withColumn("v", F.lit("x"))
    copying.copy_table(src, f"{tmp_path}/copy", "id")
    copying.copy_table(src, f"{tmp_path}/copy", "id")
    assert spark.read.parquet(f"{tmp_path}/copy").count() == 20
    copying.copy_table(src, f"{tmp_path}/copy", "id", truncate=True)
    assert spark.read.parquet(f"{tmp_path}/copy").count() == 10


def test_hot_key_spreads_over_partitions(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    laid_out = chunks.ordered_layout(df, "k", 2_000)
    sizes = [r["count"] for r in laid_out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 6_000 and sum(sizes) == 30_000


def test_copy_key(spark):
    assert chunks.copy_key(spark.sql("SELECT 'a' AS s, 1L AS n")) == "n"
    with pytest.raises(ValueError):
        chunks.copy_key(spark.sql("SELECT 'a' AS s"))


def test_granularity_and_distribution(spark):
    df = spark.sql("SELECT id, date_add(DATE'2024-01-31', CAST(id AS INT)) AS d FROM range(40)")
    got = df.select(*[sinks.partition_day("d", g) for g in ("DAY", "MONTH", "YEAR")]).distinct()
    assert got.agg(F.count("*")).first()[0] == 40
    assert df.select(sinks.partition_day("d", "MONTH").alias("m")).distinct().count() == 3
    for kind in ("HASH", "ROUNDROBIN", "REPLICATION"):
        assert sinks.distribute(df, kind, ["id"]).count() == 40
    with pytest.raises(ValueError):
        sinks.distribute(df, "CIRCLE")


def test_hot_partition_is_written_by_several_tasks(spark, database):
    """A day with nearly all rows: the write splits it by size instead of giving it to one task."""
    name = f"{database}.hot"
    sinks.create_target(spark, name, SCHEMA, partition_by=["stat_date"])
    rows_ = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"),
                                        F.when(F.col("id") % 100 == 0, F.lit(D[0])).otherwise(F.lit(D[1])).alias("stat_date"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        sinks.append(rows_, name)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {r[0]: r[1] for r in spark.table(name).select("stat_date", F.input_file_name().alias("f")).distinct()
             .groupBy("stat_date").count().collect()}
    assert files[D[1]] > 3 and files[D[0]] < files[D[1]]
    assert spark.table(name).count() == 400_000


def test_watermarks_keep_their_wall_clock_in_any_zone(spark, tmp_path, monkeypatch):
    """The driver's zone and the session's zone must not shift bounds or state."""
    import time
    src = spark.sql("SELECT id, timestamp_ntz'2025-01-01 00:30:00' + make_interval(0,0,0,0,CAST(id AS INT)) AS ts FROM range(8)")
    store, target = incremental.WatermarkStore(spark, f"{tmp_path}/state"), f"{tmp_path}/target"
    before = spark.conf.get("spark.sql.session.timeZone")
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert incremental.incremental_load(src.filter("id < 3"), "s.t", target, "ts", store) == 3
        assert store.get("s.t", target)[0] == datetime(2025, 1, 1, 2, 30)
        assert incremental.incremental_load(src, "s.t", target, "ts", store) == 5
        assert store.get("s.t", target)[0] == datetime(2025, 1, 1, 7, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        monkeypatch.undo()
        time.tzset()


@pytest.mark.parametrize("strategy", ["FULL", "INCREMENTAL_MERGE", "INCREMENTAL_UPDATE"])
def test_failed_load_keeps_the_old_rows(spark, table, strategy):
    from pyspark.errors import PySparkException
    folder = os.path.dirname(publish.location(spark, table)).removeprefix("file:")
    before, places = content(spark, table), os.listdir(folder)
    bad = data(spark, (9, "x", 1)).withColumn(spark.table(table).columns[0], F.lit("no number"))
    with pytest.raises(PySparkException):
        sinks.load(bad, table, strategy, keys=[spark.table(table).columns[0]], day=D[1])
    assert content(spark, table) == before
    assert os.listdir(folder) == places


def test_upsert_refuses_bad_keys(spark, table):
    with pytest.raises(sinks.SourceKeyError):
        sinks.load(data(spark, (1, "x", 1), (1, "y", 1)), table, "INCREMENTAL_MERGE", keys=[spark.table(table).columns[0]])
