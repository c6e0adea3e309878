from conftest import rows
from pyspark.sql import functions as F

from tidemill.operators.quality import Rule
from tidemill.sinks import tables as sinks
from tidemill.streaming import stream_dedup, stream_incremental, stream_quality_gate, stream_source
from tidemill.streaming.loads import stream_newest


def put(spark, folder, low, high):
    spark.range(low, high).select("id", (F.lit("2025-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), "id")).alias("ts"),
                                  (F.col("id") % 5).alias("v")).coalesce(1).write.mode("append").parquet(folder)


def test_incremental_picks_up_only_new_files(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{n}" for n in ("src", "out", "mark"))
    put(spark, src, 0, 10)
    schema = spark.read.parquet(src).schema
    stream_incremental(stream_source(spark, src, schema), out, mark)
    put(spark, src, 10, 15)
    for _ in range(2):
        stream_incremental(stream_source(spark, src, schema), out, mark)
    assert [r[0] for r in rows(spark.read.parquet(out).select("id"))] == sorted(range(15), key=str)


def test_dedup_across_batches(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{n}" for n in ("src", "out", "mark"))
    put(spark, src, 0, 10)
    put(spark, src, 5, 12)
    stream = stream_source(spark, src, spark.read.parquet(src).schema, max_files=1)
    stream_dedup(stream, ["id"], "ts", "2 days", out, mark)
    assert spark.read.parquet(out).count() == spark.read.parquet(out).select("id").distinct().count() == 12


def test_gate_splits_rows(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{n}" for n in ("src", "out", "mark"))
    put(spark, src, 0, 10)
    stream_quality_gate(stream_source(spark, src, spark.read.parquet(src).schema),
                        [Rule("low", "RANGE", "s", "v", {"min": 1})], out, mark)
    assert spark.read.parquet(f"{out}/dq_status=REJECT").count() == 2
    assert spark.read.parquet(f"{out}/dq_status=PASS").count() == 8


def test_newest_row_of_a_key_in_key_buckets(spark, database, tmp_path):
    """Late copies, NULL keys and a stream that starts again; a batch rewrites the buckets of its keys only."""
    src, out, bad, schema = f"{tmp_path}/src", f"{database}.newest", f"{tmp_path}/bad", "id long, v string, n long"
    sinks.create_target(spark, out, spark.createDataFrame([], schema).schema, upsert_keys=["id"], key_buckets=16)
    sinks.append(spark.range(200).select("id", F.lit("old").alias("v"), F.lit(0).alias("n")), out)

    def files():
        return {r[0]: r[1] for r in spark.table(out).select("key_bucket", "_metadata.file_path").distinct().collect()}
    before = files()
    for batch in ([(1, "b", 2), (None, "x", 1)], [(1, "a", 1), (2, "a", 1), (2, "b", 3)], [(None, "y", 1), (1, "c", 2)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
    for checkpoint in ("one", "two"):
        stream_newest(stream_source(spark, src, spark.read.parquet(src).schema, max_files=1), ["id"], "n", out, f"{tmp_path}/{checkpoint}", bad)
        assert rows(spark.table(out).filter("n > 0").drop("key_bucket")) == [(1, "c", 2), (2, "b", 3)] and spark.table(out).count() == 200
        assert rows(spark.read.parquet(bad).select("v")) == [("x",), ("y",)]
    touched = {r[0] for r in spark.table(out).filter("id IN (1, 2)").select("key_bucket").collect()}
    assert {b: f for b, f in files().items() if b not in touched} == {b: f for b, f in before.items() if b not in touched}
