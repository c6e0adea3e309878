"""Structured Streaming loads over the events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemill.operators.quality import Rule
from tidemill.session import work_path
from tidemill.sinks import tables
from tidemill.sources import Retail
from tidemill.streaming import loads


def _stream(spark, sf_dir):
    schema = Retail(spark, sf_dir).raw("events").schema
    return loads.stream_source(spark, sf_dir, schema, files="events.parquet")


def stream_incremental(spark, sf_dir):
    """Run twice; the second run finds nothing new."""
    target, checkpoint = work_path(spark, "stream"), work_path(spark, "offsets")
    for _ in range(2):
        loads.stream_incremental(_stream(spark, sf_dir), target, checkpoint, ["event_id", "user_id", "event_type", "props"])
    return spark.read.parquet(target)


def stream_dedup(spark, sf_dir):
    """Files one by one: the events; later, changed copies of some; then new events far behind the watermark, which come too late."""
    events = Retail(spark, sf_dir).raw("events").select("event_id", "event_type", "ts")
    folder = work_path(spark, "copies")
    again = events.filter(F.col("event_type") == "click").select(
        "event_id", F.lit("copy").alias("event_type"), (F.col("ts") + F.expr("INTERVAL '1' HOUR")).alias("ts"))
    late = events.filter(F.col("event_type") == "view").select(
        (-F.col("event_id") - 1).alias("event_id"), F.lit("late").alias("event_type"), (F.col("ts") - F.expr("INTERVAL '200' DAY")).alias("ts"))
    for rows in (events, again, late):
        rows.coalesce(1).write.mode("append").parquet(folder)
    target, checkpoint = work_path(spark, "stream"), work_path(spark, "offsets")
    loads.stream_dedup(loads.stream_source(spark, folder, events.schema, max_files=1), ["event_id"], "ts", "60 days", target, checkpoint)
    return spark.read.parquet(target).select("event_id", "event_type")


def stream_newest(spark, sf_dir):
    """Up to three differing copies of an event, spread over files that arrive one by one, not in order; errors have no key.

    The stream runs twice from the start, as after a lost checkpoint: rows and rejects stay the same.
    """
    events = Retail(spark, sf_dir).raw("events").select("event_id", "event_type", F.explode(
        F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int"))).alias("version"))
    events = events.withColumn("event_type", F.concat_ws("-", "event_type", "version"))
    events = events.withColumn("event_id", F.when(~F.col("event_type").startswith("error"), F.col("event_id")))
    folder, rejects, db = work_path(spark, "copies"), work_path(spark, "rejects"), f"stream_{uuid.uuid4().hex[:10]}"
    events.repartition(4, F.xxhash64("event_type", "event_id", "version")).write.parquet(folder)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{work_path(spark, db)}'")
    tables.create_target(spark, f"{db}.newest", events.schema, upsert_keys=["event_id"], key_buckets=8)
    for _ in range(2):
        stream = loads.stream_source(spark, folder, events.schema, max_files=1)
        loads.stream_newest(stream, ["event_id"], "version", f"{db}.newest", work_path(spark, "offsets"), rejects)
    return (spark.table(f"{db}.newest").drop(tables.KEY_BUCKET).withColumn("rejected", F.lit(False))
            .unionByName(spark.read.schema(events.schema).parquet(rejects).select(*events.columns).withColumn("rejected", F.lit(True))))


GATE_RULES = [
    Rule("S1", "RANGE", "events", "value", {"min": 1, "max": 250}),
    Rule("S2", "IN_SET", "events", "event_type", {"values": ["view", "click", "purchase", "signup"]}),
]


def stream_gate(spark, sf_dir):
    target, checkpoint = work_path(spark, "stream"), work_path(spark, "offsets")
    loads.stream_quality_gate(_stream(spark, sf_dir), GATE_RULES, target, checkpoint)
    return spark.read.parquet(target).select("event_id", "dq_failed", "dq_status")


QUERIES = {
    "stream_newest": (stream_newest, """
        SELECT event_id, concat(event_type, '-', event_id % 3) AS event_type, CAST(event_id % 3 AS INTEGER) AS version, false AS rejected
        FROM events WHERE event_type <> 'error'
        UNION ALL SELECT NULL, concat(event_type, '-', v), CAST(v AS INTEGER), true
        FROM (SELECT event_type, unnest(range(event_id % 3 + 1)) AS v FROM events WHERE event_type = 'error') t"""),
    "stream_incremental": (stream_incremental, "SELECT event_id, user_id, event_type, props FROM events"),
    "stream_dedup": (stream_dedup, "SELECT event_id, event_type FROM events"),
    "stream_gate": (stream_gate, """
        WITH m AS (SELECT event_id, concat_ws(',', CASE WHEN value < 1 OR value > 250 THEN 'S1' END,
                          CASE WHEN event_type NOT IN ('view', 'click', 'purchase', 'signup') THEN 'S2' END) AS dq_failed
                   FROM events)
        SELECT event_id, dq_failed, CASE WHEN dq_failed = '' THEN 'PASS' ELSE 'REJECT' END AS dq_status FROM m"""),
}
