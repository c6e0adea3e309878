"""Micro-batch forms of the loads.

All of them write through Spark's file sink, whose commit log makes a batch that is run
again after a failure count once.  The checkpoint folder holds the source offsets, which
take the place of the batch watermark state.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.dedup import latest_row
from ..operators.quality import Rule, mark_rows
from ..sinks.tables import upsert


def stream_source(spark: SparkSession, folder: str, schema: T.StructType, *, files: str | None = None,
                  file_format: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Stream the files of a folder; `files` narrows them by a glob on the file name."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def _write(df: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ()) -> None:
    """Process what is there, however long it takes, then stop."""
    writer = (df.writeStream.format("parquet").outputMode("append").option("path", target)
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def stream_incremental(stream: DataFrame, target: str, checkpoint: str, columns: Sequence[str] | None = None) -> None:
    """Append every row that arrived since the last run."""
    _write(stream.select(*columns) if columns else stream, target, checkpoint)


def stream_dedup(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str, target: str, checkpoint: str) -> None:
    """Keep the first row of each key; state older than `delay` behind the newest event is dropped.

    A zone-less time column is read in the session's zone, as a watermark needs it.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    _write(timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys)), target, checkpoint)


def stream_newest(stream: DataFrame, keys: Sequence[str], newest_by: str, table: str, checkpoint: str, rejects: str | None = None) -> None:
    """Keep the newest row of each key in a table, however late or in whatever order its copies arrive.

    Each micro-batch is reduced to its newest rows, which are upserted where the table has no newer one; a
    batch that runs again after a failure changes nothing. No state is kept besides the table, so no copy comes too late, and a table
    with key buckets has only those read and rewritten that the batch falls into. Rows without a key go to
    the folder `rejects`, a batch to a partition of its own; without such a folder they are left out.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    def merge(batch: DataFrame, number: int) -> None:
        if rejects:
            batch.filter(~known).write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        upsert(latest_row(batch.filter(known), keys, newest_by), table, keys, newest_by)

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def stream_quality_gate(stream: DataFrame, rules: Sequence[Rule], target: str, checkpoint: str) -> None:
    """Split passed and rejected rows into the folders dq_status=PASS and dq_status=REJECT in one pass."""
    _write(mark_rows(stream, rules), target, checkpoint, partition_by=["dq_status"])
