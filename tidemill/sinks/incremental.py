"""Batch watermark loads.

State is an append-only Parquet table; the row with the highest load_seq per (source,
target) counts.  Each load writes its rows into a partition named by its load_seq, so a
load that died before it saved its state overwrites the same partition when it runs again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import stamp
from ..schemas import WATERMARK
from ..sources.reader import typed_rows
from .observed import RowCounter

# Fixed value: where a load without state starts.
START = datetime(1900, 1, 1)


class WatermarkStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        typed_rows(spark, [], WATERMARK).write.mode("ignore").parquet(path)

    def log(self) -> DataFrame:
        return self.spark.read.schema(WATERMARK).parquet(self.path)

    def current(self) -> DataFrame:
        """The state rows that count, one per (source, target)."""
        return latest_states(self.log())

    def get(self, source: str, target: str) -> tuple[datetime, int]:
        """(last watermark, last load_seq)."""
        row = self.current().filter((F.col("source_table") == source) & (F.col("target_table") == target)).first()
        return (row["last_watermark"], row["load_seq"]) if row else (START, 0)

    def save(self, source: str, target: str, watermark: datetime, rows: int, load_seq: int,
             load_ts: datetime | None = None) -> None:
        state = {"source_table": source, "target_table": target, "last_watermark": watermark,
                 "last_load_time": load_ts or datetime.now(), "row_count": rows, "load_seq": load_seq}
        typed_rows(self.spark, [state], WATERMARK).coalesce(1).write.mode("append").parquet(self.path)

    def reset(self, source: str, target: str) -> None:
        """Start again from 1900-01-01; the next load appends everything once more."""
        _, seq = self.get(source, target)
        self.save(source, target, START, 0, seq + 1)


def latest_states(log: DataFrame) -> DataFrame:
    names = [c for c in log.columns if c not in ("source_table", "target_table")]
    newest = F.max_by(F.struct(*names), "load_seq").alias("state")
    return log.groupBy("source_table", "target_table").agg(newest).select("source_table", "target_table", "state.*")


def incremental_window(src: DataFrame, column: str, last: datetime, current: datetime) -> DataFrame:
    """Rows in (last, current]; both bounds are literals that reach the scan."""
    value = F.col(column)
    return src.filter((value > stamp(last)) & (value <= stamp(current)))


def new_watermark(src: DataFrame, column: str, last: datetime) -> datetime | None:
    """MAX of the column above `last`, or None when nothing is new."""
    return src.filter(F.col(column) > stamp(last)).agg(F.max(column).cast("timestamp_ntz")).first()[0]


def incremental_load(src: DataFrame, source: str, target_path: str, column: str, store: WatermarkStore, *,
                     columns: Sequence[str] | None = None, load_ts: datetime | None = None) -> int:
    """Load the new rows below `target_path` and move the watermark; returns the number of rows."""
    last, seq = store.get(source, target_path)
    current = new_watermark(src, column, last)
    if current is None:
        return 0
    rows = incremental_window(src, column, last, current)
    if columns:
        rows = rows.select(*columns)
    seen = RowCounter()
    seen.watch(rows).write.mode("overwrite").parquet(f"{target_path}/load_seq={seq + 1}")
    loaded = seen.rows
    store.save(source, target_path, current, loaded, seq + 1, load_ts)
    return loaded
