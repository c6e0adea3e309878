"""Bulk copies between files."""

from __future__ import annotations

from dataclasses import dataclass
from time import monotonic

from pyspark.sql import DataFrame, functions as F

from ..operators.chunks import BATCH_SIZE, RANGES, ROWS_PER_FILE, copy_key, ordered_layout, with_range_number
from .observed import RowCounter


@dataclass(frozen=True)
class CopyReport:
    rows: int
    batches: int
    seconds: float

    @property
    def rows_per_second(self) -> float | None:
        return round(self.rows / self.seconds) if self.seconds > 0 else None


def copy_table(src: DataFrame, target: str, key: str | None = None, batch_size: int = BATCH_SIZE,
               truncate: bool = False, rows_per_file: int = ROWS_PER_FILE, ordered: bool = False) -> CopyReport:
    """One distributed write, each task what it has read; `ordered` sorts the target by key first, which shuffles it.

    Batches only count progress (`chunk_report` lists them).  Files are larger than a
    batch, because a file per 50,000 rows would leave millions of small files.
    """
    start = monotonic()
    seen = RowCounter()
    laid_out = seen.watch(ordered_layout(src, copy_key(src, key), rows_per_file) if ordered else src)
    mode = "overwrite" if truncate else "append"
    laid_out.write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(target)
    rows = seen.rows
    return CopyReport(rows, -(-rows // batch_size), monotonic() - start)


def range_copy(src: DataFrame, target: str, key: str, ranges: int = RANGES) -> None:
    """Copy all key ranges in one job; each range is a partition folder of the target, which is replaced.

    The range number is computed from the key, so no shuffle is needed and a range that holds most of the
    rows is written by as many tasks as read it.  Rows without a key are copied too, under a NULL range number.
    """
    with_range_number(src, key, ranges).write.mode("overwrite").partitionBy("range_no").parquet(target)
