"""Latest-row and latest-batch deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import stamp

# NULL load times count as newest, as in the source dialect's DESC order.
_NEWEST = datetime(9999, 12, 31, 23, 59, 59)


def latest_row(df: DataFrame, keys: Sequence[str], newest_by: str, tiebreak: Sequence[str | Column] | None = None) -> DataFrame:
    """Keep one newest row per key.

    ROW_NUMBER = 1 lets Catalyst place a WindowGroupLimit before the shuffle, so each
    task sends at most one row per key, however many copies a key has.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c != newest_by]
    order = [F.col(newest_by).desc_nulls_first()]
    order += [F.col(c).desc() if isinstance(c, str) else c for c in tiebreak]
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(by_key)).filter(F.col("__rn") == 1).drop("__rn")


def latest_batch_total(df: DataFrame, keys: Sequence[str], batch: str, measure: str) -> DataFrame:
    """Per key, the SUM of `measure` over the newest load batch only.

    Two hash aggregates with map-side partials: many copies of one key collapse
    before either shuffle, and no window has to sort them.
    """
    per_batch = df.groupBy(*keys, batch).agg(F.sum(measure).alias(measure))
    age = F.coalesce(F.col(batch), stamp(_NEWEST))
    return per_batch.groupBy(*keys).agg(F.max_by(measure, age).alias(measure))
