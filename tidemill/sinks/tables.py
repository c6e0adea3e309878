"""Catalog-table sinks: append, full overwrite, day replace, upsert, history merge.

Parquet tables know neither DELETE nor MERGE.  Every change is computed as a new state and written
once, in the table's types, to a folder beside the table; only when it is complete does the table (or the
partition) take that folder as its location.  `publish` keeps a journal of that, so that a load that fails or dies
leaves all old rows or all new ones.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.scd2 import DEFAULT_COLUMNS, Scd2Columns, SourceKeyError, is_backdated, scd2_merge, source_key_faults
from .observed import RowCounter
from .publish import NULL_FOLDER, Change, Folder, delete_folder, drop_target, folders, partition_columns, quoted, recover, show_partitions, value_of

__all__ = ["KEY_BUCKET", "LoadReport", "append", "create_target", "delete_folder", "distribute", "drop_old_partitions", "drop_target", "load", "merge_history",
           "old_partitions", "overwrite", "partition_day", "recover", "refresh_statistics", "replace_day", "replace_days", "upsert", "upsert_state"]

#: Partition column of a table that spreads its keys over buckets, so that an upsert rewrites only those it touches.
KEY_BUCKET = "key_bucket"
_BUCKET_PROPERTY = "tidemill.key_bucket"


@dataclass(frozen=True)
class LoadReport:
    inserted: int = 0
    deleted: int = 0
    updated: int = 0


def create_target(spark: SparkSession, table: str, schema: T.StructType, *, partition_by: Sequence[str] = (),
                  bucket_by: Sequence[str] = (), buckets: int = 0, upsert_keys: Sequence[str] = (), key_buckets: int = 0, comment: str = "") -> None:
    """Create the table if it is missing; bucketing stands in for a distribution key.

    `key_buckets` adds the partition column `key_bucket`, a hash of `upsert_keys`: every load fills it, and an upsert by these keys
    reads and rewrites only the buckets that its keys fall into.
    """
    columns = []
    for f in schema.fields:
        note = f.metadata.get("comment", "").replace("\\", "\\\\").replace("'", "\\'")
        columns.append(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{note}'" if note else ""))
    if key_buckets:
        columns.append(f"`{KEY_BUCKET}` int")
        partition_by = [*partition_by, KEY_BUCKET]
    sql = f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({', '.join(columns)}) USING PARQUET"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if bucket_by:
        sql += " CLUSTERED BY (" + ", ".join(f"`{c}`" for c in bucket_by) + f") INTO {buckets} BUCKETS"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "\\'") + "'"
    if key_buckets:
        setting = json.dumps({"keys": list(upsert_keys), "buckets": key_buckets}).replace("'", "\\'")
        sql += f" TBLPROPERTIES ('{_BUCKET_PROPERTY}' = '{setting}')"
    spark.sql(sql)


def _bucketing(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """Keys and number of the key buckets of a table that has them."""
    if KEY_BUCKET not in spark.table(table).columns:
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").filter(F.col("key") == _BUCKET_PROPERTY).first()
    setting = json.loads(found["value"]) if found else None
    return (setting["keys"], setting["buckets"]) if setting else None


def _in_order(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order and type; rows of a partitioned table gathered by partition, so that a
    task does not open a file in every partition.  AQE splits what is too large for one task."""
    spark = df.sparkSession
    fields, bucketing = spark.table(table).schema.fields, _bucketing(spark, table)
    out = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields if not (bucketing and f.name == KEY_BUCKET)])
    if bucketing:
        keys, buckets = bucketing
        out = out.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int"))
        out = out.select(*[F.col(f"`{f.name}`") for f in fields])
    parts = partition_columns(spark, table)
    return out.hint("rebalance", *[F.col(f"`{c}`") for c in parts]) if parts else out


def append(df: DataFrame, table: str) -> LoadReport:
    spark = df.sparkSession
    recover(spark, table)
    seen = RowCounter()
    rows = seen.watch(df)
    _in_order(rows, table).write.mode("append").insertInto(table)
    spark.catalog.refreshTable(table)
    return LoadReport(inserted=seen.rows)


def _is_bucketed(spark: SparkSession, table: str) -> bool:
    return any(c.isBucket for c in spark.catalog.listColumns(table))


@contextmanager
def _aside(df: DataFrame, table: str) -> Iterator[Change]:
    """Writes the rows to a new folder beside the table, for the block to publish; what the block leaves unpublished is deleted."""
    spark = df.sparkSession
    change = Change.start(spark, table)
    try:
        rows, parts = _in_order(df, table), partition_columns(spark, table)
        if _is_bucketed(spark, table):
            # files carry their bucket in the name, which only an insert into a table of the same shape gives them
            twin = f"{table}__{change.path.rsplit('__v', 1)[1]}"
            spark.sql(f"CREATE TABLE {quoted(twin)} LIKE {quoted(table)} LOCATION '{change.path}'")
            try:
                rows.write.insertInto(twin)
            finally:
                spark.sql(f"DROP TABLE {quoted(twin)}")
        else:
            (rows.write.partitionBy(*parts) if parts else rows.write).parquet(change.path)
        yield change
    finally:
        change.close(spark)


def _read_aside(spark: SparkSession, table: str, path: str) -> DataFrame:
    return spark.read.schema(spark.table(table).schema).parquet(path)


def overwrite(df: DataFrame, table: str) -> LoadReport:
    """Strategy FULL: all old rows go."""
    spark = df.sparkSession
    seen = RowCounter()
    with _aside(seen.watch(df), table) as change:
        deleted = spark.table(table).count()
        change.publish(spark)
    return LoadReport(inserted=seen.rows, deleted=deleted)


def _day_text(day: date | None) -> str:
    return NULL_FOLDER if day is None else f"{day:%Y-%m-%d}"


def _of_days(column: str, days: Iterable[date | None]) -> Callable[[Folder], bool]:
    """Whether a partition belongs to one of the days, whatever other partition columns the table has."""
    texts = {_day_text(d) for d in days}
    return lambda folder: unquote(value_of(folder, column)) in texts


def replace_day(df: DataFrame, table: str, day: date, column: str = "stat_date") -> LoadReport:
    """Replace one day with all rows given; the day is cleared even if there are none, other days stay."""
    spark = df.sparkSession
    seen = RowCounter()
    with _aside(seen.watch(df).withColumn(column, F.lit(day)), table) as change:
        deleted = spark.table(table).filter(F.col(column) == F.lit(day)).count()
        change.publish(spark, _of_days(column, [day]))
    return LoadReport(inserted=seen.rows, deleted=deleted)


def replace_days(df: DataFrame, table: str, days: Iterable[date | None], column: str = "stat_date") -> LoadReport:
    """Replace several days at once; a listed day without rows comes out empty. None stands for the rows without a day."""
    spark = df.sparkSession
    wanted = set(days)
    listed = _of_days(column, wanted)
    touched = F.col(column).isin([d for d in wanted if d is not None])
    seen = RowCounter()
    with _aside(seen.watch(df), table) as change:
        if not all(map(listed, folders(spark, change.path, len(partition_columns(spark, table))))):
            raise ValueError("the rows hold days that were not listed")
        deleted = spark.table(table).filter(touched | F.col(column).isNull() if None in wanted else touched).count()
        change.publish(spark, listed)
    return LoadReport(inserted=seen.rows, deleted=deleted)


def upsert_state(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a partner in the source, then all source rows. NULL keys are equal to each other."""
    return _untouched(target, src, keys).unionByName(src.select(*target.columns))


def _untouched(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _same_key(target, src, keys, "left_anti")


def _same_key(target: DataFrame, src: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    partner = src.select(*[F.col(f"`{k}`").alias(f"__key_{n}") for n, k in enumerate(keys)]).distinct()
    same = F.lit(True)
    for n, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__key_{n}"))
    return target.join(partner, same, how)


def _in_folders(found: Iterable[Folder]) -> Column:
    """Whether a row lies in one of the partitions; a condition on partition columns only, so that no other partition is read."""
    def inside(folder: Folder) -> Column:
        tests = []
        for name, value in (f.split("=", 1) for f in folder):
            column = F.col(f"`{unquote(name)}`")
            tests.append(column.isNull() if value == NULL_FOLDER else column.cast("string") == F.lit(unquote(value)))
        return reduce(lambda a, b: a & b, tests)
    every = list(found)
    if every and all(len(f) == 1 and f[0].split("=", 1)[1] != NULL_FOLDER for f in every):
        name = unquote(every[0][0].split("=", 1)[0])
        return F.col(f"`{name}`").cast("string").isin([unquote(f[0].split("=", 1)[1]) for f in every])
    return reduce(lambda a, b: a | b, map(inside, every), F.lit(False))


def _newest_state(target: DataFrame, src: DataFrame, keys: Sequence[str], newest_by: str) -> DataFrame:
    """Target and source rows of which a source row takes the place of one that is not greater; both sides are shuffled once."""
    held = target.select(*[F.col(f"`{k}`").alias(f"__held_{n}") for n, k in enumerate(keys)], F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("__held"))
    new = src.select(*[F.col(f"`{k}`").alias(f"__new_{n}") for n, k in enumerate(keys)], F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("__new"))
    same = reduce(lambda a, b: a & b, [F.col(f"__held_{n}").eqNullSafe(F.col(f"__new_{n}")) for n in range(len(keys))])
    held_by, new_by = F.col("__held").getField(newest_by), F.col("__new").getField(newest_by)
    taken = F.col("__new").isNotNull() & (held_by.isNull() | (new_by >= held_by))
    row = F.when(F.col("__held").isNull() | F.coalesce(taken, F.lit(False)), F.col("__new")).otherwise(F.col("__held"))
    return held.join(new, same, "full").select(row.alias("row")).select("row.*")


def upsert(src: DataFrame, table: str, keys: Sequence[str], newest_by: str | None = None) -> LoadReport:
    """Strategy INCREMENTAL_MERGE.

    With `newest_by` a source row only replaces a row whose value there is not greater (NULL is the least).

    If the keys settle the partition (the partition columns are keys, or key buckets of them), only the partitions that the source falls into
    are read, merged and rewritten; otherwise the whole table is. Duplicate source keys are refused, and so is a NULL
    in a key column, except in a partition column: the rows without a day are a partition like any other.
    """
    spark = src.sparkSession
    parts, bucketing = partition_columns(spark, table), _bucketing(spark, table)
    seen = RowCounter()
    with _aside(seen.watch(src), table) as incoming:
        rows = _read_aside(spark, table, incoming.path)
        needed = [k for k in keys if k not in parts]
        faults = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
            F.coalesce(F.sum(F.when(F.concat(*[F.col(f"`{k}`").cast("string") for k in needed]).isNull(), F.col("n"))), F.lit(0)).alias("nulls")
            if needed else F.lit(0).alias("nulls")).first()
        if faults["duplicates"] or faults["nulls"]:
            raise SourceKeyError(f"source keys: {faults['nulls']} NULL, {faults['duplicates']} duplicated")
        target = spark.table(table)
        settled = [*keys, KEY_BUCKET] if bucketing and set(bucketing[0]) <= set(keys) else list(keys)
        partial = bool(parts) and set(parts) <= set(settled)
        if partial:
            target = target.filter(_in_folders(folders(spark, incoming.path, len(parts))))
        before = target.count()
        state = _newest_state(target, rows, keys, newest_by) if newest_by else upsert_state(target, rows, keys)
        with _aside(state, table) as change:
            after = _read_aside(spark, table, change.path).count()  # from file footers
            change.publish(spark, (lambda _: False) if partial else None)
    return LoadReport(inserted=after - before, updated=seen.rows - (after - before))


def merge_history(src: DataFrame, table: str, keys: Sequence[str], compare: Sequence[str], effective_date: date, *,
                  load_ts=None, names: Scd2Columns = DEFAULT_COLUMNS, delta: bool = False) -> LoadReport:
    """Strategy SCD2 on a catalog table; refuses NULL and duplicate source keys.

    The date may lie before dates that were merged already: the intervals of the source's keys are then split at it.

    In a table partitioned by the expiry date all open rows share one partition, and the rows a merge closes go to the partition
    of the day before.  Only these two partitions are read and rewritten, or those from the day before on if the
    date is a past one; older history is never touched.  Other tables are rewritten as a whole.
    """
    spark = src.sparkSession
    recover(spark, table)
    faults = source_key_faults(src, keys).first()
    if faults["null_keys"] or faults["duplicate_keys"]:
        raise SourceKeyError(f"source keys: {faults['null_keys']} NULL, {faults['duplicate_keys']} duplicated")
    whole = spark.table(table)
    closing = effective_date - timedelta(days=1)
    # no interval of these keys is touched that ends before the day before
    late = is_backdated(whole.filter(F.col(names.expiry) >= F.lit(closing)), effective_date, names)
    by_expiry, dim = partition_columns(spark, table) == [names.expiry], whole
    if by_expiry:
        dim = whole.filter(F.col(names.expiry) >= F.lit(closing) if late else F.col(names.expiry).isin(names.end_of_time, closing))
    before = dim.agg(F.count(F.lit(1)).alias("rows"), F.count_if(names.current).alias("open")).first()
    state = scd2_merge(dim, src, keys, compare, effective_date, load_ts=load_ts, names=names, delta=delta, backdated=late)

    def touched(folder: Folder) -> bool:
        day = date.fromisoformat(value_of(folder, names.expiry))
        return day >= closing if late else day in (names.end_of_time, closing)

    with _aside(state, table) as change:
        after = _read_aside(spark, table, change.path).agg(F.count(F.lit(1)).alias("rows"), F.count_if(names.current).alias("open")).first()
        change.publish(spark, touched if by_expiry else None)
    closed = (after["rows"] - after["open"]) - (before["rows"] - before["open"])
    return LoadReport(inserted=after["rows"] - before["rows"], updated=closed)


def load(df: DataFrame, table: str, strategy: str, *, keys: Sequence[str] = (), day: date | None = None,
         day_column: str = "stat_date", compare: Sequence[str] = (), force_full: bool = False, load_ts=None,
         names: Scd2Columns = DEFAULT_COLUMNS) -> LoadReport:
    """Write by strategy name; `force_full` turns every strategy into FULL."""
    strategy = "FULL" if force_full else strategy.upper()
    if strategy == "FULL":
        return overwrite(df, table)
    if strategy == "INCREMENTAL_INSERT":
        return append(df, table)
    if strategy == "INCREMENTAL_MERGE":
        return upsert(df, table, keys)
    if strategy == "INCREMENTAL_UPDATE":
        return replace_day(df, table, day, day_column)
    if strategy == "SCD2":
        return merge_history(df, table, keys, compare, day, load_ts=load_ts, names=names)
    raise ValueError(f"unknown loading strategy {strategy!r}")


def old_partitions(days: DataFrame, column: str, batch_date: date, retention_days: int) -> DataFrame:
    """Distinct days that fall out of the retention window."""
    limit = batch_date - timedelta(days=retention_days)
    return days.filter(F.col(column) < F.lit(limit)).select(column).distinct()


def drop_old_partitions(spark: SparkSession, table: str, batch_date: date, retention_days: int,
                        column: str = "stat_date") -> list[str]:
    """Drop partitions older than the retention; works on the partition list, not on rows."""
    limit = batch_date - timedelta(days=retention_days)
    dropped = []
    for value in {value_of(f, column) for f in show_partitions(spark, table)}:
        # rows without a day have no age
        if value != NULL_FOLDER and date.fromisoformat(value) < limit:
            spark.sql(f"ALTER TABLE {quoted(table)} DROP PARTITION (`{column}` = DATE '{value}')")
            dropped.append(value)
    return sorted(dropped)


# Fixed names of the partition granularities and the date unit they truncate to.
GRANULARITIES = {"DAY": "day", "MONTH": "month", "YEAR": "year"}


def partition_day(column: str, granularity: str = "DAY") -> Column:
    """First day of the column's partition."""
    return F.date_trunc(GRANULARITIES[granularity.upper()], F.col(column)).cast("date")


def distribute(df: DataFrame, kind: str, keys: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """HASH spreads by key and ROUNDROBIN evenly; REPLICATION leaves a small table to the size-checked broadcast."""
    kind = kind.upper()
    if kind == "HASH":
        # AQE splits the partition of a hot key and merges small ones
        return df.hint("rebalance", *([partitions] if partitions else []), *[F.col(k) for k in keys])
    if kind == "ROUNDROBIN":
        return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if kind == "REPLICATION":
        return df
    raise ValueError(f"unknown distribution type {kind!r}")


def refresh_statistics(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    spark.sql(f"ANALYZE TABLE {quoted(table)} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {quoted(table)} COMPUTE STATISTICS FOR COLUMNS "
                  + ", ".join(f"`{c}`" for c in columns))
