"""Slowly changing dimension, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import differs, stamp


@dataclass(frozen=True)
class Scd2Columns:
    """Names of the history columns; the other common naming is eff_start_date / eff_end_date."""

    effective: str = "effective_date"
    expiry: str = "expiry_date"
    current: str = "is_current"
    created: str | None = "created_at"
    updated: str | None = "last_updated"
    version: str | None = None
    #: array of the later dates that confirmed a row; with it, snapshots may be merged in any order
    seen: str | None = None
    end_of_time: date = date(9999, 12, 31)


DEFAULT_COLUMNS = Scd2Columns()


class SourceKeyError(ValueError):
    """The source has NULL or duplicate keys, so no single next state exists."""


def scd2_schema(source: T.StructType, keys: Sequence[str], compare: Sequence[str],
                names: Scd2Columns = DEFAULT_COLUMNS) -> T.StructType:
    """Schema of a history table for the given source columns; the keys are given, not guessed."""
    fields = [T.StructField(c, source[c].dataType, c not in keys) for c in [*keys, *compare]]
    fields += [T.StructField(names.effective, T.DateType(), False), T.StructField(names.expiry, T.DateType(), False),
               T.StructField(names.current, T.BooleanType(), False)]
    for extra in (names.created, names.updated):
        if extra:
            fields.append(T.StructField(extra, T.TimestampNTZType()))
    if names.version:
        fields.append(T.StructField(names.version, T.IntegerType()))
    if names.seen:
        fields.append(T.StructField(names.seen, T.ArrayType(T.DateType())))
    return T.StructType(fields)


def source_key_faults(src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: null_keys (rows with a NULL key part) and duplicate_keys (key values that occur twice)."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(known & (F.col("n") > 1)).alias("duplicate_keys"))


def _any(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def is_backdated(dim: DataFrame, effective_date: date, names: Scd2Columns = DEFAULT_COLUMNS) -> bool:
    """Whether the dimension knows of a later date than this one."""
    last = [F.max(names.effective)] + ([F.max(F.array_max(names.seen))] if names.seen else [])
    return any(d is not None and d > effective_date for d in dim.agg(*last).first())


def scd2_merge(dim: DataFrame, src: DataFrame, keys: Sequence[str], compare: Sequence[str], effective_date: date, *,
               load_ts: datetime | None = None, names: Scd2Columns = DEFAULT_COLUMNS, delta: bool = False,
               backdated: bool = False) -> DataFrame:
    """The next state of the dimension.

    History rows pass through without a shuffle.  Current rows meet the source on the key,
    and each pair yields the closed or kept row and the new row.  Keys missing from the
    source stay current.  A row that was opened on the same effective date is replaced in
    place.  Source keys must be known and unique (`source_key_faults`).

    A source that is a whole snapshot meets the current rows in one FULL OUTER join.  With
    `delta` the source holds changes only: the current rows LEFT join it, so the dimension
    is not shuffled when Catalyst finds the changes small enough to broadcast.

    A date before others that the dimension knows needs `backdated` (see `is_backdated`): the source's values are put into the
    history of their keys, whose intervals are split there.  Without it such a row stops the job.  A value holds
    until the next date at which the key is known to have another one; if `names.seen` keeps the dates that confirmed a row,
    merging the same snapshots in any order gives the same history.
    """
    if backdated:
        return _backdated_merge(dim, src, keys, compare, effective_date, load_ts, names)
    schema = scd2_schema(dim.schema, keys, compare, names)
    columns = schema.fieldNames()
    now = stamp(load_ts or datetime.now())
    opened = F.lit(effective_date).cast("date")

    current = F.col(names.current) == F.lit(True)
    history = dim.filter(~F.coalesce(current, F.lit(False))).select(*columns)
    open_rows = dim.filter(current).select(F.struct(*columns).alias("old"))
    fresh = src.select(F.struct(*keys, *compare).alias("new"))

    on = reduce(lambda a, b: a & b, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
    if delta:
        matched = open_rows.join(fresh, on, "left_semi")
        unknown = fresh.join(matched, on, "left_anti")
        pairs = open_rows.join(fresh, on, "left").unionByName(unknown, allowMissingColumns=True)
    else:
        pairs = open_rows.join(fresh, on, "full_outer")

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    late = F.col(f"old.{names.effective}") > opened
    if names.seen:
        late = late | (F.coalesce(F.array_max(f"old.{names.seen}"), opened) > opened)
    changed = has_old & has_new & _any([differs(F.col(f"old.{c}"), F.col(f"new.{c}")) for c in compare])
    same_day = changed & (F.col(f"old.{names.effective}") == opened)

    def old_value(name: str) -> Column:
        value = F.col(f"old.{name}")
        if name == names.effective:
            return F.when(has_new & late, F.raise_error(F.lit(f"rows are known after {effective_date}: merge with backdated=True"))).otherwise(value)
        if name == names.expiry:
            return F.when(changed, F.date_sub(opened, 1)).otherwise(value)
        if name == names.current:
            return F.when(changed, F.lit(False)).otherwise(value)
        if names.updated and name == names.updated:
            return F.when(changed, now).otherwise(value)
        if names.seen and name == names.seen:
            confirmed = has_new & ~changed & (F.col(f"old.{names.effective}") < opened)
            kept = F.when(changed, F.array_remove(value, opened)).otherwise(value)
            return F.when(confirmed, F.array_union(value, F.array(opened))).otherwise(kept)
        return value

    def new_value(name: str) -> Column:
        if name == names.effective:
            return opened
        if name == names.expiry:
            return F.lit(names.end_of_time).cast("date")
        if name == names.current:
            return F.lit(True)
        if name in (names.created, names.updated):
            return now
        if names.version and name == names.version:
            before = F.col(f"old.{name}") - F.when(same_day, 1).otherwise(0)
            return (F.coalesce(before, F.lit(0)) + 1).cast("int")
        if names.seen and name == names.seen:
            return F.array().cast("array<date>")
        return F.col(f"new.{name}")

    kept = F.when(has_old & ~same_day, F.struct(*[old_value(c).cast(schema[c].dataType).alias(c) for c in columns]))
    added = F.when(has_new & (~has_old | changed),
                   F.struct(*[new_value(c).cast(schema[c].dataType).alias(c) for c in columns]))
    rows = pairs.select(F.explode(F.array(kept, added)).alias("row")).filter(F.col("row").isNotNull()).select("row.*")
    return history.unionByName(rows)


def _backdated_merge(dim: DataFrame, src: DataFrame, keys: Sequence[str], compare: Sequence[str], effective_date: date,
                     load_ts: datetime | None, names: Scd2Columns) -> DataFrame:
    """Interval splitting: the dates at which something is known of a source key, with their values, are put in order anew.

    Each interval gives its first date and the dates that confirmed it, the source gives the effective date (it wins over a
    date already known). Neighbours with the same value are one interval; each lasts until the day before the next.
    Only rows of source keys are grouped and sorted, a key's dates in one group; the others pass through.
    """
    schema = scd2_schema(dim.schema, keys, compare, names)
    columns = schema.fieldNames()
    now, opened = stamp(load_ts or datetime.now()), F.lit(effective_date).cast("date")
    extras = [c for c in (names.created, names.updated) if c]
    known = src.select(*keys)
    others = dim.join(known, list(keys), "left_anti").select(*columns)

    value = F.struct(*[F.col(c).cast(schema[c].dataType).alias(c) for c in compare])
    keyed = [F.col(k).cast(schema[k].dataType).alias(k) for k in keys]
    kept = F.struct(F.col(names.expiry).alias("expiry"), (F.col(names.version) if names.version else F.lit(None).cast("int")).alias("version"),
                    *[F.col(c) for c in extras])
    opening = F.array(F.struct(F.col(names.effective).alias("at"), F.lit(True).alias("opens")))
    if names.seen:
        again = F.transform(F.coalesce(F.col(names.seen), F.array().cast("array<date>")), lambda d: F.struct(d.alias("at"), F.lit(False).alias("opens")))
        opening = F.concat(opening, again)
    held = (dim.join(known, list(keys), "left_semi")
            .select(*keyed, value.alias("value"), kept.alias("kept"), F.explode(opening).alias("p"))
            .select(*keys, F.col("p.at").alias("at"), "value", F.when(F.col("p.opens"), F.col("kept")).alias("kept"), F.lit(0).alias("rank")))
    given = src.select(*keyed, opened.alias("at"), value.alias("value"), F.lit(None).cast(held.schema["kept"].dataType).alias("kept"), F.lit(1).alias("rank"))

    # one value for each date; what the row that opened then held besides is kept as long as the value is
    points = held.unionByName(given).groupBy(*keys, "at").agg(
        F.max_by("value", "rank").alias("value"), F.max_by(F.struct("value"), F.when(F.col("kept").isNotNull(), F.col("rank"))).alias("was"),
        F.max_by("kept", F.when(F.col("kept").isNotNull(), F.col("rank"))).alias("kept"))
    by_key = Window.partitionBy(*keys).orderBy("at")
    starts = F.coalesce(~F.col("value").eqNullSafe(F.lag("value").over(by_key)), F.lit(True)) | (F.row_number().over(by_key) == 1)
    runs = points.select("*", starts.alias("starts")).select("*", F.sum(F.col("starts").cast("int")).over(by_key).alias("run"))
    first = F.struct("at", "value", F.when(F.col("value").eqNullSafe(F.col("was.value")), F.col("kept")).alias("kept"))
    intervals = runs.groupBy(*keys, "run").agg(F.min_by(first, "at").alias("first"), F.array_sort(F.collect_list("at")).alias("dates"),
                                               F.min("kept.version").alias("version"))
    in_order = Window.partitionBy(*keys).orderBy("run")
    following = F.lead(F.col("first.at")).over(in_order)
    placed = intervals.select("*", following.alias("next"), F.min("version").over(Window.partitionBy(*keys)).alias("base"))
    expiry = F.coalesce(F.date_sub("next", 1), F.lit(names.end_of_time).cast("date"))
    same = F.col("first.kept").isNotNull()
    out = {names.effective: F.col("first.at"), names.expiry: expiry, names.current: F.col("next").isNull()}
    if names.created:
        out[names.created] = F.when(same, F.col(f"first.kept.{names.created}")).otherwise(now)
    if names.updated:
        out[names.updated] = F.when(same & (F.col("first.kept.expiry") == expiry), F.col(f"first.kept.{names.updated}")).otherwise(now)
    if names.version:
        out[names.version] = F.coalesce("base", F.lit(1)) + F.col("run") - 1
    if names.seen:
        out[names.seen] = F.array_remove("dates", F.col("first.at"))
    out |= {c: F.col(f"first.value.{c}") for c in compare} | {k: F.col(k) for k in keys}
    return others.unionByName(placed.select(*[out[c].cast(schema[c].dataType).alias(c) for c in columns]))


def first_load(src: DataFrame, keys: Sequence[str], compare: Sequence[str], effective_date: date, *,
               load_ts: datetime | None = None, names: Scd2Columns = DEFAULT_COLUMNS) -> DataFrame:
    """History of an empty dimension: every source row is a current row."""
    now = stamp(load_ts or datetime.now())
    out = src.select(
        *keys, *compare, F.lit(effective_date).cast("date").alias(names.effective),
        F.lit(names.end_of_time).cast("date").alias(names.expiry), F.lit(True).alias(names.current))
    for extra in (names.created, names.updated):
        if extra:
            out = out.withColumn(extra, now)
    if names.version:
        out = out.withColumn(names.version, F.lit(1))
    return out.withColumn(names.seen, F.array().cast("array<date>")) if names.seen else out


def current_rows(dim: DataFrame, names: Scd2Columns = DEFAULT_COLUMNS) -> DataFrame:
    return dim.filter(F.col(names.current))


def key_history(dim: DataFrame, key: Column, names: Scd2Columns = DEFAULT_COLUMNS) -> DataFrame:
    """All versions of the rows that meet `key`, oldest first."""
    return dim.filter(key).orderBy(names.effective)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """UPDATE ... FROM: rows with a partner take the partner's values, NULLs included; others stay."""
    flag, prefix = "__hit", "__new_"
    right = source.select(*[F.col(k).alias(prefix + k) for k in keys], *[F.col(c).alias(prefix + c) for c in columns],
                          F.lit(True).alias(flag))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(prefix + k) for k in keys])
    joined = target.join(right, on, "left")
    return joined.select(*[
        (F.when(F.col(flag), F.col(prefix + c)).otherwise(F.col(c)) if c in columns else F.col(c)).alias(c)
        for c in target.columns
    ])
