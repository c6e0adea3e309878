"""The seven-step run of a mapping: gate, load, check, statistics, log."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import quality
from ..operators.scd2 import DEFAULT_COLUMNS, Scd2Columns, scd2_schema
from ..runlog import Run, RunLog, require_upstreams
from ..sinks import tables as sinks
from ..session import work_path
from .builder import Sources, build, increment, reads_only, sql_expression
from .mapping import STRATEGIES, Mapping


@dataclass(frozen=True)
class RunResult:
    inserted: int
    deleted: int
    updated: int
    errors: int


def _touched_days(mapping: Mapping, sources: Sources, batch_date: date, load_ts: datetime | None) -> list[date | None]:
    """Partition days the increment writes to, and the batch date itself; None for rows without a day.

    Where the day is computed from the PRIMARY source alone, only its increment is read. A day whose rows a later filter
    drops is recomputed all the same, which changes nothing.
    """
    primary = next(s for s in mapping.sources if s.role == "PRIMARY")
    field = next((f for f in mapping.fields if f.name == mapping.partition_key), None)
    names = [f.name for f in mapping.fields]
    if field and field.kind in ("DIRECT", "DIRECT_MAPPING", "DERIVED") and reads_only(field.expression, primary.alias, mapping, names):
        days = increment(mapping, sources, batch_date).select(sql_expression(field.expression, batch_date).cast("date")).distinct()
    else:
        days = build(mapping, sources, batch_date, full=False, load_ts=load_ts, ordered=False).select(mapping.partition_key).distinct()
    found = {batch_date, *[r[0] for r in days.collect()]}
    return sorted(found, key=lambda d: (d is None, d or batch_date))


def _of_days(rows: DataFrame, column: str, days: list[date | None]) -> DataFrame:
    test = F.col(column).isin([d for d in days if d is not None])
    return rows.filter(test | F.col(column).isNull() if None in days else test)


def _whole_days(mapping: Mapping, sources: Sources, days: list[date | None], load_ts: datetime | None) -> DataFrame:
    """Rows of the touched days built from all of their facts, not only from the increment.

    The partition key is a group column, so Catalyst pushes this filter to the scans.
    """
    return _of_days(build(mapping, sources, full=True, load_ts=load_ts, ordered=False), mapping.partition_key, days)


def _batch_column(mapping: Mapping) -> str:
    """The target's batch date: rows that are inserted once per batch are kept by it."""
    for f in mapping.fields:
        if f.kind == "SYSTEM" and "BATCH_DATE" in f.expression.upper():
            return f.name
    raise ValueError("INCREMENTAL_INSERT needs a target field with the batch date, so that a second run replaces its own rows")


def history_columns(mapping: Mapping) -> Scd2Columns:
    """The names that scd_config gives to the history columns."""
    config = mapping.scd
    return Scd2Columns(
        effective=config.get("effective_date_field", "effective_date"),
        expiry=config.get("expire_date_field", config.get("expiry_date_field", "expiry_date")),
        current=config.get("current_flag_field", "is_current"), created=config.get("created_field"), updated=config.get("updated_field"),
        version=config.get("version_field"), end_of_time=date.fromisoformat(config.get("end_date_max", "9999-12-31")))


@contextmanager
def _staged(rows: DataFrame):
    """The rows, computed once and kept in the shared folder while they are checked and loaded."""
    spark, path = rows.sparkSession, work_path(rows.sparkSession, "mapping")
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        sinks.delete_folder(spark, path)


def run_mapping(spark: SparkSession, mapping: Mapping, sources: Sources, batch_date: date, log: RunLog, *,
                target: str | None = None, references: dict[str, DataFrame] | None = None, force_full: bool = False,
                load_ts: datetime | None = None, check_upstreams: bool = True, apply_retention: bool = False) -> RunResult:
    """Load a mapping's target for one batch date and log every step.

    FULL replaces the table. INCREMENTAL_MERGE and INCREMENTAL_UPDATE recompute the days that the increment touches and replace
    their partitions; without a partition key they upsert the increment by the target's keys. INCREMENTAL_INSERT adds the
    increment under its batch date. SCD2 merges it into a history by scd_config. In each case a second run changes nothing. The
    rows are computed once, checked, and only then published: what a strategy or a rule rejects leaves the target as it was.
    Under ALLOW every row is loaded with dq_status and the ids of the rules it breaks.
    """
    if mapping.strategy not in STRATEGIES:
        raise ValueError(f"unknown loading strategy {mapping.strategy!r}")
    target = target or mapping.target
    run = Run(log, f"load_{mapping.table}", mapping.mapping_id, batch_date)
    run.note("INIT", "RUNNING", run.started, message=f"strategy {mapping.strategy}, force_full {force_full}")
    with run.step("INIT"):
        if batch_date is None:
            raise ValueError("batch_date must not be empty")
    strategy = "FULL" if force_full and mapping.strategy != "SCD2" else mapping.strategy
    full, history = strategy == "FULL" or force_full, strategy == "SCD2"
    allow = mapping.exception_strategy.upper() == "ALLOW"

    with run.step("DEPENDENCY_CHECK") as step:
        if check_upstreams and mapping.upstreams:
            require_upstreams(log.runs(), mapping.upstreams, batch_date)
        step.message = ", ".join(mapping.upstreams)

    with run.step("PREPROCESS") as step:
        part = _batch_column(mapping) if mapping.strategy == "INCREMENTAL_INSERT" else mapping.partition_key
        names, schema = DEFAULT_COLUMNS, mapping.target_schema()
        if history:
            names = history_columns(mapping)
            natural, tracked = list(mapping.scd["natural_keys"]), list(mapping.scd["track_fields"])
            schema, part = scd2_schema(schema, natural, tracked, names), names.expiry
        elif allow:
            schema = T.StructType([*schema.fields, T.StructField("dq_failed", T.StringType()), T.StructField("dq_status", T.StringType())])
        sinks.create_target(spark, target, schema, partition_by=[part] if part else [])
        by_day = strategy in ("INCREMENTAL_MERGE", "INCREMENTAL_UPDATE") and bool(mapping.partition_key)
        days = _touched_days(mapping, sources, batch_date, load_ts) if by_day else []
        rows = (_whole_days(mapping, sources, days, load_ts) if by_day
                else build(mapping, sources, batch_date, full=full, load_ts=load_ts, ordered=False))
        step.message = f"{len(days)} days" if by_day else "whole table" if full else "the increment"

    rules = [quality.rule_from_mapping(r, mapping.table, mapping.error_threshold) for r in mapping.rules]
    tables = dict(references or {})
    for r in rules:
        name = r.config.get("ref_table")
        if name and name not in tables:
            source = next((s for s in mapping.sources if s.table == name), None)
            tables[name] = sources(source.name) if callable(sources) else sources[name]

    def check_rows(df: DataFrame) -> tuple[int, float]:
        """Check, log what fails, and raise if the strategy or a rule rejects; failing rows and their largest share."""
        if not rules:
            return 0, 0.0
        tables[mapping.table] = df
        results = quality.check_with_samples(tables, rules, batch_date, sample=10).collect()  # one row per rule
        now = datetime.now()
        log.add_faults([
            {"proc_name": run.proc_name, "mapping_id": mapping.mapping_id, "table_name": mapping.table,
             "batch_date": batch_date, "rule_id": r["rule_id"], "rule_name": r["rule_name"], "error_count": r["failed_rows"],
             "error_sample": r["error_details"], "check_time": now}
            for r in results if r["failed_rows"] > 0])
        quality.enforce(results, rules, mapping.exception_strategy)
        return sum(r["failed_rows"] for r in results), max((float(r["failed_percentage"] or 0) for r in results), default=0.0)

    with _staged(rows) as ready:
        with run.step("DATA_LOAD") as step:
            errors, share = check_rows(ready)
            if allow and not history:
                ready = quality.mark_rows(ready, [r for r in rules if r.rule_type in quality.ROW_TYPES])
            if history:
                report = sinks.merge_history(ready.select(*natural, *tracked), target, natural, tracked, batch_date, load_ts=load_ts, names=names)
            elif full:
                report = sinks.overwrite(ready, target)
            elif strategy == "INCREMENTAL_INSERT":
                report = sinks.replace_day(ready, target, batch_date, part)
            elif by_day:
                report = sinks.replace_days(ready, target, days, mapping.partition_key)
            else:
                report = sinks.upsert(ready, target, mapping.keys)
            step.row_count, step.message = report.inserted, f"inserted {report.inserted}, deleted {report.deleted}"

    with run.step("DATA_QUALITY") as step:
        step.error_rate_percent, step.message = share, f"{errors} failing"

    with run.step("STATISTICS") as step:
        sinks.refresh_statistics(spark, target)
        if apply_retention and mapping.retention_days and mapping.partition_key and part == mapping.partition_key:
            dropped = sinks.drop_old_partitions(spark, target, batch_date, mapping.retention_days, mapping.partition_key)
            step.message = f"dropped {len(dropped)} partitions"

    run.note("COMPLETE", "SUCCESS", run.started, datetime.now(), row_count=report.inserted,
             message=f"inserted {report.inserted}, deleted {report.deleted}, errors {errors}")
    return RunResult(report.inserted, report.deleted, report.updated, errors)
