"""Rule-driven quality checks.

All row-level rules of a table are counted in one pass.  A UNIQUE or REFERENTIAL rule
adds one pass that first counts rows per key, so a hot key is one row by the time it
is shuffled or joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window, SparkSession, functions as F, types as T

from ..functions import percent, rows_json
from ..sources.reader import typed_rows
from .lookup import valid_rows

ROW_TYPES = ("NOT_NULL", "RANGE", "REGEX", "CUSTOM", "IN_SET", "DATE_RANGE", "INT_RANGE", "TEXT_LENGTH")
KEY_TYPES = ("UNIQUE", "REFERENTIAL")
DEFAULT_THRESHOLD = 5.0

RESULT_COLUMNS = ["check_date", "rule_id", "rule_name", "schema_name", "table_name", "column_name", "rule_type",
                  "total_rows", "failed_rows", "failed_percentage", "check_status"]


@dataclass(frozen=True)
class Rule:
    """One rule.  `config` holds min/max, pattern, condition, values, ref_table/ref_field or nulls_fail."""

    rule_id: str
    rule_type: str
    table: str
    column: str | None = None
    config: Mapping[str, Any] = field(default_factory=dict)
    threshold: float = DEFAULT_THRESHOLD
    name: str = ""
    schema: str = ""
    active: bool = True
    error_action: str = "LOG"

    @property
    def columns(self) -> list[str]:
        return [c.strip() for c in (self.column or "").split(",") if c.strip()]


def parse_rule(text: str, table: str, **more: Any) -> Rule:
    """The sheet's micro format ID:TYPE:field[:args], e.g. R2:RANGE:amount:0:100 or R3:REFERENTIAL:code:dim_x:code."""
    parts = text.split(":")
    if len(parts) < 3:
        raise ValueError(f"a rule reads ID:TYPE:field[:args], not {text!r}")
    rule_id, kind, column, args = parts[0], parts[1].upper(), parts[2], parts[3:]
    if kind in ("RANGE", "DATE_RANGE", "INT_RANGE", "TEXT_LENGTH"):
        config = {k: v for k, v in zip(("min", "max"), args) if v != ""}
    elif kind == "REGEX":
        config = {"pattern": ":".join(args)}
    elif kind == "CUSTOM":
        config = {"condition": ":".join(args)}
    elif kind == "IN_SET":
        config = {"values": args[0].split("|")}
    elif kind == "REFERENTIAL":
        config = {"ref_table": args[0], "ref_field": args[1] if len(args) > 1 else column}
    else:
        config = {}
    return Rule(rule_id, kind, table, column, config, **more)


def rule_from_mapping(entry: Mapping[str, Any], table: str, threshold: float = DEFAULT_THRESHOLD) -> Rule:
    """A validation_rules entry of a mapping document."""
    config: dict[str, Any] = {}
    for source, name in (("min_value", "min"), ("max_value", "max"), ("pattern", "pattern"), ("condition", "condition"),
                         ("values", "values"), ("ref_table", "ref_table"), ("ref_field", "ref_field"),
                         ("nulls_fail", "nulls_fail")):
        if entry.get(source) is not None:
            config[name] = entry[source]
    return Rule(entry["rule_id"], entry["rule_type"].upper(), table, entry.get("field"), config, threshold,
                entry.get("rule_name", ""), error_action=entry.get("error_action", "LOG"))


def select_rules(rules: Iterable[Rule], *, schema: str | None = None, table: str | None = None,
                 rule_id: str | None = None) -> list[Rule]:
    """Active rules, narrowed by schema, table or id; None means all."""
    return [r for r in rules if r.active
            and (rule_id is None or r.rule_id == rule_id)
            and (schema is None or r.schema == schema)
            and (table is None or r.table == table)]


def bad_row(rule: Rule) -> Column:
    """TRUE for a row that breaks a row-level rule.  NULL passes unless config nulls_fail is set."""
    column = F.col(rule.column) if rule.column else F.lit(1)
    config = rule.config
    if rule.rule_type == "NOT_NULL":
        bad = column.isNull()
        return bad | (column == "") if config.get("empty_fails") else bad
    if rule.rule_type in ("RANGE", "INT_RANGE", "DATE_RANGE", "TEXT_LENGTH"):
        value = F.length(column) if rule.rule_type == "TEXT_LENGTH" else column
        kind = "date" if rule.rule_type == "DATE_RANGE" else None
        bounds = []
        if config.get("min") is not None:
            low = F.expr(str(config["min"])) if kind is None else F.lit(str(config["min"])).cast(kind)
            bounds.append(value < low)
        if config.get("max") is not None:
            high = F.expr(str(config["max"])) if kind is None else F.lit(str(config["max"])).cast(kind)
            bounds.append(value > high)
        bad = reduce(lambda a, b: a | b, bounds, F.lit(False))
    elif rule.rule_type == "REGEX":
        bad = ~column.rlike(config["pattern"])
    elif rule.rule_type == "CUSTOM":
        bad = F.expr(config["condition"])
    elif rule.rule_type == "IN_SET":
        bad = ~column.isin(list(config["values"]))
    else:
        raise ValueError(f"unknown rule type {rule.rule_type!r} in rule {rule.rule_id}")
    bad = F.coalesce(bad, F.lit(False))
    return bad | column.isNull() if config.get("nulls_fail") else bad


def _metric_rows(one_row: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Turn one wide row (total_rows, f0, f1, ...) into one row per rule."""
    packed = F.array(*[
        F.struct(F.lit(r.rule_id).alias("rule_id"), F.col(f"f{i}").alias("failed_rows")) for i, r in enumerate(rules)
    ])
    return one_row.select("total_rows", F.explode(packed).alias("m")).select("m.rule_id", "total_rows", "m.failed_rows")


def _row_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    counts = [F.count_if(bad_row(r)).alias(f"f{i}") for i, r in enumerate(rules)]
    return _metric_rows(df.agg(F.count(F.lit(1)).alias("total_rows"), *counts), rules)


def _key_known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("key_rows"))


def _unique_rule(df: DataFrame, rule: Rule) -> DataFrame:
    """Failing = number of duplicated key values, not of rows; NULL keys are left out."""
    keys = _key_counts(df, rule.columns)
    one = keys.agg(F.coalesce(F.sum("key_rows"), F.lit(0)).alias("total_rows"),
                   F.count_if(_key_known(rule.columns) & (F.col("key_rows") > 1)).alias("f0"))
    return _metric_rows(one, [rule])


def _reference_keys(tables: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    """Distinct keys of the referenced table as __ref0, __ref1, ...; `valid_only` in the rule's config leaves rows out that are not valid."""
    dim = tables[rule.config["ref_table"]]
    if rule.config.get("valid_only", "is_valid" in dim.columns):
        dim = valid_rows(dim)
    names = [c.strip() for c in (rule.config.get("ref_field") or rule.column).split(",")]
    if len(names) != len(rule.columns):
        raise ValueError(f"rule {rule.rule_id} compares {len(rule.columns)} columns with {len(names)}")
    return dim.select(*[F.col(c).alias(f"__ref{n}") for n, c in enumerate(names)]).distinct()


def _same_reference(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__ref{n}") for n, c in enumerate(rule.columns)])


def _referential_rule(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame]) -> DataFrame:
    keys = _key_counts(df, rule.columns)
    joined = keys.join(_reference_keys(tables, rule), _same_reference(rule), "left")
    orphan = _key_known(rule.columns) & F.col("__ref0").isNull()
    one = joined.agg(F.coalesce(F.sum("key_rows"), F.lit(0)).alias("total_rows"),
                     F.coalesce(F.sum(F.when(orphan, F.col("key_rows"))), F.lit(0)).alias("f0"))
    return _metric_rows(one, [rule])


def rule_counts(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """(rule_id, total_rows, failed_rows) for every rule."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Rule]] = {}
    for rule in rules:
        if rule.rule_type in ROW_TYPES:
            by_table.setdefault(rule.table, []).append(rule)
        elif rule.rule_type == "UNIQUE":
            parts.append(_unique_rule(tables[rule.table], rule))
        elif rule.rule_type == "REFERENTIAL":
            parts.append(_referential_rule(tables[rule.table], rule, tables))
        else:
            raise ValueError(f"unknown rule type {rule.rule_type!r} in rule {rule.rule_id}")
    parts = [_row_rules(tables[t], rs) for t, rs in by_table.items()] + parts
    if not parts:
        raise ValueError("no rules to check")
    return reduce(DataFrame.unionByName, parts)


def failed_percentage(failed: Column, total: Column) -> Column:
    return F.round(percent(failed, total), 2).cast("decimal(5,2)")


def check_status(pct: Column, threshold: Column) -> Column:
    return F.when(pct == 0, "PASSED").when(pct <= threshold, "WARNING").otherwise("FAILED")


def check(tables: Mapping[str, DataFrame], rules: Sequence[Rule], check_date: date) -> DataFrame:
    """One result row per rule; lazy, and without samples (see `error_samples`)."""
    rules = select_rules(rules)
    by_id = {r.rule_id: r for r in rules}
    if len(by_id) != len(rules):
        raise ValueError("rule ids must be unique")

    def attribute(get, kind: str) -> Column:
        pairs = [x for r in rules for x in (F.lit(r.rule_id), F.lit(get(r)).cast(kind))]
        return F.create_map(*pairs)[F.col("rule_id")]

    pct = failed_percentage(F.col("failed_rows"), F.col("total_rows"))
    threshold = attribute(lambda r: str(r.threshold), "decimal(5,2)")
    return rule_counts(tables, rules).select(
        F.lit(check_date).alias("check_date"), "rule_id",
        attribute(lambda r: r.name, "string").alias("rule_name"),
        attribute(lambda r: r.schema, "string").alias("schema_name"),
        attribute(lambda r: r.table, "string").alias("table_name"),
        attribute(lambda r: r.column, "string").alias("column_name"),
        attribute(lambda r: r.rule_type, "string").alias("rule_type"),
        "total_rows", "failed_rows",
        pct.alias("failed_percentage"),
        check_status(pct, threshold).alias("check_status"),
    )


def failing_rows(tables: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    """The rows of the table that break a rule."""
    df = tables[rule.table]
    if rule.rule_type == "UNIQUE":
        twice = _key_counts(df, rule.columns).filter(_key_known(rule.columns) & (F.col("key_rows") > 1))
        return df.join(twice.drop("key_rows"), rule.columns, "left_semi")
    if rule.rule_type == "REFERENTIAL":
        return df.filter(_key_known(rule.columns)).join(_reference_keys(tables, rule), _same_reference(rule), "left_anti")
    return df.filter(bad_row(rule))


def error_samples(tables: Mapping[str, DataFrame], rules: Sequence[Rule], sample: int = 100,
                  keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(rule_id, error_details): up to `sample` failing rows of each rule as a JSON array.

    The rows are those with the least hashes, so a second run takes the same ones, however the table is laid out; every task keeps its
    own least rows and the least of all are taken from them. `keys` names the columns of a table that are hashed, else all are. All
    row rules of a table are sampled in one scan. A rule without failing rows has no row.
    """
    rules, keys = select_rules(rules), keys or {}
    by_table: dict[str, list[Rule]] = {}
    for rule in rules:
        by_table.setdefault(rule.table if rule.rule_type in ROW_TYPES else f"{rule.table} {rule.rule_id}", []).append(rule)
    parts = []
    for some in by_table.values():
        name = some[0].table
        if some[0].rule_type in ROW_TYPES:
            df, ids = tables[name], F.array_compact(F.array(*[F.when(bad_row(r), F.lit(r.rule_id)) for r in some]))
        else:
            df, ids = failing_rows(tables, some[0]), F.array(F.lit(some[0].rule_id))
        columns = [F.col(f"`{c}`") for c in df.columns]
        hashed = F.md5(F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in keys.get(name, df.columns)]))
        found = df.select(F.explode(ids).alias("rule_id"), hashed.alias("hash"), F.struct(*columns).alias("row"))
        least = Window.partitionBy("rule_id").orderBy("hash", F.to_json("row"))
        kept = found.withColumn("place", F.row_number().over(least)).filter(F.col("place") <= sample)
        rows = F.transform(F.array_sort(F.collect_list(F.struct("place", "row"))), lambda r: r["row"])
        parts.append(kept.groupBy("rule_id").agg(F.to_json(rows).alias("error_details")))
    return reduce(DataFrame.unionByName, parts)


def check_with_samples(tables: Mapping[str, DataFrame], rules: Sequence[Rule], check_date: date,
                       sample: int = 100) -> DataFrame:
    """Results with error_details.  The counts (one row per rule) are read once, and only failing rules are sampled."""
    rules = select_rules(rules)
    result = check(tables, rules, check_date)
    counted = [row.asDict() for row in result.collect()]
    result = typed_rows(result.sparkSession, counted, result.schema)
    failing = {row["rule_id"] for row in counted if row["failed_rows"] > 0}
    bad = [r for r in rules if r.rule_id in failing]
    if not bad or sample <= 0:
        return result.withColumn("error_details", F.lit("[]"))
    samples = error_samples(tables, bad, sample)
    return result.join(samples, "rule_id", "left").select(
        *RESULT_COLUMNS, F.coalesce("error_details", F.lit("[]")).alias("error_details"))


def mark_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """ALLOW strategy: keep every row and add dq_status plus the ids of the broken row-level rules."""
    broken = F.filter(
        F.array(*[F.when(bad_row(r), F.lit(r.rule_id)) for r in rules]), lambda x: x.isNotNull())
    return df.withColumn("dq_failed", F.array_join(broken, ",")).withColumn(
        "dq_status", F.when(F.col("dq_failed") == "", "PASS").otherwise("REJECT"))


def status_summary(results: DataFrame) -> DataFrame:
    """Rules checked, passed, warned and failed per check date."""
    status = F.col("check_status")
    return results.groupBy("check_date").agg(
        F.count(F.lit(1)).alias("total_rules"), F.count_if(status == "PASSED").alias("passed"),
        F.count_if(status == "WARNING").alias("warnings"), F.count_if(status == "FAILED").alias("failed"))


def status_trend(results: DataFrame) -> DataFrame:
    """History per day, newest first."""
    status = F.col("check_status")
    return results.groupBy("check_date").agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if(status == "PASSED").alias("passed"),
        F.count_if(status == "FAILED").alias("failed")).orderBy(F.col("check_date").desc())


def rule_report(results: DataFrame, rules: DataFrame) -> DataFrame:
    """Results joined to the rule table, by status and then by percentage, highest first."""
    return results.join(rules.select("rule_id", "description"), "rule_id").orderBy(
        "check_status", F.col("failed_percentage").desc())


def hit_ratios(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Per named condition, how many rows meet it and their percentage (0 for an empty table)."""
    names = list(conditions)
    one = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 *[F.count_if(conditions[n]).alias(f"f{i}") for i, n in enumerate(names)])
    rows = _metric_rows(one, [Rule(n, "CUSTOM", "") for n in names])
    return rows.select(F.col("rule_id").alias("rule_name"), "total_rows", F.col("failed_rows").alias("failed_count"),
                       failed_percentage(F.col("failed_rows"), F.col("total_rows")).alias("failed_percentage"))


class QualityError(Exception):
    """Raised when the strategy says that bad rows must not be published."""


def enforce(results: Sequence[Mapping[str, Any]], rules: Sequence[Rule], strategy: str) -> list[str]:
    """Apply REJECT / LOG / ALLOW / REJECT_AFTER_LOG to checked results; returns the ids that failed.

    A rule whose own error_action is REJECT rejects under every strategy but ALLOW.
    """
    by_id = {r.rule_id: r for r in rules}
    failing = [r for r in results if r["failed_rows"] > 0]
    over = [r for r in failing if float(r["failed_percentage"]) > by_id[r["rule_id"]].threshold]
    strategy = strategy.upper()
    if strategy == "REJECT":
        rejected = failing
    elif strategy == "REJECT_AFTER_LOG":
        rejected = over
    elif strategy == "LOG":
        rejected = [r for r in failing if by_id[r["rule_id"]].error_action.upper() == "REJECT"]
    elif strategy == "ALLOW":
        rejected = []
    else:
        raise ValueError(f"unknown exception strategy {strategy!r}")
    if rejected:
        raise QualityError("rejected by " + ", ".join(sorted(r["rule_id"] for r in rejected)))
    return [r["rule_id"] for r in failing]


def with_threshold(rules: Iterable[Rule], threshold: float) -> list[Rule]:
    return [replace(r, threshold=threshold) for r in rules]


RULE_TABLE = "rule_id string, rule_name string, schema_name string, table_name string, column_name string, rule_type string, " \
             "rule_config map<string, string>, threshold double, error_action string, is_active boolean, description string"


def rules_from_table(rules: DataFrame) -> list[Rule]:
    """Rules kept as rows (RULE_TABLE); their number is that of the checks somebody wrote, not of the data."""
    found = []
    for r in rules.orderBy("rule_id").collect():
        config = dict(r["rule_config"] or {})
        if "values" in config:
            config["values"] = config["values"].split("|")
        for name in ("nulls_fail", "empty_fails", "valid_only"):
            if name in config:
                config[name] = config[name].lower() == "true"
        found.append(Rule(r["rule_id"], r["rule_type"].upper(), r["table_name"], r["column_name"], config,
                          DEFAULT_THRESHOLD if r["threshold"] is None else r["threshold"], r["rule_name"] or "",
                          schema=r["schema_name"] or "", active=r["is_active"] is not False, error_action=r["error_action"] or "LOG"))
    return found


def store_results(results: DataFrame, path: str) -> None:
    """Keeps one check date's results below a folder, partitioned by date; checking a date again replaces its results."""
    (results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("check_date").parquet(path))


def stored_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All results kept below a folder, for `status_trend` and `rule_report`."""
    return spark.read.schema(schema).parquet(path)
