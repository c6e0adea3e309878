"""Mapping documents as frozen dataclasses.

A document is {"entity": {...}, "attributes": [...]}: where the rows come from, how they
are joined, filtered and grouped, and how each target field is made.  Attributes may be
structured (expression_type, transformation, *_config) or flat (gen_type, process_logic).
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping as MappingType
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

from ..operators.conform import target_field

DOCUMENTS = Path(__file__).parent / "documents"

STRATEGIES = ("FULL", "INCREMENTAL_INSERT", "INCREMENTAL_MERGE", "INCREMENTAL_UPDATE", "SCD2")
EXPRESSION_TYPES = ("DIRECT", "DIRECT_MAPPING", "LOOKUP", "AGGREGATE", "CASE", "CALCULATE", "DERIVED", "SYSTEM",
                    "CONSTANT", "WINDOW_FUNCTION")


@dataclass(frozen=True)
class Source:
    alias: str
    table: str
    schema: str = ""
    role: str = "PRIMARY"
    source_id: str = ""

    @property
    def name(self) -> str:
        return f"{self.schema}.{self.table}" if self.schema else self.table


@dataclass(frozen=True)
class Join:
    sequence: int
    alias: str
    how: str
    condition: str | None = None
    hint: str | None = None


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    expression: str
    data_type: str = "string"
    required: bool = False
    is_key: bool = False
    config_missing: bool = False


@dataclass(frozen=True)
class Mapping:
    mapping_id: str
    schema: str
    table: str
    strategy: str
    sources: tuple[Source, ...]
    joins: tuple[Join, ...] = ()
    where: tuple[MappingType[str, Any], ...] = ()
    group_by: tuple[str, ...] = ()
    having: tuple[str, ...] = ()
    order_by: tuple[tuple[str, str], ...] = ()
    fields: tuple[Field, ...] = ()
    rules: tuple[MappingType[str, Any], ...] = ()
    upstreams: tuple[str, ...] = ()
    incremental: MappingType[str, Any] = field(default_factory=dict)
    scd: MappingType[str, Any] = field(default_factory=dict)
    partition_key: str | None = None
    distribution_key: tuple[str, ...] = ()
    retention_days: int | None = None
    exception_strategy: str = "LOG"
    error_threshold: float = 5.0
    version: str = ""
    #: (name, document) of each branch of a union mapping, whose own sources and fields are read instead
    branches: tuple[tuple[str, Mapping], ...] = ()
    label_field: str | None = None

    @property
    def target(self) -> str:
        return f"{self.schema}.{self.table}" if self.schema else self.table

    @property
    def keys(self) -> list[str]:
        return [f.name for f in self.fields if f.is_key]

    def target_schema(self) -> T.StructType:
        return T.StructType([
            target_field(f.name, f.data_type, required=f.required, default=_zero(f)) for f in self.fields])


def _zero(f: Field) -> object:
    """A required measure defaults to 0, as target columns declare."""
    return 0 if f.required and f.data_type.startswith(("bigint", "int", "decimal")) else None


def _data_type(kind: str, precision: str) -> str:
    kind = (kind or "VARCHAR").upper()
    plain = {"VARCHAR": "string", "TEXT": "string", "STRING": "string", "BIGINT": "bigint", "INTEGER": "int", "INT": "int",
             "DATE": "date", "TIMESTAMP": "timestamp_ntz", "DATETIME": "timestamp_ntz", "BOOLEAN": "boolean"}
    if kind == "DECIMAL":
        return f"decimal({precision or '18,2'})"
    if kind not in plain:
        raise ValueError(f"unknown target type {kind!r}")
    return plain[kind]


def _in_sequence(rows: list, key: str = "sequence") -> list:
    return sorted(rows or [], key=lambda r: r.get(key, 0))


def _quoted(value: Any) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "\\'") + "'"


def _fill(template: str, parts: list[str]) -> str:
    """{0}, {1}, ... by position and {name} by target field; braces inside a string literal stay."""
    def filled(m: re.Match) -> str:
        name = m["name"]
        return m[0] if name is None else parts[int(name)] if name.isdigit() else name

    return re.sub(r"'(?:[^'\\]|\\.|'')*'|\{(?P<name>\w+)\}", filled, template)


def _references(entry: MappingType[str, Any]) -> list[str]:
    found = []
    for s in entry.get("source_fields") or []:
        alias = s.get("table_alias")
        found.append(f"{alias}.{s['field_name']}" if alias else s["field_name"])
    if not found and entry.get("source_field"):
        alias = entry.get("source_alias")
        found = [f"{alias}.{c.strip()}" if alias else c.strip() for c in entry["source_field"].split(",")]
    return found


def _expression(entry: MappingType[str, Any], kind: str) -> tuple[str, bool]:
    """(SQL expression, whether a config that the kind needs is missing)."""
    refs = _references(entry)
    logic = entry.get("transformation") or {}
    text = logic.get("expression") or entry.get("process_logic") or ""
    text = _fill(text, refs) if text else ""
    flat = "gen_type" in entry
    if kind in ("DIRECT", "DIRECT_MAPPING"):
        return (refs[0] if refs else text), False
    if kind == "LOOKUP":
        default = logic.get("default_value", entry.get("default_value"))
        if not text:
            text = refs[0] if default in (None, "") else f"COALESCE({refs[0]}, {_quoted(default)})"
        return text, not flat and not entry.get("lookup_config")
    if kind == "AGGREGATE":
        config = entry.get("aggregate_config")
        if config:
            distinct = "DISTINCT " if config.get("distinct") else ""
            text = f"{config['function']}({distinct}{_fill(config['source_expression'], refs)})"
            if config.get("filter_condition"):
                text += f" FILTER (WHERE {config['filter_condition']})"
        return text, not flat and not config
    if kind == "CALCULATE":
        config = entry.get("calculation_config") or {}
        if not text and config:
            text = _fill(config["formula_template"], list(config["parameter_fields"]))
            if str(config.get("zero_division_handling", "NULL")).upper() == "ZERO":
                text = f"COALESCE({text}, 0)"
        return text, False
    if kind == "CASE":
        config = entry.get("case_config")
        if config:
            whens = " ".join(f"WHEN {_fill(w['condition'], refs)} THEN {w['result']}" for w in config["when_clauses"])
            text = f"CASE {whens} ELSE {config.get('else_result', 'NULL')} END"
        return text, not flat and not config
    if kind == "SYSTEM":
        return logic.get("system_variable") or text or "CURRENT_TIMESTAMP", False
    if kind == "CONSTANT":
        return _quoted(entry["value"]) if "value" in entry else text, False
    return text, False


def _field(entry: MappingType[str, Any]) -> Field:
    kind = (entry.get("expression_type") or entry.get("gen_type") or "DIRECT").upper()
    if kind not in EXPRESSION_TYPES:
        raise ValueError(f"unknown expression type {kind!r} of field {entry.get('target_field')}")
    text, missing = _expression(entry, kind)
    return Field(entry["target_field"], kind, text,
                 _data_type(entry.get("target_type", ""), entry.get("target_precision", "")),
                 entry.get("nullable", "Y") == "N", entry.get("is_pk", "") == "Y", missing)


def parse_mapping(document: MappingType[str, Any]) -> Mapping:
    """A document. One with `union` has branches in place of sources: each names its own, with conditions and attributes, and a branch_name."""
    e, conditions = document["entity"], document["entity"].get("sql_conditions") or {}
    union = document.get("union") or {}
    branches = tuple((b["branch_name"], parse_mapping({
        "entity": {**{k: v for k, v in e.items() if k not in ("source_tables", "sql_conditions")}, **{k: b[k] for k in ("source_tables", "sql_conditions") if k in b}},
        "attributes": b["attributes"]})) for b in union.get("branches", ()))
    if len({n for n, _ in branches}) != len(branches):
        raise ValueError("branches of a union need names of their own")
    distribution = e.get("distribution_key") or ""
    return Mapping(
        mapping_id=e["mapping_id"], schema=e.get("target_schema", ""), table=e["target_table"],
        strategy=e.get("loading_strategy", "FULL"),
        sources=tuple(Source(s["alias"], s["table_name"], s.get("schema", ""), s.get("table_type", "PRIMARY"),
                             s.get("source_id", "")) for s in (e["source_tables"] if not branches else ())),
        joins=tuple(Join(j["join_sequence"], j["table_alias"], j.get("join_type", "LEFT").upper(), j.get("join_condition"),
                         j.get("join_hint")) for j in _in_sequence(conditions.get("joins"), "join_sequence")),
        where=tuple(_in_sequence(conditions.get("where"))),
        group_by=tuple(g["expression"] for g in _in_sequence(conditions.get("group_by"))),
        having=tuple(h["condition"] for h in _in_sequence(conditions.get("having"))),
        order_by=tuple((o["expression"], o.get("direction", "ASC")) for o in _in_sequence(conditions.get("order_by"))),
        fields=tuple(_field(a) for a in _in_sequence(document["attributes"], "seq")),
        rules=tuple(e.get("validation_rules") or ()), upstreams=tuple(e.get("dependency_tasks") or ()),
        incremental=e.get("incremental_config") or {}, scd=e.get("scd_config") or {}, partition_key=e.get("partition_key"),
        distribution_key=tuple(c.strip() for c in distribution.split(",") if c.strip()),
        retention_days=e.get("partition_retention_days"), exception_strategy=e.get("exception_strategy", "LOG"),
        error_threshold=float(e.get("error_threshold_percent", 5.0)), version=e.get("version", ""),
        branches=branches, label_field=union.get("label_field"))


def load_mapping(name_or_path: str) -> Mapping:
    """Read a document by path, or one of the shipped documents by name."""
    path = Path(name_or_path)
    if not path.exists():
        path = DOCUMENTS / f"{name_or_path}.json"
    return parse_mapping(json.loads(path.read_text(encoding="utf-8")))


REQUIRED_ENTITY = ("mapping_id", "target_schema", "target_table", "data_layer", "business_domain", "responsible_person",
                   "version", "loading_strategy", "dependency_tasks", "distribution_key", "partition_key",
                   "exception_strategy", "sql_conditions")


def document_faults(document: MappingType[str, Any]) -> list[str]:
    """What the review check-list finds wrong with a document."""
    e = document["entity"]
    faults = [f"entity.{k} is missing" for k in REQUIRED_ENTITY if not e.get(k)]
    if len(e.get("target_table", "")) > 40:
        faults.append("target_table is longer than 40 characters")
    if e.get("loading_strategy") not in STRATEGIES:
        faults.append(f"loading_strategy {e.get('loading_strategy')!r} is unknown")
    if e.get("loading_strategy") == "SCD2" and not e.get("scd_config"):
        faults.append("scd_config is missing")
    if e.get("loading_strategy") not in ("FULL", "SCD2") and not e.get("incremental_config"):
        faults.append("incremental_config is missing")
    mapping = parse_mapping(document)
    for f in mapping.fields:
        if f.config_missing:
            faults.append(f"{f.name}: the {f.kind} config is missing")
        if not f.expression:
            faults.append(f"{f.name}: no expression")
    checked = {r.get("field") for r in mapping.rules if r.get("rule_type") == "NOT_NULL"}
    if not mapping.keys or not set(mapping.keys) <= checked:
        faults.append("no NOT_NULL rule on the key")
    known = {s.alias for s in mapping.sources}
    faults += [f"join alias {j.alias} is no source" for j in mapping.joins if j.alias not in known]
    return faults
