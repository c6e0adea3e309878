"""Structured WHERE conditions turned into one Column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, functions as F

_COMPARE = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}


def _value(value: Any, value_type: str | None) -> Column:
    kind = (value_type or "STRING").upper()
    if kind == "DATE":
        return F.lit(value).cast("date")
    if kind == "TIMESTAMP":
        return F.lit(value).cast("timestamp_ntz")
    if kind == "NUMBER":
        return F.expr(str(value))
    if kind == "EXPRESSION":
        return F.expr(value)
    return F.lit(value)


def single_condition(condition: Mapping[str, Any]) -> Column:
    column = F.expr(condition["field"])
    operator = condition["operator"].upper().strip()
    value, kind = condition.get("value"), condition.get("value_type")
    if operator in _COMPARE:
        return _COMPARE[operator](column, _value(value, kind))
    if operator in ("IN", "NOT IN"):
        hit = column.isin(list(value))
        return ~hit if operator == "NOT IN" else hit
    if operator in ("LIKE", "NOT LIKE"):
        hit = column.like(value)
        return ~hit if operator == "NOT LIKE" else hit
    if operator == "IS NULL":
        return column.isNull()
    if operator == "IS NOT NULL":
        return column.isNotNull()
    if operator == "BETWEEN":
        low, high = value
        kind = None if kind == "ARRAY" else kind
        return column.between(_value(low, kind), _value(high, kind))
    if operator == "IS DISTINCT FROM":
        return ~column.eqNullSafe(_value(value, kind))
    if operator == "IS NOT DISTINCT FROM":
        return column.eqNullSafe(_value(value, kind))
    raise ValueError(f"unknown operator {condition['operator']!r}")


def fold_conditions(conditions: Sequence[Mapping[str, Any]]) -> Column | None:
    """AND/OR inside a condition group in sequence order, AND between the groups."""
    groups: dict[Any, Column] = {}
    for condition in sorted(conditions, key=lambda c: c.get("sequence", 0)):
        group = condition.get("condition_group", 1)
        test = single_condition(condition)
        if group not in groups:
            groups[group] = test
        elif (condition.get("logic") or "AND").upper() == "OR":
            groups[group] = groups[group] | test
        else:
            groups[group] = groups[group] & test
    result = None
    for test in groups.values():
        result = test if result is None else result & test
    return result
