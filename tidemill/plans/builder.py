"""Run a mapping: plain DataFrame calls from sources to the conformed target rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping as MappingType
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import stamp
from ..operators import conform, fold_conditions
from ..operators.unions import union_branches
from .aggregation import Reduction, conjuncts, plan
from .mapping import Field, Mapping

JOIN_TYPES = {"INNER": "inner", "LEFT": "left", "RIGHT": "right", "FULL": "full", "CROSS": "cross"}

Sources = MappingType[str, DataFrame] | Callable[[str], DataFrame]


def _sql(text: str, batch_date: date | None) -> str:
    """Fill ${BATCH_DATE} and spell the TEXT type Spark's way."""
    if batch_date is not None:
        text = text.replace("${BATCH_DATE}", f"{batch_date:%Y-%m-%d}")
    return re.sub(r"::\s*TEXT\b", "::STRING", text, flags=re.IGNORECASE)


def _source(sources: Sources, name: str) -> DataFrame:
    if callable(sources):
        return sources(name)
    short = name.split(".")[-1]
    return sources[name] if name in sources else sources[short]


def _system_value(name: str, batch_date: date | None, load_ts: datetime | None) -> Column:
    if name.upper().startswith(("CURRENT_TIMESTAMP", "SYSDATE", "NOW")):
        return stamp(load_ts or datetime.now())
    if "BATCH_DATE" in name.upper():
        return F.lit(batch_date)
    return F.expr(name)


def one_row(df: DataFrame) -> bool:
    """Whether the plan yields one row whatever the data: columns computed from an aggregate without groups."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "SubqueryAlias"):
        plan = plan.child()
    return plan.nodeName() == "OneRowRelation" or plan.nodeName() == "Aggregate" and plan.groupingExpressions().isEmpty()


def sql_expression(text: str, batch_date: date | None = None) -> Column:
    return F.expr(_sql(text, batch_date))


def reads_only(text: str, alias: str, mapping: Mapping, names: list[str]) -> bool:
    """Whether an expression reads the columns of one source and no other source or target field."""
    others = [s.alias for s in mapping.sources if s.alias != alias]
    return _reads_sources(text, [alias]) and not _reads_sources(text, others) and not _mentions(text, names)


def increment(mapping: Mapping, sources: Sources, batch_date: date | None, *, full: bool = False) -> DataFrame:
    """The PRIMARY source under its alias, narrowed to the increment unless all is wanted."""
    primary = next(s for s in mapping.sources if s.role == "PRIMARY")
    df = _source(sources, primary.name)
    condition = mapping.incremental.get("incremental_condition")
    if not full and condition:
        df = df.filter(F.expr(_sql(condition, batch_date)))
    return df.alias(primary.alias)


_EQUAL = re.compile(r"^(\w+)\.\w+\s*=\s*(\w+)\.\w+$")


def _looked_up(mapping: Mapping) -> dict[str, str]:
    """Lookups that need not wait for the joined rows: alias -> the PRIMARY or DETAIL source on whose own rows it can be looked up.

    A LEFT lookup by columns of one source commutes with the joins between; one by columns of a LEFT joined detail may be joined to the
    detail first, as long as an equality fails where the detail is missing.  Names of the PRIMARY source that groups read are looked up
    last, so that they do not travel with the rows.
    """
    if not all(j.how in ("LEFT", "INNER", "CROSS") for j in mapping.joins):
        return {}
    aliases, roles = [s.alias for s in mapping.sources], {s.alias: s.role for s in mapping.sources}
    base = {a: a for a, role in roles.items() if role == "PRIMARY"} | {
        j.alias: j.alias for j in mapping.joins if roles[j.alias] == "DETAIL" and j.how != "CROSS"}
    found = {}
    for join in mapping.joins:
        if roles[join.alias] != "LOOKUP" or join.how != "LEFT":
            continue
        read = {a for a in aliases if a != join.alias and _reads_sources(join.condition, [a])}
        equal = [m for m in map(_EQUAL.match, conjuncts(join.condition)) if m and join.alias in m.groups()]
        if len(read) == 1 and equal and all(set(m.groups()) == read | {join.alias} for m in equal) and (on := base.get(*read)):
            if roles[on] == "PRIMARY" and any(_reads_sources(g, [join.alias]) for g in mapping.group_by):
                continue
            found[join.alias] = base[join.alias] = on
    return found


def joined_sources(mapping: Mapping, sources: Sources, batch_date: date | None = None, *, full: bool = True,
                   hash_hints: bool = False, reductions: MappingType[str, Reduction] | None = None) -> DataFrame:
    """Sources under their aliases, joined by sequence.

    The increment's condition is applied to the PRIMARY source before any join, so it
    reaches that scan.  A LOOKUP source gets no hint: Catalyst and AQE broadcast what is
    small enough.  USE_HASH is followed for detail sources only on request, because a
    hash table per partition cannot spill.  A detail with a reduction is joined as one row per key.

    What depends on the PRIMARY source or on one detail alone is looked up on its rows, before the joins multiply and widen them.
    """
    by_alias = {s.alias: s for s in mapping.sources}
    reductions = reductions or {}
    early = _looked_up(mapping)

    def with_lookups(rows: DataFrame, alias: str) -> DataFrame:
        for join in mapping.joins:
            if early.get(join.alias) == alias:
                rows = rows.join(_source(sources, by_alias[join.alias].name).alias(join.alias), sql_expression(join.condition, batch_date), "left")
        return rows

    df = increment(mapping, sources, None if full else batch_date, full=full)
    df = with_lookups(df, next(s.alias for s in mapping.sources if s.role == "PRIMARY"))
    for join in mapping.joins:
        if join.alias in early:
            continue
        source = by_alias[join.alias]
        right = _source(sources, source.name)
        if join.how == "CROSS":
            if not one_row(right):
                raise ValueError(f"CROSS source {source.name} is not one row by construction")
            df = df.crossJoin(right.alias(join.alias))
            continue
        condition = join.condition
        if join.alias in reductions:
            condition = reductions[join.alias].condition
            right = reductions[join.alias].apply(right, lambda text: sql_expression(text, batch_date))
        right = with_lookups(right.alias(join.alias), join.alias)
        if hash_hints and join.hint == "USE_HASH" and source.role != "LOOKUP":
            right = right.hint("shuffle_hash")
        df = df.join(right, sql_expression(condition, batch_date), JOIN_TYPES[join.how])
    return df


def _reads_sources(text: str, aliases: list[str]) -> bool:
    return any(re.search(rf"\b{re.escape(a)}\.", text) for a in aliases)


def _mentions(text: str, names: list[str]) -> set[str]:
    bare = re.sub(r"'[^']*'", "", text)
    return {n for n in names if re.search(rf"(?<![\w.]){re.escape(n)}\b", bare)}


def _layers(later: list[Field], ready: set[str], names: list[str]) -> list[list[Field]]:
    """Order fields that read other target fields, so that each layer reads finished ones."""
    layers, waiting = [], list(later)
    while waiting:
        layer = [f for f in waiting if _mentions(f.expression, names) - {f.name} <= ready]
        if not layer:
            raise ValueError("fields read each other in a circle: " + ", ".join(f.name for f in waiting))
        layers.append(layer)
        ready = ready | {f.name for f in layer}
        waiting = [f for f in waiting if f not in layer]
    return layers


def _built_union(mapping: Mapping, sources: Sources, batch_date: date | None, *, load_ts: datetime | None, ordered: bool, **how) -> DataFrame:
    """The branches' rows by name, their types widened; fields of the document itself are computed over all of them."""
    rows = union_branches({name: build(part, sources, batch_date, load_ts=load_ts, ordered=False, **how) for name, part in mapping.branches},
                          mapping.label_field)
    names = [f.name for f in mapping.fields]
    # fields that a branch gives are taken as they are
    later = [f for f in mapping.fields if f.name not in rows.columns]
    for layer in _layers(later, set(rows.columns), names):
        rows = rows.select("*", *[(_system_value(f.expression, batch_date, load_ts) if f.kind == "SYSTEM"
                                   else sql_expression(f.expression, batch_date)).alias(f.name) for f in layer])
    rows = conform(rows, mapping.target_schema()) if mapping.fields else rows
    if ordered and mapping.order_by:
        rows = rows.orderBy(*[F.col(e.split(".")[-1]).desc() if d.upper() == "DESC" else F.col(e.split(".")[-1]).asc() for e, d in mapping.order_by])
    return rows


def build(mapping: Mapping, sources: Sources, batch_date: date | None = None, *, full: bool = True,
          load_ts: datetime | None = None, ordered: bool = True, hash_hints: bool = False) -> DataFrame:
    """Target rows of a mapping; of one with branches the rows of all, aligned by name."""
    if mapping.branches:
        return _built_union(mapping, sources, batch_date, full=full, load_ts=load_ts, ordered=ordered, hash_hints=hash_hints)
    aliases = [s.alias for s in mapping.sources]
    names = [f.name for f in mapping.fields]
    def is_first(f: Field) -> bool:
        if f.kind in ("DIRECT", "DIRECT_MAPPING", "LOOKUP", "AGGREGATE"):
            return True
        return f.kind in ("DERIVED", "CASE", "CALCULATE", "WINDOW_FUNCTION") and _reads_sources(f.expression, aliases)

    first = [f for f in mapping.fields if is_first(f)]
    later = [f for f in mapping.fields if not is_first(f)]
    layers = _layers(later, {f.name for f in first}, names)
    columns = [F.expr(_sql(f.expression, batch_date)).alias(f"f_{f.name}") for f in first]
    grouped = bool(mapping.group_by) or any(f.kind == "AGGREGATE" for f in first)
    eager = plan(mapping, [f.expression for f in first]) if grouped else None
    df = joined_sources(mapping, sources, batch_date, full=full, hash_hints=hash_hints, reductions=eager.reductions if eager else None)
    condition = fold_conditions(mapping.where)
    if condition is not None:
        df = df.filter(condition)

    if eager:
        df = eager.rows(df, lambda text: sql_expression(text, batch_date))
        for test in eager.tests:
            df = df.filter(sql_expression(test, batch_date))
        df = df.select(*[sql_expression(text, batch_date).alias(f.name) for f, text in zip(first, eager.texts)])
    elif grouped:
        groups = [F.expr(_sql(g, batch_date)) for g in mapping.group_by]
        tests = [F.expr(_sql(h, batch_date)).alias(f"having_{i}") for i, h in enumerate(mapping.having)]
        df = df.groupBy(*groups).agg(*columns, *tests)
        for i in range(len(tests)):
            df = df.filter(F.col(f"having_{i}"))
        df = df.select(*[F.col(f"f_{f.name}").alias(f.name) for f in first])
    else:
        df = df.select(*columns).select(*[F.col(f"f_{f.name}").alias(f.name) for f in first])

    for layer in layers:
        added = [
            (_system_value(f.expression, batch_date, load_ts) if f.kind == "SYSTEM"
             else F.expr(_sql(f.expression, batch_date))).alias(f.name)
            for f in layer
        ]
        df = df.select("*", *added)

    if not grouped:
        # without groups the condition tests output fields, so a window field can keep its first row
        for test in mapping.having:
            df = df.filter(F.expr(_sql(test, batch_date)))
    df = conform(df, mapping.target_schema())
    if ordered and mapping.order_by:
        keys = []
        for expression, direction in mapping.order_by:
            column = F.col(expression.split(".")[-1])
            keys.append(column.desc() if direction.upper() == "DESC" else column.asc())
        df = df.orderBy(*keys)
    return df
