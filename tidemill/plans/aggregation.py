"""Aggregates of a mapping over joined details, without the rows that the joins multiply.

Eager aggregation: a detail source whose columns are only summed, or serve as keys, is reduced to one row per key with the number of
its rows (copies) and its sums before it is joined.  A sum over the joined rows is then the source's own sum times the copies of the
other details, exactly as if every detail row had been joined.

Distinct counts: COUNT(DISTINCT x) and COUNT(DISTINCT CASE WHEN c THEN x END) of one x share a grouping set; a first aggregate brings each
x of a group down to one row with its flags, a second one counts.  Rows are expanded once per different x, not per measure; only the
copy for the first x carries the measures, and copies are sent to a part of their group, so that the first aggregate needs no shuffle of its
own and the second one sends a few rows per group.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from .mapping import Mapping

_CALL = re.compile(r"\b(SUM|COUNT|MIN|MAX)\s*\(", re.IGNORECASE)
_DISTINCT = re.compile(r"^\s*DISTINCT\s+(?P<arg>.*)$", re.IGNORECASE | re.DOTALL)
_CHOSEN = re.compile(r"^CASE\s+WHEN\s+(?P<test>.*?)\s+THEN\s+(?P<value>[\w.]+)\s+END$", re.IGNORECASE | re.DOTALL)
#: Tasks that may share the rows of one group; the second aggregate sends at most this many rows per group.  Groups that divide the
#: partitions of the target (days) are small and stay whole.
_PARTS = 4
_LITERAL = re.compile(r"'(?:[^'\\]|\\.|'')*'")


@dataclass(frozen=True)
class Call:
    """One aggregate call of an expression."""

    function: str
    argument: str
    distinct: bool = False

    @property
    def chosen(self) -> tuple[str, str | None]:
        """(what is counted, under which condition) of a distinct count."""
        found = _CHOSEN.match(self.argument)
        if found and " when " not in f" {found['test'].lower()} ":
            return found["value"], found["test"]
        return self.argument, None


def _closing(text: str, start: int) -> int:
    """Place of the bracket that closes the one before `start`; brackets in literals do not count."""
    plain = _LITERAL.sub(lambda m: " " * len(m[0]), text)
    depth = 1
    for at in range(start, len(plain)):
        depth += {"(": 1, ")": -1}.get(plain[at], 0)
        if not depth:
            return at
    raise ValueError(f"unbalanced brackets in {text!r}")


@dataclass
class Aggregates:
    """The aggregate calls of some expressions, which read `agg_N` in their place and `grp_N` for a group."""

    groups: list[str]
    calls: list[Call] = field(default_factory=list)

    def rewrite(self, text: str) -> str:
        out, at = "", 0
        while found := _CALL.search(text, at):
            end = _closing(text, found.end())
            inner = text[found.end():end].strip()
            distinct = _DISTINCT.match(inner)
            call = Call(found[1].upper(), " ".join((distinct["arg"] if distinct else inner).split()), bool(distinct))
            if call not in self.calls:
                self.calls.append(call)
            out += text[at:found.start()] + f"agg_{self.calls.index(call)}"
            at = end + 1
        out += text[at:]
        for n, group in enumerate(self.groups):
            out = re.sub(rf"(?<![\w.]){re.escape(group)}(?![\w.(])", f"grp_{n}", out)
        return out


def columns_of(text: str, alias: str) -> set[str]:
    return set(re.findall(rf"(?<![\w.]){re.escape(alias)}\.(\w+)", _LITERAL.sub("''", text)))


def _aliases_in(text: str, aliases: list[str]) -> set[str]:
    return {a for a in aliases if columns_of(text, a)}


@dataclass(frozen=True)
class Reduction:
    """How a detail is brought down to its keys before its join."""

    alias: str
    filters: tuple[str, ...]
    condition: str
    keys: tuple[str, ...]
    sums: tuple[str, ...]

    def apply(self, df: DataFrame, sql: Callable[[str], Column]) -> DataFrame:
        rows = df.alias(self.alias)
        for test in self.filters:
            rows = rows.filter(sql(test))
        return rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("copies_"), *[F.sum(sql(s)).alias(f"sum_{n}_") for n, s in enumerate(self.sums)])


@dataclass
class Plan:
    """What `build` does instead of joining raw details and expanding rows per distinct count."""

    aggregates: Aggregates
    texts: list[str]
    tests: list[str]
    reductions: dict[str, Reduction]
    parts: int = _PARTS

    def rows(self, df: DataFrame, sql: Callable[[str], Column]) -> DataFrame:
        """The aggregated rows: grp_N and agg_N."""
        calls = self.aggregates.calls
        copies = {a: F.coalesce(F.col(f"{a}.copies_"), F.lit(1)).cast("decimal(18,0)") for a in self.reductions}

        def times(value: Column, without: str | None = None) -> Column:
            for alias, count in copies.items():
                if alias != without:
                    value = value * count
            return value

        def summed(call: Call) -> Column:
            if call.function == "COUNT":
                # bigint as long as nothing multiplies
                one = times(F.lit(1).cast("decimal(18,0)")) if copies else F.lit(1)
                return one if call.argument == "*" else F.when(sql(call.argument).isNotNull(), one)
            for alias, r in self.reductions.items():
                if call.argument in r.sums:
                    return times(F.col(f"{alias}.sum_{r.sums.index(call.argument)}_"), alias)
            return times(sql(call.argument))

        plain = [(n, c) for n, c in enumerate(calls) if not c.distinct]
        counted = [(n, *c.chosen) for n, c in enumerate(calls) if c.distinct]
        bases = list(dict.fromkeys(base for _, base, _ in counted))
        flat = df.select(
            *[sql(g).alias(f"grp_{n}") for n, g in enumerate(self.aggregates.groups)], *[sql(b).alias(f"base_{n}") for n, b in enumerate(bases)],
            *[F.coalesce(sql(test), F.lit(False)).alias(f"flag_{n}") for n, _, test in counted if test],
            *[(summed(c) if c.function in ("SUM", "COUNT") else sql(c.argument)).alias(f"val_{n}") for n, c in plain])
        by = [f"grp_{n}" for n in range(len(self.aggregates.groups))]
        merge = {"SUM": F.sum, "COUNT": F.sum, "MIN": F.min, "MAX": F.max}

        def final(n: int, call: Call, value: Column) -> Column:
            out = merge[call.function](value)
            return (F.coalesce(out, F.lit(0)).cast("bigint") if call.function == "COUNT" else out).alias(f"agg_{n}")

        if not bases:
            return flat.groupBy(*by).agg(*[final(n, c, F.col(f"val_{n}")) for n, c in plain])
        flags = [F.max(f"flag_{n}").alias(f"flag_{n}") for n, _, test in counted if test]
        values = [merge[c.function](f"val_{n}").alias(f"val_{n}") for n, c in plain]
        names = [f"base_{n}" for n in range(len(bases))]
        if len(bases) == 1:
            each = flat.groupBy(*by, *names).agg(F.lit(0).alias("set"), *flags, *values)
        elif not by:
            # the set of a row: the one base that is not grouped away
            which = F.coalesce(*[F.when(F.grouping(name) == 0, F.lit(n)) for n, name in enumerate(names)]).alias("set")
            each = flat.groupingSets([[name] for name in names], *names).agg(which, *flags, *values)
        else:
            # a copy of a row for each base, with the flags of that base; the first one has the values
            of_base = {name: n for n, name in enumerate(names)} | {f"flag_{n}": bases.index(base) for n, base, test in counted if test}
            rest = [c for c in flat.columns if c not in by]
            copies_of_row = [F.struct(F.lit(n).alias("set"), *[F.when(F.lit(of_base.get(c, 0) == n), F.col(c)).alias(c) for c in rest]).alias(f"copy_{n}")
                             for n in range(len(bases))]
            expanded = flat.select(*by, *copies_of_row).unpivot(by, [f"copy_{n}" for n in range(len(bases))], "name", "copy").select(*by, "copy.*")
            if self.parts > 1:
                expanded = expanded.withColumn("part", F.pmod(F.xxhash64("set", *names), F.lit(self.parts)))
            to = [*by, "part"] if self.parts > 1 else by
            each = expanded.repartition(*to).groupBy(*to, "set", *names).agg(*flags, *values)
        counts = []
        for n, base, test in counted:
            at = bases.index(base)
            here = (F.col("set") == at) & F.col(f"base_{at}").isNotNull()
            counts.append(F.count_if(here & F.col(f"flag_{n}") if test else here).alias(f"agg_{n}"))
        return each.groupBy(*by).agg(*counts, *[final(n, c, F.when(F.col("set") == 0, F.col(f"val_{n}"))) for n, c in plain])


def conjuncts(condition: str) -> list[str]:
    """Parts of a plain chain of ANDs; a condition with anything else in it stays whole."""
    bare = _LITERAL.sub("''", condition)
    if re.search(r"\b(BETWEEN|OR|CASE|NOT)\b|\(", bare, re.IGNORECASE) or "AND" in "".join(_LITERAL.findall(condition)).upper():
        return [condition]
    return [c.strip() for c in re.split(r"\bAND\b", condition, flags=re.IGNORECASE)]


def plan(mapping: Mapping, expressions: list[str]) -> Plan | None:
    """A plan for the aggregates in the expressions and the HAVING tests; None if some of them are beyond it."""
    aliases = [s.alias for s in mapping.sources]
    found = Aggregates(list(mapping.group_by))
    texts, tests = [found.rewrite(t) for t in expressions], [found.rewrite(t) for t in mapping.having]
    if any(_aliases_in(t, aliases) for t in (*texts, *tests)) or any(re.search(r"\b(FILTER|OVER)\s*\(", t, re.IGNORECASE) for t in (*texts, *tests)):
        return None
    if any(_CALL.search(c.argument) for c in found.calls) or any(c.distinct and c.function != "COUNT" for c in found.calls):
        return None
    if any(c.distinct and re.search(r",", _LITERAL.sub("", c.chosen[0])) for c in found.calls):
        return None

    reductions = {}
    if all(j.how in ("LEFT", "INNER", "CROSS") for j in mapping.joins):
        wheres = " ".join(str(v) for w in mapping.where for v in w.values())
        for join in mapping.joins:
            role = next(s.role for s in mapping.sources if s.alias == join.alias)
            if role != "DETAIL" or join.how == "CROSS":
                continue
            own, other = [], []
            for part in conjuncts(join.condition):
                (own if _aliases_in(part, aliases) == {join.alias} else other).append(part)
            sums = [c.argument for c in found.calls if c.function == "SUM" and not c.distinct and _aliases_in(c.argument, aliases) == {join.alias}]
            read = [*other, wheres, *found.groups, *(j.condition or "" for j in mapping.joins if j is not join),
                    *(c.argument for c in found.calls if c.argument not in sums or c.function != "SUM" or c.distinct)]
            keys = sorted(set().union(*(columns_of(t, join.alias) for t in read)))
            if other and keys:
                reductions[join.alias] = Reduction(join.alias, tuple(own), " AND ".join(other), tuple(keys), tuple(dict.fromkeys(sums)))
    if not reductions and sum(c.distinct for c in found.calls) < 2:
        return None
    daily = mapping.partition_key in [g.split(".")[-1] for g in mapping.group_by]
    return Plan(found, texts, tests, reductions, 1 if daily else _PARTS)
