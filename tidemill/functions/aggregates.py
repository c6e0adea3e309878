"""Conditional and text aggregates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def count_when(condition: Column) -> Column:
    return F.count_if(condition)


def sum_when(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, F.col(value) if isinstance(value, str) else value))


def distinct_text(column: Column | str, sep: str = ", ", where: Column | None = None) -> Column:
    """Sorted distinct values joined to one text; meant for columns of few distinct values.

    The partial aggregate keeps one copy of each value per task, so a hot group costs
    its distinct values and not its rows.
    """
    c = F.col(column) if isinstance(column, str) else column
    kept = c if where is None else F.when(where, c)
    values = F.array_sort(F.collect_set(kept))
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def rows_json(*columns: Column | str) -> Column:
    """JSON array of rows; apply it after `limit`, so what is gathered is bounded."""
    return F.to_json(F.collect_list(F.struct(*columns)))
