"""Union of rows from several sources whose columns differ in order, number and type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}  # digits


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """The type that holds the values of all: wider numbers before text, text last."""
    found = [k for k in dict.fromkeys(kinds) if not isinstance(k, T.NullType)]
    if len(found) <= 1:
        return found[0] if found else T.StringType()
    if all(type(k) in _WHOLE for k in found):
        return max(found, key=lambda k: _WHOLE[type(k)])
    if all(type(k) in _WHOLE or isinstance(k, T.DecimalType) for k in found):
        digits = max(_WHOLE.get(type(k)) or k.precision - k.scale for k in found)
        scale = max(0 if type(k) in _WHOLE else k.scale for k in found)
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else T.StringType()
    if all(isinstance(k, T.NumericType) for k in found):
        return T.DoubleType()
    if all(isinstance(k, (T.DateType, T.TimestampNTZType)) for k in found):
        return T.TimestampNTZType()
    return T.StringType()


def union_branches(branches: Mapping[str, DataFrame], label: str | None = None) -> DataFrame:
    """All rows of the branches, columns aligned by name in the order in which they first occur.

    A column that a branch lacks is NULL there; types widen by `common_type`. `label` adds a column with the branch's name.
    """
    if not branches:
        raise ValueError("a union needs a branch")
    names = list(dict.fromkeys(c for df in branches.values() for c in df.columns))
    kinds = {n: common_type([df.schema[n].dataType for df in branches.values() if n in df.columns]) for n in names}
    parts = []
    for branch, df in branches.items():
        columns = [(F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in names]
        parts.append(df.select(*columns, *([F.lit(branch).alias(label)] if label else [])))
    return reduce(DataFrame.union, parts)
