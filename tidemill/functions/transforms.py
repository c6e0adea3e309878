"""The named attribute transforms a mapping sheet may ask for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def _joined(*parts: Column) -> Column:
    return F.concat(*parts)


# Fixed names of the transform vocabulary.  "Lookup" is a join (operators.lookup) and has no entry.
TRANSFORMS: dict[str, Callable[..., Column]] = {
    "Direct Map": lambda c: c,
    "UpperCase": lambda c: F.upper(c),
    "LowerCase": lambda c: F.lower(c),
    "Trim": lambda c: F.trim(c),
    "Substring": lambda c, start, length: F.substring(c, start, length),
    "Date Format": lambda c, pattern: F.date_format(c, pattern),
    "Calculate": lambda text: F.expr(text),
    "Concat": _joined,
    "Split": lambda c, sep, part: F.split_part(c, F.lit(sep), F.lit(part)),
    "Custom": lambda text: F.expr(text),
}


def transform(rule: str, *args) -> Column:
    """Apply one named transform: transform("Split", F.col("name"), "#", 2)."""
    if rule not in TRANSFORMS:
        raise ValueError(f"unknown transform {rule!r}; known: {', '.join(TRANSFORMS)}")
    return TRANSFORMS[rule](*args)
