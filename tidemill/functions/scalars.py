"""Column helpers built on pyspark.sql.functions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, functions as F

# Thresholds and labels of the amount bands.
VALUE_BANDS = [(1_000_000, "HIGH"), (100_000, "MEDIUM")]
LOWEST_BAND = "LOW"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stamp(value: datetime) -> Column:
    """Zone-less timestamp literal.

    Built from text: a Python datetime would pass through the driver's local zone and could
    arrive shifted in a session of another zone.
    """
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def surrogate_key(*parts: Column | str, sep: str = "_") -> Column:
    """MD5 of the parts joined by `sep`; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(_col(part).cast("string"))
    return F.md5(F.concat(*pieces))


def at_or_default(column: Column | str, default: object) -> Column:
    return F.coalesce(_col(column), F.lit(default))


def ratio(numerator: Column, denominator: Column, on_zero: object = 0) -> Column:
    """numerator / denominator where the denominator is positive, else `on_zero` (0 or None)."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(on_zero))


def percent(part: Column, whole: Column, on_zero: object = 0) -> Column:
    return ratio(part * F.lit(100.0).cast("decimal(4,1)"), whole, on_zero)


def band(amount: Column | str, bands: Sequence[tuple[object, str]] = VALUE_BANDS, lowest: str = LOWEST_BAND) -> Column:
    """First band whose threshold the amount reaches; NULL falls to the lowest band."""
    chain = None
    for threshold, label in bands:
        hit = _col(amount) >= F.lit(threshold)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return F.lit(lowest) if chain is None else chain.otherwise(lowest)


def day_window(column: Column | str, day: date) -> Column:
    """Half-open day [day, day + 1); both bounds are literals, so they reach the Parquet scan."""
    c = _col(column)
    start = F.lit(day).cast("timestamp_ntz")
    return (c >= start) & (c < start + F.expr("INTERVAL '1' DAY"))


def differs(a: Column, b: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)


def off_by_more_than(actual: Column, expected: Column, tolerance: object = "0.01") -> Column:
    return F.abs(actual - expected) > F.lit(tolerance).cast("decimal(18,2)")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def stamp_text(column: Column | str) -> Column:
    return F.date_format(_col(column), "yyyy-MM-dd HH:mm:ss")


def json_field(column: Column | str, *path: str) -> Column:
    return F.get_json_object(_col(column), "$." + ".".join(path))


def row_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def pretty_json(column: Column) -> Column:
    return F.to_json(column, {"pretty": "true"})
