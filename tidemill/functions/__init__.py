from .aggregates import count_when, distinct_text, rows_json, sum_when
from .scalars import (
    at_or_default, band, day_window, differs, json_field, off_by_more_than, percent, pretty_json, ratio,
    row_json, seconds_between, stamp, stamp_text, surrogate_key,
)
from .transforms import TRANSFORMS, transform

__all__ = [
    "TRANSFORMS", "at_or_default", "band", "count_when", "day_window", "differs", "distinct_text", "json_field",
    "off_by_more_than", "percent", "pretty_json", "ratio", "row_json", "rows_json", "seconds_between", "stamp",
    "stamp_text", "sum_when", "surrogate_key", "transform",
]
