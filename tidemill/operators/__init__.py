from .conform import conform, target_field
from .dedup import latest_batch_total, latest_row
from .lookup import dimension_names, lookup, valid_rows
from .predicates import fold_conditions, single_condition

__all__ = [
    "conform", "dimension_names", "fold_conditions", "latest_batch_total", "latest_row", "lookup",
    "single_condition", "target_field", "valid_rows",
]
