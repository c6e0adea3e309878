from .copying import copy_table, range_copy
from .incremental import WatermarkStore, incremental_load, incremental_window
from .tables import (
    LoadReport, append, create_target, distribute, drop_old_partitions, load, old_partitions, overwrite, partition_day,
    refresh_statistics, replace_day, replace_days, upsert, upsert_state,
)

__all__ = [
    "LoadReport", "WatermarkStore", "append", "copy_table", "create_target", "distribute", "drop_old_partitions", "incremental_load",
    "incremental_window", "load", "old_partitions", "overwrite", "partition_day", "range_copy", "refresh_statistics", "replace_day",
    "replace_days", "upsert", "upsert_state",
]
