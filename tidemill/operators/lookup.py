"""Dimension lookups with defaults.

No side is forced to be broadcast.  Catalyst broadcasts a dimension whose size it
knows to be under spark.sql.autoBroadcastJoinThreshold, AQE does so for one that
turns out that small, and a larger one is joined by shuffle, where AQE splits the
hot partitions of the fact side (the left side of a LEFT join may be split).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def valid_rows(dim: DataFrame, flag: str = "is_valid", value: str = "Y") -> DataFrame:
    """Filter the dimension before the join: the validity test belongs to the ON clause."""
    return dim.filter(F.col(flag) == value)


def lookup(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, tuple[str, object]]) -> DataFrame:
    """LEFT join `dim` and add columns: take = {output: (dimension column, default)}.

    `on` maps fact columns to dimension columns.  A default of None keeps NULL.
    """
    keys = {d: f"__k_{d}" for d in on.values()}
    vals = {out: f"__v_{out}" for out in take}
    right = dim.select(
        *[F.col(d).alias(k) for d, k in keys.items()],
        *[F.col(take[out][0]).alias(v) for out, v in vals.items()],
    )
    condition = None
    for fact_col, dim_col in on.items():
        test = F.col(fact_col) == F.col(keys[dim_col])
        condition = test if condition is None else condition & test
    joined = fact.join(right, condition, "left")
    kept = [c for c in fact.columns if c not in take]
    added = [
        (F.col(v) if take[out][1] is None else F.coalesce(F.col(v), F.lit(take[out][1]))).alias(out)
        for out, v in vals.items()
    ]
    return joined.select(*kept, *added)


def dimension_names(dim: DataFrame, keys: list[str], names: Mapping[str, object]) -> DataFrame:
    """One row per key and (defaulted) names, with the number of dimension rows behind it.

    Looking names up after the fact was aggregated gives the same rows as joining
    first and grouping by the names, if sums and counts are multiplied by
    `name_copies`.  The join then handles one row per group instead of one per fact row.
    """
    labels = [F.coalesce(F.col(n), F.lit(default)).alias(n) for n, default in names.items()]
    return dim.groupBy(*keys, *labels).agg(F.count(F.lit(1)).alias("name_copies"))
