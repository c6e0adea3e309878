"""Hash joins of two large sides when a few keys hold many rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

_JOINS = ("inner", "left")


def hash_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", most: int = 1_000_000) -> DataFrame:
    """`left` joined with `right` on columns both have, by a hash table of the right side that holds about `most` rows of a key at most.

    A hash table per partition cannot spill, so a key with more rows on the right is cut: its rows are dealt out over as many salts
    as it takes, and the left rows of the key are repeated once for each.  All other keys have one salt.  The heavy keys come out of a
    count per key; there are at most rows / `most` of them.  Rows that are equal in all columns stay together.  NULL keys match nothing; a
    LEFT join keeps their rows.
    """
    if how not in _JOINS:
        raise ValueError(f"join type {how!r} is none of {', '.join(_JOINS)}")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    heavy = (right.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most)
             .select(*keys, F.ceil(F.col("__n") / most).cast("int").alias("__salts")))
    others = [c for c in right.columns if c not in keys]
    salts = F.coalesce("__salts", F.lit(1))
    # by content alone: a task that runs again deals its rows out as before
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in right.columns]), salts).cast("int")
    build = right.filter(known).join(heavy, list(keys), "left").withColumn("__salt", dealt).drop("__salts")
    build = build.select(*keys, *others, "__salt", F.lit(True).alias("__found"))
    probe = left.join(heavy, list(keys), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    joined = probe.join(build.hint("shuffle_hash"), [*keys, "__salt"], how)
    if how == "left":
        # a heavy key has partners under other salts
        joined = joined.filter(F.col("__found").isNotNull() | F.col("__salts").isNull())
    return joined.select(*left.columns, *others)
