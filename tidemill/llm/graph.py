"""Connected components as alternating star contractions; only edges of the graph are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import remove, store


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u > v)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(small, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(small.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): each node that has an edge with the least node it can reach.

    Large-star and small-star steps alternate until the edges no longer change; that takes about log(n) rounds,
    also for long chains and hubs. Each round is a written table in the shared folder, the one before is deleted.
    Self-loops, repeated edges and edges with a null end are ignored; no edges give no rows.
    """
    spark = edges.sparkSession
    a, b = F.col(left), F.col(right)
    # A node that only has edges to larger nodes is the root of a star; larger ends point to smaller ones.
    now, path = store(edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    def mark(df):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    seen = mark(now)
    while seen[0]:
        then, old = now, path
        now, path = store(_stars(then), "edges")
        remove(spark, old)
        last, seen = seen, mark(now)
        if seen == last:
            break
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
