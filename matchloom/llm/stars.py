"""Connected components by alternating large and small stars.

Each round makes every node point at the smallest node it knows of; a group of n nodes needs
O(log n) rounds or so, whatever its shape. Every step is a grouped minimum (combined before the
shuffle) and an equi-join (hot nodes are split by adaptive execution). Rounds are cut by written
tables, so a lost executor repeats one round at most. Nothing is collected but three numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.session import materialize


def _large(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(e: DataFrame):
    return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 30)))).first()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its group) for every node of ``edges`` (u, v)."""
    e = materialize(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(e)
    while before[0]:
        e = materialize(_small(_large(e)), "stars")
        after = _state(e)
        if tuple(after) == tuple(before):
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
