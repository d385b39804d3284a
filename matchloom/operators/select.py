"""First and latest rows per key, bounded tops, and split sets.

All of these combine on the map side before any shuffle, so a key that holds a
third of the rows costs each map task one row (or ``n`` rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def _picked(df: DataFrame, keys: list[str], order: Column, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    return (
        df.groupBy(*keys).agg(pick(row, order).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
        .select(*df.columns)
    )


def first_by(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """First row per key in the given total order."""
    return _picked(df, keys, F.struct(*order), F.min_by)


def latest_by(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Last row per key in the given total order."""
    return _picked(df, keys, F.struct(*order), F.max_by)


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, out: str = "pos", salts: int = SALTS) -> DataFrame:
    """First ``n`` rows per group, exact: a top per salt, then the top of those tops.

    ``order`` must be total. No task sees more than its salt's share of a hot group,
    and the second step sees at most ``n * salts`` rows per group.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(*order)
    return (
        salted.withColumn("_inner", F.row_number().over(inner)).filter(F.col("_inner") <= n)
        .withColumn(out, F.row_number().over(outer)).filter(F.col(out) <= n)
        .drop("_salt", "_inner")
    )


def limited(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows in a total order (planned as a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def keep_absent(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not known. AQE broadcasts ``known`` only when it is small."""
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def keep_present(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(known.select(*keys).distinct(), keys, "left_semi")


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Incoming rows with new keys, the first arrival of each."""
    return keep_absent(first_by(incoming, keys, *order), existing, keys)
