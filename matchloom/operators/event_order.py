"""Order checks over event rows: contiguity, tick order, same-tick commands.

For nested documents the gate does this in the row; these are the forms for event
tables, where one battle may have any number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.operators import ordered


def marker_contiguity(events: DataFrame, key: str, index: str) -> DataFrame:
    """Per battle: are indexes unique, and are they 0..n-1? Counts combine on the map side."""
    per_index = events.groupBy(key, index).agg(F.count(F.lit(1)).alias("_n"))
    return per_index.groupBy(key).agg(
        F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_distinct"),
        F.min(index).alias("low"), F.max(index).alias("high"),
    ).withColumns({
        "duplicate": F.col("n_distinct") < F.col("n"),
        "contiguous": (F.col("n_distinct") == F.col("n")) & (F.col("low") == 0) & (F.col("high") == F.col("n") - 1),
    })


def tick_order(events: DataFrame, keys: list[str], seq: str, tick: str, span: int = ordered.SPAN) -> DataFrame:
    """Per battle: how often the tick falls along the marker order."""
    stepped = ordered.lagged(events, keys, seq, {"_before": tick}, span)
    return stepped.groupBy(*keys).agg(
        F.count_if(F.col(tick) < F.col("_before")).alias("falls"),
        F.count(F.lit(1)).alias("n"),
    ).withColumn("in_order", F.col("falls") == 0)


def same_tick(events: DataFrame, keys: list[str]) -> DataFrame:
    """Sides that issue several commands at one tick (``keys`` names battle, side, tick)."""
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("commands")).filter(F.col("commands") > 1)


def side_counts(events: DataFrame, key: str, side: str) -> DataFrame:
    return events.groupBy(key, side).agg(F.count(F.lit(1)).alias("events"))


def card_counts(events: DataFrame, key: str, side: str, card: str) -> DataFrame:
    return events.groupBy(key, side, card).agg(F.count(F.lit(1)).alias("plays"))
