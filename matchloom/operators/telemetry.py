"""Request log to per-lane statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom import values as V
from matchloom.operators import ordered, select


def _at_fraction(samples: Column, fraction: float) -> Column:
    """Value at index floor((n - 1) * fraction) of the sorted samples."""
    index = F.floor((F.size(samples) - 1) * F.lit(fraction)).cast("int")
    return F.round(F.get(F.array_sort(samples), index), 2)


def lane_statistics(log: DataFrame, lane: str = "lane", seq: str = "seq", samples: int = V.TELEMETRY_SAMPLES) -> DataFrame:
    """Counters over the whole log; latencies over each lane's latest samples."""
    def n(outcome: str) -> Column:
        return F.count_if(F.col("outcome") == outcome).alias(outcome)

    counters = log.groupBy(lane).agg(
        F.count(F.lit(1)).alias("requests"), n("success"), n("challenge"), n("rate_limited"),
        n("error"), n("not_found"),
        F.count_if(F.col("parsed")).alias("parsed_pages"),
        F.count_if(F.col("cache_hit")).alias("cache_hits"),
        F.count_if(F.col("missing_candidates") > 0).alias("missing_pages"),
        F.sum("missing_candidates").cast("bigint").alias("missing_candidates"),
    )
    latest = select.top_per_group(
        log.filter(F.col("latency_s").isNotNull()).select(lane, seq, "latency_s"),
        [lane], [F.col(seq).desc()], samples,
    )
    # At most ``samples`` values per lane are gathered.
    latencies = latest.groupBy(lane).agg(
        F.collect_list(F.greatest(F.lit(0.0), F.col("latency_s")) * 1000).alias("_l"))
    measured = latencies.select(
        lane,
        F.round(F.aggregate(F.array_sort("_l"), F.lit(0.0), lambda a, x: a + x) / F.size("_l"), 2).alias("latency_avg_ms"),
        _at_fraction(F.col("_l"), 0.50).alias("latency_p50_ms"),
        _at_fraction(F.col("_l"), 0.95).alias("latency_p95_ms"),
    )
    return counters.join(measured, lane, "left")


def latency_average(log: DataFrame, lane: str = "lane", seq: str = "seq", alpha: float = V.LATENCY_EMA_ALPHA, span: int = ordered.SPAN) -> DataFrame:
    """Exponential moving average per lane, seeded by the first sample that is not zero.

    Folding a lane's whole history in one task would not scale. A piece of consecutive
    samples acts on the average as ``decay * average + gain``; pieces are reduced to
    these two numbers by windows of bounded size, and the few pieces of a lane combine
    by the same rule. Negative samples do not occur.
    """
    log = log.filter(F.col("latency_s").isNotNull())
    seeds = log.groupBy(lane).agg(F.min(F.when(F.col("latency_s") != 0, F.col(seq))).alias("_seed"))
    started = log.join(seeds, lane).filter(F.col("_seed").isNull() | (F.col(seq) >= F.col("_seed")))
    pieces = ordered.with_piece(started, [lane], seq, span)
    backwards = Window.partitionBy(lane, ordered.PIECE).orderBy(F.col(seq).desc())
    # Weight of a sample within its piece; the seed itself enters undamped.
    steps = pieces.withColumn("_later", F.row_number().over(backwards) - 1)
    keep = F.lit(1.0 - alpha)
    is_seed = F.col(seq) == F.col("_seed")
    gain = F.when(is_seed, F.lit(1.0)).otherwise(F.lit(alpha)) * F.col("latency_s") * F.pow(keep, F.col("_later"))
    reduced = steps.groupBy(lane, ordered.PIECE).agg(
        F.sum(gain).alias("_gain"), F.count(F.lit(1)).alias("_n"))
    rest = Window.partitionBy(lane).orderBy(F.col(ordered.PIECE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    weighted = reduced.withColumn("_after", F.coalesce(F.sum("_n").over(rest), F.lit(0)))
    return weighted.groupBy(lane).agg(
        F.sum(F.col("_gain") * F.pow(keep, F.col("_after"))).alias("latency_ema"),
    )


def throughput(accepted: DataFrame, at: str, width: str) -> DataFrame:
    """Accepted rows per tumbling interval, with the rate per second."""
    w = F.window(at, width)
    return accepted.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("accepted")).select(
        F.unix_timestamp("w.start").alias("start_s"), "accepted",
        (F.col("accepted") / (F.unix_timestamp("w.end") - F.unix_timestamp("w.start"))).alias("per_second"),
    )
