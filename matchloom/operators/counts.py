"""Counts over tasks, decisions, metadata and navigation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.operators import select

READY_KINDS = ("detail", "upgrade")
OPEN = ("pending", "inflight")
STALE_SECONDS = 15


def by_kind_and_status(tasks: DataFrame) -> DataFrame:
    """Counts per (kind, status), per status and in all, in one pass."""
    return tasks.groupingSets(
        [[F.col("kind"), F.col("status")], [F.col("status")], []], F.col("kind"), F.col("status")
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def decision_counts(decisions: DataFrame) -> DataFrame:
    """Counts per (status, tier) and per status, for each contract."""
    return decisions.groupingSets(
        [[F.col("contract_sha256"), F.col("status"), F.col("tier")], [F.col("contract_sha256"), F.col("status")]],
        F.col("contract_sha256"), F.col("status"), F.col("tier"),
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def work_state(tasks: DataFrame) -> DataFrame:
    """One row: counts per status, ready backlog, earliest due time."""
    ready = F.col("kind").isin(*READY_KINDS)
    return tasks.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("pending", "inflight", "done", "dead", "skipped")],
        F.count_if(ready & F.col("status").isin(*OPEN)).alias("ready_backlog"),
        F.count_if((F.col("kind") == "detail") & (F.col("status") == "done")).alias("done_details"),
        F.min(F.when(F.col("status") == "pending", F.col("next_retry_at"))).alias("next_retry_at"),
    )


def metadata_completeness(metadata: DataFrame) -> DataFrame:
    return metadata.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("complete")).alias("complete"),
        F.count_if(~F.coalesce(F.col("complete"), F.lit(False))).alias("incomplete"))


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Null-safe rounded quotient, null for an empty denominator."""
    return F.round(F.try_divide(numerator, F.nullif(denominator, F.lit(0))), digits)


def navigation_totals(pages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals over pages, each task counted once, with the derived ratios."""
    once = pages.groupBy(*(by or []), "task_id").agg(
        F.min_by(F.struct("eligible", "new", "cutoff"), F.col("seq")).alias("p"))
    e, n = F.col("p.eligible"), F.col("p.new")
    totals = once.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("pages"), F.sum(e).alias("eligible_candidates"), F.sum(n).alias("new_candidates"),
        F.sum(e - n).alias("duplicate_candidates"), F.count_if(n == 0).alias("zero_new_pages"),
        F.count_if(F.col("p.cutoff")).alias("history_cutoffs"))
    return totals.withColumns({
        "eligible_duplicate_ratio": ratio(F.col("duplicate_candidates"), F.col("eligible_candidates"), 4),
        "new_candidates_per_page": ratio(F.col("new_candidates"), F.col("pages"), 3),
    })


def runtime_state(beats: DataFrame, run: list[str], now: int) -> DataFrame:
    """Each run's latest heartbeat (``seq``, ``phase``, ``updated_at`` in seconds), its age, and its phase. A heartbeat older than
    ``STALE_SECONDS`` does not prove a running process: a phase that claims one is then ``stale_unknown``."""
    latest = select.latest_by(beats.select(*run, "seq", "phase", "updated_at"), run, "seq")
    age = F.greatest(F.lit(0).cast("bigint"), F.lit(now).cast("bigint") - F.col("updated_at"))
    claims = F.col("phase").isNull() | F.col("phase").isin("running", "initializing", "waiting_for_sources")
    return latest.withColumns({"heartbeat_age_seconds": age, "stale": age > STALE_SECONDS}).withColumn(
        "phase", F.when(F.col("stale") & claims, "stale_unknown").otherwise(F.col("phase")))


def as_metrics(one_row: DataFrame, section: str) -> DataFrame:
    """A one-row aggregate as (section, name, value) rows."""
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
        for c in one_row.columns
    ])).alias("m")).select("m.*")
