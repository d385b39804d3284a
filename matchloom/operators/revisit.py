"""Sources and players to visit again: state, release, and who is due."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions import backoff as B
from matchloom.functions import keys as K
from matchloom.operators import select


def visit_state(log: DataFrame, key: str, base: float, longest: float, failure_base: float = 300.0, seq: str = "seq") -> DataFrame:
    """State per source or player from its visit log (``at``, ``ok``, ``new_count``,
    ``error``, ``html_sha256``).

    A success clears failures and, with new items, the zero streak. A failure moves the
    due time only: the last good capture stays. Counts after a mark need the mark first,
    so the log is read twice; both passes combine on the map side.
    """
    ok, order = F.col("ok"), F.col(seq)
    marks = log.groupBy(key).agg(
        F.max(F.when(ok, order)).alias("_last_ok"),
        F.max(F.when(ok & (F.col("new_count") > 0), order)).alias("_last_new"),
    )
    marked = log.join(marks, key)
    folded = marked.groupBy(key).agg(
        F.count(F.lit(1)).alias("generation"),
        F.count_if(~ok & (F.col("_last_ok").isNull() | (order > F.col("_last_ok")))).alias("failures"),
        F.count_if(ok & (F.col("_last_new").isNull() | (order > F.col("_last_new")))).alias("zero_new_streak"),
        F.max_by(F.struct("at", "ok", "error"), order).alias("_l"),
        F.max_by(F.struct("at", "new_count", "html_sha256"), F.when(ok, order)).alias("_g"),
    )
    due = F.when(F.col("_l.ok"), B.revisit_interval(F.col("zero_new_streak"), base, longest)).otherwise(
        B.source_failure_delay(F.col("failures"), failure_base, longest))
    return folded.select(
        key, "generation", "failures", "zero_new_streak",
        F.col("_g.at").alias("fetched_at"), (F.col("_g.at") + base).alias("cache_expires_at"),
        F.col("_g.new_count").alias("last_new"), F.col("_g.html_sha256").alias("html_sha256"),
        F.when(~F.col("_l.ok"), F.col("_l.error")).alias("last_error"),
        (F.col("_l.at") + due).alias("due"),
    )


def visit_totals(log: DataFrame, key: str) -> DataFrame:
    return log.agg(
        F.count(F.lit(1)).alias("scheduled"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"),
        F.sum(F.when(F.col("ok"), F.col("new_count"))).alias("new_items"), F.count_distinct(key).alias("tracked"))


def release_ended(state: DataFrame, tasks: DataFrame, now: float, failure_delay: float, message: str) -> DataFrame:
    """Free the slot of entries whose task ended without reporting back."""
    ended = tasks.filter(~F.col("status").isin("pending", "inflight")).select(F.col("id").alias("active_task_id"), F.lit(True).alias("_ended"))
    joined = state.join(ended, "active_task_id", "left")
    gone = F.coalesce(F.col("_ended"), F.lit(False))
    return joined.withColumns({
        "active_task_id": F.when(~gone, F.col("active_task_id")),
        "due": F.when(gone, F.lit(now + failure_delay)).otherwise(F.col("due")),
        "last_error": F.when(gone, F.lit(message)).otherwise(F.col("last_error")),
    }).select(*state.columns)


def due_entries(state: DataFrame, key: str, now, slots: int) -> DataFrame:
    """Free entries whose time has come, earliest first, as many as there are slots."""
    free = state.filter(F.col("active_task_id").isNull() & (F.col("due") <= now))
    return select.limited(free, ["due", key], max(0, slots))


def source_tasks(due: DataFrame) -> DataFrame:
    generation = F.col("generation") + 1
    return due.select("url", F.lit("source").alias("kind"), generation.alias("generation"),
                      K.source_key(F.col("url"), generation).alias("dedup_key"))


def revisit_tasks(due: DataFrame) -> DataFrame:
    generation = F.col("generation") + 1
    return due.select("url", F.lit("list").alias("kind"), "player_key", generation.alias("generation"),
                      F.lit(0).alias("discovery_band"), K.revisit_key(F.col("player_key"), generation).alias("dedup_key"))


def plan_sources(state: DataFrame, tasks: DataFrame, now: float, max_pending: int, failure_delay: float) -> DataFrame:
    """Source tasks to queue now."""
    freed = release_ended(state, tasks, now, failure_delay, "previous source task ended unexpectedly")
    active = tasks.filter((F.col("kind") == "source") & F.col("status").isin("pending", "inflight")).count()
    return source_tasks(due_entries(freed, "url", now, max_pending - active))


def enough_fresh_roots(tasks: DataFrame, now, watermark: int) -> bool:
    """Are there already that many due root pages? Looks no further than the mark."""
    due = tasks.filter((F.col("status") == "pending") & (F.col("dispatch_rank") == 2) & (F.col("next_retry_at") <= now))
    return due.limit(max(1, watermark)).count() >= max(1, watermark)


def plan_revisits(state: DataFrame, tasks: DataFrame, now: float, batch: int, pending_limit: int, watermark: int, failure_delay: float) -> DataFrame:
    """Revisit tasks to queue now; none while enough fresh roots wait."""
    freed = release_ended(state, tasks, now, failure_delay, "previous revisit failed or was skipped")
    if enough_fresh_roots(tasks, now, watermark):
        return revisit_tasks(freed.limit(0))
    active = freed.filter(F.col("active_task_id").isNotNull()).count()
    return revisit_tasks(due_entries(freed, "player_key", now, min(batch, max(0, pending_limit - active))))


def visit_overview(states: DataFrame, known: DataFrame, key: str, now: float) -> DataFrame:
    """One row: keys seen before and newly discovered ones (not in ``known``), how many are due now, and
    when the next one falls due."""
    marked = states.join(known.select(key).distinct().withColumn("_seen", F.lit(True)), key, "left")
    return marked.agg(
        F.count_if(F.col("_seen")).alias("seen"), F.count_if(F.col("_seen").isNull()).alias("discovered"),
        F.count_if(F.col("due") <= now).alias("due_now"), F.min(F.when(F.col("due") > now, F.col("due"))).alias("next_due"))


def register_sources(existing: DataFrame, urls: DataFrame, max_sources: int) -> DataFrame:
    """New source addresses in order, up to the limit."""
    room = max(0, max_sources - existing.count())
    return select.limited(select.insert_or_ignore(existing, urls, ["url"], "seq"), ["seq"], room)


def pool_next_check(entries: DataFrame, now: Column) -> DataFrame:
    """Next check of pool sources and candidates after an attempt."""
    failures = F.when(F.col("error").isNotNull(), F.col("failures") + 1).otherwise(0)
    return entries.withColumn("failures", failures).withColumn(
        "due", now + B.pool_delay(F.col("failures"), F.col("is_source"))).withColumn("last_error", F.col("error"))


def cache_is_fresh(record_url: Column, url: Column, tags: Column, fetched: Column, now: Column, ttl: float) -> Column:
    """A cached source page is usable: same address, valid tags, known age below ttl."""
    age = now - fetched
    valid = (F.size(tags) > 0) & F.forall(tags, lambda t: F.coalesce(F.upper(t).rlike("^[A-Z0-9]{3,32}$"), F.lit(False)))
    return F.coalesce((record_url == url) & valid & (age >= 0) & (age < ttl), F.lit(False))
