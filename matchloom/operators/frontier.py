"""Frontier rows: typed seeds, dispatch order, novelty decisions, discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions import keys as K
from matchloom.functions import text as X
from matchloom.functions import urls as U
from matchloom.functions.expr import is_true
from matchloom.operators import ordered, select
from matchloom.session import materialize

FRESH, OVERLAP = 0, 1


def seed_tasks(seeds: DataFrame, base: str, epoch: str | None = None, adaptive: bool = True) -> DataFrame:
    """Seed values (``value``, ``source``) as typed tasks with their identity key."""
    value = F.btrim("value", F.lit(X.BLANKS))
    parts = F.filter(F.split(F.regexp_replace(U.path(value), "^/+|/+$", ""), "/"), lambda s: s.isNotNull())
    third = F.get(parts, F.lit(2))
    is_page = X.is_url(value) & (F.size(parts) >= 2) & (F.get(parts, F.lit(0)) == "player") & (
        (F.size(parts) == 2) | is_true(third == "battles"))
    page_tag = F.upper(F.get(parts, F.lit(1)))
    page_url = F.when(F.size(parts) == 2, U.list_url(page_tag, base)).otherwise(value)
    first_page = ~U.path(value).contains("/history")
    plain_tag = F.upper(F.regexp_replace(value, "^#+", ""))
    param = U.query_param(value, "tag")
    page_identity = F.when(first_page & (U.query(value) == ""), K.player_key(page_tag, epoch)).otherwise(K.page_key(page_url, adaptive))
    detail_identity = F.when(param.isNotNull() & (U.path(value) == "/data/replay"), K.battle_key(param)).otherwise(value)
    task = (
        F.when(is_page, F.struct(
            page_url.alias("url"), F.lit("list").alias("kind"), page_tag.alias("tag"),
            F.when(first_page, 1).otherwise(2).alias("page"), page_identity.alias("dedup_key")))
        .when(X.is_url(value), F.struct(
            value.alias("url"), F.lit("detail").alias("kind"), param.alias("tag"),
            F.lit(None).cast("int").alias("page"), detail_identity.alias("dedup_key")))
        .when(plain_tag != "", F.struct(
            U.list_url(plain_tag, base).alias("url"), F.lit("list").alias("kind"), plain_tag.alias("tag"),
            F.lit(1).alias("page"), K.player_key(plain_tag, epoch).alias("dedup_key")))
    )
    kept = [c for c in seeds.columns if c != "value"]
    return seeds.select(*kept, task.alias("_t")).filter(F.col("_t").isNotNull()).select(*kept, "_t.*")


def dispatch_rank(kind: Column, band: Column, url: Column) -> Column:
    return (
        F.when(kind.isin("detail", "upgrade"), 0)
        .when(kind.isin("upgrade_list", "source"), 1)
        .when((kind == "list") & (band > 0), 4)
        .when((kind == "list") & ~url.contains("/history?before="), 2)
        .otherwise(3)
    )


def ready(tasks: DataFrame, now) -> DataFrame:
    return tasks.filter((F.col("status") == "pending") & (F.col("next_retry_at") <= now))


def ready_batch(tasks: DataFrame, now, n: int) -> DataFrame:
    """Next ``n`` due tasks: rank, then due time, then id."""
    return select.limited(ready(tasks, now), ["dispatch_rank", "next_retry_at", "id"], n)


# -- interleaving ------------------------------------------------------------------


def slot_4_1(position: Column, is_list: Column) -> Column:
    """Sort key putting one list task after every four ready ones."""
    i = position - 1
    return F.when(is_list, i * 5 + 4).otherwise(_div(i, 4) * 5 + i % 4)


def slot_bands(position: Column, rank: Column, has_history: Column, cursor: int = 0) -> Column:
    """Sort key for the repeating order root, history, root, history, overlap, entered
    at ``cursor``. Without history rows the roots take its places."""
    turns, at = divmod(cursor, 5)
    i = position - 1
    root = i + (2 * turns + (at > 0) + (at > 2))
    history = i + (2 * turns + (at > 1) + (at > 3))
    alone = i + (4 * turns + min(at, 4))
    return (
        F.when(rank == 4, (i + turns) * 5 + 4)
        .when(rank == 3, _div(history, 2) * 5 + 2 * (history % 2) + 1)
        .when(has_history, _div(root, 2) * 5 + 2 * (root % 2))
        .otherwise(_div(alone, 4) * 5 + alone % 4)
    )


def _div(a: Column, n: int) -> Column:
    return F.call_function("div", a.cast("bigint"), F.lit(n).cast("bigint"))


# -- novelty ---------------------------------------------------------------------------


def decision(eligible: Column, new: Column, previous_zero: Column, fingerprint: Column,
             previous_fingerprint: Column, zero_limit: int = 2) -> Column:
    """Chain length, whether history stops here, and why; a repeated page is named first."""
    chain = F.when(new == 0, previous_zero + 1).otherwise(0)
    repeated = is_true((eligible > 0) & (fingerprint == previous_fingerprint))
    stop = repeated | (chain >= zero_limit)
    return F.struct(
        chain.alias("zero_chain"), stop.alias("stop_history"),
        F.when(repeated, "same_battle_page").when(stop, "consecutive_zero_new").alias("reason"),
    )


def chain_decisions(pages: DataFrame, keys: list[str], seq: str, zero_limit: int = 2, span: int = ordered.SPAN) -> DataFrame:
    """Decisions along each player's page chain, and whether a page is still reached."""
    stepped = ordered.scan(pages, keys, seq, lag={"_fp": "fingerprint"}, run=("zero_chain", F.col("new") == 0), span=span)
    repeated = is_true((F.col("eligible") > 0) & (F.col("fingerprint") == F.col("_fp")))
    named = stepped.withColumn("repeated", repeated).withColumn(
        "stop_history", repeated | (F.col("zero_chain") >= zero_limit)).drop("_fp")
    # Where a group stops is asked of rows that stand written, so the scan runs once.
    return ordered.before_first(materialize(named, "chains"), keys, seq, F.col("stop_history"), "reached")


def cursor_steps(pages: DataFrame, keys: list[str], seq: str, now_ms: int, span: int = ordered.SPAN) -> DataFrame:
    """Does each history cursor lie strictly before the one before it? The first is a
    server-time anchor and may lie up to five minutes ahead."""
    stepped = ordered.lagged(pages, keys, seq, {"previous_cursor": "cursor"}, span)
    decreasing = (F.col("cursor") <= now_ms + 300_000) & (
        F.col("previous_cursor").isNull() | (F.col("cursor") < F.col("previous_cursor")))
    return stepped.withColumn("decreasing", is_true(decreasing))


def first_sightings(battles: DataFrame, known: DataFrame) -> DataFrame:
    """Battles not known before, each credited to the page that shows it first."""
    return select.insert_or_ignore(known, battles, ["battle_tag"], "seq", "position")


# -- discovery -----------------------------------------------------------------------


def discovered_players(pages: DataFrame, tags: Column, new_battles: DataFrame, base: str, epoch: str | None = None) -> DataFrame:
    """Player tasks of pages (``url``, ``seq``, ``owner``): players of newly seen battles
    are fresh, all others overlap; the page's owner is left out, nobody else is."""
    named = pages.select("url", "seq", "owner", F.posexplode(
        F.array_distinct(F.transform(tags, X.strip_tag))).alias("position", "player"))
    named = named.filter((F.col("player") != "") & ~F.col("player").eqNullSafe(F.upper("owner")))
    fresh = new_battles.select("url", "seq", F.explode(F.concat("team_tags", "opponent_tags")).alias("_t")).select(
        "url", "seq", X.strip_tag(F.col("_t")).alias("player")).distinct().withColumn("_fresh", F.lit(True))
    banded = named.join(fresh, ["url", "seq", "player"], "left").select(
        U.list_url(F.col("player"), base).alias("task_url"), F.lit("list").alias("kind"),
        F.col("player").alias("tag"), F.lit(1).alias("page"),
        F.when(F.col("_fresh"), FRESH).otherwise(OVERLAP).alias("discovery_band"),
        K.player_key(F.col("player"), epoch).alias("dedup_key"), "seq", "position",
        F.col("url").alias("seed"),
    )
    # First sighting queues the player; fresh evidence anywhere in the batch lifts it.
    best = banded.groupBy("dedup_key").agg(
        F.min_by(F.struct("task_url", "kind", "tag", "page", "seed", "seq", "position"), F.struct("seq", "position")).alias("t"),
        F.min("discovery_band").alias("discovery_band"))
    return best.select(F.col("t.task_url").alias("url"), "t.kind", "t.tag", "t.page", "t.seed", "t.seq",
                       "t.position", "discovery_band", "dedup_key")


def apply_discovery(frontier: DataFrame, discovered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new tasks, frontier with waiting overlap players lifted by fresh evidence)."""
    new = select.keep_absent(discovered, frontier, ["dedup_key"])
    fresh = discovered.filter(F.col("discovery_band") == FRESH).select("dedup_key", F.lit(True).alias("_fresh"))
    lift = is_true(F.col("_fresh")) & (F.col("kind") == "list") & (F.col("status") == "pending")
    lifted = frontier.join(fresh, "dedup_key", "left").withColumn(
        "discovery_band", F.when(lift, FRESH).otherwise(F.col("discovery_band"))).drop("_fresh")
    return new, lifted.select(*frontier.columns)
