"""The jobs users run, composed from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions import keys as K
from matchloom.functions import times as T
from matchloom.functions import urls as U
from matchloom.functions.expr import is_true, once
from matchloom.operators import (
    admission, cohort, counts, frontier, gate, list_pages, predicates, replays, revisit, select, setops, upgrade, upsert,
)
from matchloom.session import materialize


def list_etl(
    pages: DataFrame, base: str, contract: gate.Contract | None = None, members: DataFrame | None = None,
    exclusions: DataFrame | None = None, known: DataFrame | None = None,
    low: int | None = None, high: int | None = None, now: int | None = None,
) -> dict[str, DataFrame]:
    """List pages to battles, eligible battles, new details and current metadata.

    Pages are read once: the parsed battles are written to the shared folder, and every
    result below reads that table.
    """
    parsed = list_pages.battles(list_pages.unique_captures(pages), base)
    battles = materialize(parsed.withColumn("eligible", gate.eligible(contract, low, high, now)), "battles")
    chosen = battles.filter("eligible")
    if members is not None:
        chosen = predicates.with_expert_sides(chosen, members)
    if exclusions is not None:
        chosen = select.keep_absent(chosen, exclusions, ["battle_tag"])
    details = select.first_by(
        chosen.select("battle_tag", "replay_url", "url", "seq", "position"), ["battle_tag"], "seq", "position")
    if known is not None:
        details = select.keep_absent(details, known, ["battle_tag"])
    return {
        "battles": battles, "eligible": chosen,
        "details": details.withColumn("dedup_key", K.battle_key(F.col("battle_tag"))),
        "metadata": upsert.fold_metadata(chosen, seq="seq", ties=("position",)),
    }


def replay_etl(payloads: DataFrame) -> DataFrame:
    """Replay responses to documents; ``outcome`` tells what became of each response."""
    unwrapped = replays.unwrap(payloads)
    usable = unwrapped.withColumn("html", F.when(F.col("outcome") == "ok", F.col("html")))
    parsed = replays.parse(usable)
    return parsed.withColumn("outcome", F.when(
        (F.col("outcome") == "ok") & F.col("parse_error").isNotNull(), "marker_rejected").otherwise(F.col("outcome")))


def admit(
    documents: DataFrame, metadata: DataFrame, contract: gate.Contract | None = None,
    min_timestamp: int | None = None,
) -> DataFrame:
    """Documents joined to metadata and checked: ``decision`` and ``reason`` for each.

    With a contract the strict gate decides, without it the ordinary checks. Every document is judged
    in full; ``ruled_out`` gives the battles that metadata alone turns away, to be left out before.
    """
    usable = documents.filter(F.col("outcome") == "ok")
    if contract is None:
        merged = gate.merge(usable, metadata)
        checked = once(merged, {"reason": gate.first_error(F.col("battle_tag"))})
        return checked.withColumn("decision", gate.ordinary_outcome(F.col("reason"), False))
    merged = gate.stamp(gate.merge(usable, metadata), contract)
    checked = once(merged, {"_error": gate.first_error(F.col("battle_tag"))})
    judged = gate.evaluate(checked, contract, min_timestamp)
    return judged.withColumns({
        "decision": F.when(F.col("_error").isNotNull(), gate.ordinary_outcome(F.col("_error"), True))
        .when(F.col("eligibility.accepted"), "accepted").otherwise("rejected"),
        "tier": F.when(F.col("_error").isNotNull(), "schema").otherwise(F.col("eligibility.tier")),
        "reason": F.coalesce("_error", F.array_join("eligibility.reasons", ";")),
    }).drop("_error")


def ruled_out(tasks: DataFrame, metadata: DataFrame, contract: gate.Contract) -> DataFrame:
    """``battle_tag``, ``tier`` and ``reason`` of waiting battles that need no replay, as their metadata
    decides against them. Only metadata is read; leave them out of a batch by an anti-join."""
    early = metadata.select("battle_tag", gate.early_decision(contract).alias("_e")).filter(F.col("_e").isNotNull())
    return early.join(tasks.select("battle_tag").distinct(), "battle_tag", "left_semi").select("battle_tag", "_e.tier", "_e.reason")


def run_counters(outcomes: DataFrame) -> DataFrame:
    """One row of a run's outcome counters over its task log (``kind``, ``outcome``, ``attempts``): tasks done,
    retried, dead and skipped, in all and per kind as a map."""
    kinds = outcomes.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(F.col("outcome") == o).alias(o) for o in ("done", "retry", "dead", "skipped")])
    entry = F.struct("kind", F.struct("done", "retry", "dead", "skipped"))
    return kinds.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("outcomes"),
        *[F.coalesce(F.sum(o), F.lit(0)).alias(o) for o in ("done", "retry", "dead", "skipped")],
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("by_kind"))


def accepted(decided: DataFrame, earlier: DataFrame, target: int) -> DataFrame:
    """Accepted documents within the target."""
    return admission.capped(decided.filter(F.col("decision") == "accepted"), earlier, target)


def _cursor_ms(value: Column) -> Column:
    """A history cursor in milliseconds; seconds have up to ten digits."""
    n = value.try_cast("bigint")
    return F.when((n > 0) & (n < 10_000_000_000), n * 1000).when(n > 0, n)


def expand(
    pages: DataFrame, battles: DataFrame, known: DataFrame, base: str, low: int | None = None,
    max_pages: int = 1000, zero_limit: int = 2, closed_season: bool = False, season_end: int | None = None,
) -> dict[str, DataFrame]:
    """Frontier growth of captured pages (``url``, ``seq``, ``owner``, ``page``,
    ``zero_new_chain``, ``previous_fingerprint``, ``body``): players and next pages. A next page that is not followed
    has its reason in ``navigation``: a cutoff, or an error, as at the page ceiling or where the cursor does not decrease.
    In a closed season the first page counts as standing at ``season_end`` (in seconds), and cursors are compared by the second.
    The walk of a player pool has rules of its own, see ``pool.walk``."""
    new = frontier.first_sightings(battles.filter("eligible"), known)
    players = frontier.discovered_players(pages, list_pages.player_tags(F.col("body")), new, base)
    capture = ["url", "seq"]
    per_page = battles.groupBy(*capture).agg(
        F.count_if("eligible").alias("eligible"),
        K.fingerprint(F.collect_set("battle_tag")).alias("fingerprint"))
    credited = new.groupBy(*capture).agg(F.count(F.lit(1)).alias("new"))
    step = (
        pages.withColumn("_next", list_pages.next_page(F.col("body"), base)).drop("body")
        .join(per_page, capture, "left").join(credited, capture, "left")
        .withColumns({
            "eligible": F.coalesce("eligible", F.lit(0)), "new": F.coalesce("new", F.lit(0)),
            "fingerprint": F.coalesce("fingerprint", K.fingerprint(F.array().cast("array<string>"))),
        })
        .withColumn("decision", frontier.decision(
            F.col("eligible"), F.col("new"), F.col("zero_new_chain"), F.col("fingerprint"),
            F.col("previous_fingerprint"), zero_limit))
    )
    url = F.col("_next.url")
    reaches = is_true(url.isNotNull() & T.page_in_window(U.query_param(url, "before"), low, closed_season))
    usable = reaches & is_true(F.col("page") < max_pages)
    same = K.page_key(url) == K.page_key(F.col("url"))
    ends = (F.col("decision.stop_history") & F.lit(not closed_season)) | same
    cutoff = usable & ends
    cursor, previous = (_cursor_ms(U.query_param(u, "before")) for u in (url, F.col("url")))
    if closed_season:
        if season_end is not None:
            previous = F.coalesce(previous, F.lit(season_end).cast("bigint") * 1000)
        backwards = cursor.isNull() | is_true(F.floor(cursor / 1000) >= F.floor(previous / 1000))
    else:
        backwards = is_true(cursor >= previous)
    judged = step.withColumns({
        "cutoff": is_true(cutoff),
        "cutoff_reason": F.when(usable & same, "same_list_url").when(usable, F.col("decision.reason")),
        "error": F.when(F.col("_next.error").isNotNull(), F.col("_next.error")).when(
            usable & ~is_true(U.player_list_url_allowed(url, F.col("owner"), base)), "foreign_list_url").when(
            reaches & ~is_true(ends) & ~is_true(F.col("page") < max_pages), "page_ceiling").when(
            usable & ~is_true(cutoff) & backwards, "cursor_not_decreasing"),
    })
    follow = judged.filter(usable & ~F.col("cutoff") & F.col("error").isNull()).select(
        url.alias("url"), F.lit("list").alias("kind"), F.col("owner").alias("tag"), (F.col("page") + 1).alias("page"),
        F.when(F.col("new") > 0, frontier.FRESH).otherwise(frontier.OVERLAP).alias("discovery_band"),
        F.col("decision.zero_chain").alias("zero_new_chain"), F.col("fingerprint").alias("previous_fingerprint"),
        K.page_key(url).alias("dedup_key"), "seq")
    return {
        "players": players, "history": select.first_by(follow, ["dedup_key"], "seq"),
        "navigation": judged.select(
            F.col("seq").alias("task_id"), "url", "seq", "eligible", "new", "fingerprint", "cutoff", "cutoff_reason", "error"),
    }


def recover_metadata(tasks: DataFrame, metadata: DataFrame, battles: DataFrame, flag: str = "complete") -> DataFrame:
    """Metadata of waiting battles, looked up again on their source page where it is
    missing or not ``flag``. Found rows pass the usual upsert, so nothing is downgraded."""
    held = metadata.filter(F.col(flag)).select("battle_tag")
    lacking = tasks.select("battle_tag", F.col("source_url").alias("url")).join(held, "battle_tag", "left_anti")
    found = battles.join(lacking.distinct(), ["url", "battle_tag"], "left_semi")
    return upsert.merge_snapshot(metadata, found)


def refresh_sources(
    pages: DataFrame, sources: DataFrame, known_players: DataFrame, base: str, at: int,
    max_players: int, max_sources: int, epoch: str | None = None,
) -> dict[str, DataFrame]:
    """Captured source pages to new player tasks, new source boards, and visit-log rows
    (see ``revisit.visit_state``). An unusable page yields a failed visit, nothing else."""
    parsed = materialize(
        cohort.source_page(pages, base, list_pages.player_links(F.col("body")), max_players, max_sources), "sources")
    good = parsed.filter("page_error IS NULL")
    named = good.select("url", "seq", F.posexplode("tags").alias("position", "tag"))
    tasks = select.insert_or_ignore(
        known_players, named.withColumn("dedup_key", K.player_key(F.col("tag"), epoch)), ["dedup_key"], "seq", "position")
    boards = good.select("seq", F.posexplode("source_urls").alias("position", "board")).select(
        F.struct("seq", "position").alias("seq"), F.col("board").alias("url"))
    credited = tasks.groupBy("url", "seq").agg(F.count(F.lit(1)).alias("new_count"))
    visits = parsed.join(credited, ["url", "seq"], "left").select(
        "url", "seq", F.lit(at).cast("bigint").alias("at"), F.col("page_error").isNull().alias("ok"),
        F.coalesce("new_count", F.lit(0)).cast("bigint").alias("new_count"), F.col("page_error").alias("error"), "html_sha256")
    return {
        "players": tasks.withColumn("task_url", U.list_url(F.col("tag"), base)),
        "sources": revisit.register_sources(sources, boards, max_sources), "visits": visits,
    }


def dispatch(tasks: DataFrame, now, limit: int, ready_limit: int, list_limit: int, cursor: int = 0) -> DataFrame:
    """The next batch under quotas: ``slot`` orders it. The batch is at most ``limit``
    rows, so the ordering windows below see no more than that."""
    if limit <= 0 or ready_limit <= 0 or list_limit < 0:
        return tasks.limit(0).withColumn("slot", F.lit(0))
    is_ready = F.col("kind").isin(*counts.READY_KINDS)
    held = tasks.agg(
        F.count_if(is_ready & (F.col("status") == "inflight")).alias("ready"),
        F.count_if(~is_ready & (F.col("status") == "inflight")).alias("listed"),
        F.count_if(~is_ready & F.col("status").isin(*counts.OPEN)).alias("lists_left")).first()
    ready_slots = max(0, ready_limit - held["ready"]) + (list_limit if held["lists_left"] == 0 else 0)
    due = frontier.ready(tasks, now)

    def batch(rank: int, n: int) -> DataFrame:
        return select.limited(due.filter(F.col("dispatch_rank") == rank), ["next_retry_at", "id"], n)

    ready = batch(0, min(ready_slots, limit))
    list_take = min(max(0, list_limit - held["listed"]), max(0, limit - ready.count()))
    first = batch(1, list_take)
    left = list_take - first.count()
    bands = batch(2, left).unionByName(batch(3, left)).unionByName(batch(4, left))
    has_history = batch(3, min(left, 1)).count() > 0
    in_band = Window.partitionBy("dispatch_rank").orderBy("next_retry_at", "id")
    laid_out = bands.withColumn("_n", F.row_number().over(in_band)).withColumn(
        "_slot", frontier.slot_bands(F.col("_n"), F.col("dispatch_rank"), F.lit(has_history), cursor)).drop("_n")
    lists = first.withColumn("_slot", F.lit(-1).cast("bigint")).unionByName(laid_out).orderBy(
        "_slot", "next_retry_at", "id").limit(max(0, list_take))
    both = ready.withColumn("_slot", F.lit(0).cast("bigint")).withColumn("_list", F.lit(False)).unionByName(
        lists.withColumn("_list", F.lit(True)))
    position = F.row_number().over(Window.partitionBy("_list").orderBy("_slot", "next_retry_at", "id"))
    return both.withColumn("slot", frontier.slot_4_1(position, F.col("_list"))).drop("_slot", "_list").orderBy("slot")


def build_cohort(
    boards: DataFrame, profiles: DataFrame | None, season: str, size: int, historical: bool,
) -> DataFrame:
    """Board and profile pages to the cohort's players with their proof. Pages are read once: what they say is written to the
    shared folder, and the checks and the choice read that."""
    rows = materialize(cohort.board_rows(boards, season), "board-rows")
    cohort.require(rows.filter("page_error IS NOT NULL").select("url", "page_error"), "board page unusable")
    # Boards before profiles, then page order, then place on the page.
    order = F.struct(F.lit(0).alias("kind"), F.col("seq").cast("bigint").alias("seq"), F.col("position").cast("bigint").alias("position"))
    listed = rows.select(order.alias("seq"), F.col("rank").cast("bigint").alias("rank"), "tag", F.lit(season).alias("rank_season"))
    if not historical:
        return cohort.ranked_players(listed, size).withColumn("rank_season", F.lit(season))
    if profiles is not None:
        proofs = materialize(cohort.profile_proofs(profiles, season), "profile-proofs")
        cohort.require(proofs.filter("page_error IS NOT NULL").select("url", "page_error"), "profile page unusable")
        later = proofs.filter("rank IS NOT NULL").select(
            F.struct(F.lit(1).alias("kind"), F.col("seq").cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("position")).alias("seq"), F.col("rank").cast("bigint").alias("rank"), "tag", "rank_season")
        listed = listed.unionByName(later)
    return cohort.historical_pool(listed, size, season)


def plan_upgrades(manifest: DataFrame, documents: DataFrame, index: DataFrame, list_rate: float, replay_rate: float) -> dict[str, DataFrame]:
    rows = upgrade.candidates(manifest, documents, index)
    upgrade.check_candidates(rows)
    totals = upgrade.summary(rows)
    return {
        "candidates": rows, "groups": upgrade.groups(rows), "summary": totals,
        "schemas": upgrade.schema_counts(rows), "estimate": upgrade.work_estimate(totals, list_rate, replay_rate),
    }


def resolve_upgrades(rows: DataFrame, captures: DataFrame, battles: DataFrame, contract: gate.Contract) -> DataFrame:
    """Candidates with their resolution; resolved ones that metadata alone rules out are
    rejected here, before any replay is joined."""
    decided = upgrade.confirm(rows.filter("addressable"), captures, battles)
    early = battles.select("url", "battle_tag", "seq", gate.early_decision(contract).alias("_early"))
    latest = select.latest_by(early.filter("_early IS NOT NULL"), ["url", "battle_tag"], "seq").select(
        F.col("url").alias("source_list_url"), "battle_tag", "_early")
    joined = decided.join(latest, ["source_list_url", "battle_tag"], "left")
    ruled_out = F.col("status").startswith("resolved") & F.col("_early").isNotNull()
    return joined.withColumns({
        "tier": F.when(ruled_out, F.col("_early.tier")).when(F.col("status") == "rejected", "dependency_unresolved"),
        "reason": F.when(ruled_out, F.col("_early.reason")).otherwise(F.col("reason")),
        "status": F.when(ruled_out, "rejected").otherwise(F.col("status")),
    }).drop("_early")


def refresh_seeds(boards: DataFrame, seen: DataFrame, minimum_unseen: int) -> tuple[DataFrame, DataFrame]:
    """Chosen seed tags and the receipt of the refresh."""
    named = boards.select(F.explode(F.transform(list_pages.player_links(F.col("body")), F.upper)).alias("tag")).distinct()
    codes = boards.select(F.explode(cohort.country_codes(F.col("body"))).alias("code"))
    chosen = setops.choose_seeds(named, seen, minimum_unseen)
    receipt = counts.as_metrics(boards.agg(F.count(F.lit(1)).alias("pages")), "seeds")
    for name, df in (
        ("countries", codes.distinct()), ("all_unique_tags", named), ("unseen_tags", setops.unseen(named, seen)),
        ("previously_seen_tags", setops.previously_seen(named, seen)), ("selected_tags", chosen),
    ):
        receipt = receipt.unionByName(counts.as_metrics(df.agg(F.count(F.lit(1)).alias(name)), "seeds"))
    return chosen, receipt


def import_exclusions(
    tags: DataFrame, stored: DataFrame, tasks: DataFrame, metadata: DataFrame, source: str, skip_completed: bool = False,
) -> dict[str, DataFrame]:
    """New exclusion, task and metadata tables, and what the import changed."""
    wanted = tags.select(F.btrim("battle_tag").alias("battle_tag")).filter("battle_tag <> ''").distinct()
    added = select.keep_absent(wanted, stored, ["battle_tag"])
    hit = wanted.select(K.battle_key(F.col("battle_tag")).alias("dedup_key"), F.lit(True).alias("_hit"))
    open_states = ["pending", "inflight", "dead"] + (["done"] if skip_completed else [])
    drop = is_true(F.col("_hit")) & (F.col("kind") == "detail") & F.col("status").isin(open_states)
    marked = tasks.join(hit, "dedup_key", "left").withColumn("_drop", drop)
    after = marked.withColumns({
        "status": F.when(F.col("_drop"), "skipped").otherwise(F.col("status")),
        "error": F.when(F.col("_drop"), "excluded: already in training dataset").otherwise(F.col("error")),
    }).select(*tasks.columns)
    effect = counts.as_metrics(wanted.agg(F.count(F.lit(1)).alias("requested")), "exclusions")
    for name, df in (("inserted", added), ("total", stored.select("battle_tag").unionByName(added))):
        effect = effect.unionByName(counts.as_metrics(df.agg(F.count(F.lit(1)).alias(name)), "exclusions"))
    effect = effect.unionByName(counts.as_metrics(marked.agg(F.count_if("_drop").alias("unfinished_tasks_skipped")), "exclusions"))
    return {
        "exclusions": stored.unionByName(added.withColumn("source", F.lit(source)), allowMissingColumns=True),
        "tasks": after, "metadata": metadata.join(wanted, "battle_tag", "left_anti"), "effect": effect,
    }


def campaign_status(tasks: DataFrame, decisions: DataFrame, waiting: DataFrame) -> DataFrame:
    """A campaign's counts as (section, name, value) rows: tasks by kind and status, results by status and by tier, and how many index records
    (``waiting``) are staged and not published."""
    def counted(df: DataFrame, section: str, *keys: str) -> DataFrame:
        name = F.concat_ws(":", *keys)
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("value")).select(F.lit(section).alias("section"), name.alias("name"), "value")

    return counted(tasks, "tasks", "kind", "status").unionByName(counted(decisions, "status", "status")).unionByName(
        counted(decisions, "tiers", "status", "tier")).unionByName(waiting.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit("index").alias("section"), F.lit("pending_index_records").alias("name"), "value"))


def status(tasks: DataFrame, decisions: DataFrame, navigation: DataFrame, visits: DataFrame, accepted_log: DataFrame,
           as_of: Column, daily_target: int = 300_000) -> DataFrame:
    """Run status as (section, name, value) rows: one-row aggregates put side by side."""
    last_hour = F.col("accepted_at") > as_of - F.expr("INTERVAL 1 HOUR")
    parts = (
        ("tasks", counts.work_state(tasks)),
        ("decisions", decisions.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("accepted", "rejected", "queued")])),
        ("navigation", counts.navigation_totals(navigation)),
        ("sources", revisit.visit_totals(visits, "url")),
        ("throughput", accepted_log.agg(
            (F.count_if(last_hour) / 3600).alias("accepted_per_second"), F.lit(daily_target / 86400).alias("target_per_second"))),
    )
    out = None
    for section, df in parts:
        rows = counts.as_metrics(df, section)
        out = rows if out is None else out.unionByName(rows)
    return out
