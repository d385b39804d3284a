"""Frontier, telemetry, navigation, event order and state folds over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog import derived as D
from matchloom.catalog.registry import query
from matchloom.operators import admission, counts, event_order, frontier, ordered, revisit, select, telemetry, upsert
from matchloom.plans import jobs
from matchloom.session import load


def _flat(df, column: str, names: dict[str, str]):
    return df.select(*[c for c in df.columns if c != column], *[F.col(f"{column}.{n}").alias(o) for n, o in names.items()])


@query(f"SELECT * FROM {D.MARKER_SQL}")
def dedup_first(spark, sf):
    return D.markers(spark, sf)


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal < 2000)")
def exclude_anti(spark, sf):
    barred = load(spark, sf, "customer").filter("c_acctbal < 2000").select(F.col("c_custkey").alias("o_custkey"))
    return select.keep_absent(load(spark, sf, "orders"), barred, ["o_custkey"]).select("o_orderkey")


@query("SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 45)")
def complete_semi(spark, sf):
    wanted = load(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return select.keep_present(load(spark, sf, "orders"), wanted, ["o_orderkey"]).select("o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1998-03-01'")
def window_half_open(spark, sf):
    # The bounds are compared in the column's own type, so they reach the scan.
    o = load(spark, sf, "orders")
    low, high = F.lit("1997-03-01").cast("timestamp"), F.lit("1998-03-01").cast("timestamp")
    return o.filter((F.col("o_orderdate") >= low) & (F.col("o_orderdate") < high)).select("o_orderkey", "o_custkey")


_FOLD = f"""
WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY battle_tag ORDER BY seq) AS rn, upper(ltrim(team, '#')) AS t, upper(ltrim(opponent, '#')) AS p FROM {D.OBSERVATION_SQL}),
f AS (
  SELECT battle_tag, rn, seq, t, p, complete, authoritative_complete FROM o WHERE rn = 1
  UNION ALL
  SELECT f.battle_tag, o.rn,
    CASE WHEN ok THEN o.seq ELSE f.seq END, CASE WHEN ok THEN o.t ELSE f.t END, CASE WHEN ok THEN o.p ELSE f.p END,
    CASE WHEN ok THEN o.complete ELSE f.complete END, CASE WHEN ok THEN o.authoritative_complete ELSE f.authoritative_complete END
  FROM f JOIN (SELECT * FROM o) o ON o.battle_tag = f.battle_tag AND o.rn = f.rn + 1,
  LATERAL (SELECT (f.t = '' OR o.t = '' OR f.t = o.t) AND (f.p = '' OR o.p = '' OR f.p = o.p)
      AND (NOT f.authoritative_complete OR o.authoritative_complete) AND (o.complete OR NOT f.complete) AS ok) x)
SELECT battle_tag, seq, complete, authoritative_complete FROM (SELECT *, row_number() OVER (PARTITION BY battle_tag ORDER BY rn DESC) AS last FROM f) WHERE last = 1
"""


@query(_FOLD)
def upsert_fold(spark, sf):
    return upsert.fold_metadata(D.observations(spark, sf)).select("battle_tag", "seq", "complete", "authoritative_complete")


@query(_FOLD)
def upsert_snapshot(spark, sf):
    """The same fold in two batches: a stored snapshot, then later observations."""
    seen = D.observations(spark, sf)
    middle = seen.agg(F.max("seq") / 2).scalar()
    stored = upsert.fold_metadata(seen.filter(F.col("seq") <= middle))
    renumbered = stored.withColumn("origin", F.col("seq"))
    later = seen.filter(F.col("seq") > middle).withColumn("origin", F.col("seq"))
    merged = upsert.merge_snapshot(renumbered, later)
    return merged.select("battle_tag", F.col("origin").alias("seq"), "complete", "authoritative_complete")


@query(f"""
WITH d AS {D.DECISION_SQL}
SELECT battle_tag,
  CASE WHEN bool_or(status = 'accepted') THEN 'accepted' ELSE arg_max(status, seq) END AS status,
  CASE WHEN bool_or(status = 'accepted') THEN arg_min(tier, seq) FILTER (status = 'accepted') ELSE arg_max(tier, seq) END AS tier,
  arg_min(saved_path, seq) FILTER (saved_path IS NOT NULL) AS saved_path, arg_min(source_path, seq) FILTER (source_path IS NOT NULL) AS source_path,
  arg_min(source_schema_version, seq) FILTER (source_schema_version IS NOT NULL) AS source_schema_version,
  arg_min(contract_sha256, seq) FILTER (contract_sha256 IS NOT NULL) AS contract_sha256, max(seq) AS updated_seq
FROM d GROUP BY battle_tag
""")
def decision_merge(spark, sf):
    return upsert.decisions(D.decision_log(spark, sf)).drop("reason")


_OUTCOME = {
    "task_id": "user_id", "seq": "event_id",
    "outcome": "CASE event_type WHEN 'view' THEN 'done' WHEN 'click' THEN 'inflight' WHEN 'error' THEN 'retry' WHEN 'signup' THEN 'skipped' ELSE 'dead' END",
    "reason": "'because ' || event_id", "saved_path": "'p' || event_id", "meta": "'m' || event_id",
    "at": "CAST(event_id * 10 AS DOUBLE)", "delay": "CAST(event_id % 100 - 20 AS DOUBLE)",
}


@query(f"""
WITH o AS {D._sql(_OUTCOME, "events")}, l AS (SELECT task_id, arg_max(outcome, seq) AS outcome, arg_max(reason, seq) AS reason,
  arg_max(saved_path, seq) AS saved_path, arg_max(meta, seq) AS meta, arg_max("at", seq) AS at_, arg_max(delay, seq) AS delay,
  count(*) FILTER (outcome = 'retry') AS attempts FROM o GROUP BY task_id)
SELECT task_id, CASE WHEN outcome = 'inflight' THEN 'pending' WHEN outcome = 'retry' THEN CASE WHEN attempts >= 12 THEN 'dead' ELSE 'pending' END ELSE outcome END AS status,
  attempts, CASE WHEN outcome <> 'done' THEN reason END AS error, saved_path, meta,
  CASE WHEN outcome = 'retry' AND attempts < 12 THEN at_ + greatest(0.0::DOUBLE, delay) ELSE 0.0::DOUBLE END AS next_retry_at FROM l
""")
def task_states(spark, sf):
    return upsert.task_states(D._df(spark, sf, "events", _OUTCOME), 12)


@query(f"SELECT kind, status, count(*) AS n, CAST(grouping(kind, status) AS BIGINT) AS level FROM {D.TASK_SQL} GROUP BY GROUPING SETS ((kind, status), (status), ())")
def counts_kind_status(spark, sf):
    return counts.by_kind_and_status(D.tasks(spark, sf))


@query(f"""
SELECT contract_sha256, status, tier, count(*) AS n, CAST(grouping(contract_sha256, status, tier) AS BIGINT) AS level
FROM {D.DECISION_SQL} GROUP BY GROUPING SETS ((contract_sha256, status, tier), (contract_sha256, status))
""")
def decision_counts(spark, sf):
    return counts.decision_counts(D.decision_log(spark, sf))


_WORK_STATE = f"""
SELECT count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'inflight') AS inflight, count(*) FILTER (status = 'done') AS done,
  count(*) FILTER (status = 'dead') AS dead, count(*) FILTER (status = 'skipped') AS skipped,
  count(*) FILTER (kind IN ('detail', 'upgrade') AND status IN ('pending', 'inflight')) AS ready_backlog,
  count(*) FILTER (kind = 'detail' AND status = 'done') AS done_details, min(next_retry_at) FILTER (status = 'pending') AS next_retry_at FROM {D.TASK_SQL}
"""


@query(_WORK_STATE)
def work_state(spark, sf):
    return counts.work_state(D.tasks(spark, sf))


@query(f"SELECT count(*) AS total, count(*) FILTER (complete) AS complete, count(*) FILTER (NOT complete) AS incomplete FROM {D.OBSERVATION_SQL}")
def metadata_completeness(spark, sf):
    return counts.metadata_completeness(D.observations(spark, sf))


_NAVIGATION = f"""
WITH o AS (SELECT player, task_id, arg_min(eligible, seq) AS e, arg_min("new", seq) AS n, arg_min(cutoff, seq) AS c FROM {D.PAGE_CHAIN_SQL} GROUP BY player, task_id)
SELECT player, count(*) AS pages, CAST(sum(e) AS BIGINT) AS eligible_candidates, CAST(sum(n) AS BIGINT) AS new_candidates, CAST(sum(e - n) AS BIGINT) AS duplicate_candidates,
  count(*) FILTER (n = 0) AS zero_new_pages, count(*) FILTER (c) AS history_cutoffs,
  round(CAST(sum(e - n) AS DOUBLE) / nullif(sum(e), 0), 4) AS eligible_duplicate_ratio, round(CAST(sum(n) AS DOUBLE) / count(*), 3) AS new_candidates_per_page
FROM o GROUP BY player
"""


@query(_NAVIGATION)
def navigation_totals(spark, sf):
    return counts.navigation_totals(D.page_chains(spark, sf), ["player"])


@query(f"""
WITH r AS {D.REQUEST_SQL}, c AS (SELECT lane, count(*) AS requests, count(*) FILTER (outcome = 'success') AS success, count(*) FILTER (outcome = 'challenge') AS challenge,
  count(*) FILTER (outcome = 'rate_limited') AS rate_limited, count(*) FILTER (outcome = 'error') AS error, count(*) FILTER (outcome = 'not_found') AS not_found,
  count(*) FILTER (parsed) AS parsed_pages, count(*) FILTER (cache_hit) AS cache_hits, count(*) FILTER (missing_candidates > 0) AS missing_pages,
  CAST(sum(missing_candidates) AS BIGINT) AS missing_candidates FROM r GROUP BY lane),
l AS (SELECT lane, list_sort(list(latency_s * 1000)) AS s FROM (SELECT lane, latency_s, row_number() OVER (PARTITION BY lane ORDER BY seq DESC) AS rn FROM r WHERE latency_s IS NOT NULL) WHERE rn <= 256 GROUP BY lane)
SELECT c.*, round(list_sum(s) / len(s), 2) AS latency_avg_ms, round(s[CAST(floor((len(s) - 1) * 0.5) AS INT) + 1], 2) AS latency_p50_ms,
  round(s[CAST(floor((len(s) - 1) * 0.95) AS INT) + 1], 2) AS latency_p95_ms FROM c LEFT JOIN l USING (lane)
""")
def lane_statistics(spark, sf):
    return telemetry.lane_statistics(D.requests(spark, sf))


@query(f"""
SELECT lane, round(list_reduce(list(latency_s ORDER BY seq), lambda a, x: CASE WHEN a = 0 THEN x ELSE 0.2 * x + 0.8 * a END), 6) AS latency_ema
FROM {D.REQUEST_SQL} WHERE latency_s IS NOT NULL GROUP BY lane
""")
def latency_ema(spark, sf):
    return telemetry.latency_average(D.requests(spark, sf)).withColumn("latency_ema", F.round("latency_ema", 6))


@query(f"SELECT battle, side, card, count(*) AS plays FROM {D.MARKER_SQL} GROUP BY ALL")
def card_counts(spark, sf):
    return event_order.card_counts(D.markers(spark, sf), "battle", "side", "card")


@query("SELECT l_orderkey, l_returnflag, count(*) AS events FROM lineitem GROUP BY ALL")
def side_counts(spark, sf):
    return event_order.side_counts(load(spark, sf, "lineitem"), "l_orderkey", "l_returnflag")


@query("""
SELECT CAST(epoch(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')) AS BIGINT) AS start_s, count(*) AS accepted, count(*) / 21600.0::DOUBLE AS per_second
FROM events WHERE event_type = 'purchase' GROUP BY ALL
""")
def throughput_window(spark, sf):
    return telemetry.throughput(load(spark, sf, "events").filter("event_type = 'purchase'"), "ts", "6 hours")


_CHAIN = f"""
WITH p AS (SELECT *, lag(fingerprint) OVER (PARTITION BY player ORDER BY seq) AS before,
    sum(CASE WHEN "new" <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY player ORDER BY seq) AS era FROM {D.PAGE_CHAIN_SQL}),
z AS (SELECT *, CASE WHEN "new" = 0 THEN count(*) FILTER ("new" = 0) OVER (PARTITION BY player, era ORDER BY seq) ELSE 0 END AS zero_chain,
    coalesce(eligible > 0 AND fingerprint = before, false) AS repeated FROM p),
s AS (SELECT *, repeated OR zero_chain >= 2 AS stop_history FROM z)
SELECT player, seq, zero_chain, repeated, stop_history,
  coalesce(max(CASE WHEN stop_history THEN 1 ELSE 0 END) OVER (PARTITION BY player ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS reached FROM s
"""


@query(_CHAIN)
def zero_chain(spark, sf):
    return frontier.chain_decisions(D.page_chains(spark, sf), ["player"], "seq").select(
        "player", "seq", "zero_chain", "repeated", "stop_history", "reached")


@query(_CHAIN)
def zero_chain_in_pieces(spark, sf):
    """The same decisions with pieces far smaller than a player's chain."""
    return frontier.chain_decisions(D.page_chains(spark, sf), ["player"], "seq", span=500).select(
        "player", "seq", "zero_chain", "repeated", "stop_history", "reached")


@query(f"""
WITH c AS (SELECT player, seq, "cursor", lag("cursor") OVER (PARTITION BY player ORDER BY seq) AS previous_cursor FROM {D.PAGE_CHAIN_SQL})
SELECT player, seq, previous_cursor, "cursor" <= 1700000000000 + 300000 AND (previous_cursor IS NULL OR "cursor" < previous_cursor) AS decreasing FROM c
""")
def cursor_monotone(spark, sf):
    return frontier.cursor_steps(D.page_chains(spark, sf), ["player"], "seq", 1_700_000_000_000).select(
        "player", "seq", "previous_cursor", "decreasing")


@query("""
SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber - 1) AS n_distinct, min(l_linenumber - 1) AS low, max(l_linenumber - 1) AS high,
  count(DISTINCT l_linenumber) < count(*) AS duplicate, count(DISTINCT l_linenumber) = count(*) AND min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AS contiguous
FROM lineitem GROUP BY l_orderkey
""")
def marker_contiguous(spark, sf):
    rows = load(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("idx"))
    return event_order.marker_contiguity(rows, "l_orderkey", "idx")


@query(f"""
SELECT battle, count(*) FILTER (tick < before) AS falls, count(*) AS n, count(*) FILTER (tick < before) = 0 AS in_order
FROM (SELECT *, lag(tick) OVER (PARTITION BY battle ORDER BY idx) AS before FROM {D.MARKER_SQL}) GROUP BY battle
""")
def tick_order(spark, sf):
    return event_order.tick_order(D.markers(spark, sf), ["battle"], "idx", "tick")


@query(f"SELECT battle, side, tick, count(*) AS commands FROM {D.MARKER_SQL} GROUP BY ALL HAVING count(*) > 1")
def same_tick(spark, sf):
    return event_order.same_tick(D.markers(spark, sf), ["battle", "side", "tick"])


@query(f"""
WITH t AS (SELECT id, kind NOT IN ('detail', 'upgrade') AS is_list FROM {D.TASK_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY is_list ORDER BY id) - 1 AS i FROM t)
SELECT id, CASE WHEN is_list THEN i * 5 + 4 ELSE (i // 4) * 5 + i % 4 END AS slot FROM r
""")
def interleave_4_1(spark, sf):
    rows = D.tasks(spark, sf).select("id", (~F.col("kind").isin(*counts.READY_KINDS)).alias("is_list"))
    placed = ordered.ranked(rows, ["is_list"], "id", "n")
    return placed.select("id", frontier.slot_4_1(F.col("n"), F.col("is_list")).alias("slot"))


@query(f"""
WITH t AS (SELECT id, dispatch_rank AS r FROM {D.RANKED_TASK_SQL} WHERE dispatch_rank >= 2), n AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY id) - 1 AS i FROM t)
SELECT id, r AS dispatch_rank, CASE r WHEN 4 THEN (i + 1) * 5 + 4 WHEN 3 THEN ((i + 3) // 2) * 5 + 2 * ((i + 3) % 2) + 1 ELSE ((i + 4) // 2) * 5 + 2 * ((i + 4) % 2) END AS slot FROM n
""")
def interleave_bands(spark, sf):
    """Bands entered at position 8 of the repeating order."""
    rows = D.tasks(spark, sf).filter("dispatch_rank >= 2").select("id", "dispatch_rank")
    placed = ordered.ranked(rows, ["dispatch_rank"], "id", "n", span=1000)
    slot = frontier.slot_bands(F.col("n"), F.col("dispatch_rank"), F.lit(True), 8)
    return placed.select("id", "dispatch_rank", slot.alias("slot"))


@query(f"SELECT id, dispatch_rank FROM {D.RANKED_TASK_SQL}")
def dispatch_rank(spark, sf):
    return D.tasks(spark, sf).select("id", "dispatch_rank")


@query(f"SELECT id, dispatch_rank, next_retry_at FROM {D.RANKED_TASK_SQL} WHERE status = 'pending' AND next_retry_at <= 60000 ORDER BY dispatch_rank, next_retry_at, id LIMIT 200")
def ready_topk(spark, sf):
    return frontier.ready_batch(D.tasks(spark, sf), 60000, 200).select("id", "dispatch_rank", "next_retry_at")


@query(f"""
WITH t AS {D.RANKED_TASK_SQL}, h AS (SELECT count(*) FILTER (kind IN ('detail', 'upgrade') AND status = 'inflight') AS r, count(*) FILTER (kind NOT IN ('detail', 'upgrade') AND status = 'inflight') AS l FROM t),
due AS (SELECT * FROM t WHERE status = 'pending' AND next_retry_at <= 90000),
ready AS (SELECT id, row_number() OVER (ORDER BY next_retry_at, id) AS n FROM due WHERE dispatch_rank = 0 QUALIFY n <= (SELECT least(greatest(0, 900 - r), 300) FROM h)),
take AS (SELECT least((SELECT greatest(0, 1400 - l) FROM h), 300 - (SELECT count(*) FROM ready)) AS n),
deps AS (SELECT id, row_number() OVER (ORDER BY next_retry_at, id) AS n FROM due WHERE dispatch_rank = 1 QUALIFY n <= (SELECT n FROM take)),
remaining AS (SELECT (SELECT n FROM take) - (SELECT count(*) FROM deps) AS n),
bands AS (SELECT id, dispatch_rank AS d, next_retry_at, row_number() OVER (PARTITION BY dispatch_rank ORDER BY next_retry_at, id) - 1 AS i FROM due WHERE dispatch_rank > 1),
laid AS (SELECT id, row_number() OVER (ORDER BY CASE d WHEN 4 THEN i * 5 + 4 WHEN 3 THEN (i // 2) * 5 + 2 * (i % 2) + 1 ELSE (i // 2) * 5 + 2 * (i % 2) END, next_retry_at, id) AS n FROM bands),
lists AS (SELECT id, n FROM deps UNION ALL SELECT id, n + (SELECT count(*) FROM deps) FROM laid WHERE n <= (SELECT n FROM remaining))
SELECT id, ((n - 1) // 4) * 5 + (n - 1) % 4 AS slot FROM ready UNION ALL SELECT id, (n - 1) * 5 + 4 FROM lists
""")
def dispatch_batch(spark, sf):
    return jobs.dispatch(D.tasks(spark, sf), 90000, 300, 900, 1400).select("id", "slot")


@query("""
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000), m AS (SELECT o_orderkey, o_custkey, o_custkey IN (FROM a) AS was FROM orders),
f AS (SELECT o_custkey, min(o_orderkey) AS k FROM m WHERE NOT was GROUP BY o_custkey ORDER BY k, o_custkey LIMIT (SELECT greatest(0, 900 - count(*)) FROM a))
SELECT o_orderkey, CASE WHEN was THEN 'recommitted' WHEN o_custkey IN (SELECT o_custkey FROM f) THEN 'accepted' ELSE 'skipped' END AS admission FROM m
""")
def cap_accept(spark, sf):
    o = load(spark, sf, "orders")
    before = o.filter("o_orderstatus = 'F' AND o_totalprice > 400000").select("o_custkey")
    return admission.capped(o.select("o_orderkey", "o_custkey"), before, 900, "o_orderkey", "o_custkey").select("o_orderkey", "admission")


_VISIT_STATE = f"""
WITH v AS {D.VISIT_SQL}, m AS (SELECT url, max(seq) FILTER (ok) AS lo, max(seq) FILTER (ok AND new_count > 0) AS ln FROM v GROUP BY url),
g AS (SELECT v.url, count(*) AS generation, count(*) FILTER (NOT ok AND (lo IS NULL OR seq > lo)) AS failures, count(*) FILTER (ok AND (ln IS NULL OR seq > ln)) AS zero_new_streak,
  arg_max("at", seq) AS at_, arg_max(ok, seq) AS lok, arg_max(coalesce(error, ''), seq) AS err, arg_max("at", seq) FILTER (ok) AS fetched_at,
  arg_max(new_count, seq) FILTER (ok) AS last_new, arg_max(html_sha256, seq) FILTER (ok) AS html_sha256 FROM v JOIN m USING (url) GROUP BY v.url)
SELECT url, generation, failures, zero_new_streak, fetched_at, fetched_at + 1800.0::DOUBLE AS cache_expires_at, last_new, html_sha256, CASE WHEN NOT lok THEN err END AS last_error,
  at_ + CASE WHEN lok THEN least(7200.0::DOUBLE, 1800.0 * pow(2, least(zero_new_streak, 8))) ELSE least(7200.0::DOUBLE, 300.0 * pow(2, least(failures - 1, 8))) END AS due FROM g
"""


@query(_VISIT_STATE)
def visit_state(spark, sf):
    return revisit.visit_state(D.visits(spark, sf), "url", 1800.0, 7200.0)


@query(f"SELECT count(*) AS scheduled, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS failed, CAST(sum(new_count) FILTER (ok) AS BIGINT) AS new_items, count(DISTINCT url) AS tracked FROM {D.VISIT_SQL}")
def visit_totals(spark, sf):
    return revisit.visit_totals(D.visits(spark, sf), "url")


_STATE = {
    "url": "'/players/' || c_custkey", "player_key": "'player:' || c_custkey", "generation": "c_custkey % 9",
    "active_task_id": "CASE WHEN c_custkey % 4 = 0 THEN c_custkey END", "due": "CAST((c_custkey * 31) % 5000 AS DOUBLE)",
    "last_error": "CASE WHEN c_custkey % 10 = 0 THEN 'old' END",
}
_RELEASED = f"""
f AS (SELECT s.url, s.player_key, s.generation, CASE WHEN e.id IS NULL THEN s.active_task_id END AS active_task_id,
  CASE WHEN e.id IS NULL THEN s.due ELSE 4300.0::DOUBLE END AS due, CASE WHEN e.id IS NULL THEN s.last_error ELSE 'previous source task ended unexpectedly' END AS last_error
  FROM {D._sql(_STATE, "customer")} s LEFT JOIN (SELECT id FROM {D.TASK_SQL} WHERE status NOT IN ('pending', 'inflight')) e ON s.active_task_id = e.id)
"""


@query(f"WITH {_RELEASED} SELECT * FROM f")
def release_ended(spark, sf):
    state = D._df(spark, sf, "customer", _STATE)
    return revisit.release_ended(state, D.tasks(spark, sf), 4000.0, 300.0, "previous source task ended unexpectedly")


@query(f"""
WITH {_RELEASED}, n AS (SELECT count(*) AS active FROM {D.TASK_SQL} WHERE kind = 'source' AND status IN ('pending', 'inflight'))
SELECT url, 'source' AS kind, generation + 1 AS generation, 'source:' || sha256(url) || ':' || (generation + 1) AS dedup_key
FROM f WHERE active_task_id IS NULL AND due <= 4000 ORDER BY due, url LIMIT (SELECT greatest(0, 2500 - active) FROM n)
""")
def plan_sources(spark, sf):
    return revisit.plan_sources(D._df(spark, sf, "customer", _STATE), D.tasks(spark, sf), 4000.0, 2500, 300.0)


@query(f"""
WITH {_RELEASED}, a AS (SELECT count(*) AS active FROM f WHERE active_task_id IS NOT NULL),
e AS (SELECT count(*) >= 100000 AS enough FROM {D.RANKED_TASK_SQL} WHERE status = 'pending' AND dispatch_rank = 2 AND next_retry_at <= 4000)
SELECT url, 'list' AS kind, player_key, generation + 1 AS generation, 0 AS discovery_band, player_key || ':revisit:' || (generation + 1) AS dedup_key
FROM f WHERE active_task_id IS NULL AND due <= 4000 AND NOT (SELECT enough FROM e) ORDER BY due, player_key LIMIT (SELECT least(40, greatest(0, 700 - active)) FROM a)
""")
def plan_revisits(spark, sf):
    return revisit.plan_revisits(D._df(spark, sf, "customer", _STATE), D.tasks(spark, sf), 4000.0, 40, 700, 100_000, 300.0)


@query(f"""
WITH t AS ({_WORK_STATE}), n AS (SELECT * FROM (SELECT count(*) AS pages, CAST(sum(e) AS BIGINT) AS eligible_candidates, CAST(sum(n) AS BIGINT) AS new_candidates, CAST(sum(e - n) AS BIGINT) AS duplicate_candidates,
    count(*) FILTER (n = 0) AS zero_new_pages, count(*) FILTER (c) AS history_cutoffs, round(CAST(sum(e - n) AS DOUBLE) / sum(e), 4) AS eligible_duplicate_ratio, round(CAST(sum(n) AS DOUBLE) / count(*), 3) AS new_candidates_per_page
    FROM (SELECT task_id, arg_min(eligible, seq) AS e, arg_min("new", seq) AS n, arg_min(cutoff, seq) AS c FROM {D.PAGE_CHAIN_SQL} GROUP BY task_id))),
d AS (SELECT count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'queued') AS queued FROM {D.DECISION_SQL}),
v AS (SELECT count(*) AS scheduled, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS failed, CAST(sum(new_count) FILTER (ok) AS BIGINT) AS new_items, count(DISTINCT url) AS tracked FROM {D.VISIT_SQL}),
a AS (SELECT count(*) FILTER (event_type = 'purchase' AND ts > TIMESTAMP '2024-01-30 11:00:00') / 3600.0::DOUBLE AS accepted_per_second, 300000 / 86400.0::DOUBLE AS target_per_second FROM events)
SELECT 'tasks' AS section, name, CAST(value AS DOUBLE) AS value FROM (UNPIVOT t ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL SELECT 'navigation', name, value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM n) ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL SELECT 'decisions', name, value FROM (UNPIVOT d ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL SELECT 'sources', name, value FROM (UNPIVOT v ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL SELECT 'throughput', name, value FROM (UNPIVOT a ON COLUMNS(*) INTO NAME name VALUE value)
""")
def status_report(spark, sf):
    purchases = load(spark, sf, "events").filter("event_type = 'purchase'").select(F.col("ts").alias("accepted_at"))
    return jobs.status(
        D.tasks(spark, sf), D.decision_log(spark, sf), D.page_chains(spark, sf), D.visits(spark, sf), purchases,
        F.lit("2024-01-30 12:00:00").cast("timestamp"))
