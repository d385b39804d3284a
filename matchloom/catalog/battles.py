"""Extraction from rendered pages: list pages, decks, replays, events."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog import rendering as R
from matchloom.catalog.derived import AUTHORITATIVE, COMPLETE, FACTS_SQL, NORMAL
from matchloom.catalog.registry import query
from matchloom.functions import times as T
from matchloom.functions import urls as U
from matchloom.functions import keys as K
from matchloom.operators import gate, list_pages, predicates, replays, select
from matchloom.plans import jobs
from matchloom.session import load


def _pages(spark, sf, mirrored=False):
    orders = load(spark, sf, "orders")
    return R.list_pages(orders, mirrored, R.tasks_for(orders))


def _payloads(spark, sf):
    orders = load(spark, sf, "orders")
    return R.replay_payloads(orders.repartition(R.tasks_for(orders), "o_orderkey"))


def _battles(spark, sf, mirrored=False):
    return list_pages.battles(_pages(spark, sf, mirrored), R.BASE)


@query(f"""
SELECT tag AS battle_tag, bare AS bare_button, {COMPLETE} AS complete, {NORMAL} AS normal_1v1, {AUTHORITATIVE} AS authoritative_complete,
  CASE WHEN NOT bare THEN k % 17 = 5 END AS draft, CASE WHEN NOT bare THEN CASE WHEN k % 13 = 4 THEN '2v2' ELSE 'Ranked' END END AS game_mode,
  CASE WHEN NOT bare THEN CASE WHEN k % 29 = 6 THEN 'riverRaceDuel' ELSE 'trail' END END AS battle_type,
  CASE WHEN NOT bare AND k % 23 <> 9 THEN CAST(72000000 + k % 5 AS INT) END AS numeric_game_mode_id, CASE WHEN NOT bare THEN CAST(1000000 + k AS INT) END AS battle_index,
  CASE WHEN NOT bare AND k % 23 <> 9 THEN '1v1' END AS matchup_players, CASE WHEN NOT bare THEN owner ELSE '' END AS team, CASE WHEN NOT bare THEN rival ELSE '' END AS opponent,
  CASE WHEN NOT bare THEN CAST(k % 4 AS INT) END AS team_crowns, CASE WHEN NOT bare THEN CAST((k + 1) % 3 AS INT) END AS opponent_crowns,
  NOT bare AND k % 23 <> 9 AND k % 31 <> 8 AS deck_crosscheck_complete,
  'http://corpus.example/data/replay?tag=' || tag || '&team_tags=' || owner || '&opponent_tags=' || rival || '&team_crowns=' || (k % 4) || '&opponent_crowns=' || ((k + 1) % 3)
    || '&referrer_path=http://corpus.example/player/' || owner || '/battles' AS replay_url
FROM {FACTS_SQL}
""")
def list_battles(spark, sf):
    return _battles(spark, sf).select(
        "battle_tag", "bare_button", "complete", "normal_1v1", "authoritative_complete", "draft", "game_mode", "battle_type",
        "numeric_game_mode_id", "battle_index", "matchup_players", F.array_join("team_tags", ",").alias("team"),
        F.array_join("opponent_tags", ",").alias("opponent"), "team_crowns", "opponent_crowns", "deck_crosscheck_complete", "replay_url")


@query(f"""
SELECT tag AS battle_tag, CASE WHEN NOT bare THEN ts END AS timestamp, CASE WHEN NOT bare THEN strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') END AS battle_time_utc,
  CASE WHEN NOT bare THEN CASE WHEN k % 5 IN (1, 3) THEN 'timestamp_popup_utc' ELSE 'derived_from_list_timestamp' END END AS battle_time_utc_provenance FROM {FACTS_SQL}
""")
def battle_times(spark, sf):
    return _battles(spark, sf).select("battle_tag", "timestamp", "battle_time_utc", "battle_time_utc_provenance")


_HP_KING = "CASE WHEN k % 2 = 0 THEN 7728 ELSE 5000 + k % 100 END"


@query(f"""
SELECT tag AS battle_tag, CAST({_HP_KING} AS INT) AS king, CAST(k % 3000 AS INT) AS princess0, CAST(k % 7 AS INT) AS princess1, CAST({_HP_KING} + k % 3000 + k % 7 AS INT) AS total
FROM {FACTS_SQL} WHERE NOT bare AND k % 19 <> 7
""")
def tower_hp(spark, sf):
    hp = F.col("final_tower_hp.opponent")
    return _battles(spark, sf).filter("final_tower_hp IS NOT NULL").select(
        "battle_tag", hp["king"].alias("king"), hp["princess0"].alias("princess0"), hp["princess1"].alias("princess1"), hp["total"].alias("total"))


@query(f"""
WITH d AS (SELECT tag, k, s, j, (k * 3 + s * 5 + j * 13) % 104 AS b, (k + j + s) % 9 AS f FROM {FACTS_SQL}, range(0, 2) a(s), range(0, 8) c(j) WHERE NOT bare)
SELECT tag AS battle_tag, CASE s WHEN 0 THEN 'team' ELSE 'opponent' END AS side, CAST(j AS INT) AS slot,
  'card' || b || CASE f WHEN 0 THEN '-ev1' WHEN 1 THEN '-hero' ELSE '' END AS slug, 'card' || b AS base_slug, CASE f WHEN 0 THEN 'ev1' WHEN 1 THEN 'hero' ELSE 'base' END AS form,
  CASE WHEN s = 0 AND j = 0 AND k % 10 = 3 THEN NULL ELSE CAST(9 + (k + j) % 8 AS INT) END AS level, 'tower' || (k % 4) AS tower, CAST(14 + (k + s) % 3 AS INT) AS tower_level FROM d
""")
def deck_cards(spark, sf):
    def side(name):
        return F.transform(F.col("rounds")[0][name], lambda p: F.struct(F.lit(name).alias("side"), p.alias("p")))

    players = _battles(spark, sf).filter("size(rounds) = 1").select(
        "battle_tag", F.explode(F.concat(side("team"), side("opponent"))).alias("x"))
    cards = players.select("battle_tag", "x.side", F.explode("x.p.deck_cards").alias("c"), F.col("x.p.tower_troop").alias("tower"),
                           F.col("x.p.tower_troop_level").alias("tower_level"))
    return cards.select("battle_tag", "side", "c.*", "tower", "tower_level")


@query(f"""
WITH t AS (SELECT page_no, tag, p, min(n) AS n FROM (
  SELECT page_no, owner AS p, k * 2 AS n, bare, tag FROM {FACTS_SQL} UNION ALL SELECT page_no, rival, k * 2 + 1, bare, tag FROM {FACTS_SQL}) GROUP BY ALL),
o AS (SELECT page_no, p, min(n + CASE WHEN (n // 2) % 37 = 11 THEN 1000000000 ELSE 0 END) AS n FROM t GROUP BY ALL)
SELECT page_no, string_agg(p, ',' ORDER BY n) AS players FROM o GROUP BY page_no
""")
def list_players(spark, sf):
    return _pages(spark, sf).select("page_no", F.array_join(list_pages.player_tags(F.col("body")), ",").alias("players"))


@query(f"""
SELECT page_no, CASE WHEN page_no % 3 <> 1 THEN 'http://corpus.example/player/OWN' || page_no || '/battles/history?before=' || (min(k) + 1000000000000) END AS url,
  CAST(NULL AS VARCHAR) AS error, page_no % 3 <> 1 AND (min(k) + 1000000000000) // 1000 >= 1000000001 AS in_window FROM {FACTS_SQL} GROUP BY page_no
""")
def next_pages(spark, sf):
    pages = _pages(spark, sf).select("page_no", list_pages.next_page(F.col("body"), R.BASE).alias("n"))
    inside = T.page_in_window(U.query_param(F.col("n.url"), "before"), 1_000_000_001)
    return pages.select("page_no", "n.url", "n.error", (F.col("n.url").isNotNull() & inside).alias("in_window"))


@query(f"SELECT tag AS battle_tag, 'team' AS side, owner AS player FROM {FACTS_SQL} WHERE NOT bare UNION ALL SELECT tag, 'opponent', rival FROM {FACTS_SQL} WHERE NOT bare")
def battle_edges(spark, sf):
    return list_pages.edges(_battles(spark, sf)).select("battle_tag", "side", "player")


@query(f"""SELECT tag AS battle_tag, 'http://corpus.example/player/OWN' || page_no || '/battles' AS url, owner AS team FROM {FACTS_SQL} WHERE NOT bare""")
def first_perspective(spark, sf):
    """Every battle is shown on both players' pages; the page captured first names its sides."""
    both = _battles(spark, sf).unionByName(_battles(spark, sf, True).withColumn("seq", F.col("seq") + 1_000_000_000))
    shown = both.filter(~F.col("bare_button")).select("battle_tag", "url", "seq", "position", F.array_join("team_tags", ",").alias("team"))
    return select.first_by(shown, ["battle_tag"], "seq", "position").select("battle_tag", "url", "team")


@query(f"""
SELECT page_no, sha256(string_agg(tag, chr(10) ORDER BY tag)) AS fingerprint FROM {FACTS_SQL} GROUP BY page_no
""")
def battle_page_fingerprint(spark, sf):
    tags = F.regexp_extract_all("body", F.lit('data-replay="([^"]*)"'), F.lit(1))
    return _pages(spark, sf).select("page_no", K.fingerprint(tags).alias("fingerprint"))


_LOW, _HIGH = 850_000_000, 950_000_000


@query(f"""
WITH f AS (SELECT *, {NORMAL} AS n, {NORMAL} AND ts >= {_LOW} AND ts < {_HIGH} AS e FROM {FACTS_SQL})
SELECT page_no, count(*) AS candidates, count(*) FILTER (n) AS normal_1v1, count(*) FILTER (e) AS eligible, CAST(0 AS BIGINT) AS timestamp_missing,
  count(*) FILTER (n AND ts < {_LOW}) AS timestamp_old, count(*) FILTER (n AND ts >= {_HIGH}) AS timestamp_after, count(*) FILTER (NOT e) AS filtered FROM f GROUP BY page_no
""")
def page_funnel(spark, sf):
    return predicates.funnel(_battles(spark, sf), gate.eligible(low=_LOW, high=_HIGH), _LOW, _HIGH, ["page_no"])


_OUTCOME = (
    "CASE WHEN k % 41 = 8 THEN 'login_required' WHEN k % 43 = 9 THEN 'replay_not_found' WHEN k % 47 = 10 THEN 'not_json' "
    "WHEN k % 21 = 4 OR k % 22 = 5 THEN 'marker_rejected' ELSE 'ok' END"
)
_ERROR = f"CASE WHEN {_OUTCOME} <> 'marker_rejected' THEN NULL WHEN k % 22 = 5 THEN 'tick_invalid' ELSE 'orientation_invalid' END"
_DURATION = "CASE WHEN k % 25 = 7 THEN 400 ELSE 30 + k % 20 END"


_BODIES = {
    0: ("'{\"success\":true,\"html\":\"<div class=''a''>x' || k || '</div>\"}'", "'<div class=''a''>x' || k || '</div>'"),
    1: ("'<html><body><pre style=''x''> {\"html\":\"<div class=''a''>y &amp; z' || k || '</div>\"} </pre></body></html>'", "'<div class=''a''>y &amp; z' || k || '</div>'"),
    2: ("'<pre>{\"html\":\"&lt;b&gt;t &amp;amp; u' || k || '&lt;/b&gt;\"}</pre>'", "'<b>t &amp; u' || k || '</b>'"),
    3: ("'<p>{\"html\":\"plain ' || k || '\"}</p>'", "'plain ' || k"),
    4: ("'<pre>{&quot;html&quot;:&quot;q' || k || '&quot;}</pre>'", "'q' || k"),
    5: ("'  <pre>{\"html\":\"<pre>inner'", "NULL"),
    6: ("'<pre>{\"success\":false,\"html\":\"<i>Requires login</i>\"}</pre>'", "'<i>Requires login</i>'"),
    7: ("'<div>gateway error</div>'", "NULL"),
}

@query(f"""
WITH o AS (SELECT o_orderkey AS k FROM orders)
SELECT k, CASE k % 8 {' '.join(f'WHEN {i} THEN {html}' for i, (_, html) in _BODIES.items())} END AS html,
  CASE WHEN k % 8 IN (5, 7) THEN 'not_json' WHEN k % 8 = 6 THEN 'login_required' ELSE 'ok' END AS outcome FROM o
""")
def payload_unwrap(spark, sf):
    """Responses as they come: bare, wrapped by a browser with its markup raw or escaped, and damaged."""
    body = f"CASE k % 8 {' '.join(f'WHEN {i} THEN {text}' for i, (text, _) in _BODIES.items())} END".replace("''a''", "\\'a\\'").replace("''x''", "\\'x\\'")
    return replays.unwrap(load(spark, sf, "orders").selectExpr("o_orderkey AS k").selectExpr("k", f"{body} AS body")).select("k", "html", "outcome")


@query(f"""
SELECT tag AS battle_tag, {_OUTCOME} AS outcome, {_ERROR} AS parse_error,
  CASE WHEN {_OUTCOME} IN ('ok', 'marker_rejected') THEN CAST({_DURATION} AS INT) END AS duration_seconds,
  CASE WHEN {_OUTCOME} IN ('ok', 'marker_rejected') THEN 16 END AS plays,
  CASE WHEN {_OUTCOME} IN ('ok', 'marker_rejected') THEN CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END END AS abilities FROM {FACTS_SQL}
""")
def replay_outcomes(spark, sf):
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).alias
    return jobs.replay_etl(_payloads(spark, sf)).select(
        "battle_tag", "outcome", "parse_error", "duration_seconds", size("card_plays")("plays"), size("ability_plays")("abilities"))


_X, _Y = "(k * 37 + j * 1130) % 18001", "(k * 91 + j * 2050) % 32001"


@query(f"""
WITH e AS (SELECT tag AS battle_tag, k, j, s, {_X} AS x, {_Y} AS y, (k + j) % 2 AS i FROM {FACTS_SQL}, range(0, 8) c(j), range(0, 2) a(s) WHERE {_OUTCOME} = 'ok')
SELECT battle_tag, CAST(j * 2 + s AS INT) AS marker_index, 'play' AS event_kind, CASE s WHEN 0 THEN 'team' ELSE 'opponent' END AS side, 'card' || ((k * 3 + s * 5 + j * 13) % 104) AS card,
  CAST(CASE WHEN k % 33 = 3 AND j = 5 THEN 100 + k % 5 ELSE 20 * (j + 1) + k % 5 END AS INT) AS time_raw, CAST(CASE i WHEN 0 THEN 18000 - x ELSE x END AS INT) AS x,
  CAST(CASE i WHEN 0 THEN 32000 - y ELSE y END AS INT) AS y, CASE i WHEN 0 THEN 'rotate_180' ELSE 'identity' END AS coordinate_transform FROM e
UNION ALL SELECT tag, 16, 'ability', 'team', NULL, 300, NULL, NULL, NULL FROM {FACTS_SQL} WHERE {_OUTCOME} = 'ok' AND k % 6 = 0
""")
def replay_events(spark, sf):
    documents = jobs.replay_etl(_payloads(spark, sf)).filter("outcome = 'ok'")
    return replays.events(documents, "battle_tag").select(
        "battle_tag", "marker_index", "event_kind", "side", "card", "time_raw", "x", "y", "coordinate_transform")


_T1, _T2 = "(8 + CASE WHEN k % 27 = 2 THEN 1 ELSE 0 END)", "(8 + CASE WHEN k % 53 = 11 THEN 1 ELSE 0 END)"


@query(f"""
WITH t AS (SELECT tag, k, {_T1} AS a, {_T2} AS b FROM {FACTS_SQL} WHERE {_OUTCOME} = 'ok'),
s AS (SELECT *, CASE WHEN a = 8 THEN 1 WHEN b = 8 THEN 2 ELSE 1 END AS team_table FROM t)
SELECT tag AS battle_tag, CAST(CASE team_table WHEN 1 THEN a ELSE b END AS INT) AS team_total, CAST(b AS INT) AS opponent_total,
  CAST(CASE WHEN team_table = 1 AND k % 6 = 0 THEN 1 ELSE 0 END AS INT) AS team_abilities, 20 + k % 9 + 0.5::DOUBLE AS team_elixir, 8 AS team_cards FROM s
""")
def elixir_tables(spark, sf):
    def entry(side, title):
        return F.try_element_at(F.col("elixir_stats")[side], F.lit(title))

    return jobs.replay_etl(_payloads(spark, sf)).filter("outcome = 'ok'").select(
        "battle_tag", entry("team", "Total")["count"].alias("team_total"), entry("opponent", "Total")["count"].alias("opponent_total"),
        entry("team", "Ability")["count"].alias("team_abilities"), entry("team", "Total")["elixir"].alias("team_elixir"),
        F.size("card_counts.team").alias("team_cards"))


@query(f"""
WITH r AS (SELECT tag, k, CAST(k % 6 AS INT) AS v, {_OUTCOME} AS o FROM {FACTS_SQL})
SELECT tag AS battle_tag, v AS source_schema_version, CASE WHEN v NOT IN (3, 4) THEN 'source_schema_not_exact'
  WHEN k % 29 = 1 THEN 'deployment_exact_tick_missing' WHEN k % 31 = 2 THEN 'raw_coordinate_upgrade_failed:orientation_invalid' END AS upgrade_error FROM r WHERE o = 'ok'
""")
def upgrade_legacy(spark, sf):
    """Documents as an older version: derived coordinates wrong, some ticks or orientations lost."""
    def spoil(e):
        return (
            e.withField("x", F.lit(-1)).withField("coordinate_transform", F.lit("old"))
            .withField("time_raw", F.when(F.col("k") % 29 != 1, e["time_raw"]))
            .withField("data_i", F.when(F.col("k") % 31 != 2, e["data_i"]))
        )

    documents = jobs.replay_etl(_payloads(spark, sf)).filter("outcome = 'ok'").withColumn("k", F.col("seq"))
    old = documents.withColumns({
        "schema_version": (F.col("k") % 6).cast("int"), "card_plays": F.transform("card_plays", spoil)})
    return replays.upgrade_legacy(old).select("battle_tag", "source_schema_version", "upgrade_error")
