"""Cohorts, the player pool, boards, profiles and set steps over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog import rendering as R
from matchloom.catalog import derived as D
from matchloom.catalog.registry import query
from matchloom.operators import cohort, list_pages, predicates, revisit, select, setops, upgrade
from matchloom.plans import jobs
from matchloom.session import load

_BATTLE = {
    "battle_tag": "'B' || o_orderkey",
    "team_tag": "'#tag' || o_custkey",
    "opponent_tag": "'TAG' || ((o_custkey * 7 + 3) % 1500)",
}
_MEMBER = {"tag": "'TAG' || c_custkey", "rank": "c_custkey + 1", "rank_season": "'2024-0' || (1 + c_nationkey % 9)"}
_MEMBER_FILTER = "c_mktsegment = 'BUILDING'"


def _people(spark, sf):
    """Customers, dealt to as many tasks as rendering and reading a page of each needs."""
    people = load(spark, sf, "customer")
    return people.repartition(R.tasks_for(people), "c_custkey")


def _battles(spark, sf):
    return D._df(spark, sf, "orders", _BATTLE).select(
        "battle_tag", F.array("team_tag").alias("team_tags"), F.array("opponent_tag").alias("opponent_tags"))


def _members(spark, sf):
    return load(spark, sf, "customer").filter(_MEMBER_FILTER).selectExpr(*[f"{e} AS {n}" for n, e in _MEMBER.items()])


_MEMBER_SQL = "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in _MEMBER.items()) + f" FROM customer WHERE {_MEMBER_FILTER})"
_SIDES_SQL = f"""
b AS {D._sql(_BATTLE, "orders")}, m AS {_MEMBER_SQL},
s AS (SELECT battle_tag, 0 AS side_order, 'team' AS side, upper(ltrim(team_tag, '#')) AS tag FROM b
      UNION ALL SELECT battle_tag, 1, 'opponent', opponent_tag FROM b)
"""


@query(f'WITH {_SIDES_SQL} SELECT battle_tag, side, tag, "rank", rank_season FROM s JOIN m USING (tag)')
def side_members(spark, sf):
    return predicates.member_sides(_battles(spark, sf), _members(spark, sf)).drop("side_order")


@query(f"WITH {_SIDES_SQL} SELECT DISTINCT battle_tag FROM s WHERE tag IN (SELECT tag FROM m)")
def member_battles(spark, sf):
    return predicates.with_member_side(_battles(spark, sf), _members(spark, sf)).select("battle_tag")


@query(f"""WITH {_SIDES_SQL} SELECT battle_tag, string_agg(side || ':' || tag || ':' || "rank" || ':' || rank_season, ',' ORDER BY side_order, tag) AS experts
FROM s JOIN m USING (tag) GROUP BY battle_tag""")
def expert_sides(spark, sf):
    rows = predicates.with_expert_sides(_battles(spark, sf), _members(spark, sf))
    return rows.select("battle_tag", F.array_join(F.transform("expert_sides", lambda e: F.concat_ws(
        ":", e["side"], e["tag"], e["rank"].cast("string"), e["rank_season"])), ",").alias("experts"))


_RANKING = {"rank": "CASE WHEN c_custkey % 97 = 5 THEN NULL WHEN c_custkey % 50 = 7 THEN c_custkey ELSE c_custkey + 1 END", "tag": "CASE WHEN c_custkey % 211 = 9 THEN '?' ELSE '#tag' || (c_custkey - CASE WHEN c_custkey % 60 = 8 THEN 1 ELSE 0 END) END"}


@query(f"""
WITH r AS (SELECT "rank", CASE WHEN tag <> '?' THEN upper(ltrim(tag, '#')) END AS tag FROM {D._sql(_RANKING, "customer")}),
k AS (SELECT * FROM r WHERE "rank" BETWEEN 1 AND 1200 AND tag IS NOT NULL)
SELECT 'invalid_row' AS problem, "rank", tag FROM r WHERE "rank" IS NULL OR "rank" < 1 OR tag IS NULL
UNION ALL SELECT 'rank_conflict', "rank", min(tag) FROM k GROUP BY "rank" HAVING min(tag) <> max(tag)
UNION ALL SELECT 'player_conflict', min("rank"), tag FROM k GROUP BY tag HAVING min("rank") <> max("rank")
UNION ALL SELECT 'rank_missing', n, NULL FROM range(1, 1201) t(n) WHERE n NOT IN (SELECT "rank" FROM k)
""")
def rank_cohort_problems(spark, sf):
    return cohort.ranked_problems(D._df(spark, sf, "customer", _RANKING), 1200)


@query("SELECT c_custkey + 1 AS \"rank\", 'TAG' || c_custkey AS tag FROM customer WHERE c_custkey < least(1000, (SELECT count(*) FROM customer))")
def rank_cohort(spark, sf):
    rows = load(spark, sf, "customer").selectExpr("c_custkey + 1 AS rank", "'tag' || c_custkey AS tag")
    return cohort.ranked_players(rows, min(1000, rows.count()))


_PROOF = {
    "seq": "o_orderkey", "tag": "'tag' || o_custkey", "rank": "(o_orderkey * 13) % 15000",
    "rank_season": "CASE WHEN o_orderkey % 500 = 3 THEN '2024-13' WHEN o_orderkey % 300 = 4 THEN '2025-01' ELSE '2023-0' || (1 + o_orderkey % 9) END",
}
_PROOF_OK = "o_orderkey % 500 <> 3 AND o_orderkey % 300 <> 4"


@query(f"""
WITH p AS (SELECT seq, upper(tag) AS tag, "rank", CASE WHEN rank_season NOT LIKE '%-13' THEN rank_season END AS rank_season FROM {D._sql(_PROOF, "orders")})
SELECT 'invalid_proof' AS problem, tag, rank_season FROM p WHERE rank_season IS NULL OR rank_season > '2024-12'
UNION ALL SELECT 'season_conflict', tag, rank_season FROM p WHERE rank_season <= '2024-12' GROUP BY tag, rank_season HAVING min("rank") <> max("rank")
""")
def pool_evidence_problems(spark, sf):
    return cohort.historical_problems(D._df(spark, sf, "orders", _PROOF), "2024-12")


@query(f"""
WITH p AS (SELECT upper(tag) AS tag, min(seq) AS seq, arg_min(rank_season, seq) AS rank_season, arg_min("rank", seq) AS "rank"
  FROM {D._sql(_PROOF, "orders")} WHERE "rank" BETWEEN 1 AND 10000 AND rank_season NOT LIKE '%-13' GROUP BY 1)
SELECT * FROM p ORDER BY seq LIMIT 700
""")
def pool_first_n(spark, sf):
    proofs = D._df(spark, sf, "orders", _PROOF).filter("rank_season NOT LIKE '%-13'")
    return cohort.first_qualified(proofs, 700)


@query(f"""
WITH m AS {_MEMBER_SQL}, p AS (SELECT upper(tag) AS tag, min(seq) AS seq, arg_min(rank_season, seq) AS rank_season, arg_min("rank", seq) AS "rank"
  FROM (SELECT * FROM {D._sql(_PROOF, f"(SELECT * FROM orders WHERE {_PROOF_OK})")} WHERE "rank" BETWEEN 1 AND 10000) GROUP BY 1)
SELECT tag, seq, rank_season, "rank" FROM p WHERE tag NOT IN (SELECT tag FROM m) ORDER BY seq LIMIT 500
""")
def pool_admit(spark, sf):
    proofs = load(spark, sf, "orders").filter(_PROOF_OK).selectExpr(*[f"{e} AS {n}" for n, e in _PROOF.items()])
    return cohort.new_members(proofs.filter("rank BETWEEN 1 AND 10000"), _members(spark, sf), 500)


@query(f"""
WITH m AS {_MEMBER_SQL}, p AS (SELECT seq, upper(tag) AS tag, "rank", CASE WHEN rank_season NOT LIKE '%-13' THEN rank_season END AS rank_season FROM {D._sql(_PROOF, "orders")}),
g AS (SELECT * FROM p WHERE "rank" BETWEEN 1 AND 10000 AND rank_season <= '2024-12'),
f AS (SELECT tag, arg_min(rank_season, seq) AS s, arg_min("rank", seq) AS r FROM g GROUP BY tag)
SELECT 'invalid_proof' AS problem, tag, rank_season FROM p WHERE NOT coalesce("rank" BETWEEN 1 AND 10000, false) OR rank_season IS NULL OR rank_season > '2024-12'
UNION ALL SELECT 'contradicts_member', g.tag, g.rank_season FROM g JOIN m ON g.tag = m.tag AND g.rank_season = m.rank_season AND g."rank" <> m."rank"
UNION ALL SELECT 'contradicts_batch', g.tag, g.rank_season FROM g JOIN f ON g.tag = f.tag AND g.rank_season = f.s AND g."rank" <> f.r WHERE g.tag NOT IN (SELECT tag FROM m)
""")
def pool_admission_problems(spark, sf):
    return cohort.admission_problems(D._df(spark, sf, "orders", _PROOF), _members(spark, sf), "2024-12")


@query(f"""
WITH m AS {_MEMBER_SQL}, known AS (SELECT 'TAG' || s_suppkey AS tag FROM supplier), o AS (SELECT upper(tag) AS tag, min(seq) AS seq FROM {D._sql(_PROOF, "orders")} GROUP BY 1)
SELECT tag, seq FROM o WHERE tag NOT IN (SELECT tag FROM m) AND tag NOT IN (SELECT tag FROM known) ORDER BY seq LIMIT 600
""")
def pool_offer(spark, sf):
    offers = D._df(spark, sf, "orders", _PROOF).select("tag", "seq")
    known = load(spark, sf, "supplier").selectExpr("'TAG' || s_suppkey AS tag")
    return cohort.new_candidates(offers, _members(spark, sf), known, 600)


@query(f"""
SELECT 'target' AS name, 10000 AS value UNION ALL SELECT 'verified', count(*) FROM customer WHERE {_MEMBER_FILTER}
UNION ALL SELECT 'candidates', count(*) FROM supplier UNION ALL SELECT 'sources', count(*) FROM nation
""")
def pool_statistics(spark, sf):
    return cohort.pool_statistics(_members(spark, sf), load(spark, sf, "supplier"), load(spark, sf, "nation"), 10000)


_SOURCE = "'/players/' || (o_custkey % 400)"


@query(f"""
WITH e AS (SELECT '/players/' || s_suppkey AS url FROM supplier), u AS (SELECT {_SOURCE} AS url, min(o_orderkey) AS seq FROM orders GROUP BY 1)
SELECT * FROM u WHERE url NOT IN (SELECT url FROM e) ORDER BY seq LIMIT (SELECT greatest(0, 300 - count(*)) FROM e)
""")
def register_sources(spark, sf):
    held = load(spark, sf, "supplier").selectExpr("'/players/' || s_suppkey AS url")
    offered = load(spark, sf, "orders").selectExpr(f"{_SOURCE} AS url", "o_orderkey AS seq")
    return revisit.register_sources(held, offered, 300)


@query("SELECT (c_custkey // 100) * 1000000 + c_custkey % 100 AS seq, c_custkey + 1 AS \"rank\", 'TAG' || c_custkey AS tag FROM customer")
def board_rows(spark, sf):
    pages = R.board_pages(load(spark, sf, "customer"), "2024-08")
    return cohort.board_rows(pages, "2024-08").filter("page_error IS NULL").select(
        (F.col("seq") * 1_000_000 + F.col("position")).alias("seq"), "rank", "tag")


_PROFILE_SQL = """
p AS (SELECT c_custkey, unnest([struct_pack(s := '2024-03', r := 1 + (c_custkey * 7919) % 12000), struct_pack(s := '2024-05', r := 1 + (c_custkey * 104729) % 12000),
  struct_pack(s := '2024-09', r := 1 + (c_custkey * 1299709) % 12000)], recursive := true) FROM customer)
"""


@query(f"""
WITH {_PROFILE_SQL}, b AS (SELECT c_custkey, max(s) AS rank_season, arg_max(r, s) AS r FROM p WHERE s <= '2024-08' AND r BETWEEN 1 AND 10000 GROUP BY c_custkey)
SELECT c_custkey AS seq, 'TAG' || c_custkey AS tag, CAST(r AS INT) AS "rank", rank_season FROM customer LEFT JOIN b USING (c_custkey)
""")
def profile_best(spark, sf):
    pages = R.profile_pages(_people(spark, sf))
    return cohort.profile_proofs(pages, "2024-08").select("seq", "tag", "rank", "rank_season")


@query(f"""
WITH {_PROFILE_SQL},
b AS (SELECT c_custkey, max(s) AS rank_season, arg_max(r, s) AS r FROM p WHERE s <= '2024-08' AND r BETWEEN 1 AND 10000 GROUP BY c_custkey),
e AS (SELECT (c_custkey // 100) * 1000000 + row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS seq, 'TAG' || c_custkey AS tag, c_custkey + 1 AS r, '2024-08' AS rank_season
  FROM customer WHERE c_acctbal > 6000
  UNION ALL SELECT c_custkey + 1152921504606846976, 'TAG' || c_custkey, r, rank_season FROM b),
f AS (SELECT tag, min(seq) AS seq, arg_min(r, seq) AS "rank", arg_min(rank_season, seq) AS rank_season FROM e WHERE r BETWEEN 1 AND 10000 GROUP BY tag)
SELECT tag, "rank", rank_season FROM f ORDER BY seq LIMIT (SELECT count(*) // 2 FROM customer)
""")
def cohort_build(spark, sf):
    people = load(spark, sf, "customer")
    boards = R.board_pages(people.filter("c_acctbal > 6000"), "2024-08")
    return jobs.build_cohort(boards, R.profile_pages(_people(spark, sf)), "2024-08", people.count() // 2, True).select("tag", "rank", "rank_season")


@query("""
SELECT c_custkey // 100 AS seq, string_agg('TAG' || c_custkey, ',' ORDER BY c_custkey) AS tags,
  'http://corpus.example/players/leaderboard/de,http://corpus.example/players/leaderboard/fr' AS sources, 'de,fr' AS countries,
  CASE WHEN count(*) > 99 THEN 'too_many_players' END AS page_error FROM customer GROUP BY 1
""")
def source_pages(spark, sf):
    pages = R.board_pages(load(spark, sf, "customer"), "2024-08")
    parsed = cohort.source_page(pages, R.BASE, list_pages.player_links(F.col("body")), 99, 10)
    codes = pages.select("seq", F.array_join(cohort.country_codes(F.col("body")), ",").alias("countries"))
    return parsed.select(
        "seq", F.array_join("tags", ",").alias("tags"), F.array_join("source_urls", ",").alias("sources"), "page_error").join(codes, "seq")


@query("SELECT c_custkey, c_custkey % 4 = 0 AS missing FROM customer")
def player_missing(spark, sf):
    named = F.expr("CASE c_custkey % 4 WHEN 0 THEN 'TAG' || c_custkey WHEN 1 THEN 'TAG' || (c_custkey + 1) ELSE '' END")
    body = F.concat(F.lit('<div class="ui negative message"><div class="header"> Player  tag #'), named, F.lit(" not found\n (404) </div></div>"))
    return load(spark, sf, "customer").select(
        "c_custkey", list_pages.player_missing(body, F.expr("'TAG' || c_custkey")).alias("missing"))


_A, _B = "event_type = 'view'", "event_type = 'purchase' AND value > 60"


def _tags(spark, sf, where):
    return load(spark, sf, "events").filter(where).select(F.expr("'U' || user_id").alias("tag"))


@query(f"SELECT 'U' || user_id AS tag FROM events WHERE {_A} UNION SELECT 'U' || user_id FROM events WHERE {_B}")
def set_union(spark, sf):
    return setops.all_tags([_tags(spark, sf, _A), _tags(spark, sf, _B)])


@query(f"SELECT 'U' || user_id AS tag FROM events WHERE {_A} EXCEPT SELECT 'U' || user_id FROM events WHERE {_B}")
def set_except(spark, sf):
    return setops.unseen(_tags(spark, sf, _A), _tags(spark, sf, _B))


@query(f"SELECT 'U' || user_id AS tag FROM events WHERE {_A} INTERSECT SELECT 'U' || user_id FROM events WHERE {_B}")
def set_intersect(spark, sf):
    return setops.previously_seen(_tags(spark, sf, _A), _tags(spark, sf, _B))


@query(f"SELECT substr(dedup_key, 8) AS battle_tag FROM {D.TASK_SQL} WHERE kind = 'detail' AND status = 'done' UNION SELECT battle_tag FROM {D.DECISION_SQL} WHERE status = 'accepted'")
def completed_battles(spark, sf):
    return setops.completed_battles(D.tasks(spark, sf), D.decision_log(spark, sf))


@query("SELECT DISTINCT upper('user' || user_id) AS tag FROM events WHERE event_type <> 'signup'")
def seen_players(spark, sf):
    urls = load(spark, sf, "events").filter("event_type <> 'signup'").selectExpr("'http://corpus.example/player/user' || user_id || '/battles?x=1' AS url")
    return setops.seen_players(urls)


@query("""
WITH a AS (SELECT 'TAG' || c_custkey AS tag FROM customer), s AS (SELECT DISTINCT 'TAG' || (user_id * 3) AS tag FROM events),
u AS (SELECT count(*) AS n FROM a WHERE tag NOT IN (SELECT tag FROM s)), t AS (SELECT count(*) AS n FROM a)
SELECT 'seeds' AS section, name, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'pages' AS name, count(DISTINCT c_custkey // 100) AS value FROM customer UNION ALL SELECT 'countries', 2 UNION ALL SELECT 'all_unique_tags', n FROM t
  UNION ALL SELECT 'unseen_tags', n FROM u UNION ALL SELECT 'previously_seen_tags', t.n - u.n FROM t, u UNION ALL SELECT 'selected_tags', CASE WHEN u.n >= 50 THEN u.n ELSE t.n END FROM t, u)
""")
def seed_receipt(spark, sf):
    boards = R.board_pages(load(spark, sf, "customer"), "2024-08")
    seen = load(spark, sf, "events").selectExpr("'TAG' || (user_id * 3) AS tag")
    return jobs.refresh_seeds(boards, seen, 50)[1]


@query("""
WITH a AS (SELECT DISTINCT 'TAG' || c_custkey AS tag FROM customer), s AS (SELECT DISTINCT 'TAG' || o_custkey AS tag FROM orders),
u AS (SELECT tag FROM a WHERE tag NOT IN (SELECT tag FROM s)) SELECT tag FROM a WHERE (SELECT count(*) FROM u) < 100000 OR tag IN (SELECT tag FROM u)
""")
def seeds_chosen(spark, sf):
    """Too few unseen tags: all current ones are chosen."""
    boards = R.board_pages(load(spark, sf, "customer"), "2024-08")
    seen = load(spark, sf, "orders").selectExpr("'TAG' || o_custkey AS tag")
    return jobs.refresh_seeds(boards, seen, 100_000)[0]


@query(f"""
WITH w AS (SELECT DISTINCT 'B' || event_id AS battle_tag FROM events WHERE value > 40), st AS (SELECT DISTINCT 'B' || event_id AS battle_tag FROM events WHERE event_type = 'signup'),
t AS {D.TASK_SQL}
SELECT 'exclusions' AS section, name, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'requested' AS name, count(*) AS value FROM w UNION ALL SELECT 'inserted', count(*) FROM w WHERE battle_tag NOT IN (SELECT battle_tag FROM st)
  UNION ALL SELECT 'total', (SELECT count(*) FROM (SELECT battle_tag FROM w UNION SELECT battle_tag FROM st))
  UNION ALL SELECT 'unfinished_tasks_skipped', count(*) FROM t WHERE kind = 'detail' AND status IN ('pending', 'inflight', 'dead') AND substr(dedup_key, 8) IN (SELECT battle_tag FROM w))
""")
def exclusion_import(spark, sf):
    e = load(spark, sf, "events")
    wanted = e.filter("value > 40").selectExpr("'B' || event_id AS battle_tag")
    stored = e.filter("event_type = 'signup'").selectExpr("'B' || event_id AS battle_tag", "'old' AS source")
    tasks = D.tasks(spark, sf).withColumn("error", F.lit(None).cast("string"))
    return jobs.import_exclusions(wanted, stored, tasks, wanted, "run")["effect"]


@query(f"""
WITH w AS (SELECT DISTINCT 'B' || event_id AS battle_tag FROM events WHERE value > 40)
SELECT id, CASE WHEN d THEN 'skipped' ELSE status END AS status, CASE WHEN d THEN 'excluded: already in training dataset' END AS error FROM (
  SELECT id, status, kind = 'detail' AND status IN ('pending', 'inflight', 'dead', 'done') AND substr(dedup_key, 8) IN (SELECT battle_tag FROM w) AS d FROM {D.TASK_SQL})
""")
def exclusion_tasks(spark, sf):
    wanted = load(spark, sf, "events").filter("value > 40").selectExpr("'B' || event_id AS battle_tag")
    tasks = D.tasks(spark, sf).withColumn("error", F.lit(None).cast("string"))
    stored = wanted.limit(0)
    return jobs.import_exclusions(wanted, stored, tasks, wanted, "run", True)["tasks"].select("id", "status", "error")


_INDEX = {
    "seq": "event_id", "kind": "CASE WHEN event_type = 'error' THEN 'list' ELSE 'battle' END",
    "battle_tag": "CASE WHEN event_id % 3 = 0 THEN '' ELSE 'B' || (user_id % 400) END",
    "url": "'http://corpus.example/data/replay?tag=B' || (user_id % 400) || '&e=' || event_id",
}


@query(f"SELECT 'B' || (user_id % 400) AS battle_tag, arg_min(url, seq) AS url, min(seq) AS seq FROM (SELECT {', '.join(f'{e} AS {n}' for n, e in _INDEX.items())}, user_id FROM events) WHERE kind = 'battle' GROUP BY 1")
def replay_index(spark, sf):
    return upgrade.replay_index(D._df(spark, sf, "events", _INDEX))


@query(f"SELECT arg_max(url, seq) AS url FROM {D._sql(_INDEX, 'events')} WHERE kind = 'battle'")
def newest_replay(spark, sf):
    return upgrade.newest_replay_url(D._df(spark, sf, "events", _INDEX), R.BASE)


@query("SELECT 'P' || o_custkey AS tag, min(o_orderkey) AS seq FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1")
def insert_or_ignore(spark, sf):
    incoming = load(spark, sf, "orders").selectExpr("'P' || o_custkey AS tag", "o_orderkey AS seq")
    held = load(spark, sf, "supplier").selectExpr("'P' || s_suppkey AS tag")
    return select.insert_or_ignore(held, incoming, ["tag"], "seq")
