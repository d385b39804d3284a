import pytest
from markup_samples import SITE, block, el
from pyspark.sql import functions as F

from matchloom.operators import counts, predicates
from matchloom.plans import jobs, pool
from matchloom.sources import readers, sinks

NOW = 1_800_000_000
PAGES = "url string, seq bigint, owner string, page int, zero_new_chain int, revisit boolean, body string"
FULL = "url string, seq bigint, position int, battle_tag string, team_tags array<string>, opponent_tags array<string>, eligible boolean"


def body(cursor=None, listed=True):
    link = "" if cursor is None else el("a", "item", el("i", "angle right icon"), href=f"/player/AAA/battles/history?before={cursor}")
    return (el("div", "battle_list_container", block()) if listed else "<p>x</p>") + link


def walked(spark, page, shown=("new",), known=(), members=("AAA",), **options):
    url = page[0]
    pages = spark.createDataFrame([page], PAGES)
    battles = spark.createDataFrame([(url, 1, i, t, ["#AAA"], ["BBB"], True) for i, t in enumerate(shown)], FULL)
    held = spark.createDataFrame([(t,) for t in known], "battle_tag string")
    who = spark.createDataFrame([(t,) for t in members], "tag string")
    return pool.walk(pages, battles, held, who, SITE, NOW, **options)


def at(before):
    return f"{SITE}/player/AAA/battles" + ("" if before is None else f"/history?before={before}")


@pytest.mark.parametrize("page,before,cursor,error", [
    (3, 1_700_000_000_000, 1_600_000_000_000, None),
    (4, 1_700_000_000_000, 1_600_000_000_000, "page_ceiling"),
    (3, 1_700_000_000_000, 1_700_000_000_000, "cursor_not_decreasing"),
    (3, 1_700_000_000, 1_700_000_000_001, "cursor_not_decreasing"),  # seconds and milliseconds
    (1, None, NOW * 1000 + 300_000, None),  # five minutes ahead at most
    (1, None, NOW * 1000 + 300_001, "cursor_not_decreasing"),
    (1, None, "+5", "cursor_not_decreasing"),
])
def test_next_pages_of_a_member(spark, page, before, cursor, error):
    made = walked(spark, (at(before), 1, "AAA", page, 0, False, body(cursor)), max_pages=4)
    row = made["navigation"].first()
    assert (row.error, row.cutoff, row.candidates, row.new) == (error, False, 1, 1)
    assert made["history"].count() == (error is None)
    assert made["refresh"].count() == (error is None and page == 1)


def test_players_outside_the_pool_lead_nowhere(spark):
    made = walked(spark, (at(None), 1, "AAA", 1, 0, False, body(1_600_000_000_000)), members=("CCC",))
    row = made["navigation"].first()
    assert (row.error, row.candidates, made["history"].count()) == ("foreign_list_url", 0, 0)
    assert {r.tag for r in made["offered"].collect()} == {"AAA", "BBB"}
    assert "offered" not in walked(spark, (at(None), 1, "AAA", 1, 0, False, body()), expanding=False)


@pytest.mark.parametrize("revisit,chain,cut", [(True, 1, True), (True, 0, False), (False, 9, False)])
def test_only_a_revisit_ends_at_known_battles(spark, revisit, chain, cut):
    made = walked(spark, (at(1_700_000_000_000), 1, "AAA", 2, chain, revisit, body(1_600_000_000_000)), known=("new",))
    row = made["navigation"].first()
    assert (row.cutoff, row.cutoff_reason, row.error) == (cut, "revisit_caught_up" if cut else None, None)
    (followed,) = made["history"].collect() or [None]
    assert (followed is None) == cut
    if followed:
        assert (followed.page, followed.zero_new_chain, followed.revisit) == (3, chain + 1, revisit)


@pytest.mark.parametrize("tag,unavailable", [("AAA", True), ("AAB", False)])
def test_only_the_right_404_makes_a_page_empty(spark, tag, unavailable):
    said = el("div", "ui negative message", el("div", "header", f"Player tag #{tag} not found (404)"))
    made = walked(spark, (at(None), 1, "AAA", 1, 0, False, said), shown=())
    row = made["navigation"].first()
    assert (row.unavailable, row.error) == (unavailable, None if unavailable else "unrecognized_player_page")
    assert [r.next_retry_at for r in made["unavailable"].collect()] == [NOW + 21600] * unavailable
    assert made["refresh"].count() == made["history"].count() == 0


def test_empty_tables(spark):
    made = pool.walk(spark.createDataFrame([], PAGES), spark.createDataFrame([], FULL), spark.createDataFrame([], "battle_tag string"),
                     spark.createDataFrame([], "tag string"), SITE, NOW)
    assert all(df.count() == 0 for df in made.values())


@pytest.mark.parametrize("before,cursor,error", [
    (None, 1_700_000_000_000, "cursor_not_decreasing"), (None, 1_699_999_999_999, None),  # the season's end stands before the first page
    (1_600_000_000_900, 1_600_000_000_100, "cursor_not_decreasing"),  # the same second
])
def test_closed_season_starts_at_its_end(spark, before, cursor, error):
    page = (at(before), 1, "AAA", 1, 0, None, body(cursor))
    pages = spark.createDataFrame([page], "url string, seq bigint, owner string, page int, zero_new_chain int, previous_fingerprint string, body string")
    battles = spark.createDataFrame([(page[0], 1, 0, "new", ["AAA"], ["BBB"], True)], FULL)
    made = jobs.expand(pages, battles, spark.createDataFrame([], "battle_tag string"), SITE, closed_season=True, season_end=1_700_000_000)
    assert made["navigation"].first().error == error


def test_member_flag_and_outside_pool(spark):
    battles = spark.sql("SELECT 1 AS page_no, * FROM VALUES ('a', array('AAA'), array('BBB'), 5L, true), ('b', array('CCC'), array('DDD'), 5L, true), "
                        "('c', array('CCC'), array(), null, true), ('d', array('CCC'), array('DDD'), 5L, false) AS t(battle_tag, team_tags, opponent_tags, timestamp, normal_1v1)")
    flagged = predicates.with_member_flag(battles, spark.sql("SELECT 'BBB' AS tag UNION ALL SELECT 'BBB'"))
    row = predicates.funnel(flagged, F.col("normal_1v1"), None, None, ["page_no"], F.col("member")).first()
    assert (row.candidates, row.outside_pool, row.timestamp_missing) == (4, 1, 1)


def test_stale_heartbeats_prove_nothing(spark):
    beats = spark.sql("SELECT * FROM VALUES ('r', 1, 'failed', 10L), ('r', 2, 'running', 20L), ('s', 1, 'stopped', 5L), ('t', 1, null, 90L), ('u', 1, 'running', 200L) AS t(run, seq, phase, updated_at)")
    found = {r.run: (r.phase, r.heartbeat_age_seconds, r.stale) for r in counts.runtime_state(beats, ["run"], 105).collect()}
    assert found == {"r": ("stale_unknown", 85, True), "s": ("stopped", 100, True), "t": (None, 15, False), "u": ("running", 0, False)}


def test_campaign_rules_by_row_and_by_value(spark):
    rows = [(name, low, high, roster, discover) for name in ("run", "", "-a", "a b", "a\n", "x" * 64, "x" * 65) for low, high in ((1, 2), (2, 2), (None, 2))
            for roster in (True, False) for discover in (True, False)]
    df = spark.createDataFrame(rows, "name string, low int, high int, roster boolean, discover boolean")
    found = df.select("*", readers.campaign_faults(*[F.col(c) for c in df.columns]).alias("faults")).collect()
    assert all(r.faults == readers.campaign_problems(*r[:5]) for r in found)


def test_nothing_waits_in_an_empty_outbox(spark, tmp_path):
    waiting = sinks.waiting_records(spark, str(tmp_path / "outbox"))
    rows = jobs.campaign_status(spark.sql("SELECT 'list' AS kind, 'done' AS status"), spark.sql("SELECT 'accepted' AS status, 'x' AS tier"), waiting)
    assert {(r.section, r.name): r.value for r in rows.collect()} == {
        ("tasks", "list:done"): 1, ("status", "accepted"): 1, ("tiers", "accepted:x"): 1, ("index", "pending_index_records"): 0}
