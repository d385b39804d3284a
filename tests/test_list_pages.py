import pytest
from pyspark.sql import functions as F

import markup_samples as S
from matchloom.operators import list_pages as L

BASE = "http://site.example"


def parse(spark, body, url="http://site.example/player/ALPHA/battles"):
    df = spark.createDataFrame([(0, url, body)], "seq bigint, url string, body string")
    return [r.asDict(True) for r in L.battles(df, BASE).orderBy("position").collect()]


def test_one_on_one(spark):
    (b,) = parse(spark, S.block())
    assert b["complete"] and b["authoritative_complete"] and b["normal_1v1"] and b["deck_crosscheck_complete"]
    assert (b["battle_tag"], b["team_tags"], b["opponent_tags"]) == ("M1", ["ALPHA"], ["BRAVO"])
    assert (b["timestamp"], b["battle_time_utc"], b["battle_time_utc_provenance"]) == (1800000000, "2027-01-15T08:00:00Z", "timestamp_popup_utc")
    side = b["rounds"][0]["team"][0]
    assert side["full_deck"] == S.TEAM and side["card_levels"]["t3"] == 13 and side["tower_troop"] == "tower-a" and side["tower_troop_level"] == 15
    assert side["deck_cards"][7] == {"slot": 7, "slug": "t7", "base_slug": "t7", "form": "base", "level": 17}
    assert b["final_tower_hp"]["opponent"] == {"king": 7728, "princess0": 0, "princess1": 915, "total": 8643}
    assert b["replay_url"] == (
        "http://site.example/data/replay?tag=M1&team_tags=ALPHA&opponent_tags=BRAVO&team_crowns=1&opponent_crowns=0"
        "&referrer_path=http://site.example/player/ALPHA/battles")


def test_two_on_two_is_complete_but_not_normal(spark):
    (b,) = parse(spark, S.block(team="ALPHA,CHARLIE", rival="BRAVO,DELTA"))
    assert b["complete"] and not b["normal_1v1"] and [p["player_tag"] for p in b["rounds"][0]["team"]] == ["ALPHA", "CHARLIE"]
    assert "team_tags=ALPHA%2CCHARLIE" in b["replay_url"]


def test_duel_has_two_rounds(spark):
    one_round = [S.player("ALPHA", S.TEAM), S.player("BRAVO", S.RIVAL)]
    (b,) = parse(spark, S.block(rounds=[one_round, one_round], kind="riverRaceDuel"))
    assert len(b["rounds"]) == 2 and b["complete"] and not b["normal_1v1"]


@pytest.mark.parametrize("changes, flag", [
    ({"mode": "Touchdown"}, "normal_1v1"), ({"draft": "1"}, "normal_1v1"), ({"kind": "riverRaceDuel"}, "normal_1v1"),
    ({"rounds": [S.player("ALPHA", S.TEAM, levels=False), S.player("BRAVO", S.RIVAL)]}, "complete"),
    ({"rounds": [S.player("ALPHA", S.TEAM[:7] + ["t0-ev1"]), S.player("BRAVO", S.RIVAL)]}, "complete"),
    ({"rounds": [S.player("ALPHA", S.TEAM[:7] + ["_invalid"]), S.player("BRAVO", S.RIVAL)]}, "complete"),
    ({"rounds": [S.player("ALPHA", S.TEAM[:7] + ["other"]), S.player("BRAVO", S.RIVAL)]}, "deck_crosscheck_complete"),
])
def test_flags_fall(spark, changes, flag):
    (b,) = parse(spark, S.block(**changes))
    assert not b[flag]


def test_first_button_wins_and_bare_buttons_follow(spark):
    bare = '<button class="replay_button" data-replay="{}" data-team-tags="X1Y" data-opponent-tags="Z1Z" data-team-crowns="0" data-opponent-crowns="2"></button>'
    rows = parse(spark, S.block() + S.block(mode="2v2") + bare.format("M1") + bare.format("M2"))
    assert [(r["battle_tag"], r["bare_button"], r["game_mode"]) for r in rows] == [("M1", False, "1v1"), ("M2", True, None)]
    assert rows[1]["rounds"] == [] and not rows[1]["complete"] and "tag=M2&team_tags=X1Y" in rows[1]["replay_url"]


def test_scripts_comments_and_stray_tags_do_not_confuse(spark):
    noise = "<!-- <div class='battle_list_battle'> --><script>var a = '<div class=\"battle_list_battle\">';</script></section>"
    assert len(parse(spark, noise + S.block() + noise)) == 1


def test_hp_must_add_up(spark):
    (b,) = parse(spark, S.block().replace('data-team-total="11338"', 'data-team-total="11339"'))
    assert b["final_tower_hp"] is None and not b["authoritative_complete"]


@pytest.mark.parametrize("stamp, seconds", [("1800000000123", 1800000000), ("1800000000.5", 1800000000), ("", 1800000000), ("junk", 1800000000)])
def test_timestamps(spark, stamp, seconds):
    # A fractional or missing attribute falls back to the popup, here 1800000000 too.
    (b,) = parse(spark, S.block(timestamp=stamp))
    assert b["timestamp"] == seconds


@pytest.mark.parametrize("links, url, error", [
    ('<a href="/p/history?before=1"><i class="angle left icon"></i></a><a href="/p/history?before=2&amp;"><i class="angle right icon"></i></a>', "http://site.example/p/history?before=2", None),
    ('<a class="item disabled" href="/p/history?before=2"><i class="angle right icon"></i></a>', None, None),
    ('<a href="/p/history?before=5">x</a>', "http://site.example/p/history?before=5", None),
    ('<a href="/p/history?before=5">x</a><a href="/p/history?before=6">y</a>', None, "ambiguous"),
    ('<a href="/p/history?before=5">x</a><a rel="next" href="/p/history?before=6">y</a>', "http://site.example/p/history?before=6", None),
])
def test_next_page(spark, links, url, error):
    r = spark.range(1).select(L.next_page(F.lit(links), BASE).alias("n")).first().n
    assert (r.url, r.error) == (url, error)


def test_players_in_page_order(spark):
    body = S.block(team="ALPHA, CHARLIE") + S.block("M2", team="BRAVO", rival="ALPHA")
    assert spark.range(1).select(L.player_tags(F.lit(body))).first()[0] == ["ALPHA", "CHARLIE", "BRAVO"]
    board = '<a href="/player/ABC1">x</a><script>[{"rank":1,"tag":"XYZ"},{"rank":"2","tag":"ABC1"}]</script>'
    assert spark.range(1).select(L.player_links(F.lit(board))).first()[0] == ["ABC1", "XYZ"]


@pytest.mark.parametrize("status, body, expected", [
    (404, "", "not_found"), (429, "", "rate_limited"), (403, "", "forbidden"), (502, "", "server_error"), (301, "", "unexpected_status"),
    (200, '{"success": false, "html": "Requires login"}', "login_required"), (200, '{"success": false}', "refused"),
    (200, '{"success": true, "html": "replay not found"}', "replay_not_found"), (200, S.block(), "ok"),
    (200, "<p>Cloudflare</p>", "challenge"), (200, '<div class="battle_list_container">', "no_battles"), (200, "<p>hi</p>", "unrecognized"),
])
def test_outcomes(one, status, body, expected):
    assert one(L.outcome(F.col("s"), F.col("b")), s=status, b=body) == expected


def test_page_is_parsed_once_per_content(spark):
    df = spark.createDataFrame([(3, "u", "a"), (1, "u", "a"), (2, "u", "b"), (4, "v", "a")], "seq bigint, url string, body string")
    assert sorted(r.seq for r in L.unique_captures(df).collect()) == [1, 2, 4]
