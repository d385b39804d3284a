import copy
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import markup_samples as S
from matchloom.operators import gate as G
from matchloom.operators import list_pages as L
from matchloom.operators import replays as P
from matchloom.plans import jobs

CONTRACT = G.Contract(3, "1.0", "c" * 64, tuple(S.TEAM + S.RIVAL), ("tower-a",), (), {501: 9})


def parse(spark, *pages):
    rows = [(i, "M1", f"u{i}", json.dumps({"success": True, "html": p})) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "seq bigint, battle_tag string, url string, body string")
    return jobs.replay_etl(df)


def test_markers_tables_and_duration(spark):
    page = S.replay(
        markers=[S.marker("blue", "knight", 203, "t", 8499, 500, "0"), S.marker("blue", "archers", 220, "t", 8000, 600),
                 S.marker("red", "bats", 301, "o", 9500, 8500), '<div class="blue marker" data-x="None" data-y="None" data-c="_invalid" data-t="0" data-s="t"></div>'],
        tables=[S.table(2, 1), S.table(1)])
    r = parse(spark, page).first().asDict(True)
    first = r["card_plays"][0]
    assert (first["x"], first["y"], first["time"], first["coordinate_transform"], first["tile_x"]) == (9501, 31500, 10.15, "rotate_180", 9.5)
    (ability,) = r["ability_plays"]
    assert ability["marker_index"] == 3 and ability["coordinate_status"] == "not_applicable" and ability["x"] is None
    assert r["duration_seconds"] == 65 and r["elixir_stats"]["team"]["Total"] == {"count": 2, "elixir": 31.0}
    assert r["elixir_stats"]["opponent"]["Total"]["count"] == 1 and r["card_counts"]["team"] == {"knight": 1, "archers": 1}


@pytest.mark.parametrize("marker, error", [
    (S.marker("blue", "a", 1, "t", i=""), "orientation_invalid"), (S.marker("blue", "a", 1, "t", i="2"), "orientation_invalid"),
    (S.marker("blue", "a", 1, "t", i="x"), "orientation_invalid"), (S.marker("blue", "", 1, "t"), "card_missing"),
    (S.marker("blue", "a", "1.5", "t"), "tick_invalid"), (S.marker("blue", "a", 1, "t", x="None"), "coordinate_missing"),
    (S.marker("blue", "_invalid", 1, "t", x="None"), "ability_coordinate_partial"), (S.marker("blue", "a", 1, "t", x=18001), "coordinate_out_of_bounds"),
    (S.marker("blue", "_invalid", 1, "t", i=""), "orientation_invalid"),
])
def test_bad_markers_are_named(spark, marker, error):
    r = parse(spark, S.replay(markers=[marker])).first()
    assert (r.parse_error, r.outcome) == (error, "marker_rejected")


def test_duration_falls_back_to_latest_clock(spark):
    assert parse(spark, S.replay(end=None)).first().duration_seconds == 9 * 60 + 41


def test_tables_match_by_count_before_position(spark):
    markers = [S.marker("blue", "a", 1, "t"), S.marker("red", "b", 1, "o"), S.marker("red", "c", 2, "o")]
    swapped = parse(spark, S.replay(markers=markers, tables=[S.table(2), S.table(1)])).first()
    assert swapped.elixir_stats.team["Total"]["count"] == 1 and swapped.elixir_stats.opponent["Total"]["count"] == 2


@pytest.mark.parametrize("body, outcome", [
    ("<html>x</html>", "not_json"), ("[1]", "not_object"), ('{"success": false}', "refused"), ('{"success": false, "html": "Requires login"}', "login_required"),
    ('{"success": true, "html": "Replay Not Found"}', "replay_not_found"), ('<html><pre>{"success": true, "html": "&lt;p&gt;"}</pre></html>', "ok"),
])
def test_unwrap(spark, body, outcome):
    df = spark.createDataFrame([(body,)], "body string")
    assert P.unwrap(df).first().outcome == outcome


# -- gate ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def valid(spark):
    """A document that passes, as plain values."""
    pages = spark.createDataFrame([(0, "http://site.example/player/ALPHA/battles", S.block(rounds=[S.player("ALPHA", S.TEAM, 16), S.player("BRAVO", S.RIVAL, 15)]))], "seq bigint, url string, body string")
    merged = G.stamp(G.merge(parse(spark, S.replay()), L.battles(pages, "http://site.example")), CONTRACT)
    relaxed = merged.schema.json().replace('ullable":false', 'ullable":true').replace('sNull":false', 'sNull":true')
    return StructType.fromJson(json.loads(relaxed)), merged.first().asDict(True)


def _set(path, value):
    def change(d):
        *head, last = path
        for p in head:
            d = d[p]
        d[last] = value

    return change


def _each(*changes):
    return lambda d: [c(d) for c in changes]


SIDE = ("rounds", 0, "team", 0)
CASES = {
    "schema_version_not_authoritative": ("schema", _set(["schema_version"], 4)),
    "coordinate_contract_missing_or_mismatched": ("schema", _set(["orientation_contract"], None)),
    "battle_tag_missing": ("schema", _set(["battle_tag"], " ")),
    "draft_or_unknown": ("mode", _set(["draft"], None)),
    "matchup_players_not_1v1": ("mode", _set(["matchup_players"], "2v2")),
    "not_single_round": ("mode", lambda d: d["rounds"].append(d["rounds"][0])),
    "not_one_player_per_side": ("mode", _set(["rounds", 0, "team"], [])),
    "river_race_duel": ("mode", _set(["battle_type"], "riverRaceDuel")),
    "numeric_game_mode_id_missing": ("mode", _set(["numeric_game_mode_id"], None)),
    "numeric_game_mode_not_allowed": ("mode", _set(["numeric_game_mode_id"], 502)),
    "native_execution_game_mode_mismatch": ("mode", _set(["execution_game_mode_id"], 8)),
    "native_execution_game_mode_provenance_invalid": ("mode", _set(["execution_game_mode_provenance"], "x")),
    "numeric_game_mode_provenance_missing": ("mode", _set(["numeric_game_mode_provenance"], None)),
    "battle_index_missing": ("mode", _set(["battle_index"], 0)),
    "battle_index_provenance_missing": ("mode", _set(["battle_index_provenance"], None)),
    "exact_version_timestamp_missing": ("version", _set(["version_timestamp"], None)),
    "before_native_version_window": ("version", _set(["version_timestamp"], 1000)),
    "version_timestamp_provenance_missing": ("version", _set(["version_timestamp_provenance"], None)),
    "battle_time_utc_missing": ("version", _set(["battle_time_utc"], "2027-01-15")),
    "battle_time_utc_provenance_missing": ("version", _set(["battle_time_utc_provenance"], "guess")),
    "final_tower_hp_missing": ("terminal", _set(["final_tower_hp"], None)),
    "team_tower_hp_missing": ("terminal", _set(["final_tower_hp", "team"], None)),
    "team_tower_hp_invalid": ("terminal", _set(["final_tower_hp", "team", "king"], None)),
    "opponent_tower_hp_total_mismatch": ("terminal", _set(["final_tower_hp", "opponent", "total"], 1)),
    "team_crowns_invalid": ("terminal", _set(["team_crowns"], 4)),
    "team_king_tower_level_missing": ("king_level", _set([*SIDE, "king_tower_level"], 15)),
    "opponent_king_tower_level_exact_evidence_missing": ("king_level", _each(_set(["final_tower_hp", "opponent", "king"], 7727), _set(["final_tower_hp", "opponent", "total"], 8642))),
    "team_king_tower_level_provenance_invalid": ("king_level", _set([*SIDE, "king_tower_level_provenance"], "x")),
    "team_deck_not_8": ("deck", _set(["team_deck"], ["t0"])),
    "opponent_deck_not_unique_cycle": ("deck", lambda d: d["opponent_deck"].__setitem__(1, "r0")),
    "team_native_card_mapping_missing:zap": ("deck", lambda d: d["team_deck"].__setitem__(1, "zap")),
    "team_round_deck_mismatch": ("deck", _set([*SIDE, "full_deck"], S.TEAM[::-1])),
    "team_card_levels_missing": ("deck", lambda d: d["rounds"][0]["team"][0]["card_levels"].pop("t0")),
    "team_card_level_invalid": ("deck", _set([*SIDE, "card_levels", "t0"], 0)),
    "team_deck_cards_missing": ("deck", _set([*SIDE, "deck_cards"], None)),
    "team_deck_card_2_invalid": ("deck", _set([*SIDE, "deck_cards", 2, "form"], "hero")),
    "team_tower_troop_missing": ("deck", _set([*SIDE, "tower_troop"], "")),
    "team_native_tower_troop_mapping_missing": ("deck", _set([*SIDE, "tower_troop"], "tower-z")),
    "opponent_tower_troop_level_missing": ("deck", _set(["rounds", 0, "opponent", 0, "tower_troop_level"], None)),
    "card_plays_missing": ("events", _set(["card_plays"], [])),
    "ability_plays_missing": ("events", _set(["ability_plays"], None)),
    "duration_invalid": ("events", _set(["duration_seconds"], 361)),
    "deployment_side_invalid": ("events", _set(["card_plays", 0, "side"], "x")),
    "deployment_exact_tick_missing": ("events", _set(["card_plays", 0, "time_raw"], None)),
    "deployment_marker_index_missing": ("events", _set(["card_plays", 0, "marker_index"], None)),
    "team_played_card_not_in_deck": ("events", _set(["card_plays", 0, "card"], "zap")),
    "team_played_card_form_unmapped": ("events", _set(["card_plays", 0, "card_form"], None)),
    "deployment_coordinate_mismatch": ("events", _set(["card_plays", 0, "x"], 1)),
    "deployment_raw_coordinate_invalid": ("events", _set(["card_plays", 0, "data_i"], None)),
    "team_incomplete_observed_8_card_cycle": ("events", _set(["card_plays", 0, "card"], "t1")),
    "team_deployment_count_mismatch": ("events", _set(["elixir_stats", "team", "Total", "count"], 9)),
    "team_ability_count_mismatch": ("events", _set(["elixir_stats", "team", "Ability", "count"], 1)),
    "team_native_ability_source_mapping_missing": ("events", _set(["elixir_stats", "team", "Ability", "count"], 1)),
    "team_multiple_commands_same_tick": ("events", _set(["card_plays", 2, "time_raw"], 44)),
    "marker_index_duplicate": ("events", _set(["card_plays", 1, "marker_index"], 0)),
    "marker_index_not_contiguous": ("events", _set(["card_plays", 15, "marker_index"], 99)),
    "marker_tick_order_invalid": ("events", _set(["card_plays", 15, "time_raw"], 1)),
}


def test_valid_document_is_accepted(spark, valid):
    schema, row = valid
    e = G.evaluate(spark.createDataFrame([row], schema), CONTRACT, 1_700_000_000).first().eligibility
    assert e.accepted and e.reasons == []
    assert spark.createDataFrame([row], schema).select(G.first_error(F.lit("M1"))).first()[0] is None


def test_each_break_gives_its_reason(spark, valid):
    schema, row = valid
    broken = []
    for name, (_, change) in CASES.items():
        d = copy.deepcopy(row)
        change(d)
        d["url"] = name
        broken.append(d)
    judged = G.evaluate(spark.createDataFrame(broken, schema), CONTRACT, 1_700_000_000)
    verdicts = {r.url: r.eligibility for r in judged.select("url", "eligibility").collect()}
    wrong = {n: verdicts[n] for n, (tier, _) in CASES.items() if verdicts[n].accepted or verdicts[n].tier != tier or n not in verdicts[n].reasons}
    assert not wrong


def test_no_contract_fails_in_mapping(spark, valid):
    schema, row = valid
    e = G.evaluate(spark.createDataFrame([row], schema), None).first().eligibility
    assert (e.tier, e.reasons) == ("mapping", ["native_contract_missing"])


def test_first_errors(spark, valid):
    schema, row = valid
    cases = {
        "replay battle_tag missing": _set(["replay_tag"], None), "replay battle_tag mismatch: X != M1": _set(["replay_tag"], "X"),
        "replay has no card plays": _set(["card_plays"], []), "invalid replay duration: 0": _set(["duration_seconds"], 0),
        "ability_plays missing": _set(["ability_plays"], None), "unexpected replay schema_version: 3": _set(["schema_version"], 3),
        "coordinate_provenance missing": _set(["orientation_contract"], None),
        "card play count mismatch for team: markers=8, table=9": _set(["elixir_stats", "team", "Total", "count"], 9),
        "ability count mismatch for opponent: markers=0, table=2": _set(["elixir_stats", "opponent", "Ability", "count"], 2),
        "invalid card play tick": _set(["card_plays", 3, "time_raw"], -1),
        "invalid card play raw coordinate provenance": _set(["card_plays", 3, "data_i"], 5),
        "card play coordinate_provenance mismatch": _set(["card_plays", 3, "coordinate_provenance"], "x"),
        "card play native coordinate mismatch": _set(["card_plays", 3, "y"], 0),
    }
    broken = []
    for name, change in cases.items():
        d = copy.deepcopy(row)
        change(d)
        d["url"] = name
        broken.append(d)
    found = {r.url: r.e for r in spark.createDataFrame(broken, schema).select("url", G.first_error(F.lit("M1")).alias("e")).collect()}
    assert found == {n: n for n in cases}


@pytest.mark.parametrize("version, tower, king, mode, proof", [
    (3, 16, 100, 501, "template_cap_and_tower_level_v1"), (3, 15, 7728, 501, "template_cap_and_full_king_hp_v1"), (2, 16, 100, 501, None), (3, 15, 7727, 501, None), (3, 16, 7728, 502, None),
])
def test_king_evidence(spark, version, tower, king, mode, proof):
    contract = G.Contract(version, "1", "c", (), (), (), {501: 1})
    df = spark.sql(
        f"SELECT array(named_struct('team', array(named_struct('tower_troop_level', {tower})), 'opponent', array(named_struct('tower_troop_level', 1)))) AS rounds, "
        f"named_struct('team', named_struct('king', {king}), 'opponent', named_struct('king', 0)) AS hp, {mode} AS mode")
    assert df.select(G.king_evidence(contract, F.col("mode"), F.col("rounds"), F.col("hp"), "team")).first()[0] == proof


def test_legacy_documents_are_rederived_or_refused(spark, valid):
    schema, row = valid
    rows = []
    for version, change in ((3, lambda d: None), (4, _set(["card_plays", 0, "time_raw"], None)), (2, lambda d: None), (4, _set(["card_plays", 0, "data_i"], 7))):
        d = copy.deepcopy(row)
        d["schema_version"] = version
        d["card_plays"][0]["x"] = -1
        change(d)
        rows.append(d)
    out = [r.asDict(True) for r in P.upgrade_legacy(spark.createDataFrame(rows, schema)).collect()]
    assert [r["upgrade_error"] for r in out] == [
        None, "deployment_exact_tick_missing", "source_schema_not_exact", "raw_coordinate_upgrade_failed:orientation_invalid"]
    assert out[0]["card_plays"][0]["x"] == row["card_plays"][0]["x"] and out[0]["schema_version"] == 5
