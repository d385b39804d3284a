import json

import pytest
from pyspark.sql import functions as F

from matchloom import values as V
from matchloom.operators.cohort import EvidenceError
from matchloom.sources import contracts, readers, sinks
from matchloom.streaming import ingest


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_seeds(spark, tmp_path):
    path = write(tmp_path / "seeds.txt", "// note\n; note\n\n  #ABC \nhttp://s/player/X\n")
    assert sorted(r.value for r in readers.seeds(spark, path).collect()) == ["#ABC", "http://s/player/X"]


def test_exclusions_fail_closed(spark, tmp_path):
    good = write(tmp_path / "good.jsonl", '{"battle_tag": "A"}\n\n{"battle_tag": " B "}\n')
    assert sorted(r.battle_tag for r in readers.exclusions(spark, good, 2).collect()) == ["A", "B"]
    for name, text in (("dup", '{"battle_tag": "A"}\n{"battle_tag": "A"}\n'), ("miss", '{"battle_tag": "A"}\n{"x": 1}\n'), ("bad", '{"battle_tag": "A"}\n{oops\n')):
        with pytest.raises(EvidenceError):
            readers.exclusions(spark, write(tmp_path / f"{name}.jsonl", text))
    with pytest.raises(EvidenceError):
        readers.exclusions(spark, good, 3)


def test_damaged_index_lines_are_set_apart(spark, tmp_path):
    good, bad = readers.index_rows(spark, write(tmp_path / "i.jsonl", '{"kind": "battle", "battle_tag": "A", "url": "u"}\n{"kind": \n'))
    assert [r.battle_tag for r in good.collect()] == ["A"] and bad.count() == 1


def test_files_are_imported_once(spark, tmp_path):
    write(tmp_path / "a.json", "{}")
    none = spark.createDataFrame([], "path string, size bigint, mtime_us bigint")
    fresh = readers.not_imported(spark, str(tmp_path), none)
    assert fresh.count() == 1 and readers.not_imported(spark, str(tmp_path), fresh).count() == 0


def test_replay_corpus_of_mixed_versions(spark, tmp_path):
    write(tmp_path / "1.json", json.dumps({"battle_tag": "A", "schema_version": 1, "card_plays": [{"time": 1.5, "card": "x"}]}))
    write(tmp_path / "5.json", json.dumps({"battle_tag": "B", "schema_version": 5, "elixir_stats": {"team": {"Total": {"count": 3, "elixir": 1.0}}}}))
    got = {r.battle_tag: r for r in readers.replay_corpus(spark, str(tmp_path)).collect()}
    assert got["A"].card_plays[0].time_raw is None and got["B"].elixir_stats.team["Total"]["count"] == 3


def contract(spark, tmp_path, **changes):
    value = {
        "schema_version": 3, "kind": V.CONTRACT_KINDS[3], "game_version": "1", "allowed_card_tokens": ["a", "B"], "allowed_tower_troops": ["t"],
        "ability_source_tokens": ["a"], "source_numeric_game_mode_ids": [1, 2], "native_execution_mode_by_source": {"1": 10, "2": 20},
        "king_tower_max_hp_by_level": {"16": 7728}, "king_tower_level_evidence": {"schema_version": 1}, **changes}
    path = tmp_path / f"c{len(list(tmp_path.iterdir()))}.json"
    write(path, json.dumps(value))
    digest = spark.read.schema(contracts.S.CONTRACT).json(str(path), multiLine=True).select(contracts.contract_digest()).first()[0]
    if "contract_sha256" not in changes:
        value["contract_sha256"] = digest
    return write(path, json.dumps(value))


def test_contract(spark, tmp_path):
    c = contracts.load_contract(spark, contract(spark, tmp_path), "1")
    assert c.cards == ("a", "b") and c.modes == {1: 10, 2: 20} and c.version == 3 and len(c.sha256) == 64


@pytest.mark.parametrize("changes, problem", [
    ({"schema_version": 1}, "schema_or_kind_unsupported"), ({"game_version": "2"}, "game_version_differs"), ({"contract_sha256": "0" * 64}, "digest_mismatch"),
    ({"allowed_card_tokens": ["a", "A "]}, "allowed_card_tokens_invalid"), ({"allowed_tower_troops": []}, "allowed_tower_troops_invalid"),
    ({"source_numeric_game_mode_ids": [1, 1]}, "source_numeric_game_mode_ids_invalid"), ({"native_execution_mode_by_source": {"1": 10}}, "native_execution_mode_by_source_not_exact"),
    ({"king_tower_max_hp_by_level": {"16": 7727}}, "king_hp_anchor_missing"), ({"king_tower_level_evidence": None}, "king_evidence_missing"),
    ({"ability_source_tokens": ["z"]}, "ability_source_not_allowed"),
])
def test_contract_problems(spark, tmp_path, changes, problem):
    with pytest.raises(EvidenceError, match=problem):
        contracts.load_contract(spark, contract(spark, tmp_path, **changes), "1")


ROSTER = {
    "schema_version": 1, "season_id": "2024-05", "ranking_type": "path_of_legends", "top_n": 2, "start_utc": "2024-05-06T09:00:00Z", "end_utc": "2024-06-03T09:00:00Z",
    "source_urls": ["https://s.example/b"], "boundary_source": "notes", "players": [{"rank": 1, "tag": "AAA"}, {"rank": 2, "tag": "BBB"}]}


def now():
    return F.lit("2024-07-01").cast("timestamp")



def test_roster(spark, tmp_path):
    players, window = contracts.load_roster(spark, write(tmp_path / "r.json", json.dumps(ROSTER)), now(), "2024-05", 2)
    assert players.count() == 2 and window.first().end_s == 1717405200


@pytest.mark.parametrize("changes, problem", [
    ({"schema_version": 2}, "schema_version_not_1"), ({"season_id": "2024-5"}, "season_id_invalid"), ({"ranking_type": "x"}, "ranking_type_invalid"), ({"eligibility": "x"}, "eligibility_unknown"),
    ({"end_utc": "2024-08-03T09:00:00Z"}, "time_range_invalid"), ({"start_utc": "2024-04-29T09:00:00Z"}, "start_not_in_season"), ({"source_urls": ["http://s"]}, "source_urls_invalid"),
    ({"source_urls": ["https://u:p@s.example"]}, "source_urls_invalid"), ({"boundary_source": " "}, "boundary_source_missing"), ({"players": [{"rank": 1, "tag": "AAA"}]}, "complete"),
    ({"roster_sha256": "0"}, "digest"),
])
def test_roster_problems(spark, tmp_path, changes, problem):
    with pytest.raises(EvidenceError, match=problem):
        contracts.load_roster(spark, write(tmp_path / "r.json", json.dumps({**ROSTER, **changes})), now())


def test_roster_writer_refuses_other_content(spark, tmp_path):
    players = spark.createDataFrame([(1, "AAA", "2024-05"), (2, "BBB", "2024-05")], "rank bigint, tag string, rank_season string")
    manifest = {k: v for k, v in ROSTER.items() if k != "players"}
    path = str(tmp_path / "roster")
    digest = sinks.write_roster(manifest, players, path)
    assert sinks.write_roster(manifest, players.orderBy(F.desc("rank")), path) == digest
    loaded, _ = contracts.load_roster(spark, path, now(), "2024-05", 2)
    assert loaded.count() == 2
    with pytest.raises(EvidenceError):
        sinks.write_roster(manifest, players.limit(1), path)


def test_seed_lists(spark, tmp_path):
    tags = spark.createDataFrame([("BBB",), ("AAA",)], "tag string")
    path = str(tmp_path / "seeds")
    assert sinks.write_seeds(tags, path).first().selected_tags == 2
    sinks.append_new_seeds(spark.createDataFrame([("AAA",), ("CCC",)], "tag string"), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["#AAA", "#BBB", "#CCC"]


def test_contract_and_campaign_pins(spark):
    decisions = spark.createDataFrame([("A", "c1"), ("B", None)], "battle_tag string, contract_sha256 string")
    with pytest.raises(EvidenceError):
        readers.one_contract(decisions, "c1")
    stored = spark.createDataFrame([("campaign", "p1")], "name string, payload string")
    assert readers.frozen_contract(stored, stored, 5).count() == 0
    with pytest.raises(EvidenceError):
        readers.frozen_contract(stored, stored.withColumn("payload", F.lit("p2")), 5)
    with pytest.raises(EvidenceError):
        readers.frozen_contract(stored.limit(0), stored, 5)
    assert readers.campaign_problems("ok-1", 1, 2, True, False) == [] and len(readers.campaign_problems("-", 2, 1, True, True)) == 3


def test_archive_and_pages(spark, tmp_path):
    pages = spark.createDataFrame([("u", "b", "2024-01-01 10:00:00"), ("v", "c", "2024-01-02 10:00:00")], "url string, body string, at string").select(
        "url", "body", F.col("at").cast("timestamp").alias("fetched_at"))
    sinks.archive_pages(pages, str(tmp_path / "pages"))
    got = spark.read.parquet(str(tmp_path / "pages")).filter("fetched_date = DATE '2024-01-02'")
    assert [r.url for r in got.collect()] == ["v"]


def test_stream_dedup_survives_a_second_run(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    schema = "k string, seq bigint"
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], schema).write.parquet(src)
    like = spark.read.parquet(src)
    ingest.dedup_into(ingest.table_stream(spark, src, like), out, mark, ["k"], "seq")
    spark.createDataFrame([("a", 0), ("c", 4)], schema).write.mode("append").parquet(src)
    ingest.dedup_into(ingest.table_stream(spark, src, like), out, mark, ["k"], "seq")
    ingest.dedup_into(ingest.table_stream(spark, src, like), out, mark, ["k"], "seq")
    assert sorted((r.k, r.seq) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 3), ("c", 4)]
