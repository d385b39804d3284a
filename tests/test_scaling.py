"""What keeps large tables within bounds: how rows are dealt, what is shuffled, what is read once."""

import contextlib
import io
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import markup_samples as S
from matchloom.catalog import rendering as R
from matchloom.functions import text as X
from matchloom.operators import cohort, list_pages, markup, replays
from matchloom.plans import jobs

SF = "/root/testdata/sf0.001"


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_tasks_follow_rows(spark):
    assert R.tasks_for(spark.range(10)) == spark.sparkContext.defaultParallelism
    assert R.tasks_for(spark.range(1_000_001), 10_000) == 101


def test_no_markup_is_shuffled_to_make_pages(spark):
    orders = spark.range(200).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey", "timestamp_seconds(900000000 + id) AS o_orderdate")
    pages = R.list_pages(orders, tasks=3)
    assert plan_of(pages).count("Exchange") == 1
    key = lambda r: r.page_no
    assert sorted(pages.collect(), key=key) == sorted(R.list_pages(orders).collect(), key=key)


def test_bodies_are_not_sorted_to_find_unique_captures(spark):
    plan = plan_of(list_pages.unique_captures(spark.createDataFrame([(1, "u", "a")], "seq bigint, url string, body string")))
    assert "SortMergeJoin" not in plan and "Sort " not in plan


def test_battle_tag_comes_with_the_item(spark):
    row = spark.createDataFrame([(S.block("M7"),)], "body string").select(markup.battle_items("body").alias("i")).first()
    assert [len(i) for i in row.i] == [2] and row.i[0][0] == "M7" and '"data-replay": "M7"' in row.i[0][1]


def test_tags_of_one_class_text_and_nested_elements():
    page = markup._Page('<div class="a b"><p class="a">x<i class="b">y</i></p></div><b class="a &amp; b">z</b><p class="a">')
    assert page.find(0, "a") == [1, 2, 4, 5] and page.find(1, "b") == [3] and page.first(2, "a") is None and page.first(0, "b") == 1
    assert page.text(2) == "xy" and page.parent[3] == 2 and page.first(5, "b") is None


def test_plain_attributes_and_classes_are_read_without_scanning_again(monkeypatch):
    class Unused:
        def __getattr__(self, name):
            raise AssertionError(name)

    asked = []
    monkeypatch.setattr(markup, "_CLASS", type("Counted", (), {"search": lambda self, raw, real=markup._CLASS: asked.append(raw) or real.search(raw)})())
    page = markup._Page('<p class="only-here">a</p>' * 5 + "<b>x &lt; y</b>")
    assert page.find(0, "only-here") == [1, 2, 3, 4, 5] and page.text(6) == "x < y" and asked == [' class="only-here"']
    monkeypatch.setattr(markup, "_ATTRIBUTE", Unused())
    assert markup._attributes(' A="1"  b = "x &amp; y" c="it\'s" /') == {"a": "1", "b": "x & y", "c": "it's"}


@pytest.mark.parametrize("raw", [
    "", "/", " x", ' a="1" a="2"', " a='1' b=\"2\"", ' a=1 b="2"', ' a b="2"', ' a="1"b="2"', '/a="1"', "\na=\"1\"\n", " a='x\"y' b='\"'", ' A="&lt;" a="2"', ' a="" b'])
def test_attributes_are_those_of_the_pattern(raw):
    found = {}
    for name, *values in markup._ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), markup.unescape("".join(values)))
    assert markup._attributes(raw) == found


def test_slugs_with_and_without_hyphens(spark):
    slugs = [("Zap", "zap", "base"), ("hog-rider", "hog-rider", "base"), ("Hog-Rider-EV2", "hog-rider", "ev2"), ("x-hero", "x", "hero"),
             (" x-hero ", " x-hero ", "hero"), ("x-ev", "x-ev", "base"), ("-hero", "", "hero"), ("", "", "base"), (None, None, "base")]
    rows = spark.createDataFrame(slugs, "c string, b string, f string").select(X.base_slug(F.col("c")), "b", X.card_form(F.col("c")), "f").collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in rows)


@pytest.mark.parametrize("html, seconds", [
    ('<div class="marker end_time"> 1:05</div><em>7:07</em>', 65), ('<div class="end_time">1:05</div><em>7:07</em>', 427),
    ('<div class="marker end_time">soon</div><div class="end_time marker">0:09</div>', 9), ("<em>0:30</em><em>0:20</em>", 30), ("", None), (None, None)])
def test_duration(spark, html, seconds):
    assert spark.createDataFrame([(html,)], "h string").select(replays.duration_seconds(F.col("h"))).first()[0] == seconds


@pytest.mark.parametrize("reader", [markup._battles, markup._profile, markup._board])
def test_workers_read_pages_without_the_package(reader, tmp_path):
    load = "import pickle, sys; print(type(pickle.loads(sys.stdin.buffer.read())('<script>initRoster($(\\'#roster\\'), []);</script>')).__name__)"
    made = subprocess.run([sys.executable, "-c", load], input=cloudpickle.dumps(reader), capture_output=True, cwd=tmp_path, timeout=60)
    assert made.returncode == 0, made.stderr.decode()


def test_cohort_reads_pages_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(body):
        read.add(1)
        return body

    # Customers on a board and with a profile each; a count per body read shows how often pages are parsed.
    people = spark.range(40).selectExpr("id AS c_custkey")
    profiles = R.profile_pages(people).withColumn("body", seen.asNondeterministic()("body"))
    boards = R.board_pages(people, "2024-08").withColumn("body", seen.asNondeterministic()("body"))
    assert jobs.build_cohort(boards, profiles, "2024-08", 20, True).count() == 20
    assert read.value == 40 + 1


def test_rosters_hold_all_players(spark, tmp_path):
    spark.range(5, 10_030).selectExpr("id AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    rows = entry_points.queries()["roster_file"](spark, str(tmp_path))
    got = rows.agg(F.count("*"), F.min("rank"), F.max("rank"), F.count_distinct("tag"), F.count_if(F.expr("tag <> 'TAG' || (rank + 4)"))).first()
    assert tuple(got) == (10_025, 1, 10_025, 10_025, 0)


def test_one_roster_is_still_bounded(spark, tmp_path):
    from matchloom.sources import sinks

    rows = spark.range(1, 10_002).selectExpr("id AS rank", "'TAG' || id AS tag", "'2024-03' AS rank_season")
    with pytest.raises(cohort.EvidenceError):
        sinks.write_roster({}, rows, f"{tmp_path}/roster")


def _written(monkeypatch, module):
    """Columns of the tables that a module writes, by label."""
    seen, real = {}, module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: seen.setdefault(label, (df.columns, real(df, label)))[1])
    return seen


def test_walk_writes_only_what_it_reads_of_battles(spark, monkeypatch):
    from matchloom.catalog import pools

    seen = _written(monkeypatch, pools)
    pools._walk(spark, "/root/testdata/sf0.001")
    assert sorted(seen["pool-battles"][0]) == sorted(pools.pool.SIGHTING)


def test_documents_and_battles_are_judged_without_tables_between(spark, monkeypatch):
    from matchloom.catalog import flows

    seen = _written(monkeypatch, flows)
    flows._judged(spark, "/root/testdata/sf0.001")
    assert not seen


def test_cards_outside_the_contract_are_named(spark):
    from pyspark.sql import functions as F

    from matchloom.catalog.flows import CONTRACT
    from matchloom.operators import gate

    cards = [f"card{i}" for i in range(6)] + ["zap", "drone-ev1"]
    player = ("struct<tower_troop:string,tower_troop_level:int,full_deck:array<string>,card_levels:map<string,int>,"
              "deck_cards:array<struct<slot:int,slug:string,base_slug:string,form:string,level:int>>>")
    df = spark.createDataFrame([(cards, cards)], "team_deck array<string>, opponent_deck array<string>").withColumn(
        "rounds", F.lit(None).cast(f"array<struct<team:array<{player}>,opponent:array<{player}>>>"))
    found = df.select(gate._deck_tier(CONTRACT)).first()[0]
    assert found == ["team_native_card_mapping_missing:drone-ev1,zap", "opponent_native_card_mapping_missing:drone-ev1,zap"]


def test_ordinary_faults_write_only_what_the_checks_read(spark, monkeypatch):
    from matchloom.catalog import faults

    seen = _written(monkeypatch, faults)
    assert faults.ordinary_faults(spark, "/root/testdata/sf0.001").count() > 0
    assert sorted(seen["checked"][0]) == sorted(["k", "battle_tag", "_first", *faults.gate.CHECKED])


def test_gate_faults_write_only_what_the_gate_reads(spark, monkeypatch):
    from matchloom.catalog import faults

    seen = _written(monkeypatch, faults)
    assert faults.gate_faults(spark, "/root/testdata/sf0.001").filter("reason <> ''").count() > 0
    columns, judged = seen["judged"]
    assert sorted(columns) == sorted(["k", "decision", "tier", "reason", *faults.gate.JUDGED])
    assert judged.filter("decision <> 'accepted' AND (card_plays IS NOT NULL OR rounds IS NOT NULL)").count() == 0
    assert judged.filter("decision = 'accepted' AND card_plays IS NOT NULL").count() > 0


def test_pages_of_a_task_are_few(spark):
    assert R.tasks_for(spark.range(1_000_001)) == 201  # a Python worker holds the pages of 5 000 battles at once


def test_stream_writes_only_what_it_stores_of_judged_documents(spark, monkeypatch):
    from matchloom.catalog import flows
    from matchloom.streaming import acceptance

    columns, real = [], acceptance.materialize
    monkeypatch.setattr(acceptance, "materialize", lambda df, label: (columns.append((label, df.columns)), real(df, label))[1])
    flows._accept_stream(spark, "/root/testdata/sf0.001", 1 << 40)
    judged = [c for label, c in columns if label == "judged"]
    assert len(judged) == 2 and all(sorted(c) == sorted([*acceptance.STORED, "decision", "tier", "reason"]) for c in judged)
