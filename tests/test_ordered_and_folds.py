"""Piecewise operators against plain sequential code, with pieces far smaller than groups."""

import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators import event_order, frontier, ordered, select, telemetry, upsert


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    # One key holds most rows; one key is null.
    return [(rng.choice(["hot", "hot", "hot", "b", None]), s, rng.randint(0, 2), rng.randint(0, 9)) for s in rng.sample(range(400), 250)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "key string, seq bigint, new int, tick int")


def groups(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_ranked(df, rows, span):
    expected = {(k, r[1]): i + 1 for k, g in groups(rows).items() for i, r in enumerate(g)}
    assert {(r.key, r.seq): r["rank"] for r in ordered.ranked(df, ["key"], "seq", span=span).collect()} == expected


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_lagged(df, rows, span):
    expected = {(k, r[1]): (g[i - 1][3] if i else None) for k, g in groups(rows).items() for i, r in enumerate(g)}
    assert {(r.key, r.seq): r.before for r in ordered.lagged(df, ["key"], "seq", {"before": "tick"}, span).collect()} == expected


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_run_lengths(df, rows, span):
    expected = {}
    for k, g in groups(rows).items():
        run = 0
        for r in g:
            run = run + 1 if r[2] == 0 else 0
            expected[(k, r[1])] = run
    got = ordered.run_lengths(df, ["key"], "seq", F.col("new") == 0, span=span)
    assert {(r.key, r.seq): r.chain for r in got.collect()} == expected


def test_before_first(df, rows):
    expected = {}
    for k, g in groups(rows).items():
        stopped = False
        for r in g:
            expected[(k, r[1])] = not stopped
            stopped = stopped or r[3] == 9
    assert {(r.key, r.seq): r.kept for r in ordered.before_first(df, ["key"], "seq", F.col("tick") == 9).collect()} == expected


def test_tick_order(df, rows):
    expected = {k: sum(a[3] > b[3] for a, b in zip(g, g[1:])) for k, g in groups(rows).items()}
    assert {r.key: r.falls for r in event_order.tick_order(df, ["key"], "seq", "tick", 5).collect()} == expected


@pytest.mark.parametrize("salts", [1, 5])
def test_top_per_group_is_exact(df, rows, salts):
    expected = {(k, r[1]) for k, g in groups(rows).items() for r in g[-6:]}
    got = select.top_per_group(df, ["key"], [F.col("seq").desc()], 6, salts=salts)
    assert {(r.key, r.seq) for r in got.collect()} == expected


@pytest.mark.parametrize("span", [3, 1000])
def test_latency_average(spark, span):
    rng = random.Random(3)
    log = [(lane, s, 0.0 if s < 20 and lane == "a" else rng.random() * 3) for lane in "ab" for s in range(100)] + [("z", 1, 0.0)]
    expected = {}
    for lane, _, x in log:
        e = expected.get(lane, 0.0)
        expected[lane] = x if e == 0.0 else 0.2 * x + 0.8 * e
    got = telemetry.latency_average(spark.createDataFrame(log, "lane string, seq bigint, latency_s double"), span=span)
    assert {r.lane: round(r.latency_ema, 9) for r in got.collect()} == {k: round(v, 9) for k, v in expected.items()}


def sequential_fold(observations):
    stored = None
    for o in sorted(observations, key=lambda o: o["seq"]):
        if stored is not None:
            clash = any(stored[s] and o[s] and stored[s] != o[s] for s in ("team_tags", "opponent_tags"))
            if clash or (stored["authoritative_complete"] and not o["authoritative_complete"]) or o["complete"] < stored["complete"]:
                continue
        stored = o
    return stored["seq"]


@pytest.mark.parametrize("fanout, levels, seed", [(2, 3, 1), (3, 2, 2), (16, 1, 3), (4096, 3, 4)])
def test_fold_equals_the_sequential_rule(spark, fanout, levels, seed):
    rng = random.Random(seed)
    data = []
    for battle in range(12):
        for seq in rng.sample(range(300), 1 if battle == 0 else rng.choice([2, 5, 60])):
            data.append({
                "battle_tag": f"B{battle}", "seq": seq, "team_tags": rng.choice([[], ["A"], ["A"], ["B"]]), "opponent_tags": rng.choice([[], ["B"], ["A"]]),
                "complete": rng.random() < 0.5, "authoritative_complete": rng.random() < 0.2})
    df = spark.createDataFrame(data, "battle_tag string, seq bigint, team_tags array<string>, opponent_tags array<string>, complete boolean, authoritative_complete boolean")
    got = {r.battle_tag: r.seq for r in upsert.fold_metadata(df, fanout=fanout, levels=levels).collect()}
    assert got == {t: sequential_fold([d for d in data if d["battle_tag"] == t]) for t in {d["battle_tag"] for d in data}}


def test_no_downgrade_and_perspective(spark):
    schema = "battle_tag string, seq bigint, team_tags array<string>, opponent_tags array<string>, complete boolean, authoritative_complete boolean, payload string"
    rows = [
        ("up", 1, ["A"], ["B"], False, False, "first"), ("up", 2, ["#a"], ["B"], True, False, "complete"), ("up", 3, ["A"], ["B"], False, False, "late"),
        ("auth", 1, ["A"], ["B"], True, True, "proof"), ("auth", 2, ["A"], ["B"], True, False, "plain"),
        ("side", 1, ["A"], ["B"], False, False, "mine"), ("side", 2, ["B"], ["A"], True, True, "theirs"),
        ("same", 1, ["A"], ["B"], True, False, "old"), ("same", 2, ["A"], ["B"], True, False, "new"),
    ]
    got = {r.battle_tag: r.payload for r in upsert.fold_metadata(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"up": "complete", "auth": "proof", "side": "mine", "same": "new"}


def test_decisions_stay_accepted(spark):
    schema = "battle_tag string, seq bigint, status string, tier string, reason string, saved_path string, source_path string, source_schema_version int, contract_sha256 string"
    log = [("x", 1, "queued", "q", None, None, "src", None, None), ("x", 2, "accepted", "gate", None, "p1", "other", 3, "c"), ("x", 3, "rejected", "deck", "r", "p2", None, 4, "d"),
           ("y", 1, "queued", "q", None, None, None, None, None), ("y", 2, "rejected", "mode", "r", None, None, None, None)]
    got = {r.battle_tag: r for r in upsert.decisions(spark.createDataFrame(log, schema)).collect()}
    assert (got["x"].status, got["x"].tier, got["x"].saved_path, got["x"].source_path, got["x"].source_schema_version) == ("accepted", "gate", "p1", "src", 3)
    assert (got["y"].status, got["y"].reason) == ("rejected", "r")


def slots_by_hand(n_root, n_history, n_overlap, cursor):
    """Bands by their own pattern while each still has rows."""
    left, out = {"r": n_root, "h": n_history, "o": n_overlap}, []
    while sum(left.values()):
        at = cursor % 5
        want = "o" if at == 4 else "h" if at in (1, 3) else "r"
        if not left[want]:
            break
        out.append(want)
        left[want] -= 1
        cursor += 1
    return out


@pytest.mark.parametrize("cursor", [0, 1, 3, 4, 7])
def test_band_order(spark, cursor):
    rows = [(rank, n) for rank, count in ((2, 8), (3, 8), (4, 4)) for n in range(1, count + 1)]
    df = spark.createDataFrame(rows, "rank int, n bigint").withColumn("slot", frontier.slot_bands(F.col("n"), F.col("rank"), F.lit(True), cursor))
    names = {2: "r", 3: "h", 4: "o"}
    expected = slots_by_hand(8, 8, 4, cursor)
    assert [names[r["rank"]] for r in df.orderBy("slot").collect()][:len(expected)] == expected


@pytest.mark.parametrize("ready, lists", [(9, 4), (3, 5), (20, 1), (0, 3), (4, 0)])
def test_four_to_one(spark, ready, lists):
    df = spark.createDataFrame([(False, n) for n in range(1, ready + 1)] + [(True, n) for n in range(1, lists + 1)], "l boolean, n bigint")
    got = [(r.l, r.n) for r in df.orderBy(frontier.slot_4_1(F.col("n"), F.col("l"))).collect()]
    a, b, expected = [(False, n) for n in range(1, ready + 1)], [(True, n) for n in range(1, lists + 1)], []
    while a or b:
        expected += a[:4] + b[:1] if a else b
        a, b = (a[4:], b[1:]) if a else ([], [])
    assert got == expected
