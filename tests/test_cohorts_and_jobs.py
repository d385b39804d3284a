import pytest
from pyspark.sql import functions as F

from matchloom.operators import admission, cohort, revisit
from matchloom.operators.cohort import EvidenceError
from matchloom.plans import jobs


def ranks(spark, rows):
    return spark.createDataFrame(rows, "rank bigint, tag string")


def proofs(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq bigint, tag string, rank bigint, rank_season string")


def test_complete_ranking(spark):
    got = cohort.ranked_players(ranks(spark, [(2, "#bbb"), (1, "AAA"), (1, "aaa"), (3, "CCC")]), 2)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "AAA"), (2, "BBB")]


@pytest.mark.parametrize("rows", [
    [(1, "AAA")], [(1, "AAA"), (2, "BBB"), (2, "CCC")], [(1, "AAA"), (2, "AAA")], [(1, "AAA"), (2, "BBB"), (None, "CCC")], [(1, "AAA"), (2, "b!")],
])
def test_ranking_problems_stop_the_job(spark, rows):
    with pytest.raises(EvidenceError):
        cohort.ranked_players(ranks(spark, rows), 2)


def test_conflict_beyond_the_cut_is_no_conflict(spark):
    assert cohort.ranked_players(ranks(spark, [(1, "AAA"), (5, "BBB"), (5, "CCC")]), 1).count() == 1


def test_historical_pool(spark):
    rows = [("AAA", 10001, "2024-01"), ("BBB", 5, "2024-01"), ("#aaa", 7, "2024-02"), ("BBB", 1, "2024-03"), ("CCC", 9, "2024-02")]
    got = cohort.historical_pool(proofs(spark, rows), 2, "2024-06")
    assert [(r.tag, r["rank"], r.rank_season) for r in got.orderBy("seq").collect()] == [("BBB", 5, "2024-01"), ("AAA", 7, "2024-02")]
    for bad in (rows + [("CCC", 8, "2024-02")], rows + [("DDD", 1, "2024-07")], rows + [("DDD", 1, "2024-13")], rows + [("DDD", None, "2024-01")]):
        with pytest.raises(EvidenceError):
            cohort.historical_pool(proofs(spark, bad), 2, "2024-06")
    with pytest.raises(EvidenceError):
        cohort.historical_pool(proofs(spark, rows), 4, "2024-06")


def test_admission_is_bounded_and_all_or_nothing(spark):
    members = spark.createDataFrame([("OLD", 3, "2024-01")], "tag string, rank bigint, rank_season string")
    candidates = spark.createDataFrame([("AAA",), ("ZZZ",)], "tag string")
    grown, left = cohort.admit(proofs(spark, [("OLD", 9, "2024-02"), ("AAA", 1, "2024-01"), ("BBB", 2, "2024-01")]), members, candidates, 2, "2024-06")
    assert sorted(r.tag for r in grown.collect()) == ["AAA", "OLD"] and [r.tag for r in left.collect()] == ["ZZZ"]
    for bad in ([("NEW", 1, "2024-01"), ("OLD", 4, "2024-01")], [("NEW", 1, "2024-01"), ("XXX", 10001, "2024-01")], [("NEW", 1, "2024-09")], [("NEW", 1, "2024-01"), ("NEW", 2, "2024-01")]):
        with pytest.raises(EvidenceError):
            cohort.admit(proofs(spark, bad), members, candidates, 9, "2024-06")


def test_offers(spark):
    members = spark.createDataFrame([("OLD",)], "tag string")
    offers = spark.createDataFrame([(1, "#new"), (2, "OLD"), (3, "new"), (4, "x"), (5, "TWO")], "seq bigint, tag string")
    known = members.filter("tag = 'none'")
    assert [r.tag for r in cohort.offer(offers, members, known, 5).orderBy("seq").collect()] == ["NEW", "TWO"]
    assert cohort.offer(offers, members, known, 1).count() == 0 and cohort.offer(offers, members, known, 5, frozen=True).count() == 0


def test_cap_keeps_earlier_members(spark):
    ready = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3), ("D", 4)], "battle_tag string, seq bigint")
    before = spark.createDataFrame([("C",), ("X",)], "battle_tag string")
    got = {r.battle_tag: r.admission for r in admission.capped(ready, before, 3).collect()}
    assert got == {"A": "accepted", "B": "skipped", "C": "recommitted", "D": "skipped"}
    # A target already passed admits nobody new, but takes back its own.
    assert {r.admission for r in admission.capped(ready, before, 1).collect()} == {"recommitted", "skipped"}


def test_visits(spark):
    rows = [("u", 1, 100, True, 0, None, "h1"), ("u", 2, 200, True, 5, None, "h2"), ("u", 3, 300, True, 0, None, "h3"), ("u", 4, 400, False, 0, "boom", None), ("u", 5, 500, False, 0, "bang", None),
            ("v", 1, 50, True, 0, None, "g")]
    log = spark.createDataFrame(rows, "url string, seq bigint, at bigint, ok boolean, new_count bigint, error string, html_sha256 string")
    got = {r.url: r for r in revisit.visit_state(log, "url", 1000, 5000, 60).collect()}
    u, v = got["u"], got["v"]
    assert (u.failures, u.zero_new_streak, u.fetched_at, u.html_sha256, u.last_error, u.due) == (2, 1, 300, "h3", "bang", 620.0)
    assert (v.failures, v.zero_new_streak, v.last_error, v.due) == (0, 1, None, 2050.0)


def test_watermark_counts_due_roots_only(spark):
    tasks = spark.createDataFrame([(1, "pending", 2, 0), (2, "pending", 2, 99), (3, "done", 2, 0), (4, "pending", 3, 0)], "id int, status string, dispatch_rank int, next_retry_at int")
    assert revisit.enough_fresh_roots(tasks, 10, 1) and not revisit.enough_fresh_roots(tasks, 10, 2)


def test_dispatch_gives_list_quota_back(spark):
    schema = "id bigint, kind string, status string, dispatch_rank int, next_retry_at bigint"
    only_ready = spark.createDataFrame([(i, "detail", "pending", 0, 0) for i in range(10)], schema)
    assert jobs.dispatch(only_ready, 5, 10, 2, 3).count() == 5
    mixed = spark.createDataFrame([(i, "detail", "pending", 0, 0) for i in range(10)] + [(20, "list", "pending", 2, 0), (21, "source", "pending", 1, 0), (22, "list", "inflight", 2, 0)], schema)
    got = [r.id for r in jobs.dispatch(mixed, 5, 10, 6, 3).orderBy("slot").collect()]
    assert got == [0, 1, 2, 3, 21, 4, 5, 20]
    assert jobs.dispatch(mixed, 5, 0, 6, 3).count() == 0


def test_board_of_another_season_stops_the_job(spark):
    page = lambda h: f"<h1>{h}</h1><script>initRoster($('#roster'), [{{\"rank\": 1, \"tag\": \"AAA\", \"x\": [1, 2]}}, {{\"rank\": \"2\", \"tag\": \"BBB\"}}], {{}});</script>"
    boards = spark.createDataFrame([(0, "u", page("Top Global Players for Season 2024-05"))], "seq bigint, url string, body string")
    rows = cohort.board_rows(boards, "2024-05").orderBy("position").collect()
    # A rank given as text is no integer rank.
    assert [(r["rank"], r.tag) for r in rows] == [(1, "AAA"), (None, "BBB")]
    with pytest.raises(EvidenceError):
        jobs.build_cohort(boards, None, "2024-06", 1, False)


def test_status_is_narrow(spark):
    from matchloom.operators import counts

    got = counts.as_metrics(spark.range(3).agg(F.count(F.lit(1)).alias("n")), "s").collect()
    assert [tuple(r) for r in got] == [("s", "n", 3.0)]
