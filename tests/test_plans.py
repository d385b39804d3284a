"""Physical plans: what reaches the scan, what is shuffled, what is gathered."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from matchloom.catalog import registry
from matchloom.catalog import battles, cohorts, flows, scalars, streams, work  # noqa: F401
from matchloom.catalog import derived as D
from matchloom.operators import frontier, ordered, select
from matchloom.plans import jobs
from matchloom.session import load

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_window_bounds_and_columns_reach_the_scan(spark):
    text = plan(registry.QUERIES["window_half_open"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate" in text
    assert "PushedFilters" in text and "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_small_exclusions_are_broadcast_by_size(spark):
    text = plan(registry.QUERIES["exclude_anti"](spark, SF))
    assert "LeftAnti" in text and "o_totalprice" not in text


def test_large_exclusions_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.QUERIES["exclude_anti"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and "LeftAnti" in text


def test_top_k_is_no_full_sort(spark):
    text = plan(frontier.ready_batch(D.tasks(spark, SF), 60000, 50))
    assert "TakeOrderedAndProject" in text and "Window" not in text


def test_first_sighting_combines_before_the_shuffle(spark):
    text = plan(select.first_by(D.markers(spark, SF), ["battle"], "idx"))
    assert "partial_min_by" in text and "Window" not in text


@pytest.mark.parametrize("make", [
    lambda s: ordered.ranked(D.page_chains(s, SF), ["player"], "seq", span=100),
    lambda s: ordered.lagged(D.page_chains(s, SF), ["player"], "seq", {"p": "new"}, 100),
    lambda s: ordered.run_lengths(D.page_chains(s, SF), ["player"], "seq", F.col("new") == 0, span=100),
])
def test_rows_are_never_partitioned_by_the_group_alone(spark, make):
    """The rows themselves shuffle by (group, piece); only piece totals shuffle by group."""
    text = plan(make(spark))
    by_group = [l for l in text.splitlines() if "hashpartitioning(player" in l]
    assert by_group and any("_piece" in l for l in by_group)


def test_gate_adds_no_shuffle(spark, tmp_path):
    """Merge, stamp, both checks: one join, nothing else moves rows."""
    docs, rows = str(tmp_path / "docs"), str(tmp_path / "rows")
    documents = jobs.replay_etl(battles._payloads(spark, SF).repartition(2))
    meta = battles._battles(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents.write.mode("overwrite").parquet(docs)
        meta.write.mode("overwrite").parquet(rows)
        judged = jobs.admit(spark.read.parquet(docs), spark.read.parquet(rows), flows.CONTRACT)
        text = plan(judged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") >= 1 and text.count("hashpartitioning(") == 2


def test_pages_are_parsed_once_even_under_filters(spark):
    rows = battles._battles(spark, SF).filter("complete AND NOT draft").select("battle_tag", "rounds")
    assert plan(rows).count("ArrowEvalPython") == 2  # named in the tree and in the details


def test_no_cross_joins_anywhere(spark):
    for name in ("status_report", "seed_receipt", "exclusion_import", "upgrade_confirmation", "dispatch_batch", "zero_chain", "pool_admission_problems"):
        text = plan(registry.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_columns_are_pruned(spark):
    text = plan(load(spark, SF, "events").select("user_id").distinct())
    assert "ReadSchema: struct<user_id:bigint>" in text
