"""Domain tables derived from the input tables.

The expressions are plain enough to hold in Spark and in the checking SQL alike, so a
derived table is stated once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.operators.frontier import dispatch_rank
from matchloom.operators.select import first_by
from matchloom.session import load

TASK = {
    "id": "event_id",
    "kind": "CASE event_type WHEN 'click' THEN 'detail' WHEN 'purchase' THEN 'upgrade' WHEN 'signup' THEN 'source' ELSE 'list' END",
    "status": "CASE user_id % 5 WHEN 1 THEN 'done' WHEN 3 THEN 'dead' WHEN 4 THEN 'inflight' ELSE 'pending' END",
    "next_retry_at": "(event_id * 37) % 100003",
    "discovery_band": "CASE WHEN event_type = 'view' AND event_id % 3 = 0 THEN 1 ELSE 0 END",
    "url": "CASE WHEN event_type = 'error' THEN '/player/U' || user_id || '/battles/history?before=' || event_id "
           "ELSE '/player/U' || user_id || '/battles' END",
    "dedup_key": "'battle:B' || event_id",
}
REQUEST = {
    "seq": "event_id",
    "lane": "'lane' || (user_id % 6)",
    "outcome": "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'challenge' WHEN 'purchase' THEN 'rate_limited' ELSE 'success' END",
    "latency_s": "CASE WHEN event_id % 13 = 5 THEN NULL ELSE value END",
    "cache_hit": "event_id % 7 = 0",
    "parsed": "event_type = 'view'",
    "missing_candidates": "CASE WHEN event_id % 11 = 0 THEN event_id % 5 ELSE 0 END",
}
PAGE_CHAIN = {
    "player": "user_id",
    "seq": "event_id",
    "task_id": "event_id - event_id % 2",
    "eligible": "event_id % 4",
    "new": "CASE WHEN event_type IN ('view', 'click') THEN event_id % 4 ELSE 0 END",
    "cutoff": "event_type = 'error'",
    "fingerprint": "'f' || (event_id % 3)",
    "cursor": "1700000000000 - event_id * 10 + (event_id % 5) * user_id",
}
VISIT = {
    "url": "'/players/' || user_id",
    "seq": "event_id",
    "at": "event_id * 60",
    "ok": "event_type <> 'error'",
    "new_count": "CASE WHEN event_type = 'view' THEN event_id % 3 ELSE 0 END",
    "error": "CASE WHEN event_type = 'error' THEN 'failed ' || event_id END",
    "html_sha256": "'h' || event_id",
}
DECISION = {
    "battle_tag": "'U' || user_id",
    "seq": "event_id",
    "status": "CASE WHEN event_type = 'purchase' AND value > 60 THEN 'accepted' WHEN event_type = 'error' THEN 'rejected' ELSE 'queued' END",
    "tier": "'tier_' || event_type",
    "reason": "CASE WHEN event_type = 'error' THEN 'r' || event_id END",
    "saved_path": "CASE WHEN event_type = 'purchase' THEN 'p' || event_id END",
    "source_path": "CASE WHEN event_type = 'view' THEN 's' || event_id END",
    "source_schema_version": "CASE WHEN event_id % 4 = 0 THEN event_id % 5 END",
    "contract_sha256": "CASE WHEN event_id % 3 = 0 THEN 'c' || (event_id % 2) END",
}
OBSERVATION = {
    "battle_tag": "'U' || user_id",
    "seq": "event_id",
    "team": "CASE WHEN event_id % 7 = 0 THEN '' WHEN event_type IN ('view', 'click', 'error') THEN '#a' ELSE 'B' END",
    "opponent": "CASE WHEN event_id % 5 = 0 THEN '' WHEN event_type IN ('view', 'click', 'error') THEN 'B' ELSE 'a' END",
    "complete": "event_id % 3 <> 0 AND value > 5",
    "authoritative_complete": "event_id % 3 <> 0 AND value > 30",
}


def _sql(columns: dict[str, str], table: str) -> str:
    return "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {table})"


def _df(spark: SparkSession, sf: str, table: str, columns: dict[str, str]) -> DataFrame:
    return load(spark, sf, table).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


TASK_SQL = _sql(TASK, "events")
REQUEST_SQL = _sql(REQUEST, "events")
PAGE_CHAIN_SQL = _sql(PAGE_CHAIN, "events")
VISIT_SQL = _sql(VISIT, "events")
DECISION_SQL = _sql(DECISION, "events")
OBSERVATION_SQL = _sql(OBSERVATION, "events")


def tasks(spark: SparkSession, sf: str) -> DataFrame:
    return _df(spark, sf, "events", TASK).withColumn(
        "dispatch_rank", dispatch_rank(F.col("kind"), F.col("discovery_band"), F.col("url")))


RANKED_TASK_SQL = (
    "(SELECT *, CASE WHEN kind IN ('detail', 'upgrade') THEN 0 WHEN kind IN ('upgrade_list', 'source') THEN 1 "
    "WHEN kind = 'list' AND discovery_band > 0 THEN 4 WHEN kind = 'list' AND url NOT LIKE '%/history?before=%' THEN 2 "
    f"ELSE 3 END AS dispatch_rank FROM {TASK_SQL})"
)


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return _df(spark, sf, "events", REQUEST)


def page_chains(spark: SparkSession, sf: str) -> DataFrame:
    return _df(spark, sf, "events", PAGE_CHAIN)


def visits(spark: SparkSession, sf: str) -> DataFrame:
    return _df(spark, sf, "events", VISIT)


def decision_log(spark: SparkSession, sf: str) -> DataFrame:
    return _df(spark, sf, "events", DECISION)


def observations(spark: SparkSession, sf: str) -> DataFrame:
    def tags(c: str):
        return F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.array(F.col(c)))

    return _df(spark, sf, "events", OBSERVATION).withColumns(
        {"team_tags": tags("team"), "opponent_tags": tags("opponent")})


# Facts of the rendered battles (see ``rendering``), as SQL over ``orders``.
FACTS_SQL = (
    "(SELECT o_orderkey AS k, o_custkey AS c, CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 1000 AS ts, "
    "o_orderkey // 25 AS page_no, 'B' || o_orderkey AS tag, 'OWN' || (o_orderkey // 25) AS owner, "
    "'OPP' || o_custkey AS rival, o_orderkey % 37 = 11 AS bare FROM orders)"
)
COMPLETE = "(NOT bare AND k % 10 <> 3)"
NORMAL = f"({COMPLETE} AND k % 17 <> 5 AND k % 29 <> 6 AND k % 13 <> 4)"
AUTHORITATIVE = f"({COMPLETE} AND k % 23 <> 9 AND k % 31 <> 8 AND k % 19 <> 7)"


def markers(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as markers, one per (order, line): the first of equal ones."""
    rows = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS battle", "l_linenumber AS idx", "l_partkey AS card", "l_suppkey AS player",
        "CASE WHEN l_returnflag = 'R' THEN 'team' ELSE 'opponent' END AS side",
        "CAST(l_quantity AS BIGINT) AS tick")
    return first_by(rows, ["battle", "idx"], "card", "player", "side", "tick")


MARKER_SQL = (
    "(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY battle, idx ORDER BY card, player, side, tick) AS rn "
    "FROM (SELECT l_orderkey AS battle, l_linenumber AS idx, l_partkey AS card, l_suppkey AS player, "
    "CASE WHEN l_returnflag = 'R' THEN 'team' ELSE 'opponent' END AS side, CAST(l_quantity AS BIGINT) AS tick FROM lineitem)) WHERE rn = 1)"
)
