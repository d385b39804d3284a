"""Continuous jobs, run over what is there and compared with their batch meaning."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from matchloom.catalog import derived as D
from matchloom.catalog.cohorts import _BATTLE, _MEMBER_SQL, _members
from matchloom.catalog.registry import query
from matchloom.catalog.work import _FOLD, _VISIT_STATE
from matchloom.session import fresh_dir, load
from matchloom.streaming import counters, ingest, visits
from matchloom.streaming.store import Store


def _in_batches(spark, sf, table: str, order: str, drain, batches: int = 3) -> None:
    """The table arrives in parts, in ``order``; after each, ``drain`` takes a stream of what is new and stops. Each part is as
    many files as tasks write it, and each time but the first starts from the checkpoint."""
    path, rows = fresh_dir(spark, f"stream-{table}"), load(spark, sf, table)
    width = rows.agg((F.max(order) + 1) / batches).scalar()
    for i in range(batches):
        rows.filter(F.floor(F.col(order) / width) == i).write.mode("append").parquet(path)
        drain(ingest.table_stream(spark, path, rows, max_files=100_000))


def _select(df, columns: dict[str, str]):
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def stream_dedup(spark, sf):
    out, mark = fresh_dir(spark, "dedup"), fresh_dir(spark, "mark")
    keys = ["user_id", "event_type"]
    _in_batches(spark, sf, "events", "event_id", lambda new: ingest.dedup_into(new, out, mark, keys, "event_id"))
    return Store(spark, out, keys).read().select("user_id", "event_type", "event_id")


@query("""
WITH w AS (SELECT CAST(epoch(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')) AS BIGINT) AS start_s, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT * FROM w WHERE start_s + 21600 <= (SELECT floor(epoch(max(ts))) - 3600 FROM events)
""")
def stream_throughput(spark, sf):
    """Windows the watermark has closed."""
    out, mark = fresh_dir(spark, "throughput"), fresh_dir(spark, "mark")
    def drain(new):
        counted = ingest.throughput_stream(new, "ts", "6 hours", "1 hour", "event_type")
        ingest.run_available(counted.writeStream.format("parquet").option("path", out).outputMode("append"), mark)

    _in_batches(spark, sf, "events", "event_id", drain)
    return spark.read.parquet(out)


@contextmanager
def rocks(spark):
    """Keyed state with timers needs this provider; the session's own setting comes back."""
    name, provider = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _visited(spark, sf) -> tuple[str, str]:
    """Checkpoint and output folder of the visit stream, restarted after every part of the log."""
    out, mark = fresh_dir(spark, "visits"), fresh_dir(spark, "mark")

    def drain(new):
        states = visits.visit_stream(_select(new, D.VISIT), "url", 1800.0, 7200.0)
        ingest.log_into(states, out, mark, "update")

    with rocks(spark):
        _in_batches(spark, sf, "events", "event_id", drain)
    return mark, out


@query(_VISIT_STATE)
def stream_visits(spark, sf):
    """State of every source, kept by the stream and read from its checkpoint."""
    mark, _ = _visited(spark, sf)
    return visits.visit_table(spark, mark, "url", 1800.0)


@query(f"""
WITH v AS {D.VISIT_SQL}, w AS (SELECT max("at") AS clock FROM v), c AS ({_VISIT_STATE})
SELECT url, due FROM c, w WHERE due <= clock
""")
def stream_due(spark, sf):
    """Sources whose time had come, by the stream's clock, when the log ended: the rows that timers sent out and no later
    visit took back."""
    _, out = _visited(spark, sf)
    sent = spark.read.parquet(out).withColumn("_due", (F.col("kind") == "due").cast("int"))
    newest = sent.groupBy("key").agg(F.max_by(F.struct("kind", "due"), F.struct("generation", "_due")).alias("l"))
    return newest.filter("l.kind = 'due'").select(F.col("key").alias("url"), "l.due")


@query(_FOLD)
def stream_metadata(spark, sf):
    out, mark = fresh_dir(spark, "metadata"), fresh_dir(spark, "mark")

    def tags(c: str):
        return F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.array(F.col(c)))

    def drain(new):
        seen = _select(new, D.OBSERVATION).withColumns({"team_tags": tags("team"), "opponent_tags": tags("opponent"), "origin": F.col("seq")})
        ingest.metadata_into(seen, out, mark)

    _in_batches(spark, sf, "events", "event_id", drain)
    return Store(spark, out, ["battle_tag"]).read().select("battle_tag", F.col("origin").alias("seq"), "complete", "authoritative_complete")


@query(f"""
WITH b AS {D._sql(_BATTLE, "orders")}, m AS {_MEMBER_SQL}, s AS (SELECT battle_tag, 'team' AS side, upper(ltrim(team_tag, '#')) AS tag FROM b UNION ALL SELECT battle_tag, 'opponent', opponent_tag FROM b)
SELECT battle_tag, side, tag, "rank" FROM s JOIN m USING (tag)
""")
def stream_members(spark, sf):
    out, mark = fresh_dir(spark, "members"), fresh_dir(spark, "mark")
    members = _members(spark, sf)

    def drain(new):
        arriving = _select(new, _BATTLE).select(
            "battle_tag", F.array("team_tag").alias("team_tags"), F.array("opponent_tag").alias("opponent_tags"))
        ingest.log_into(ingest.member_battles(arriving, members), out, mark)

    _in_batches(spark, sf, "orders", "o_orderkey", drain)
    return spark.read.parquet(out).select("battle_tag", "side", "tag", "rank")


@query("SELECT 'TAG' || c_custkey AS value FROM customer")
def stream_seeds(spark, sf):
    """Seed files as they arrive, comments skipped."""
    path, out, mark = fresh_dir(spark, "seeds"), fresh_dir(spark, "seen"), fresh_dir(spark, "mark")
    lines = load(spark, sf, "customer").selectExpr(
        "explode(array(' TAG' || c_custkey || ' ', '// note', ';' || c_custkey, '')) AS value")
    lines.write.text(path)
    ingest.log_into(ingest.seed_stream(spark, path), out, mark)
    return spark.read.parquet(out).select("value")


@query(f"""
WITH t AS (SELECT user_id AS id, arg_max(kind, event_id) AS kind, arg_max(status, event_id) AS status FROM (SELECT user_id, event_id, {D.TASK['kind']} AS kind,
  CASE event_id % 5 WHEN 1 THEN 'done' WHEN 3 THEN 'dead' WHEN 4 THEN 'inflight' ELSE 'pending' END AS status FROM events) GROUP BY 1)
SELECT kind, status, count(*) AS n FROM t GROUP BY ALL
""")
def maintained_counts(spark, sf):
    """Tasks per kind and status after every change, kept by differences."""
    root, mark = fresh_dir(spark, "counters"), fresh_dir(spark, "mark")
    state = {"id": "user_id", "kind": D.TASK["kind"], "seq": "event_id",
             "status": "CASE event_id % 5 WHEN 1 THEN 'done' WHEN 3 THEN 'dead' WHEN 4 THEN 'inflight' ELSE 'pending' END"}
    _in_batches(spark, sf, "events", "event_id", lambda new: counters.counted_into(_select(new, state), root, mark, "id", ["kind", "status"]))
    return Store(spark, f"{root}/counts", ["kind", "status"], buckets=1).read()
