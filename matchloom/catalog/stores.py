"""Files and stores: the given tables are written to the shared folder in a reader's form, read back by it,
and compared with what was written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom import values as V
from matchloom.catalog.registry import query
from matchloom.operators import cohort, gate, revisit
from matchloom.plans import jobs
from matchloom.session import fresh_dir, load
from matchloom.sources import contracts, readers, sinks
from matchloom.streaming import ingest


@query("SELECT 'B' || o_orderkey AS battle_tag FROM orders")
def exclusion_manifest(spark, sf):
    """A manifest of JSON lines with the expected number of tags, each once."""
    path, tags = fresh_dir(spark, "exclusions"), load(spark, sf, "orders").selectExpr("'B' || o_orderkey AS battle_tag")
    tags.write.json(path)
    return readers.exclusions(spark, path, tags.count())


@query("""
SELECT 'replays/' || l_orderkey || '-' || l_linenumber || '.json' AS source_path, CASE WHEN l_linenumber % 3 <> 0 THEN 'B' || l_orderkey END AS battle_tag,
  CAST(3 + l_linenumber % 2 AS INTEGER) AS schema_version FROM lineitem
""")
def upgrade_manifest_rows(spark, sf):
    path = fresh_dir(spark, "manifest")
    load(spark, sf, "lineitem").selectExpr(
        "'replays/' || l_orderkey || '-' || l_linenumber || '.json' AS source_path",
        "CASE WHEN l_linenumber % 3 <> 0 THEN 'B' || l_orderkey END AS battle_tag", "3 + l_linenumber % 2 AS schema_version").write.json(path)
    return readers.upgrade_manifest(spark, path).select("source_path", "battle_tag", "schema_version")


@query("""
SELECT CASE WHEN o_orderkey % 50 = 7 THEN 'damaged' ELSE 'good' END AS state, count(*) AS n FROM orders GROUP BY 1
""")
def index_repair(spark, sf):
    """An index with damaged lines: they are set apart, the others are kept."""
    path = fresh_dir(spark, "index-lines")
    load(spark, sf, "orders").selectExpr(
        "CASE WHEN o_orderkey % 50 = 7 THEN '{\"kind\": \"battle\", \"battle_tag\": ' ELSE "
        "to_json(struct('battle' AS kind, 'B' || o_orderkey AS battle_tag, 'http://x/' || o_orderkey AS url)) END AS value").write.text(path)
    good, bad = readers.index_rows(spark, path)
    return good.select(F.lit("good").alias("state")).unionByName(bad.select(F.lit("damaged").alias("state"))).groupBy("state").agg(
        F.count(F.lit(1)).alias("n"))


@query("""
SELECT 'B' || o_orderkey AS battle_tag, CAST(1 + o_orderkey % 5 AS INTEGER) AS schema_version, CASE WHEN o_orderkey % 5 > 1 THEN CAST(o_orderkey % 360 AS INTEGER) END AS duration_seconds FROM orders
""")
def replay_corpus_rows(spark, sf):
    """Documents of all versions; what a version lacks is null."""
    path = fresh_dir(spark, "corpus")
    load(spark, sf, "orders").selectExpr(
        "'B' || o_orderkey AS battle_tag", "1 + o_orderkey % 5 AS schema_version",
        "CASE WHEN o_orderkey % 5 > 1 THEN o_orderkey % 360 END AS duration_seconds").write.json(path)
    return readers.replay_corpus(spark, path).select("battle_tag", "schema_version", "duration_seconds")


@query("SELECT row_number() OVER (ORDER BY s_suppkey) AS rank, 'TAG' || s_suppkey AS tag, '2024-03' AS rank_season FROM supplier")
def roster_file(spark, sf):
    """Roster manifests written once, written again unchanged, and read with their rules and digests checked. One manifest holds
    ``MAX_RANK`` players at most, so there are as many as the players need, each ranked from one."""
    suppliers = load(spark, sf, "supplier").select("s_suppkey")
    least, most = suppliers.agg(F.min("s_suppkey"), F.max("s_suppkey")).first()
    players = suppliers.select(
        (F.col("s_suppkey") - least + 1).cast("bigint").alias("rank"), F.concat(F.lit("TAG"), "s_suppkey").alias("tag"),
        F.lit("2024-03").alias("rank_season"))
    path, found = fresh_dir(spark, "roster"), []
    for low in range(0, 1 if least is None else most - least + 1, V.MAX_RANK):
        part = players.filter((F.col("rank") > low) & (F.col("rank") <= low + V.MAX_RANK)).withColumn("rank", F.col("rank") - low)
        manifest = {
            "schema_version": 1, "season_id": "2024-03", "ranking_type": V.RANKING_TYPE, "top_n": part.count(), "eligibility": "season_top_n",
            "start_utc": "2024-03-04T08:00:00Z", "end_utc": "2024-04-01T08:00:00Z", "source_urls": ["https://site.example/board"],
            "boundary_source": "announced"}
        for _ in range(2):
            sinks.write_roster(manifest, part, f"{path}/{low}")
        read = contracts.load_roster(spark, f"{path}/{low}", F.lit("2024-06-01").cast("timestamp"), "2024-03")[0]
        found.append(read.withColumn("rank", F.col("rank") + low))
    return reduce(DataFrame.unionByName, found)


@query("SELECT DISTINCT lower(trim(p_brand)) AS card FROM part")
def contract_file(spark, sf):
    """A contract document with its digest, read and checked."""
    document = load(spark, sf, "part").agg(
        F.array_sort(F.collect_set("p_brand")).alias("allowed_card_tokens"), F.array_sort(F.collect_set(F.lower("p_type"))).alias("allowed_tower_troops")
    ).select(
        F.lit(3).alias("schema_version"), F.lit(V.CONTRACT_KINDS[3]).alias("kind"), F.lit("1.0").alias("game_version"), "allowed_card_tokens",
        "allowed_tower_troops", F.slice("allowed_card_tokens", 1, 1).alias("ability_source_tokens"),
        F.array(F.lit(1).cast("bigint")).alias("source_numeric_game_mode_ids"),
        F.create_map(F.lit("1"), F.lit(9).cast("bigint")).alias("native_execution_mode_by_source"),
        F.create_map(F.lit(str(V.KING_LEVEL)), F.lit(V.KING_FULL_HP).cast("bigint")).alias("king_tower_max_hp_by_level"),
        F.struct(F.lit(1).alias("schema_version")).alias("king_tower_level_evidence"))
    path = fresh_dir(spark, "contract")
    document.withColumn("contract_sha256", contracts.contract_digest()).coalesce(1).write.json(path)
    found = contracts.load_contract(spark, path, "1.0")
    return spark.createDataFrame([(c,) for c in found.cards], "card string")


_CAPTURES = {
    "url": "url", "status": "200", "body": "html", "lane": "'direct'", "fetched_at": "timestamp_seconds(1704067200 + page_id % 30 * 86400)",
    "latency_s": "CAST(0.5 AS DOUBLE)", "seq": "page_id"}


@query("SELECT CAST(CAST('2024-01-01' AS DATE) + CAST(page_id % 30 AS INTEGER) AS DATE) AS day, count(*) AS pages FROM pages GROUP BY 1")
def page_archive(spark, sf):
    """Captured pages archived by date and read back."""
    path = fresh_dir(spark, "archive")
    sinks.archive_pages(load(spark, sf, "pages").selectExpr(*[f"{e} AS {n}" for n, e in _CAPTURES.items()]), path)
    return spark.read.parquet(path).groupBy(F.col("fetched_date").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("pages"))


@query("SELECT page_id AS seq, url FROM pages")
def stream_pages(spark, sf):
    """Pages as they are captured, each batch in its own folder."""
    source, out, mark = fresh_dir(spark, "captures"), fresh_dir(spark, "pages"), fresh_dir(spark, "mark")
    load(spark, sf, "pages").selectExpr(*[f"{e} AS {n}" for n, e in _CAPTURES.items()]).withColumn(
        "status", F.col("status").cast("int")).write.parquet(source)
    ingest.log_into(ingest.page_stream(spark, source, 4), out, mark)
    return spark.read.parquet(out).select("seq", "url")


@query("SELECT '#TAG' || c_custkey AS value FROM customer")
def seed_list(spark, sf):
    """A seed list with half of the tags, then all of them offered: only the new ones are added."""
    path, tags = fresh_dir(spark, "seeds"), load(spark, sf, "customer").selectExpr("c_custkey", "'TAG' || c_custkey AS tag")
    sinks.write_seeds(tags.filter("c_custkey % 2 = 0"), path)
    sinks.append_new_seeds(tags, path)
    return readers.seeds(spark, path).select("value")


@query("SELECT count(*) AS tasks, count(*) FILTER (WHERE o_orderstatus = 'F') AS done FROM orders")
def status_snapshot(spark, sf):
    path = fresh_dir(spark, "status")
    sinks.write_status(load(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("tasks"), F.count_if(F.col("o_orderstatus") == "F").alias("done")), path)
    return spark.read.json(path).select("tasks", "done")


@query("SELECT 'B' || o_orderkey AS battle_tag FROM orders WHERE floor(epoch(o_orderdate)) <= 890000000 + 300")
def battles_not_ahead(spark, sf):
    """Battles whose stamp is not in the future of the capture, five minutes allowed."""
    rows = load(spark, sf, "orders").selectExpr("'B' || o_orderkey AS battle_tag", "unix_timestamp(o_orderdate) AS timestamp", "true AS normal_1v1")
    return rows.filter(gate.eligible(now=890_000_000)).select("battle_tag")


@query("""
SELECT 'open' AS pool, 'CUST' || c_custkey AS tag FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
""")
def pool_frozen(spark, sf):
    """Offers to an open pool are taken, to a frozen one none."""
    offers = load(spark, sf, "customer").selectExpr("'CUST' || c_custkey AS tag", "c_custkey AS seq")
    members = load(spark, sf, "supplier").selectExpr("'CUST' || s_suppkey AS tag")
    taken = [cohort.new_candidates(offers, members, offers.limit(0), 1 << 30, pool_open).select(F.lit(name).alias("pool"), "tag")
             for name, pool_open in (("open", True), ("frozen", False))]
    return taken[0].unionByName(taken[1])


_OUTCOME = "CASE user_id % 7 WHEN 0 THEN 'retry' WHEN 1 THEN 'dead' WHEN 2 THEN 'skipped' ELSE 'done' END"


@query(f"""
SELECT count(*) AS outcomes, count(*) FILTER (WHERE o = 'done') AS done, count(*) FILTER (WHERE o = 'retry') AS retry,
  count(*) FILTER (WHERE o = 'dead') AS dead, count(*) FILTER (WHERE o = 'skipped') AS skipped FROM (SELECT {_OUTCOME} AS o FROM events)
""")
def run_counters(spark, sf):
    """Outcome counters of a run."""
    return jobs.run_counters(load(spark, sf, "events").selectExpr("event_type AS kind", f"{_OUTCOME} AS outcome")).drop("by_kind")


@query("""
WITH s AS (SELECT user_id, max(event_id % 5000) AS due FROM events GROUP BY 1)
SELECT count(*) FILTER (WHERE user_id % 3 = 0) AS seen, count(*) FILTER (WHERE user_id % 3 <> 0) AS discovered,
  count(*) FILTER (WHERE due <= 4000) AS due_now, min(due) FILTER (WHERE due > 4000) AS next_due FROM s
""")
def visit_overview(spark, sf):
    states = load(spark, sf, "events").groupBy("user_id").agg(F.max(F.col("event_id") % 5000).alias("due"))
    return revisit.visit_overview(states, states.filter("user_id % 3 = 0"), "user_id", 4000)


class _Crash(Exception):
    """Stands for a driver that is lost."""


@query("SELECT 'battle|B' || o_custkey AS index_key, min(o_orderkey) AS seq FROM orders GROUP BY 1")
def outbox_recovery(spark, sf):
    """Index records staged with their data and published later, with a crash before a publication and one within: nothing is
    lost, nothing is there twice."""
    outbox, path = fresh_dir(spark, "outbox"), fresh_dir(spark, "index")
    rows = load(spark, sf, "orders").selectExpr("'battle' AS kind", "'B' || o_custkey AS battle_tag", "'u' || o_orderkey AS url", "o_orderkey AS seq")
    width = rows.agg((F.max("seq") + 1) / 4).scalar()

    def batch(number: int, crash: str = "") -> None:
        sinks.stage_index(rows.filter(F.floor(F.col("seq") / width) == number), outbox, number)
        if crash == "before":
            raise _Crash
        if crash == "within":
            waiting = [f"{outbox}/batch_id={b}" for b in sinks.waiting_batches(spark, outbox)]
            sinks.append_index(spark.read.parquet(*waiting), path)
            raise _Crash
        sinks.publish_index(spark, outbox, path)

    for number, crash in enumerate(("", "before", "within", "")):
        try:
            batch(number, crash)
        except _Crash:
            sinks.waiting_batches(spark, outbox)
    return spark.read.parquet(path).select("index_key", "seq")


@query("SELECT 'B' || o_orderkey AS battle_tag, o_custkey AS seq FROM orders")
def import_ledger(spark, sf):
    """Files imported once each, over a run that is lost between its claim and its record and one that finds nothing new."""
    source, ledger, into = fresh_dir(spark, "manifests"), fresh_dir(spark, "ledger"), fresh_dir(spark, "imported")
    rows = load(spark, sf, "orders").selectExpr("'B' || o_orderkey AS battle_tag", "o_custkey AS seq", "o_orderkey % 3 AS part")

    def parse(lines):
        return lines.select(F.from_json("value", "battle_tag string, seq bigint").alias("j")).select("j.*")

    def lost(lines):
        parse(lines).limit(10).write.mode("overwrite").parquet(f"{into}/n=1")
        raise _Crash

    for part, reader in ((0, parse), (1, lost), (2, parse)):
        rows.filter(F.col("part") == part).drop("part").write.mode("append").json(source)
        try:
            readers.import_new(spark, source, ledger, into, reader)
        except _Crash:
            continue
    readers.import_new(spark, source, ledger, into, parse)
    return spark.read.parquet(into).select("battle_tag", "seq")
