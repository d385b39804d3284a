"""Scalar functions over whole tables: slugs, addresses, times, coordinates, delays."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog import rendering as R
from matchloom.catalog.derived import FACTS_SQL
from matchloom.catalog.registry import query
from matchloom.functions import backoff as B
from matchloom.functions import coords as C
from matchloom.functions import keys as K
from matchloom.functions import text as X
from matchloom.functions import times as T
from matchloom.functions import urls as U
from matchloom.operators import frontier, list_pages, revisit
from matchloom.session import load

_URL = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


@query(r"""
SELECT page_id, pos, href FROM (
  SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*\bhref="([^"]*)"', 1) AS h FROM pages))
""")
def page_links(spark, sf):
    pages = load(spark, sf, "pages")
    return pages.select("page_id", F.posexplode(list_pages.links(F.col("html"))).alias("pos", "href")).withColumn(
        "pos", F.col("pos").cast("bigint"))


@query(r"""
WITH l AS (SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) AS pos
           FROM (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*\bhref="([^"]*)"', 1) AS h FROM pages)),
     f AS (SELECT page_id, href, min(pos) AS pos FROM l GROUP BY ALL)
SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS pos FROM f
""")
def page_links_distinct(spark, sf):
    pages = load(spark, sf, "pages")
    return pages.select("page_id", F.posexplode(F.array_distinct(list_pages.links(F.col("html")))).alias("pos", "href")).withColumn(
        "pos", F.col("pos").cast("bigint"))


@query(rf"""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '{_URL}', 1)) AS s, lower(regexp_extract(url, '{_URL}', 2)) AS a,
           rtrim(regexp_extract(url, '{_URL}', 3), '/') AS h, regexp_extract(url, '{_URL}', 4) AS q FROM pages)
SELECT page_id, s || '://' || a || h || CASE WHEN q = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(q, '&')), '&') END AS url FROM p
""")
def url_canonical(spark, sf):
    return load(spark, sf, "pages").select("page_id", U.canonical_url(F.col("url")).alias("url"))


@query(rf"""
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') AS ref,
       regexp_extract(url, '{_URL}', 3) AS path, regexp_extract(url, '{_URL}', 2) LIKE '%.example.com' AND url LIKE 'https:%' AS chosen FROM pages
""")
def url_parts(spark, sf):
    url = F.col("url")
    return load(spark, sf, "pages").select(
        "page_id", U.query_param(url, "page").alias("page"), U.query_param(url, "ref").alias("ref"), U.path(url).alias("path"),
        (U.authority(url).endswith(".example.com") & (U.scheme(url) == "https")).alias("chosen"))


@query(r"""
SELECT page_id, sha256(array_to_string(list_sort(list_distinct(regexp_extract_all(html, '<a\s[^>]*\bhref="([^"]*)"', 1))), chr(10))) AS fingerprint FROM pages
""")
def page_fingerprint(spark, sf):
    return load(spark, sf, "pages").select("page_id", K.fingerprint(list_pages.links(F.col("html"))).alias("fingerprint"))


@query("SELECT source AS url, sha256(text) AS body_sha, min(doc_id) AS seq FROM documents GROUP BY ALL")
def page_dedup(spark, sf):
    pages = load(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"), F.col("source").alias("url"), F.col("text").alias("body"))
    return list_pages.unique_captures(pages).select("url", F.sha2("body", 256).alias("body_sha"), "seq")


_STATUS = "CASE page_id % 7 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 403 WHEN 4 THEN 503 WHEN 5 THEN 302 ELSE 200 END"


@query(f"""
WITH s AS (SELECT page_id, lower(html) AS h, html, {_STATUS} AS status FROM pages), o AS (
SELECT page_id, CASE WHEN status = 404 THEN 'not_found' WHEN status = 429 THEN 'rate_limited' WHEN status = 403 THEN 'forbidden'
  WHEN status >= 500 THEN 'server_error' WHEN status <> 200 THEN 'unexpected_status'
  WHEN h LIKE '%cloudflare%' OR h LIKE '%challenge%' OR h LIKE '%cf_clearance%' OR h LIKE '%turnstile%' THEN 'challenge'
  ELSE 'unrecognized' END AS outcome FROM s)
SELECT page_id, outcome, CASE outcome WHEN 'not_found' THEN 'not_found' WHEN 'rate_limited' THEN 'rate_limited'
  WHEN 'forbidden' THEN 'challenge' WHEN 'challenge' THEN 'challenge' ELSE 'error' END AS counter FROM o
""")
def page_outcome(spark, sf):
    pages = load(spark, sf, "pages").withColumn("status", F.expr(_STATUS))
    return pages.select("page_id", list_pages.outcome(F.col("status"), F.col("html")).alias("outcome")).withColumn(
        "counter", list_pages.failure_class(F.col("outcome")))


@query(r"""
SELECT p_partkey, slug, regexp_replace(slug, '-(ev[0-9]+|hero)$', '') AS base,
  CASE WHEN slug LIKE '%-hero' THEN 'hero' WHEN regexp_matches(slug, '-ev[0-9]+$') THEN regexp_extract(slug, '-(ev[0-9]+)$', 1) ELSE 'base' END AS form
FROM (SELECT p_partkey, replace(p_name, ' ', '-') || CASE p_size % 4 WHEN 0 THEN '-ev' || p_size WHEN 1 THEN '-hero' ELSE '' END AS slug FROM part)
""")
def slug_split(spark, sf):
    slug = F.expr("replace(p_name, ' ', '-') || CASE p_size % 4 WHEN 0 THEN '-ev' || p_size WHEN 1 THEN '-hero' ELSE '' END")
    return load(spark, sf, "part").select("p_partkey", slug.alias("slug")).select(
        "p_partkey", "slug", X.base_slug(F.col("slug")).alias("base"), X.card_form(F.col("slug")).alias("form"))


_RAW_MARKER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "CAST((l_partkey * 370 + l_linenumber * 10) % 20010 AS INT) AS x",
    "CAST((l_suppkey * 410 + l_linenumber * 8) % 34008 AS INT) AS y", "CAST(l_orderkey % 3 AS INT) AS i",
    "CAST(l_quantity AS INT) * 7 AS tick",
)


def _rounded_sql(x: str, divisor: int, digits: int) -> str:
    """Round the binary quotient half to even, in exact integer arithmetic."""
    scale = 10 ** digits
    q = f"({x} / {float(divisor)})"
    up = f"(({x} * {2 * scale} // {divisor} + 1) // 2)"
    tie = f"(({x} * {2 * scale}) % {divisor} = 0 AND ({x} * {2 * scale} // {divisor}) % 2 = 1)"
    side = (
        f"sign(CASE WHEN {q} < 0.03125 THEN CAST({q} * {float(2 ** 67)} AS HUGEINT) * {divisor} - CAST({x} AS HUGEINT) * {2 ** 67} "
        f"ELSE CAST({q} * {float(2 ** 57)} AS HUGEINT) * {divisor} - CAST({x} AS HUGEINT) * {2 ** 57} END)"
    )
    return (
        f"(CASE WHEN NOT {tie} THEN {up} WHEN {side} > 0 THEN {up} WHEN {side} < 0 THEN {up} - 1 ELSE {up} - {up} % 2 END) / {float(scale)}"
    )


@query(f"""
WITH r AS (SELECT {", ".join(_RAW_MARKER)} FROM lineitem),
o AS (SELECT *, CASE WHEN i NOT IN (0, 1) THEN 'orientation_invalid' WHEN x > 18000 OR y > 32000 THEN 'coordinate_out_of_bounds' END AS error,
  CASE i WHEN 0 THEN 18000 - x WHEN 1 THEN x END AS ox, CASE i WHEN 0 THEN 32000 - y WHEN 1 THEN y END AS oy FROM r)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, error, CASE WHEN error IS NULL THEN ox END AS x, CASE WHEN error IS NULL THEN oy END AS y,
  CASE WHEN error IS NULL THEN CASE i WHEN 0 THEN 'rotate_180' ELSE 'identity' END END AS transform,
  CASE WHEN error IS NULL THEN {_rounded_sql("ox", 18000, 4)} END AS x_norm, CASE WHEN error IS NULL THEN {_rounded_sql("oy", 32000, 4)} END AS y_norm,
  CASE WHEN error IS NULL THEN {_rounded_sql("ox", 1000, 1)} END AS tile_x, CASE WHEN error IS NULL THEN {_rounded_sql("oy", 1000, 1)} END AS tile_y,
  tick * 5 / 100.0 AS seconds FROM o
""")
def orientation(spark, sf):
    raw = load(spark, sf, "lineitem").selectExpr(*_RAW_MARKER)
    x, y, i = F.col("x"), F.col("y"), F.col("i")
    placed = raw.withColumns({"error": C.orientation_error(x, y, i), "ox": C.oriented_x(x, i), "oy": C.oriented_y(y, i)})
    good = F.col("error").isNull()
    return placed.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "error",
        F.when(good, F.col("ox")).alias("x"), F.when(good, F.col("oy")).alias("y"),
        F.when(good, C.transform_name(i)).alias("transform"),
        F.when(good, C.ratio_rounded(F.col("ox"), 18000, 4)).alias("x_norm"),
        F.when(good, C.ratio_rounded(F.col("oy"), 32000, 4)).alias("y_norm"),
        F.when(good, C.ratio_rounded(F.col("ox"), 1000, 1)).alias("tile_x"),
        F.when(good, C.ratio_rounded(F.col("oy"), 1000, 1)).alias("tile_y"),
        C.seconds_of_tick(F.col("tick")).alias("seconds"),
    )


_RAW_TAG = (
    "CASE c_custkey % 6 WHEN 0 THEN ' #tag' || c_custkey || ' ' WHEN 1 THEN '##Tag' || c_custkey WHEN 2 THEN 'no tag' "
    "WHEN 3 THEN '#a' WHEN 4 THEN c_name ELSE 'TAG' || c_custkey END"
)


@query(f"""
WITH r AS (SELECT c_custkey, upper(ltrim(trim({_RAW_TAG}), '#')) AS t FROM customer)
SELECT c_custkey, CASE WHEN regexp_full_match(t, '[A-Z0-9]{{3,32}}') THEN t END AS tag FROM r
""")
def player_tags_normalized(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", X.player_tag(F.expr(_RAW_TAG)).alias("tag"))


_RAW_TIME = (
    "CASE o_orderkey % 6 WHEN 0 THEN '' || (1500000000 + o_orderkey) WHEN 1 THEN '' || (1500000000123 + o_orderkey * 1000) "
    "WHEN 2 THEN '0' WHEN 3 THEN '12.0' WHEN 4 THEN '-5' ELSE 'x' || o_orderkey END"
)


@query(f"""
WITH r AS (SELECT o_orderkey, {_RAW_TIME} AS raw FROM orders), n AS (
SELECT o_orderkey, CASE WHEN regexp_full_match(raw, '[0-9]+') THEN CAST(raw AS BIGINT) END AS n FROM r)
SELECT o_orderkey, CASE WHEN n > 10000000000 THEN n // 1000 WHEN n > 0 THEN n END AS seconds,
  CASE WHEN n > 0 THEN CASE WHEN n < 10000000000 THEN n * 1000 ELSE n END END AS cursor_ms FROM n
""")
def epochs_normalized(spark, sf):
    raw = load(spark, sf, "orders").select("o_orderkey", F.expr(_RAW_TIME).alias("raw"))
    return raw.select("o_orderkey", T.epoch_seconds(F.col("raw")).alias("seconds"), T.cursor_millis(F.col("raw")).alias("cursor_ms"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, CAST(epoch(o_orderdate) AS BIGINT) AS back,
  CAST(epoch(o_orderdate) AS BIGINT) - 7200 AS shifted, CAST(epoch(o_orderdate) AS BIGINT) AS popup FROM orders
""")
def iso_times(spark, sf):
    iso = T.epoch_to_iso(F.unix_timestamp("o_orderdate"))
    return load(spark, sf, "orders").select(
        "o_orderkey", iso.alias("iso"), T.iso_epoch(iso).alias("back"),
        T.iso_epoch(F.replace(iso, F.lit("Z"), F.lit("+02:00"))).alias("shifted"),
        F.unix_timestamp(T.popup_instant(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm 'UTC'"))).alias("popup"))


_AT = "date_trunc('day', o_orderdate) + to_hours(CAST(o_orderkey % 24 AS INT))"


@query(f"""
WITH t AS (SELECT o_orderkey, {_AT} AS moment, date_trunc('month', o_orderdate) AS first FROM orders),
s AS (SELECT *, first + to_days(CAST((8 - isodow(first)) % 7 AS INT)) + INTERVAL 9 HOUR AS settled FROM t)
SELECT o_orderkey, strftime(first - CASE WHEN moment < settled THEN INTERVAL 2 MONTH ELSE INTERVAL 1 MONTH END, '%Y-%m') AS season,
  strftime(first - CASE WHEN moment < settled THEN INTERVAL 49 MONTH ELSE INTERVAL 48 MONTH END, '%Y-%m') AS oldest FROM s
""")
def finished_season(spark, sf):
    at = F.expr("date_trunc('DAY', o_orderdate) + make_interval(0, 0, 0, 0, CAST(o_orderkey % 24 AS INT))")
    season = T.latest_finished_season(at)
    return load(spark, sf, "orders").select("o_orderkey", season.alias("season")).withColumn(
        "oldest", F.element_at(T.season_list(F.col("season")), -1))


_HEADER = (
    "CASE event_id % 6 WHEN 0 THEN '' || (event_id % 300) WHEN 1 THEN '-3' WHEN 2 THEN 'soon' WHEN 3 THEN '1.5' "
    "WHEN 4 THEN 'Mon, 01 Jan 2024 10:00:00 GMT' END"
)


@query(f"""
SELECT event_id, CASE event_id % 6 WHEN 0 THEN CAST(event_id % 300 AS DOUBLE) WHEN 3 THEN 1.5::DOUBLE
  WHEN 4 THEN greatest(0.0::DOUBLE, 1704103200.0::DOUBLE - (1704100000 + event_id)) END AS seconds FROM events
""")
def retry_after(spark, sf):
    now = F.timestamp_seconds(F.lit(1704100000) + F.col("event_id"))
    return load(spark, sf, "events").select("event_id", T.retry_after_seconds(F.expr(_HEADER), now).alias("seconds"))


@query(f"""
SELECT k, 'http://corpus.example/data/replay?tag=' || tag || '&team_tags=' || owner || '%2C' || rival || '&opponent_tags=' || rival ||
  '&team_crowns=' || (k % 4) || '&opponent_crowns=0&referrer_path=/p,q' AS url FROM {FACTS_SQL}
""")
def replay_urls(spark, sf):
    return R.battle_facts(load(spark, sf, "orders")).select("k", U.replay_url(
        R.BASE, F.col("tag"), F.concat("owner", F.lit(","), "rival"), F.col("rival"),
        F.expr("'' || (k % 4)"), F.lit("0"), F.lit("/p,q")).alias("url"))


_SEED = (
    "CASE c_custkey % 7 WHEN 0 THEN '#tag' || c_custkey WHEN 1 THEN 'http://corpus.example/player/tag' || c_custkey "
    "WHEN 2 THEN 'http://corpus.example/player/TAG' || c_custkey || '/battles' "
    "WHEN 3 THEN 'http://corpus.example/player/tag' || c_custkey || '/battles/history?before=' || c_custkey || '#x' "
    "WHEN 4 THEN 'http://corpus.example/data/replay?tag=B' || c_custkey || '&x=1' WHEN 5 THEN 'http://corpus.example/other/' || c_custkey ELSE '##' END"
)


@query(f"""
WITH s AS (SELECT c_custkey, c_custkey % 7 AS r, {_SEED} AS v, 'TAG' || c_custkey AS t FROM customer)
SELECT c_custkey, CASE WHEN r IN (0, 1) THEN 'http://corpus.example/player/' || t || '/battles' ELSE v END AS url,
  CASE WHEN r IN (4, 5) THEN 'detail' ELSE 'list' END AS kind, CASE r WHEN 4 THEN 'B' || c_custkey WHEN 5 THEN NULL ELSE t END AS tag,
  CASE WHEN r IN (4, 5) THEN NULL WHEN r = 3 THEN 2 ELSE 1 END AS page,
  CASE r WHEN 3 THEN 'http://corpus.example/player/' || t || '/battles/history?before=' || c_custkey WHEN 4 THEN 'battle:B' || c_custkey
    WHEN 5 THEN v ELSE 'player:' || t || ':refresh:e1' END AS dedup_key FROM s WHERE r <> 6
""")
def seed_tasks(spark, sf):
    seeds = load(spark, sf, "customer").select("c_custkey", F.expr(_SEED).alias("value"))
    return frontier.seed_tasks(seeds, R.BASE, "e1")


@query("""
WITH u AS (SELECT page_id, url, substr(sha1(url), 1, 16) AS h, nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') AS ref FROM pages)
SELECT page_id, h AS url_hash, 'source:' || sha256(url) || ':' || (page_id % 5) AS source_key, coalesce(ref, h) AS identity,
  CASE WHEN ref IS NULL THEN 'xx' ELSE lower(substr(ref, 1, 2)) END AS shard, 'battle|' || coalesce(ref, 'url:' || url) AS index_key FROM u
""")
def identity_keys(spark, sf):
    url, ref = F.col("url"), U.query_param(F.col("url"), "ref")
    identity = K.identity_from_fields(ref)
    return load(spark, sf, "pages").select(
        "page_id", K.url_hash(url).alias("url_hash"), K.source_key(url, F.col("page_id") % 5).alias("source_key"),
        K.storage_identity(identity, url).alias("identity"), K.storage_prefix(identity, url).alias("shard"),
        K.index_key(F.lit("battle"), ref, url).alias("index_key"))


@query("""
SELECT event_id, least(600.0::DOUBLE, 30.0 * pow(2, least(user_id % 9, 3))) AS retry_delay,
  least(7200.0::DOUBLE, 60.0 * pow(2, least(user_id % 12, 8))) AS revisit_interval,
  least(7200.0::DOUBLE, 45.0 * pow(2, least(user_id % 12, 8))) AS failure_delay,
  CASE WHEN user_id % 5 > 0 THEN least(3600.0::DOUBLE, 120.0 * pow(2, least(user_id % 5, 5))) WHEN event_type = 'view' THEN 86400.0::DOUBLE ELSE 604800.0::DOUBLE END AS pool_delay,
  CASE WHEN user_id % 9 + 1 >= 8 THEN 'dead' ELSE 'pending' END AS next_status FROM events
""")
def backoff_delays(spark, sf):
    u = F.col("user_id")
    return load(spark, sf, "events").select(
        "event_id", B.retry_delay(u % 9 + 1, 30, 120).alias("retry_delay"), B.revisit_interval(u % 12, 60, 7200).alias("revisit_interval"),
        B.source_failure_delay(u % 12 + 1, 45, 7200).alias("failure_delay"),
        B.pool_delay(u % 5, F.col("event_type") == "view").alias("pool_delay"), B.after_failure(u % 9, 8).alias("next_status"))


@query("""
SELECT event_id, CASE WHEN event_id % 40 > 15 AND event_type IN ('view', 'click', 'error') THEN 'stale_unknown'
    ELSE CASE event_type WHEN 'view' THEN 'running' WHEN 'click' THEN 'initializing' WHEN 'signup' THEN 'stopped' WHEN 'purchase' THEN 'finished' END END AS phase,
  event_id % 3 <> 0 AND event_id % 7 > 1 AND user_id % 50 < 30 AS cache_fresh,
  CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS campaign_start FROM events
""")
def freshness(spark, sf):
    e = load(spark, sf, "events")
    phase = F.expr("CASE event_type WHEN 'view' THEN 'running' WHEN 'click' THEN 'initializing' WHEN 'signup' THEN 'stopped' WHEN 'purchase' THEN 'finished' END")
    tags = F.expr("CASE event_id % 7 WHEN 0 THEN array() WHEN 1 THEN array('ok1', '!') ELSE array('ok1', 'tag2') END")
    return e.select(
        "event_id", T.heartbeat_phase(phase, F.col("event_id") % 40).alias("phase"),
        revisit.cache_is_fresh(
            F.expr("CASE WHEN event_id % 3 = 0 THEN 'other' ELSE 'u' END"), F.lit("u"), tags,
            F.lit(1000), F.lit(1000) + F.col("user_id") % 50, 30).alias("cache_fresh"),
        T.campaign_start(F.date_format("ts", "yyyy-MM-dd")).alias("campaign_start"))
