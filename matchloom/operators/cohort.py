"""Ranked cohorts and the bounded player pool. All rules fail closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import values as V
from matchloom.functions import text as X
from matchloom.functions import urls as U
from matchloom.functions.expr import is_true
from matchloom.operators import markup, select


class EvidenceError(ValueError):
    """Evidence that must stop the job; the message carries counts and a sample."""


def require(violations: DataFrame, message: str) -> None:
    """Raise when there is any violation, naming a few."""
    sample = violations.limit(5).collect()
    if sample:
        raise EvidenceError(f"{message}: {[r.asDict() for r in sample]}")


# -- evidence from pages --------------------------------------------------------------


def board_rows(pages: DataFrame, season: str) -> DataFrame:
    """Ranking rows of season boards, with a per-page ``page_error``."""
    item = F.from_json(
        markup.board_item("body"), "heading string, broken boolean, rows array<struct<rank: string, tag: string>>")
    typed = F.from_json(markup.board_item("body"), "rows array<struct<rank: bigint, tag: string>>")
    parsed = pages.select("seq", "url", F.sha2("body", 256).alias("sha256"), item.alias("i"), typed.alias("t"))
    error = (
        F.when(~is_true(F.col("i.heading") == V.SEASON_HEADING + season), F.lit("not_the_season_board"))
        .when(F.col("i.broken"), F.lit("board_json_unreadable"))
        .when(F.coalesce(F.size("i.rows"), F.lit(0)) == 0, F.lit("no_ranking_rows"))
    )
    rows = F.when(error.isNull(), F.col("t.rows"))
    return parsed.select(
        "seq", "url", "sha256", error.alias("page_error"), F.posexplode_outer(rows).alias("position", "r")
    ).select("seq", "url", "sha256", "page_error", "position", F.col("r.rank").alias("rank"), F.col("r.tag").alias("tag"))


def profile_proofs(pages: DataFrame, latest: str) -> DataFrame:
    """Best finished-season rank of each profile page: latest season, then lowest rank."""
    item = F.from_json(
        markup.profile_item("body"), "headings array<string>, popups array<struct<rank: string, season: string>>")
    own = F.array_distinct(F.filter("i.headings", lambda h: h.rlike("^#[A-Z0-9]{3,32}$")))
    ranked = F.transform(
        "i.popups",
        lambda p: F.struct(
            p["season"].alias("season"),
            (-X.digits_to_int(F.replace(p["rank"], F.lit(","), F.lit("")))).alias("minus_rank"),
        ),
    )
    usable = F.filter(
        ranked,
        lambda r: r["season"].rlike(V.SEASON_PATTERN) & (r["season"] <= latest) & r["minus_rank"].between(-V.MAX_RANK, -1),
    )
    parsed = pages.select("seq", "url", F.sha2("body", 256).alias("sha256"), item.alias("i")).withColumns({
        "_own": own, "_best": F.array_max(usable)})
    return parsed.select(
        "seq", "url", "sha256",
        F.when(F.size("_own") == 1, X.player_tag(F.get("_own", F.lit(0)))).alias("tag"),
        (-F.col("_best.minus_rank")).alias("rank"), F.col("_best.season").alias("rank_season"),
        F.when(F.size("_own") != 1, F.lit("own_tag_missing")).alias("page_error"),
    )


def source_page(pages: DataFrame, base: str, links: Column, max_players: int, max_sources: int) -> DataFrame:
    """Players and country boards of a source page; empty or oversized pages are errors, nothing is cut."""
    tags = F.array_distinct(F.filter(F.transform(links, F.upper), lambda t: t.rlike(V.PLAYER_PATTERN)))
    hrefs = F.regexp_extract_all("body", F.lit(r'<a\b[^>]*\bhref="([^"]*)"'), F.lit(1))
    boards = F.filter(
        F.transform(hrefs, lambda h: U.source_url(h, base)),
        lambda u: is_true(U.path(u).rlike(V.BOARD_PATH)),
    )
    staged = pages.withColumns({"tags": tags, "_boards": F.array_distinct(boards)})
    return staged.select(
        "seq", "url", "tags", F.col("_boards").alias("source_urls"),
        F.sha2("body", 256).alias("html_sha256"),
        F.when(F.size("tags") == 0, F.lit("no_players"))
        .when(F.size("tags") > max_players, F.lit("too_many_players"))
        .when(F.size("_boards") > max_sources, F.lit("too_many_sources")).alias("page_error"),
    )


def country_codes(body: Column) -> Column:
    found = F.regexp_extract_all(body, F.lit(V.COUNTRY_BOARD), F.lit(1))
    return F.array_sort(F.array_distinct(found))


# -- cohorts -------------------------------------------------------------------------------


def ranked_problems(rows: DataFrame, top_n: int) -> DataFrame:
    """What keeps ranking rows from being a complete 1..N list: (problem, rank, tag)."""
    typed = rows.select("rank", X.player_tag(F.col("tag")).alias("tag"))
    invalid = typed.filter(~is_true(F.col("rank") >= 1) | F.col("tag").isNull()).select(
        F.lit("invalid_row").alias("problem"), "rank", "tag")
    kept = typed.filter(F.col("rank").between(1, top_n) & F.col("tag").isNotNull())
    shared_rank = kept.groupBy("rank").agg(F.min("tag").alias("tag"), F.max("tag").alias("_other")).filter(
        F.col("tag") != F.col("_other")).select(F.lit("rank_conflict").alias("problem"), "rank", "tag")
    two_ranks = kept.groupBy("tag").agg(F.min("rank").alias("rank"), F.max("rank").alias("_other")).filter(
        F.col("rank") != F.col("_other")).select(F.lit("player_conflict").alias("problem"), "rank", "tag")
    wanted = rows.sparkSession.range(1, top_n + 1).select(F.col("id").alias("rank"))
    gaps = wanted.join(kept.select(F.col("rank").cast("bigint")).distinct(), "rank", "left_anti").select(
        F.lit("rank_missing").alias("problem"), "rank", F.lit(None).cast("string").alias("tag"))
    return invalid.unionByName(shared_rank).unionByName(two_ranks).unionByName(gaps)


def ranked_players(rows: DataFrame, top_n: int) -> DataFrame:
    """Complete top N; a gap, a conflict or a bad row stops the job."""
    require(ranked_problems(rows, top_n), "ranking is not a complete, consistent list")
    return rows.select("rank", X.player_tag(F.col("tag")).alias("tag")).filter(F.col("rank") <= top_n).distinct()


def _evidence(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"tag": X.player_tag(F.col("tag")), "rank_season": X.season_id(F.col("rank_season"))})


def historical_problems(rows: DataFrame, latest: str) -> DataFrame:
    """Rows that are no finished-season proof, and players with two ranks in one season."""
    typed = _evidence(rows)
    bad = F.col("rank").isNull() | F.col("tag").isNull() | ~is_true(F.col("rank_season") <= latest)
    invalid = typed.filter(bad).select(F.lit("invalid_proof").alias("problem"), "tag", "rank_season")
    conflict = typed.filter(~bad).groupBy("tag", "rank_season").agg(
        F.min("rank").alias("_a"), F.max("rank").alias("_b")).filter(F.col("_a") != F.col("_b")).select(
        F.lit("season_conflict").alias("problem"), "tag", "rank_season")
    return invalid.unionByName(conflict)


def first_qualified(rows: DataFrame, pool_size: int, seq: str = "seq") -> DataFrame:
    """First ``pool_size`` players with a qualifying rank, in evidence order."""
    qualified = _evidence(rows).filter(F.col("rank").between(1, V.MAX_RANK)).select(seq, "tag", "rank_season", "rank")
    return select.limited(select.first_by(qualified, ["tag"], seq), [seq], pool_size)


def historical_pool(rows: DataFrame, pool_size: int, latest: str, seq: str = "seq") -> DataFrame:
    """The fixed pool; contradictory evidence or too few players stop the job."""
    require(historical_problems(rows, latest), "ranking evidence is not usable")
    pool = first_qualified(rows, pool_size, seq)
    found = pool.count()
    if found != pool_size:
        raise EvidenceError(f"only {found} of {pool_size} players qualify; none are made up")
    return pool


def admission_problems(proofs: DataFrame, members: DataFrame, latest: str) -> DataFrame:
    """Anything here rejects the whole batch."""
    typed = _evidence(proofs)
    bad = ~is_true(F.col("rank").between(1, V.MAX_RANK)) | F.col("tag").isNull() | ~is_true(F.col("rank_season") <= latest)
    invalid = typed.filter(bad).select(F.lit("invalid_proof").alias("problem"), "tag", "rank_season")
    known = members.select("tag", F.col("rank_season").alias("_season"), F.col("rank").alias("_rank"))
    contradiction = typed.filter(~bad).join(known, "tag").filter(
        (F.col("rank_season") == F.col("_season")) & (F.col("rank") != F.col("_rank"))
    ).select(F.lit("contradicts_member").alias("problem"), "tag", "rank_season")
    # Two ranks for a season inside the batch contradict once the first is admitted.
    first = select.first_by(typed.filter(~bad), ["tag"], "seq").select(
        "tag", F.col("rank_season").alias("_season"), F.col("rank").alias("_rank"))
    within = typed.filter(~bad).join(first, "tag").join(members.select("tag"), "tag", "left_anti").filter(
        (F.col("rank_season") == F.col("_season")) & (F.col("rank") != F.col("_rank"))
    ).select(F.lit("contradicts_batch").alias("problem"), "tag", "rank_season")
    return invalid.unionByName(contradiction).unionByName(within)


def new_members(proofs: DataFrame, members: DataFrame, room: int, seq: str = "seq") -> DataFrame:
    """Players to admit, in evidence order, as many as there is room for."""
    fresh = select.insert_or_ignore(members, _evidence(proofs), ["tag"], seq)
    return select.limited(fresh, [seq], max(0, room))


def admit(proofs: DataFrame, members: DataFrame, candidates: DataFrame, target: int, latest: str) -> tuple[DataFrame, DataFrame]:
    """New member and candidate tables. Bad evidence rejects the batch as a whole."""
    require(admission_problems(proofs, members, latest), "membership evidence is not usable")
    added = new_members(proofs, members, target - members.count())
    grown = members.unionByName(added.select(*members.columns))
    return grown, candidates.join(added.select("tag"), "tag", "left_anti")


def new_candidates(offers: DataFrame, members: DataFrame, candidates: DataFrame, room: int, pool_open: bool = True, seq: str = "seq") -> DataFrame:
    """Candidates to take in: neither members nor known, in order, within the room;
    none when the pool is full or frozen."""
    typed = offers.withColumn("tag", X.player_tag(F.col("tag"))).filter(F.col("tag").isNotNull())
    outside = select.keep_absent(typed, members, ["tag"])
    fresh = select.insert_or_ignore(candidates, outside, ["tag"], seq)
    return select.limited(fresh, [seq], max(0, room) if pool_open else 0)


def offer(offers: DataFrame, members: DataFrame, candidates: DataFrame, target: int, frozen: bool = False) -> DataFrame:
    room = V.MAX_CANDIDATES - candidates.count()
    return new_candidates(offers, members, candidates, room, not frozen and members.count() < target)


def pool_statistics(members: DataFrame, candidates: DataFrame, sources: DataFrame, target: int) -> DataFrame:
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("name"), "value")

    goal = members.limit(0).agg(F.lit(target).cast("bigint").alias("value")).select(F.lit("target").alias("name"), "value")
    return goal.unionByName(one(members, "verified")).unionByName(one(candidates, "candidates")).unionByName(one(sources, "sources"))


def roster_digest(players: DataFrame) -> DataFrame:
    """One digest of a roster, independent of row order: rows are hashed, ranged into
    buckets of bounded size, and the bucket digests hashed in order."""
    rows = players.select(
        F.call_function("div", F.col("rank").cast("bigint"), F.lit(1000).cast("bigint")).alias("bucket"), "rank",
        F.sha2(F.to_json(F.struct(*sorted(players.columns))), 256).alias("h"))
    buckets = rows.groupBy("bucket").agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "h"))), lambda x: x["h"]), ","), 256).alias("h"))
    return buckets.agg(F.sha2(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("bucket", "h"))), lambda x: x["h"]), ","), 256).alias("roster_sha256"))
