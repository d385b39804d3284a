"""Contract and roster manifests: one small document each, checked in full."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom import schemas as S
from matchloom import values as V
from matchloom.functions import times as T
from matchloom.functions import urls as U
from matchloom.functions.expr import is_true, reasons
from matchloom.operators import cohort
from matchloom.operators.cohort import EvidenceError
from matchloom.operators.gate import Contract

MAX_TOKENS = 20000


def _normal(name: str) -> Column:
    return F.transform(F.col(name), lambda t: F.lower(F.btrim(t)))


def _usable_set(name: str) -> Column:
    tokens = _normal(name)
    return is_true((F.size(tokens) > 0) & ~F.exists(tokens, lambda t: F.coalesce(t, F.lit("")) == "")
                   & (F.size(F.array_distinct(tokens)) == F.size(tokens)))


def _sorted_map(name: str) -> Column:
    return F.to_json(F.array_sort(F.map_entries(name)))


def contract_digest() -> Column:
    """Digest of the contract's content in a fixed field order, without the digest itself."""
    return F.sha2(F.concat_ws(
        "\n", F.col("schema_version").cast("string"), "kind", "game_version",
        *[F.to_json(F.array_sort(F.col(c))) for c in (
            "allowed_card_tokens", "allowed_tower_troops", "ability_source_tokens")],
        F.to_json(F.array_sort("source_numeric_game_mode_ids")),
        _sorted_map("native_execution_mode_by_source"), _sorted_map("king_tower_max_hp_by_level"),
    ), 256)


def contract_problems(expected_version: str) -> Column:
    """Everything wrong with a contract row."""
    modes = F.col("source_numeric_game_mode_ids")
    covered = F.array_sort(F.map_keys("native_execution_mode_by_source"))
    hp = F.col("king_tower_max_hp_by_level")
    identity = [(F.col("schema_version") == v) & (F.col("kind") == k) for v, k in V.CONTRACT_KINDS.items()]
    known = identity[0] | identity[1]
    sets = ("allowed_card_tokens", "allowed_tower_troops", "ability_source_tokens")
    modes_ok = is_true((F.size(modes) > 0) & F.forall(modes, lambda m: is_true(m >= 1)) & (F.size(F.array_distinct(modes)) == F.size(modes)))
    return reasons(
        (~is_true(known), "schema_or_kind_unsupported"),
        (~is_true(F.col("game_version") == expected_version), "game_version_differs"),
        (~is_true(F.col("contract_sha256") == contract_digest()), "digest_mismatch"),
        *[(~_usable_set(s), f"{s}_invalid") for s in sets],
        (~modes_ok, "source_numeric_game_mode_ids_invalid"),
        (~is_true((covered == F.array_sort(F.transform(modes, lambda m: m.cast("string"))))
                  & F.forall(F.map_values("native_execution_mode_by_source"), lambda m: is_true(m >= 1))),
         "native_execution_mode_by_source_not_exact"),
        (~is_true((F.size(hp) > 0) & F.forall(F.map_keys(hp), lambda k: k.rlike("^(0|[1-9][0-9]*)$"))
                  & F.forall(F.map_values(hp), lambda v: is_true(v >= 1))), "king_tower_max_hp_by_level_invalid"),
        (~is_true(F.try_element_at(hp, F.lit(str(V.KING_LEVEL))) == V.KING_FULL_HP), "king_hp_anchor_missing"),
        (is_true((F.col("schema_version") == 3) & F.col("king_tower_level_evidence").isNull()), "king_evidence_missing"),
        (is_true((F.col("schema_version") == 2) & F.col("king_tower_level_evidence").isNotNull()), "king_evidence_unexpected"),
        (F.size(F.array_except(_normal("ability_source_tokens"), _normal("allowed_card_tokens"))) > 0, "ability_source_not_allowed"),
        (F.size("allowed_card_tokens") + F.size("allowed_tower_troops") + F.size(modes) > MAX_TOKENS, "too_many_tokens"),
    )


def load_contract(spark: SparkSession, path: str, expected_version: str) -> Contract:
    """Read and check a contract. Its size is bounded, so it becomes literals in plans."""
    row = spark.read.schema(S.CONTRACT).json(path, multiLine=True).select(
        "*", contract_problems(expected_version).alias("problems"), contract_digest().alias("digest"))
    found = row.take(2)
    if len(found) != 1 or found[0]["problems"]:
        raise EvidenceError(f"contract refused: {found[0]['problems'] if found else 'no document'}")
    c = found[0]
    clean = lambda values: tuple(sorted(v.strip().lower() for v in values))
    return Contract(
        c["schema_version"], c["game_version"], c["digest"], clean(c["allowed_card_tokens"]),
        clean(c["allowed_tower_troops"]), clean(c["ability_source_tokens"]),
        {int(k): int(v) for k, v in c["native_execution_mode_by_source"].items()},
        int(c["king_tower_max_hp_by_level"][str(V.KING_LEVEL)]))


def roster_problems(as_of: Column, season: str | None = None, top_n: int | None = None) -> Column:
    """Everything wrong with a roster manifest row, apart from its players."""
    start, end = T.iso_epoch(F.col("start_utc")), T.iso_epoch(F.col("end_utc"))
    return reasons(
        (~is_true(F.col("schema_version") == 1), "schema_version_not_1"),
        (~is_true(F.col("season_id").rlike(V.SEASON_PATTERN)), "season_id_invalid"),
        (F.lit(season is not None) & ~is_true(F.col("season_id") == F.lit(season or "")), "season_differs"),
        (~is_true(F.col("ranking_type") == V.RANKING_TYPE), "ranking_type_invalid"),
        (~F.coalesce("eligibility", F.lit("season_top_n")).isin("season_top_n", "historical_top10000"), "eligibility_unknown"),
        (F.lit(top_n is not None) & ~is_true(F.col("top_n") == F.lit(top_n or 0)), "top_n_differs"),
        (~is_true(F.col("top_n").between(1, V.MAX_RANK)), "top_n_invalid"),
        (~is_true((start > 0) & (end > start) & (end - start <= V.MAX_ROSTER_SECONDS)), "time_range_invalid"),
        (is_true(end > F.unix_timestamp(as_of)), "season_not_ended"),
        (~is_true(F.date_format(F.timestamp_seconds(start), "yyyy-MM") == F.col("season_id")), "start_not_in_season"),
        (~is_true((F.size("source_urls") > 0) & F.forall("source_urls", lambda u: is_true(
            (U.scheme(u) == "https") & (U.authority(u) != "") & ~U.has_credentials(u)))), "source_urls_invalid"),
        (F.btrim(F.coalesce("boundary_source", F.lit(""))) == "", "boundary_source_missing"),
    )


def load_roster(spark: SparkSession, path: str, as_of: Column, season: str | None = None, top_n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(players, one-row window) of a roster manifest, or an error."""
    row = spark.read.schema(S.ROSTER).json(path, multiLine=True)
    cohort.require(row.select(roster_problems(as_of, season, top_n).alias("p")).filter(F.size("p") > 0), "roster refused")
    window = row.select("season_id", "top_n", T.iso_epoch(F.col("start_utc")).alias("start_s"), T.iso_epoch(F.col("end_utc")).alias("end_s"),
                        F.coalesce("eligibility", F.lit("season_top_n")).alias("eligibility"), "roster_sha256")
    head = window.take(2)
    if len(head) != 1:
        raise EvidenceError("roster manifest must hold one document")
    rows = row.select(F.posexplode("players").alias("seq", "p")).select("seq", "p.*")
    if head[0]["eligibility"] == "historical_top10000":
        players = cohort.historical_pool(rows, head[0]["top_n"], head[0]["season_id"])
    else:
        players = cohort.ranked_players(rows, head[0]["top_n"]).withColumn("rank_season", F.lit(head[0]["season_id"]))
    players = players.select("rank", "tag", "rank_season")
    claimed = head[0]["roster_sha256"]
    if claimed is not None and claimed != cohort.roster_digest(players).first()[0]:
        raise EvidenceError("roster digest does not match its players")
    return players, window


