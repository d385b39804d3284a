"""Schemas of the tables this package reads and writes (DDL form)."""

PAGES = "url string, status int, body string, lane string, fetched_at timestamp, latency_s double, seq bigint"

SEEDS = "value string, source string"
EXCLUSIONS = "battle_tag string"
INDEX = "kind string, battle_tag string, url string, schema_version int, contract_sha256 string, saved_path string, fetched_at double"
UPGRADE_MANIFEST = (
    "source_path string, battle_tag string, schema_version int, replay_url string, source_list_url string"
)

_PLAY = (
    "time double, time_raw int, side string, color string, card string, marker_index int, data_i int, x_raw int, "
    "y_raw int, coordinate_status string, coordinate_provenance string, coordinate_transform string, x int, y int, "
    "x_norm double, y_norm double, tile_x double, tile_y double, card_base string, card_form string"
)
_PLAYER = (
    "player_tag string, full_deck array<string>, "
    "deck_cards array<struct<slot: int, slug: string, base_slug: string, form: string, level: int>>, "
    "tower_troop string, tower_troop_level int, card_levels map<string, int>, complete boolean"
)
_HP = "king: int, princess0: int, princess1: int, total: int"
_COUNTS = "map<string, struct<count: int, elixir: double>>"


def _struct(fields: str) -> str:
    """DDL columns to struct fields."""
    out, depth = [], 0
    for part in fields.split(", "):
        if depth == 0:
            name, kind = part.split(" ", 1)
            part = f"{name}: {kind}"
        out.append(part)
        depth += part.count("<") - part.count(">")
    return f"struct<{', '.join(out)}>"


REPLAYS = (
    "battle_tag string, schema_version int, "
    f"card_plays array<{_struct(_PLAY)}>, ability_plays array<{_struct(_PLAY)}>, "
    f"elixir_stats struct<team: {_COUNTS}, opponent: {_COUNTS}>, "
    "card_counts struct<team: map<string, int>, opponent: map<string, int>>, duration_seconds int, "
    f"rounds array<struct<team: array<{_struct(_PLAYER)}>, opponent: array<{_struct(_PLAYER)}>>>, "
    f"final_tower_hp struct<team: struct<{_HP}>, opponent: struct<{_HP}>, provenance: string>, "
    "team_tags array<string>, opponent_tags array<string>, team_crowns int, opponent_crowns int, "
    "deck_metadata struct<complete: boolean, source_list_url: string>, _provenance struct<replay_endpoint: string>"
)

CONTRACT = (
    "schema_version int, kind string, game_version string, contract_sha256 string, "
    "allowed_card_tokens array<string>, allowed_tower_troops array<string>, ability_source_tokens array<string>, "
    "source_numeric_game_mode_ids array<bigint>, native_execution_mode_by_source map<string, bigint>, "
    "king_tower_max_hp_by_level map<string, bigint>, king_tower_level_evidence struct<schema_version: int>"
)
ROSTER = (
    "schema_version bigint, season_id string, ranking_type string, top_n bigint, eligibility string, start_utc string, "
    "end_utc string, source_urls array<string>, boundary_source string, roster_sha256 string, "
    "players array<struct<rank: bigint, tag: string, rank_season: string>>"
)
