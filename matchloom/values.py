"""They must equal what captured pages carry or what results report.

Everything in this file is data, not logic.
"""

# Game modes whose battles count as normal one-on-one.
NORMAL_MODES = [
    "Ranked", "Ladder", "1v1", "1v1 Battle", "1v1 Showdown",
    "Classic Challenge", "Grand Challenge", "Normal Battle",
]
DUEL_BATTLE_TYPE = "riverRaceDuel"
INVALID_CARD = "_invalid"
DECK_SIZE = 8

# Output and metadata schema versions.
REPLAY_SCHEMA_VERSION = 5
METADATA_SCHEMA_VERSION = 2
EXACT_LEGACY_VERSIONS = (3, 4)

# Arena size in raw coordinate units, and replay clock.
ARENA_WIDTH = 18000
ARENA_HEIGHT = 32000
TICKS_PER_SECOND = 20
MAX_DURATION_SECONDS = 360
MAX_CROWNS = 3

# Values above this are epoch milliseconds, not seconds.
MILLIS_THRESHOLD = 10_000_000_000
FUTURE_TOLERANCE_SECONDS = 300

# King tower evidence.
KING_LEVEL = 16
KING_FULL_HP = 7728

# Ranking evidence.
MAX_RANK = 10000
MAX_CANDIDATES = 30000
MAX_ROSTER_SECONDS = 62 * 86400
SEASON_PATTERN = r"^20[0-9]{2}-(0[1-9]|1[0-2])$"
PLAYER_PATTERN = r"^[A-Z0-9]{3,32}$"
RANKING_TYPE = "path_of_legends"
SEASON_HEADING = "Top Global Players for Season "

# Provenance strings of this package.
ORIENTATION_ID = "orientation_v1"
MODE_FROM_MATCHUP = "matchup_button_by_index"
INDEX_FROM_BOTH = "replay_and_matchup_index"
TIME_FROM_LIST = "list_exact_timestamp"
UTC_FROM_POPUP = "timestamp_popup_utc"
UTC_FROM_TIMESTAMP = "derived_from_list_timestamp"
HP_FROM_POPUP = "list_hp_popup"
EXECUTION_MODE_FROM_CONTRACT = "contract_mode_map_v1"
KING_FROM_TOWER_LEVEL = "template_cap_and_tower_level_v1"
KING_FROM_FULL_HP = "template_cap_and_full_king_hp_v1"
METADATA_SOURCE = "list_page"
ACCEPT_TIER = "static_gate_v1"

# Contract identities accepted by the contract reader: schema version -> kind.
CONTRACT_KINDS = {2: "match_corpus_contract_v2", 3: "match_corpus_contract_v3"}

TELEMETRY_SAMPLES = 256
LATENCY_EMA_ALPHA = 0.2
STALE_AFTER_SECONDS = 15

# Class names of the markup that captured pages carry; how tags are read stands in ``functions.text``.
REPLAY_BUTTON = "replay_button"
MARKER = "marker"
MARKER_COLORS = ("blue", "red")
REPLAY_BOX = "battle_replay"
ELIXIR_TABLE = "replay_elixir_table"
END_MARK = "end_time"
TOWER_CLASS = "deck_card_key_"
LEVEL_WORD = "Lvl"
ROSTER_CALL, ROSTER_BOX = "initRoster(", "#roster"

# Patterns of values inside the markup.
CLOCK = r"([0-9]+:[0-9]{2})"
COUNTRY_BOARD = r'href="/players/leaderboard/([a-z]{2})"'
BOARD_PATH = r"^/players/leaderboard/[a-z]{2}$"

# Reason codes and error texts of the checks are fixed values too; they stand beside
# their tests in ``operators.gate``, as decisions in existing corpora carry them.
