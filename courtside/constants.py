"""Values that fix what the jobs compute. Nothing in here is derived."""

# CSV columns that are always loaded as text.
FORCED_STRING_COLUMNS = (
    "game_time",
    "live_pc_time",
    "natl_tv_broadcaster_abbreviation",
    "wctimestring",
    "wl_home",
    "wl_away",
    "scoremargin",
    "fg3_pct_home",
    "fg3_pct_away",
)

# Which tables make up each load group.
TABLE_GROUPS = {
    "test_specific": ("game",),
    "game_specific": (
        "game",
        "game_info",
        "game_summary",
        "inactive_players",
        "line_score",
        "officials",
        "other_stats",
        "play_by_play",
    ),
    "player_specific": (
        "common_player_info",
        "draft_combine_stats",
        "draft_history",
        "player",
    ),
    "team_specific": ("team", "team_details", "team_history", "team_info_common"),
}

# Cell texts a headered CSV read takes for a missing value
# (the documented defaults of pandas.read_csv).
CSV_MISSING = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Texts that stand for NULL when tables are consolidated.
SENTINEL_TEXTS = ("None", "nan", "")

# Numeric patterns, whole text and first occurrence.
NUMERIC_TEXT = r"^\s*[-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?\s*$"
NUMERIC_PART = r"[-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?"

# Columns that the consolidation turns back into numbers.
PERCENTAGE_COLUMNS = (
    "fg_pct_home",
    "fg3_pct_home",
    "ft_pct_home",
    "fg_pct_away",
    "fg3_pct_away",
    "ft_pct_away",
)

# The column list of the game statistics scan.
GAME_STAT_COLUMNS = (
    "game_id",
    "season_id",
    "season_type",
    "team_id_home",
    "team_name_home",
    "team_id_away",
    "team_name_away",
    "fg_pct_home",
    "fg3_pct_home",
    "ft_pct_home",
    "ast_home",
    "reb_home",
    "stl_home",
    "blk_home",
    "tov_home",
    "pf_home",
    "fg_pct_away",
    "fg3_pct_away",
    "ft_pct_away",
    "ast_away",
    "reb_away",
    "stl_away",
    "blk_away",
    "tov_away",
    "pf_away",
    "pts_home",
    "pts_away",
)

# The season type the statistics are restricted to, the event
# types that score, thresholds, sizes and seeds.
SEASON_TYPE = "Regular Season"
SCORING_EVENT_TYPES = (1, 3)
CORRELATION_THRESHOLD = 0.7
HISTOGRAM_BINS = 30
PHIK_BINS = 10
MAX_HUE_VALUES = 10
MAX_HUE_FEATURES = 5
FLOAT32_LIMIT = 1e38
MAX_VARCHAR = 255
MIN_VARCHAR = 10
FOREST_TREES = 100
SPLIT_SEED = 42

# Source type name to column-store type name; unknown types
# become "String".
ROWSTORE_TO_COLUMNSTORE = {
    "integer": "Int32",
    "bigint": "Int64",
    "smallint": "Int16",
    "serial": "Int32",
    "bigserial": "Int64",
    "boolean": "UInt8",
    "text": "String",
    "varchar": "String",
    "character varying": "String",
    "timestamp without time zone": "DateTime",
    "timestamp with time zone": "DateTime",
    "timestamp": "DateTime",
    "date": "Date",
    "double precision": "Float64",
    "real": "Float32",
    "numeric": "Float64",
    "json": "String",
}
WAREHOUSE_TO_COLUMNSTORE = {
    "STRING": "String",
    "INT64": "Int64",
    "INTEGER": "Int32",
    "FLOAT": "Float64",
    "FLOAT64": "Float64",
    "BOOLEAN": "UInt8",
    "DATE": "Date",
    "DATETIME": "DateTime",
    "TIMESTAMP": "DateTime",
}
