"""Role views: the game, play-by-play and player shapes over the given tables.

Each view is one SQL text that Spark and DuckDB both read, so that a query and
its check start from the same rows. No view holds a window, so that building
the input never gathers one game in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_TEAM_HOME = "o_custkey % 30"
_TEAM_AWAY = "(o_custkey + 1 + o_orderkey % 29) % 30"

# view name -> (base tables, text with {table} placeholders)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_line_score": (
        ("orders",),
        f"""SELECT o_orderkey AS game_id, {_TEAM_HOME} AS team_id_home, {_TEAM_AWAY} AS team_id_away,
  80 + CAST(floor(o_totalprice) AS BIGINT) % 60 AS pts_home, 80 + o_orderkey % 61 AS pts_away
FROM {{orders}}""",
    ),
    "v_game": (
        ("orders",),
        f"""SELECT o_orderkey AS game_id, CAST(year(o_orderdate) AS BIGINT) AS season_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Playoffs' ELSE 'Regular Season' END AS season_type,
  {_TEAM_HOME} AS team_id_home, {_TEAM_AWAY} AS team_id_away,
  o_totalprice AS fg_pct_home, CAST(o_totalprice AS STRING) AS fg3_pct_home,
  o_orderpriority AS team_name_home, o_orderstatus AS wl_home,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 10 + (o_custkey * 7 + o_orderkey) % 40 END AS reb_home,
  (o_custkey * o_custkey + o_orderkey) % 31 AS ast_home,
  80 + CAST(floor(o_totalprice) AS BIGINT) % 60 AS pts_home, 80 + o_orderkey % 61 AS pts_away,
  o_orderdate AS game_date_est, CAST(NULL AS DOUBLE) AS all_null, 1 AS constant_col
FROM {{orders}}""",
    ),
    "v_play_by_play": (
        ("lineitem", "orders"),
        f"""SELECT l_orderkey AS game_id, l_linenumber AS eventnum, l_suppkey AS player1_id,
  CASE WHEN l_suppkey % 2 = 0 THEN {_TEAM_HOME} ELSE {_TEAM_AWAY} END AS player1_team_id,
  CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_partkey % 100 END AS player2_id,
  CASE WHEN l_partkey % 2 = 0 THEN {_TEAM_HOME} ELSE {_TEAM_AWAY} END AS player2_team_id,
  CASE WHEN l_partkey % 5 = 0 THEN l_partkey % 90 ELSE NULL END AS player3_id,
  {_TEAM_HOME} AS player3_team_id
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    ),
    "v_player_info": (
        ("supplier",),
        """SELECT s_suppkey AS person_id, concat('F', CAST(s_nationkey AS STRING)) AS first_name,
  s_name AS last_name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Guard' WHEN s_suppkey % 3 = 1 THEN 'Center' ELSE 'Forward' END AS position,
  CASE WHEN s_suppkey % 10 = 0 THEN '' WHEN s_suppkey % 10 = 1 THEN NULL WHEN s_suppkey % 10 = 2 THEN '6'
    ELSE concat(CAST(5 + s_suppkey % 3 AS STRING), '-', CAST(s_suppkey % 12 AS STRING)) END AS height,
  CASE WHEN s_suppkey % 9 = 0 THEN 'None' ELSE CAST(180 + s_suppkey % 80 AS STRING) END AS weight,
  CAST(s_suppkey % 19 AS DOUBLE) AS season_exp,
  CAST(1985 + s_suppkey % 30 AS STRING) AS from_year, CAST(1990 + s_suppkey % 33 AS STRING) AS to_year,
  CASE WHEN s_suppkey % 8 = 0 THEN 'Undrafted' ELSE CAST(1990 + s_suppkey % 30 AS STRING) END AS draft_year,
  CASE WHEN s_suppkey % 8 = 0 THEN 'Undrafted' ELSE CAST(1 + s_suppkey % 2 AS STRING) END AS draft_round,
  CASE WHEN s_suppkey % 8 = 0 THEN '' ELSE CAST(1 + s_suppkey % 60 AS STRING) END AS draft_number
FROM {supplier}""",
    ),
    "v_events_scored": (
        ("events",),
        """SELECT event_id AS eventnum, CAST(day(ts) AS BIGINT) AS game_id,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS player1_id,
  CAST(floor(hour(ts) / 6) AS BIGINT) + 1 AS period,
  CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'view' THEN 4 ELSE 5 END
    AS eventmsgtype,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'OT' WHEN event_id % 101 = 0 THEN '102'
    ELSE concat(CAST(CAST(floor(event_id / 7) AS BIGINT) AS STRING), ' - ',
                CAST(CAST(floor(event_id / 5) AS BIGINT) AS STRING)) END AS score,
  value
FROM {events}""",
    ),
    "v_player": (
        ("customer",),
        """SELECT c_custkey AS player_id, CAST(c_nationkey AS BIGINT) AS team_id,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey * 10 + 3 END AS game_id FROM {customer}""",
    ),
    "v_player_bio": (
        ("customer",),
        """SELECT c_custkey AS player_id, c_name AS display_first_last
FROM {customer} WHERE c_mktsegment <> 'MACHINERY'""",
    ),
    "v_draft_history": (("orders",), "SELECT o_custkey AS player_id, o_orderkey AS pick FROM {orders}"),
    "v_team": (
        ("nation",),
        "SELECT CAST(n_nationkey AS BIGINT) AS team_id, n_name AS team_name FROM {nation} WHERE n_regionkey <> 3",
    ),
    "v_team_details": (
        ("nation",),
        """SELECT CAST(n_nationkey AS BIGINT) AS team_id, 1990 + CAST(n_regionkey AS BIGINT) AS season_year
FROM {nation}""",
    ),
    "v_game_summary": (
        ("orders",),
        """SELECT o_orderkey AS game_id, CAST(floor(o_totalprice) AS BIGINT) % 150 AS pts
FROM {orders} WHERE o_orderstatus <> 'P'""",
    ),
    "v_commentary": (
        ("lineitem",),
        "SELECT l_orderkey AS game_id, concat(l_returnflag, l_linestatus) AS comment FROM {lineitem}",
    ),
}


# Players of which some are missing, so that left joins miss.
VIEWS["v_common_player_info"] = (VIEWS["v_player_info"][0], VIEWS["v_player_info"][1] + " WHERE s_suppkey % 7 <> 0")


class Tables:
    """The tables of one data folder, read on use, plus the role views."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        bases, text = VIEWS[name]
        return self.spark.sql(text, **{base: self[base] for base in bases})


def view_ctes(*names: str) -> str:
    """The ``WITH`` list of the named views, for an engine with plain table names."""
    parts = []
    for name in names:
        bases, text = VIEWS[name]
        parts.append(f"{name} AS (\n{text.format(**{b: b for b in bases})}\n)")
    return "WITH " + ",\n".join(parts)
