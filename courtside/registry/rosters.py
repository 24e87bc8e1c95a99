"""Roster, star and chain joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators import catalog, unions
from courtside.operators.joins import star_join, star_join_size, star_joins
from courtside.plans import rosters
from courtside.registry.core import ORACLES, checked, query
from courtside.session import scratch_path
from courtside.sources.copying import export_join
from courtside.sources.csv import read_json_config
from courtside.sources.stores import FolderStore

_ROSTER_VIEWS = ("v_line_score", "v_play_by_play", "v_common_player_info")

_SCORES = """scores AS (
  SELECT game_id, unnest([team_id_home, team_id_away]) AS team_id, unnest([pts_home, pts_away]) AS final_score
  FROM v_line_score
)"""

_SEEN = " UNION ".join(
    f"""SELECT game_id, player{slot}_team_id AS team_id, player{slot}_id AS player_id FROM v_play_by_play
  WHERE player{slot}_id IS NOT NULL"""
    for slot in (1, 2, 3)
)

_BIO_INTEGERS = ("from_year", "to_year", "draft_year", "draft_round", "draft_number")
_BIO_TEXTS = ("first_name", "last_name", "position", "height", "weight", "season_exp", *_BIO_INTEGERS)
_SIDE_COLUMNS = ("final_score", "team_id_home", "team_id_away", "pts_home", "pts_away")
_PLAY_COLUMNS = ("eventnum", "player1_id", "player1_team_id", "player2_id", "player2_team_id", "player3_id",
                 "player3_team_id")

_HEIGHT = """CASE WHEN len(string_split(coalesce(height, ''), '-')) = 2
    THEN TRY_CAST(string_split(height, '-')[1] AS INTEGER) * 12 + TRY_CAST(string_split(height, '-')[2] AS INTEGER)
  END"""


def _roster_inputs(t):
    return t["v_line_score"], t["v_play_by_play"], t["v_common_player_info"]


@query(
    "roster_scores",
    checked(*_ROSTER_VIEWS, sql=f"""
WITH {_SCORES}, seen AS ({_SEEN})
SELECT game_id, team_id, final_score, player_id, first_name, last_name, position, height, weight
FROM scores JOIN seen USING (game_id, team_id) JOIN v_common_player_info ON player_id = person_id"""),
)
def roster_scores(t):
    return rosters.roster_scores(*_roster_inputs(t))


_TYPED = f"""
WITH {_SCORES}, seen AS (
  SELECT player1_id AS player_id, player1_team_id AS team_id, game_id FROM v_play_by_play
  WHERE player1_id <> 0 GROUP BY ALL
)
SELECT game_id, team_id, final_score, player_id, first_name, last_name, season_exp,
  {_HEIGHT} AS height_in, TRY_CAST(weight AS REAL) AS weight,
  {", ".join(f"TRY_CAST({c} AS INTEGER) AS {c}" for c in _BIO_INTEGERS)}
FROM scores JOIN seen USING (game_id, team_id)
LEFT JOIN v_common_player_info ON player_id = person_id"""


@query("roster_scores_typed", checked(*_ROSTER_VIEWS, sql=_TYPED))
def roster_scores_typed(t):
    return rosters.roster_scores_typed(*_roster_inputs(t))


@query(
    "roster_left_top100",
    checked(*_ROSTER_VIEWS, sql=_TYPED + "\nORDER BY game_id, team_id, player_id LIMIT 100"),
)
def roster_left_top100(t):
    return rosters.roster_top(*_roster_inputs(t), n=100)


@query(
    "roster_star",
    checked(*_ROSTER_VIEWS, sql=f"""
WITH sides AS (
  SELECT *, unnest([team_id_home, team_id_away]) AS team_id, unnest([pts_home, pts_away]) AS final_score
  FROM v_line_score
), plays AS (SELECT DISTINCT * FROM v_play_by_play WHERE player1_id <> 0)
SELECT game_id, team_id, {", ".join(f"sides.{c} AS t__{c}" for c in _SIDE_COLUMNS)},
  player1_id AS pbp__player_id, {", ".join(f"plays.{c} AS pbp__{c}" for c in _PLAY_COLUMNS)},
  {", ".join(f"{c} AS cpi__{c}" for c in _BIO_TEXTS)}, {_HEIGHT} AS cpi__height_in,
  TRY_CAST(weight AS REAL) AS cpi__weight_cast,
  {", ".join(f"TRY_CAST({c} AS INTEGER) AS cpi__{c}_cast" for c in _BIO_INTEGERS)}
FROM sides JOIN plays USING (game_id) LEFT JOIN v_common_player_info ON player1_id = person_id
WHERE player1_team_id = team_id"""),
)
def roster_star(t):
    return rosters.roster_star(*_roster_inputs(t))


@query(
    "pbp_game_join",
    checked("v_play_by_play", "v_game", sql="""
SELECT p.*, g.season_id AS game__season_id, g.season_type AS game__season_type, g.team_id_home AS game__team_id_home,
  g.team_id_away AS game__team_id_away, g.fg_pct_home AS game__fg_pct_home, g.fg3_pct_home AS game__fg3_pct_home,
  g.team_name_home AS game__team_name_home, g.wl_home AS game__wl_home, g.reb_home AS game__reb_home,
  g.ast_home AS game__ast_home, g.pts_home AS game__pts_home, g.pts_away AS game__pts_away,
  g.game_date_est AS game__game_date_est, g.all_null AS game__all_null, g.constant_col AS game__constant_col
FROM v_play_by_play p JOIN v_game g ON p.game_id = g.game_id"""),
)
def pbp_game_join(t):
    return rosters.plays_with_game(t["v_play_by_play"], t["v_game"])


@query(
    "merged_left_chain",
    checked(
        "v_player", "v_player_bio", "v_draft_history", "v_team", "v_team_details", "v_game", "v_game_summary",
        "v_commentary",
        sql="""
WITH people AS (
  SELECT player_id, team_id AS of_team, game_id AS of_game, display_first_last AS player_name
  FROM v_player LEFT JOIN v_player_bio USING (player_id)
), drafted AS (SELECT people.* FROM people LEFT JOIN v_draft_history USING (player_id)),
teams AS (SELECT team_id, team_name, season_year FROM v_team LEFT JOIN v_team_details USING (team_id)),
games AS (
  SELECT v_game.game_id, game_date_est AS game_date, pts AS team_points, comment AS play_commentary
  FROM v_game LEFT JOIN v_game_summary USING (game_id) LEFT JOIN v_commentary USING (game_id)
)
SELECT player_id, player_name, team_name, season_year, game_id, game_date, team_points, play_commentary
FROM drafted LEFT JOIN teams ON of_team = team_id LEFT JOIN games ON of_game = game_id""",
    ),
)
def merged_left_chain(t):
    return rosters.merged_chain(
        t["v_player"], t["v_player_bio"], t["v_draft_history"], t["v_team"], t["v_team_details"], t["v_game"],
        t["v_game_summary"], t["v_commentary"],
    )


@query(
    "auto_star_join",
    checked("v_line_score", "v_game_summary", "v_play_by_play", sql="""
SELECT t0.game_id, t0.team_id_home AS line_score__team_id_home, t0.team_id_away AS line_score__team_id_away,
  t0.pts_home AS line_score__pts_home, t0.pts_away AS line_score__pts_away, t1.pts AS game_summary__pts,
  t2.eventnum AS play_by_play__eventnum, t2.player1_id AS play_by_play__player1_id,
  t2.player1_team_id AS play_by_play__player1_team_id, t2.player2_id AS play_by_play__player2_id,
  t2.player2_team_id AS play_by_play__player2_team_id, t2.player3_id AS play_by_play__player3_id,
  t2.player3_team_id AS play_by_play__player3_team_id
FROM v_line_score t0 JOIN v_game_summary t1 ON t0.game_id = t1.game_id
JOIN v_play_by_play t2 ON t0.game_id = t2.game_id"""),
)
def auto_star_join(t):
    tables = {name: t[f"v_{name}"] for name in ("line_score", "game_summary", "play_by_play")}
    return star_join(tables, "game_id")


@query(
    "joined_table_export",
    checked("v_line_score", "v_game_summary", sql="""
SELECT t0.game_id, t0.team_id_home AS line_score__team_id_home, t0.team_id_away AS line_score__team_id_away,
  t0.pts_home AS line_score__pts_home, t0.pts_away AS line_score__pts_away, t1.pts AS game_summary__pts
FROM v_line_score t0 JOIN v_game_summary t1 ON t0.game_id = t1.game_id"""),
)
def joined_table_export(t):
    """The first of the generated joins, stored as a table and read back."""
    tables = {name: t[f"v_{name}"] for name in ("line_score", "game_summary")}
    joins = star_joins({"game_id": list(tables)}, tables)
    return export_join(t.spark, joins, FolderStore(scratch_path(t.spark, "joined")))[1]


@query("team_points", checked("v_line_score", sql=f"WITH {_SCORES} SELECT * FROM scores"))
def team_points(t):
    return unions.team_points(t["v_line_score"])


@query(
    "distinct_roster",
    checked("v_play_by_play", sql=_SEEN),
)
def distinct_roster(t):
    return unions.distinct_roster(t["v_play_by_play"])


@query(
    "typed_player_info",
    checked("v_common_player_info", sql=f"""
SELECT person_id, {_HEIGHT} AS height_in, TRY_CAST(weight AS REAL) AS weight,
  {", ".join(f"TRY_CAST({c} AS INTEGER) AS {c}" for c in _BIO_INTEGERS)} FROM v_common_player_info"""),
)
def typed_player_info(t):
    info = t["v_common_player_info"]
    return info.select("person_id", *rosters.typed_bio(info))


_SHARED = {
    "nationkey": {"nation": "n_nationkey", "customer": "c_nationkey", "supplier": "s_nationkey"},
    "orderkey": {"orders": "o_orderkey", "lineitem": "l_orderkey"},
    "partkey": {"part": "p_partkey", "lineitem": "l_partkey"},
    "suppkey": {"lineitem": "l_suppkey", "supplier": "s_suppkey"},
}


def _size_sql(column: str, keys: dict[str, str]) -> str:
    (first, key), *others = keys.items()
    joins = " ".join(f"JOIN {t} ON {first}.{key} = {t}.{k}" for t, k in others)
    return f"SELECT '{column}' AS column_name, count(DISTINCT {first}.{key}) AS n_keys, count(*) AS n_rows FROM {first} {joins}"


@query("star_join_sizes", " UNION ALL ".join(_size_sql(c, keys) for c, keys in _SHARED.items()))
def star_join_sizes(t):
    """How large the join on each shared column is, told without joining the rows."""
    parts = []
    for column, keys in _SHARED.items():
        tables = {table: t[table].select(F.col(key).alias(column)) for table, key in keys.items()}
        size = star_join_size(tables, column)
        parts.append(size.select(F.lit(column).alias("column_name"), "n_keys", F.col("n_rows").cast("bigint").alias("n_rows")))
    return reduce(DataFrame.unionByName, parts)


@query("star_join_from_report", ORACLES["joined_table_export"])
def star_join_from_report(t):
    """The report of shared columns written as JSON, read back, and the joins it names generated."""
    tables = {name: t[f"v_{name}"] for name in ("line_score", "game_summary")}
    home = scratch_path(t.spark, "shared-columns")
    FolderStore(home, "json").write(catalog.common_columns_document(t.spark, tables), "common")
    return star_joins(read_json_config(t.spark, f"{home}/common.json"), tables)["game_id"]
