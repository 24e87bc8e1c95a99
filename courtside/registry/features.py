"""Event counts, score differences and the feature table."""

from __future__ import annotations

from courtside.operators.joins import keep_ids
from courtside.plans import features
from courtside.registry.core import checked, query

# Types the fixture's events have; naming them saves the pass that finds them.
EVENT_TYPES = (1, 2, 3, 4, 5)

_DELTAS = """
deltas AS (
  SELECT game_id, player1_id, period, eventnum, home_score, away_score, prev_home_score, prev_away_score,
    coalesce(home_score - prev_home_score, 0) AS home_delta, coalesce(away_score - prev_away_score, 0) AS away_delta
  FROM (
    SELECT *, lag(home_score) OVER w AS prev_home_score, lag(away_score) OVER w AS prev_away_score
    FROM (
      SELECT *, TRY_CAST(string_split(score, ' - ')[1] AS INTEGER) AS home_score,
        TRY_CAST(string_split(score, ' - ')[2] AS INTEGER) AS away_score
      FROM v_events_scored WHERE eventmsgtype IN (1, 3) AND score IS NOT NULL
    ) WINDOW w AS (PARTITION BY game_id ORDER BY eventnum)
  )
), points AS (
  SELECT *, CASE WHEN home_delta > 0 THEN home_delta WHEN away_delta > 0 THEN away_delta ELSE 0 END AS points_scored
  FROM deltas
), total AS (
  SELECT game_id, player1_id, period, CAST(sum(points_scored) AS BIGINT) AS total_points
  FROM points GROUP BY ALL
)"""

_TYPE_COLUMNS = ", ".join(
    f"CAST(count(*) FILTER (WHERE eventmsgtype = {t}) AS BIGINT) AS event_type_{t}" for t in EVENT_TYPES
)

_DELTA_SQL = checked("v_events_scored", sql=f"WITH {_DELTAS} SELECT * FROM points")


@query("score_deltas", _DELTA_SQL)
def score_deltas(t):
    return features.score_deltas(t["v_events_scored"])


@query("score_deltas_sliced", _DELTA_SQL)
def score_deltas_sliced(t):
    """The same with every game taken for a hot one, so that all are scanned in ranges."""
    return features.score_deltas(t["v_events_scored"], slice_rows=50)


# Most rows are one game's; half of its rows share one number, and others have none.
_TIES = (
    "CASE WHEN game_id <= 20 THEN 0 ELSE game_id END AS game_id", "player1_id", "period", "eventmsgtype", "score",
    "CASE WHEN game_id % 2 = 0 THEN 7 WHEN game_id % 3 > 0 THEN eventnum END AS eventnum",
)
_TIES_SQL = f"WITH ties AS (SELECT {', '.join(_TIES)} FROM v_events_scored), {_DELTAS.strip()} SELECT * FROM points"
_TIES_SQL = _TIES_SQL.replace("FROM v_events_scored WHERE", "FROM ties WHERE").replace(
    "ORDER BY eventnum", "ORDER BY eventnum NULLS FIRST, home_score NULLS FIRST, away_score NULLS FIRST, player1_id NULLS FIRST, period NULLS FIRST"
)


@query("score_deltas_ties", checked("v_events_scored", sql=_TIES_SQL))
def score_deltas_ties(t):
    """Score differences where event numbers repeat and lack: rows of one number by their scores, then by player and period."""
    return features.score_deltas(t["v_events_scored"].selectExpr(*_TIES), slice_rows=50)



@query("player_points", checked("v_events_scored", sql=f"WITH {_DELTAS} SELECT * FROM total"))
def player_points(t):
    return features.player_points(t["v_events_scored"])


@query(
    "event_counts",
    checked("v_events_scored", sql="""
SELECT game_id, player1_id, period, count(*) AS total_events FROM v_events_scored GROUP BY ALL"""),
)
def event_counts(t):
    return features.event_counts(t["v_events_scored"])


@query(
    "event_type_counts",
    checked("v_events_scored", sql="""
SELECT game_id, player1_id, period, eventmsgtype, count(*) AS count FROM v_events_scored GROUP BY ALL"""),
)
def event_type_counts(t):
    return features.event_type_counts(t["v_events_scored"])


@query(
    "event_type_pivot",
    checked("v_events_scored", sql=f"""
SELECT game_id, player1_id, period, {_TYPE_COLUMNS} FROM v_events_scored GROUP BY game_id, player1_id, period"""),
)
def event_type_pivot(t):
    return features.event_type_pivot(t["v_events_scored"])


FEATURES_SQL = f"""
{_DELTAS}, types AS (
  SELECT game_id, player1_id, period, {_TYPE_COLUMNS} FROM v_events_scored GROUP BY game_id, player1_id, period
), base AS (
  SELECT game_id, player1_id, period, count(*) AS total_events FROM v_events_scored GROUP BY ALL
), features AS (
  SELECT coalesce(base.game_id, 0) AS game_id, coalesce(base.player1_id, 0) AS player1_id,
    coalesce(base.period, 0) AS period, total_events,
    {", ".join(f"coalesce(event_type_{t}, 0) AS event_type_{t}" for t in EVENT_TYPES)},
    coalesce(total_points, 0) AS total_points
  FROM base
  LEFT JOIN types ON base.game_id = types.game_id AND base.player1_id = types.player1_id AND base.period = types.period
  LEFT JOIN total ON base.game_id = total.game_id AND base.player1_id = total.player1_id AND base.period = total.period
)"""


@query("player_features", checked("v_events_scored", sql=f"WITH {FEATURES_SQL} SELECT * FROM features"))
def player_features(t):
    return features.player_features(t["v_events_scored"], EVENT_TYPES)


@query(
    "semi_sampled_games",
    checked("v_play_by_play", "v_game", sql="""
SELECT * FROM v_play_by_play
WHERE game_id IN (SELECT game_id FROM v_game WHERE season_type = 'Regular Season')"""),
)
def semi_sampled_games(t):
    ids = t["v_game"].where("season_type = 'Regular Season'").select("game_id").distinct()
    return keep_ids(t["v_play_by_play"], ids, "game_id")


@query("unique_game_ids", checked("v_play_by_play", sql="SELECT DISTINCT game_id FROM v_play_by_play"))
def unique_game_ids(t):
    return t["v_play_by_play"].select("game_id").distinct()
