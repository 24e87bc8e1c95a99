"""Per player and period: event counts, points from the running score, features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.constants import SCORING_EVENT_TYPES
from courtside.functions.text import score_part
from courtside.operators.windows import SLICE_ROWS, with_previous

PLAYER_KEYS = ("game_id", "player1_id", "period")


def scoring_events(events: DataFrame) -> DataFrame:
    """Scoring events that carry a score, with both sides as numbers."""
    return events.where(
        F.col("eventmsgtype").isin(*SCORING_EVENT_TYPES) & F.col("score").isNotNull()
    ).withColumns({"home_score": score_part(F.col("score"), 0), "away_score": score_part(F.col("score"), 1)})


def score_deltas(events: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Scoring events with the change of both scores since the last scoring event.

    The first event of a game, and any next to an unreadable score, changes
    nothing. The points go to the home side if it moved, else to the away side.
    """
    scored = scoring_events(events).select(*PLAYER_KEYS, "eventnum", "home_score", "away_score")
    previous = with_previous(scored, ["game_id"], "eventnum", ["home_score", "away_score"], slice_rows=slice_rows)
    return previous.withColumns(
        {
            "home_delta": F.coalesce(F.col("home_score") - F.col("prev_home_score"), F.lit(0)),
            "away_delta": F.coalesce(F.col("away_score") - F.col("prev_away_score"), F.lit(0)),
        }
    ).withColumn(
        "points_scored",
        F.when(F.col("home_delta") > 0, F.col("home_delta"))
        .when(F.col("away_delta") > 0, F.col("away_delta"))
        .otherwise(F.lit(0)),
    )


def player_points(events: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Points per (game, player, period)."""
    return (
        score_deltas(events, slice_rows)
        .groupBy(*PLAYER_KEYS)
        .agg(F.sum("points_scored").cast("bigint").alias("total_points"))
    )


def event_counts(events: DataFrame) -> DataFrame:
    """Events per (game, player, period)."""
    return events.groupBy(*PLAYER_KEYS).agg(F.count(F.lit(1)).alias("total_events"))


def event_type_counts(events: DataFrame) -> DataFrame:
    """Events per (game, player, period, type)."""
    return events.groupBy(*PLAYER_KEYS, "eventmsgtype").agg(F.count(F.lit(1)).alias("count"))


def event_types(events: DataFrame) -> list[int]:
    """The event types that occur, in order."""
    found = events.select("eventmsgtype").where(F.col("eventmsgtype").isNotNull()).distinct()
    return sorted(row[0] for row in found.collect())


def event_type_pivot(events: DataFrame, types: Sequence[int] | None = None) -> DataFrame:
    """One ``event_type_<type>`` column per type, 0 where it did not occur.

    Counting under a condition gives the pivot of the per-type counts in one
    aggregation instead of two.
    """
    types = event_types(events) if types is None else types
    return events.groupBy(*PLAYER_KEYS).agg(
        *[F.count_if(F.col("eventmsgtype") == t).alias(f"event_type_{t}") for t in types]
    )


def player_features(
    events: DataFrame, types: Sequence[int] | None = None, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Event counts, counts by type and points per (game, player, period); nulls as 0.

    Rows without a player count as events, but their types and points are 0,
    because a join on a NULL player finds nothing. The events are read twice:
    for the counts, and for the points, which need the events of a game in order.
    """
    types = event_types(events) if types is None else types
    keyed = F.lit(True)
    for key in PLAYER_KEYS:
        keyed = keyed & F.col(key).isNotNull()
    counts = events.groupBy(*PLAYER_KEYS).agg(
        F.count(F.lit(1)).alias("total_events"),
        *[F.count_if(keyed & (F.col("eventmsgtype") == t)).alias(f"event_type_{t}") for t in types],
    )
    return counts.join(player_points(events, slice_rows), list(PLAYER_KEYS), "left").na.fill(0)
