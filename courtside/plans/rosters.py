"""Final scores joined to who played, in the shapes the analysts ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.text import height_to_inches, to_double, to_integer
from courtside.operators.joins import left_fanout, left_lookup, prefixed, spell_out_copies, with_copies
from courtside.operators.unions import distinct_roster, team_points
from courtside.session import materialize

_BIO_INTEGERS = ("from_year", "to_year", "draft_year", "draft_round", "draft_number")


def roster_scores(line_score: DataFrame, play_by_play: DataFrame, info: DataFrame) -> DataFrame:
    """Final team score per (game, team, player) with the player's particulars, sorted."""
    roster = distinct_roster(play_by_play)
    bio = info.select(
        F.col("person_id").alias("player_id"), "first_name", "last_name", "position", "height", "weight"
    )
    return (
        team_points(line_score)
        .join(roster, ["game_id", "team_id"])
        .join(bio, "player_id")
        .select(
            "game_id", "team_id", "final_score", "player_id",
            "first_name", "last_name", "position", "height", "weight",
        )
        .orderBy("game_id", "team_id", "last_name", "first_name")
    )


def typed_bio(info: DataFrame, suffix: str = "") -> list[Column]:
    """Height in inches and the text columns as numbers, bad text as NULL."""
    return [
        height_to_inches(info["height"]).alias("height_in"),
        to_double(info["weight"]).cast("float").alias("weight" + suffix),
        *[to_integer(info[c]).alias(c + suffix) for c in _BIO_INTEGERS],
    ]


def roster_scores_typed(line_score: DataFrame, play_by_play: DataFrame, info: DataFrame) -> DataFrame:
    """As :func:`roster_scores` for the first player slot, typed, players without particulars kept."""
    first = play_by_play.where(F.col("player1_id") != 0)
    roster = distinct_roster(first, slots=(1,))
    bio = info.select(
        F.col("person_id").alias("player_id"), "first_name", "last_name", "season_exp", *typed_bio(info)
    )
    joined = team_points(line_score).join(roster, ["game_id", "team_id"])
    return left_lookup(joined, bio.withColumnRenamed("player_id", "person_id"), "player_id", "person_id").select(
        "game_id", "team_id", "final_score", "player_id", "first_name", "last_name", "season_exp",
        "height_in", "weight", *_BIO_INTEGERS,
    )


def roster_top(line_score: DataFrame, play_by_play: DataFrame, info: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` rows of :func:`roster_scores_typed` by game, team and player."""
    return roster_scores_typed(line_score, play_by_play, info).orderBy("game_id", "team_id", "player_id").limit(n)


def roster_star(line_score: DataFrame, play_by_play: DataFrame, info: DataFrame) -> DataFrame:
    """All columns of score, distinct plays of the first slot, and particulars.

    Columns are named after their table, so the result can be written. A game
    is joined as one row and its side told afterwards, so that neither its
    columns are shuffled twice nor the plays, which lie by game already.
    """
    told = ["team_id_home", "team_id_away", "pts_home", "pts_away"]
    plays = (
        play_by_play.where(F.col("player1_id") != 0)
        .distinct()
        .withColumn("team_id", F.col("player1_team_id"))
        .withColumn("player_id", F.col("player1_id"))
    )
    bio = info.select("*", *typed_bio(info, suffix="_cast"))
    played = prefixed(plays.withColumnRenamed("team_id", "of_team"), "pbp", keep=["game_id", "of_team"])
    games = line_score.select("game_id", *told).join(played, "game_id")
    joined = (
        team_points(games, keep=[c for c in games.columns if c != "game_id"])
        .where(F.col("team_id") == F.col("of_team"))
        .select(
            "game_id", "team_id", *[F.col(c).alias(f"t__{c}") for c in (*told, "final_score")],
            *[c for c in played.columns if c.startswith("pbp__")],
        )
    )
    return left_lookup(joined, prefixed(bio, "cpi"), "pbp__player_id", "cpi__person_id")


def plays_with_game(play_by_play: DataFrame, game: DataFrame) -> DataFrame:
    """Every play with all columns of its game."""
    return play_by_play.join(prefixed(game, "game", keep=["game_id"]), "game_id")


def merged_chain(
    player: DataFrame,
    info: DataFrame,
    draft_history: DataFrame,
    team: DataFrame,
    team_details: DataFrame,
    game: DataFrame,
    game_summary: DataFrame,
    play_by_play: DataFrame,
) -> DataFrame:
    """One wide row per player, draft entry and play of the player's game.

    Draft entries add no column but still repeat the rows they match; plays of
    a game fan out last, when the row is as small as it gets.
    """
    base = player.select("player_id", F.col("team_id").alias("of_team"), F.col("game_id").alias("of_game"))
    base = left_lookup(base, info.select("player_id", F.col("display_first_last").alias("player_name")), "player_id")
    base = with_copies(base, draft_history, "player_id")
    base = left_lookup(
        base, team.select(F.col("team_id").alias("_team"), "team_id", "team_name"), "of_team", "_team"
    )
    base = left_lookup(base, team_details.select("team_id", "season_year"), "team_id")
    games = game.select(F.col("game_id").alias("_game"), "game_id", F.col("game_date_est").alias("game_date"))
    base = left_lookup(base, games, "of_game", "_game")
    base = left_lookup(base, game_summary.select("game_id", F.col("pts").alias("team_points")), "game_id")
    plays = play_by_play.select("game_id", F.col("comment").alias("play_commentary"))
    # Stored, as the fan-out reads it twice: for the matches and for the rest.
    return spell_out_copies(left_fanout(materialize(base, "chain"), plays, "game_id")).select(
        "player_id", "player_name", "team_name", "season_year", "game_id", "game_date", "team_points",
        "play_commentary",
    )
