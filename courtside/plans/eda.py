"""From the game table to clean numbers and their correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.constants import GAME_STAT_COLUMNS, SEASON_TYPE
from courtside.operators import cleaning, phik, stats
from courtside.operators.catalog import columns_like, numeric_columns


def game_scan(game: DataFrame, season_type: str = SEASON_TYPE) -> DataFrame:
    """The statistics columns of one season type; both reach the scan."""
    wanted = [c for c in GAME_STAT_COLUMNS if c in game.columns]
    return game.where(F.col("season_type") == season_type).select(*wanted)


def clean_numeric(game: DataFrame) -> DataFrame:
    """Every column but the ids as a number; columns without values and rows with a NULL go."""
    numbers = cleaning.coerce_numeric(game.drop(*columns_like(game, "id")))
    return cleaning.drop_null_rows(cleaning.drop_all_null_columns(numbers))


def correlations_before_after(game: DataFrame) -> DataFrame:
    """PhiK of the regular season's columns, raw and after the power transform.

    Raw correlations also take the text columns in; the transformed ones are of
    the numbers only, so some pairs have no value after.
    """
    games = game_scan(game)
    shown = cleaning.drop_null_rows(games.drop(*columns_like(games, "id")))
    before = phik.phik_pairs(shown, numeric_columns(shown))

    numbers = cleaning.drop_constant_columns(clean_numeric(games))
    transformed = stats.apply_yeo_johnson(numbers, stats.fit_yeo_johnson(numbers, numbers.columns))
    after = phik.phik_pairs(transformed, transformed.columns)
    return phik.compare_correlations(before, after)
