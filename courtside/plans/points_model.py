"""From play-by-play to a points model and how it does against the mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from courtside.operators import model
from courtside.operators.joins import keep_ids
from courtside.plans.features import player_features
from courtside.session import materialize


def train_points_model(
    events: DataFrame,
    sampled_games: DataFrame | None = None,
    types: Sequence[int] | None = None,
    trees: int | None = None,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The fitted model, its predictions of the test rows, and the naive ones.

    The feature table is stored once, as training reads it several times.
    """
    if sampled_games is not None:
        events = keep_ids(events, sampled_games, "game_id")
    return fit_points_model(materialize(player_features(events, types), "features"), trees)


def fit_points_model(features: DataFrame, trees: int | None = None) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """:func:`train_points_model` over a feature table that is stored already."""
    train, test = model.train_test_split(features)
    fitted = model.fit_forest(train, **({"trees": trees} if trees else {}))
    return fitted, fitted.transform(test).drop("features"), model.naive_predictions(train, test)
