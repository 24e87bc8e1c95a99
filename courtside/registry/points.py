"""Split, model and baseline."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtside.operators import model
from courtside.plans.features import player_features
from courtside.plans.points_model import fit_points_model
from courtside.registry.core import checked, query
from courtside.registry.features import EVENT_TYPES, FEATURES_SQL
from courtside.session import materialize

_SPLIT = "(game_id * 31 + player1_id * 17 + period * 7) % 100 < 80"


@query(
    "train_test_split",
    checked("v_events_scored", sql=f"""
WITH {FEATURES_SQL} SELECT game_id, player1_id, period, total_points, {_SPLIT} AS training FROM features"""),
)
def train_test_split(t):
    features = materialize(player_features(t["v_events_scored"], EVENT_TYPES), "features")
    train, test = model.train_test_split(features)
    columns = ("game_id", "player1_id", "period", "total_points")
    return train.select(*columns, F.lit(True).alias("training")).unionByName(
        test.select(*columns, F.lit(False).alias("training"))
    )


@query(
    "naive_mae",
    checked("v_events_scored", sql=f"""
WITH {FEATURES_SQL}, m AS (SELECT avg(total_points) AS mean FROM features WHERE {_SPLIT})
SELECT count(*) AS n, round(avg(abs(total_points - mean)), 6) AS mae FROM features, m WHERE NOT {_SPLIT}"""),
)
def naive_mae(t):
    """Mean absolute error of predicting the training mean."""
    features = materialize(player_features(t["v_events_scored"], EVENT_TYPES), "features")
    train, test = model.train_test_split(features)
    return model.mean_absolute_error(model.naive_predictions(train, test)).withColumn("mae", F.round("mae", 6))


@query(
    "rf_predictions",
    checked("v_events_scored", sql=f"""
WITH {FEATURES_SQL} SELECT game_id, player1_id, period, total_points, true AS within_labels
FROM features WHERE NOT {_SPLIT}"""),
)
def rf_predictions(t):
    """The test rows, and whether each prediction lies among the labels, as means of labels do.

    Another forest would predict otherwise, so the numbers themselves have no SQL.
    """
    features = materialize(player_features(t["v_events_scored"], EVENT_TYPES), "features")
    predictions = fit_points_model(features)[1]
    low, high = features.agg(F.min("total_points"), F.max("total_points")).first()
    within = F.coalesce(F.col("prediction").between(low - 1e-9, high + 1e-9), F.lit(False))
    return predictions.select("game_id", "player1_id", "period", "total_points", within.alias("within_labels"))
