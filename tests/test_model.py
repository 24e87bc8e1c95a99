from __future__ import annotations

from pyspark.sql import functions as F

from courtside.operators import model
from courtside.plans import features
from courtside.plans.points_model import train_points_model
from courtside.registry import QUERIES
from tests.conftest import FOLDER

EVENTS = 6000


def planted(spark):
    """Every scoring event brings its home side two points, so the counts give the points away."""
    return spark.range(EVENTS).select(
        (F.col("id") % 40).alias("game_id"),
        F.col("id").alias("eventnum"),
        (F.xxhash64("id") % 5 + 5).alias("player1_id"),
        (F.xxhash64("id", F.lit(1)) % 2 + 2).alias("period"),
        F.when(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(3)) == 0, 1).otherwise(2).alias("eventmsgtype"),
        F.concat((F.col("id") * 2).cast("string"), F.lit(" - 0")).alias("score"),
    )


def test_split_is_the_same_on_any_partitioning(spark):
    df = spark.range(500).select(
        (F.col("id") % 13).alias("game_id"), F.col("id").alias("player1_id"), (F.col("id") % 4).alias("period")
    )
    train, test = model.train_test_split(df)
    again, _ = model.train_test_split(df.repartition(17))
    assert train.count() + test.count() == 500 and train.exceptAll(again).isEmpty()
    assert 330 < train.count() < 470


def test_forest_beats_the_mean(spark):
    fitted, predicted, naive = train_points_model(planted(spark), trees=10)
    forest_error = model.mean_absolute_error(predicted).first()
    naive_error = model.mean_absolute_error(naive).first()
    assert forest_error["n"] == naive_error["n"] > 0
    assert forest_error["mae"] < 0.8 * naive_error["mae"]
    assert len(fitted.stages[-1].trees) == 10


def test_predictions_build_the_features_once(spark, monkeypatch):
    calls, build = [], features.with_previous
    monkeypatch.setattr(features, "with_previous", lambda *a, **b: calls.append(1) or build(*a, **b))
    assert QUERIES["rf_predictions"](spark, FOLDER).where("NOT within_labels").isEmpty()
    assert len(calls) == 1


def test_only_sampled_games_are_trained_on(spark):
    games = spark.range(3).select(F.col("id").alias("game_id"))
    _, predicted, naive = train_points_model(planted(spark), sampled_games=games, trees=2)
    assert {r[0] for r in naive.select("game_id").distinct().collect()} <= {0, 1, 2}
