"""Split, forest, baseline and error of the points model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.constants import FOREST_TREES, SPLIT_SEED
from courtside.plans.features import PLAYER_KEYS

TRAIN_PERCENT = 80

# As deep as Spark grows trees.
MAX_DEPTH = 30


def in_training(percent: int = TRAIN_PERCENT) -> Column:
    """True for the rows to train on: the same ones on every run and partitioning."""
    game, player, period = (F.col(c) for c in PLAYER_KEYS)
    return F.pmod(game * 31 + player * 17 + period * 7, F.lit(100)) < percent


def train_test_split(features: DataFrame, percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, by a sum over the keys."""
    return features.where(in_training(percent)), features.where(~in_training(percent))


def feature_columns(features: DataFrame) -> list[str]:
    """The event counts."""
    return [c for c in features.columns if c == "total_events" or c.startswith("event_type_")]


def fit_forest(
    train: DataFrame,
    columns: Sequence[str] | None = None,
    label: str = "total_points",
    trees: int = FOREST_TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = SPLIT_SEED,
) -> PipelineModel:
    """A random forest over all features at every split."""
    assembler = VectorAssembler(inputCols=list(columns or feature_columns(train)), outputCol="features")
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=label,
        numTrees=trees,
        maxDepth=max_depth,
        featureSubsetStrategy="all",
        seed=seed,
        maxMemoryInMB=1024,
    )
    return Pipeline(stages=[assembler, forest]).fit(train)


def mean_absolute_error(predictions: DataFrame, label: str = "total_points", prediction: str = "prediction") -> DataFrame:
    """(n, mae) over all rows."""
    return predictions.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col(label) - F.col(prediction))).alias("mae")
    )


def naive_predictions(train: DataFrame, test: DataFrame, label: str = "total_points") -> DataFrame:
    """The mean of the training label as the prediction of every test row."""
    mean = train.agg(F.avg(label)).first()[0]
    return test.withColumn("prediction", F.lit(mean).cast("double"))
