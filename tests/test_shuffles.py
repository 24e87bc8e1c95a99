"""What a task takes from a shuffle or a file is bounded by its bytes, not by the session's number of partitions."""

from __future__ import annotations

import pytest

from courtside.registry import QUERIES
from courtside.session import ADAPTIVE_SETTINGS
from courtside.views import Tables
from tests.conftest import FOLDER

# So small that the smallest tables make many pieces; joins are not broadcast.
_SMALL = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}

SPLIT_KEY = "spark.sql.files.maxPartitionBytes"


@pytest.mark.parametrize("name", ["distinct_roster", "roster_scores", "roster_star"])
def test_tasks_are_more_than_the_sessions_partitions_where_rows_are_many(spark, name):
    frame = QUERIES[name](spark, FOLDER)  # a query tunes the session
    old = {key: spark.conf.get(key, None) for key in _SMALL}
    try:
        for key, value in _SMALL.items():
            spark.conf.set(key, value)
        assert frame.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions")) == 8
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert ADAPTIVE_SETTINGS["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "16m"


@pytest.mark.parametrize(("asked", "kept"), [(None, "16m"), ("128MB", "16m"), ("1g", "16m"), ("8m", "8m"), ("4096", "4096")])
def test_splits_of_files_are_bounded_and_a_sessions_smaller_ones_stay(spark, asked, kept):
    old = spark.conf.get(SPLIT_KEY, None)
    try:
        spark.conf.unset(SPLIT_KEY) if asked is None else spark.conf.set(SPLIT_KEY, asked)
        frame = QUERIES["roster_scores"](spark, FOLDER)
        assert spark.conf.get(SPLIT_KEY) == kept
        if asked == "4096":  # read so, too
            assert Tables(spark, FOLDER)["lineitem"].rdd.getNumPartitions() > 8
            assert frame.count() > 0
    finally:
        spark.conf.unset(SPLIT_KEY) if old is None else spark.conf.set(SPLIT_KEY, old)
