from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from courtside.operators import joins, unions
from courtside.plans import rosters


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_left_lookup_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "c")], "k long, v string")
    right = spark.createDataFrame([(1, "one"), (1, "uno"), (None, "null")], "id long, name string")
    found = joins.left_lookup(left, right, "k", "id")
    assert found.columns == ["k", "v", "name"]
    assert rows(found, "k", "v", "name") == sorted(
        [(1, "a", "one"), (1, "a", "uno"), (2, "b", None), (None, "c", None), (None, "c", None)], key=str
    )


def test_rows_without_key_are_hashed_apart(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = spark.range(2000).select(F.when(F.col("id") < 0, F.col("id")).alias("k"), F.col("id").alias("v"))
        right = spark.range(10).select(F.col("id"), F.col("id").alias("w"))
        found = joins.left_lookup(left, right, "k", "id")
        assert "hashpartitioning(k#" in found._jdf.queryExecution().toString()
        assert "_spread" in [
            line for line in found._jdf.queryExecution().toString().splitlines() if "hashpartitioning(k#" in line
        ][0]
        assert found.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_left_fanout_is_a_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 0)], "k long, w long")
    found = joins.left_fanout(left, right, "k")
    assert rows(found, "k", "v", "w") == rows(left.join(right, "k", "left"), "k", "v", "w")


@pytest.mark.parametrize("piece", [1, 2, 100_000])
def test_copies_repeat_rows_as_the_join_would(spark, monkeypatch, piece):
    monkeypatch.setattr(joins, "COPIES_PER_PIECE", piece)
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    right = spark.createDataFrame([(1,), (1,), (1,), (9,), (None,)], "k long")
    found = joins.spell_out_copies(joins.with_copies(left, right, "k"))
    assert rows(found, "k", "v") == rows(left.join(right, "k", "left"), "k", "v")


def test_a_hot_key_is_split_by_the_adaptive_planner(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "64",
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        plays = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias("game_id"),
                (F.xxhash64("id") % 1000000).alias("eventnum"),
        )
        game = spark.range(5000).select(F.col("id").alias("game_id"), F.col("id").alias("season"))
        joined = joins.star_join({"play": plays, "game": game}, "game_id")
        counted = joined.groupBy("game_id").agg(F.sum("play__eventnum"), F.max("game__season"))
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_star_join_of_both_entry_forms(spark):
    tables = {
        "a": spark.createDataFrame([(1, 2)], "id long, x long"),
        "b": spark.createDataFrame([(1, 3), (1, 4)], "id long, x long"),
        "c": spark.createDataFrame([(5,)], "y long"),
    }
    common = {
        "id": {"table_count": 2, "tables": [{"name": "a", "position": 0}, {"name": "b", "position": 0}]},
        "x": ["a", "b"],
        "y": ["c"],
    }
    found = joins.star_joins(common, tables)
    assert list(found) == ["id", "x"]
    assert found["id"].columns == ["id", "a__x", "b__x"]
    assert rows(found["id"], "id", "a__x", "b__x") == [(1, 2, 3), (1, 2, 4)]


def test_unpivot_doubles_rows(spark):
    scores = spark.createDataFrame([(1, 10, 20, 99, 98)], "game_id long, team_id_home long, team_id_away long, "
                                                         "pts_home long, pts_away long")
    assert rows(unions.team_points(scores), "game_id", "team_id", "final_score") == [(1, 10, 99), (1, 20, 98)]


def test_stacked_tables_with_different_types(spark):
    tables = {
        "t1": spark.createDataFrame([(1, "a")], "x int, y string"),
        "t2": spark.createDataFrame([(2.5, 7)], "x double, z int"),
        "t3": spark.createDataFrame([("q",)], "x string"),
    }
    found = unions.stack_tables(tables)
    assert rows(found, "__source_table", "x", "y", "z") == [
        ("t1", "1", "a", None), ("t2", "2.5", None, 7), ("t3", "q", None, None),
    ]
    numbers = unions.stack_tables({k: tables[k] for k in ("t1", "t2")}, source_column=None)
    assert dict(numbers.dtypes)["x"] == "double"
    assert unions.stack_tables(tables, limit=1).count() == 3


def test_the_chain_before_a_fan_out_is_planned_once(spark, tables):
    from courtside.registry import QUERIES

    plan = QUERIES["merged_left_chain"](spark, tables.folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 6


def test_the_size_of_a_star_join_is_told_before_it_runs(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 300 + [2, 3, None, None])], "k int, a int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 200 + [3, 3, 4, None])], "k int, b int")
    tables = {"left": left, "right": right}
    size = joins.star_join_size(tables, "k").first()
    assert (size["n_keys"], size["n_rows"]) == (2, 300 * 200 + 2)
    assert joins.star_join(tables, "k", max_rows=60_002).count() == 60_002
    with pytest.raises(ValueError, match="60002 rows"):
        joins.star_join(tables, "k", max_rows=60_001)
    apart = joins.star_join_size({"left": left.where("k = 2"), "right": right}, "k").first()
    assert (apart["n_keys"], apart["n_rows"]) == (0, 0)


def _star(spark, games, plays):
    info = spark.createDataFrame(
        [(7, "A", "B", "Guard", "6-2", "200", 3.0, "1990", "x", "1989", "1", "")],
        "person_id long, first_name string, last_name string, position string, height string, weight string, "
        "season_exp double, from_year string, to_year string, draft_year string, draft_round string, draft_number string",
    )
    return rosters.roster_star(
        spark.createDataFrame(games, "game_id long, team_id_home long, team_id_away long, pts_home long, pts_away long"),
        spark.createDataFrame(plays, "game_id long, eventnum int, player1_id long, player1_team_id long"),
        info,
    )


def test_star_tells_the_side_of_every_play(spark):
    games = [
        (1, 10, 20, 99, 98),
        (2, 10, 10, 90, 80),  # both sides
        (3, None, 20, 70, 60),
        (4, 10, 20, None, 50),
        (5, 10, 20, 1, 2), (5, 20, 10, 3, 4),  # a game twice
        (None, 10, 20, 5, 6),
    ]
    plays = [
        (1, 1, 7, 10), (1, 1, 7, 10), (1, 2, 8, 20), (1, 3, 7, 30), (1, 4, 0, 10), (1, 5, None, 10), (1, 6, 7, None),
        (2, 1, 7, 10), (3, 1, 7, None), (3, 2, 7, 20), (4, 1, 7, 10), (5, 1, 7, 10), (6, 1, 7, 10), (None, 1, 7, 10),
    ]
    found = _star(spark, games, plays)
    assert found.columns[:12] == [
        "game_id", "team_id", "t__team_id_home", "t__team_id_away", "t__pts_home", "t__pts_away", "t__final_score",
        "pbp__eventnum", "pbp__player1_id", "pbp__player1_team_id", "pbp__player_id", "cpi__first_name",
    ]
    assert rows(found, "game_id", "team_id", "t__pts_home", "t__final_score", "pbp__eventnum", "cpi__first_name") == sorted(
        [
            (1, 10, 99, 99, 1, "A"), (1, 20, 99, 98, 2, None), (2, 10, 90, 90, 1, "A"), (2, 10, 90, 80, 1, "A"),
            (3, 20, 70, 60, 2, "A"), (4, 10, None, None, 1, "A"), (5, 10, 1, 1, 1, "A"), (5, 10, 3, 4, 1, "A"),
        ],
        key=str,
    )


def test_star_shuffles_a_game_once_and_not_once_a_side(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _star(spark, [(1, 10, 20, 99, 98)], [(1, 1, 7, 10)])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"hashpartitioning\(game_id#\w+, \d", plan)
    assert not re.search(r"hashpartitioning\(game_id#\w+, team_id#", plan)
