from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from courtside.operators.windows import scan_ranges, scanned, with_previous
from courtside.plans.features import player_features, score_deltas


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables lie in several ranges too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def expected_previous(rows):
    last, out = {}, []
    for game, number, value in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        out.append((game, number, value, last.get(game)))
        last[game] = value
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_rows", [1, 7, 100, 10_000])
@pytest.mark.parametrize("spread", ["dense", "sparse", "clustered"])
def test_previous_value_with_a_hot_group(spark, slice_rows, spread):
    rng = random.Random(5)
    numbers = {
        "dense": list(range(400)),
        "sparse": rng.sample(range(10**12), 400),
        "clustered": [*range(200), *range(10**9, 10**9 + 200)],
    }[spread]
    rows = [("hot", n, rng.choice([None, rng.randrange(100)])) for n in numbers]
    rows += [(g, n, n * 2) for g in ("a", "b", None) for n in range(20)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "game string, number long, value int")
    found = with_previous(df, ["game"], "number", ["value"], slice_rows=slice_rows)
    assert found.columns == ["game", "number", "value", "prev_value"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected_previous(rows)


def test_no_task_reads_much_more_than_the_others_of_a_hot_group(spark):
    half = F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 4 == 1, F.col("id"))
    df = spark.range(80_000).select(F.floor(F.col("id") / 70_000).alias("game"), half.alias("number"), F.col("id").alias("value"))
    stored = scan_ranges(df.repartition(8), ["game"], "number", ["value"])
    sizes = sorted(r["count"] for r in stored.groupBy("_range").count().collect())
    assert len(sizes) >= 7 and sizes[-1] <= 2 * sizes[len(sizes) // 2] and sum(sizes) == 80_000


@pytest.mark.parametrize("slice_rows", [3, 1000])
def test_rows_without_a_number_come_first_at_any_size(spark, slice_rows):
    df = spark.createDataFrame([("g", None, 7)] + [("g", n, n) for n in range(10)], "game string, number long, value int")
    found = with_previous(df, ["game"], "number", ["value"], slice_rows=slice_rows)
    previous = {r["number"]: r["prev_value"] for r in found.collect()}
    assert previous[None] is None and previous[0] == 7 and previous[9] == 8


ORDERS = {
    "text": ("string", ["b", "a", "", None, "a", "ab"]),
    "time": ("timestamp", [datetime(2024, 1, 2), datetime(2024, 1, 1, 5), None, datetime(2024, 1, 1)]),
    "double": ("double", [0.5, -1.0, float("nan"), None, float("inf"), 0.0, -0.0]),
    "date": ("date", [date(2024, 1, 2), date(2023, 1, 2), None]),
}


@pytest.mark.parametrize("kind", ORDERS)
def test_any_order_with_ties_is_the_same_both_ways(spark, kind):
    type_, values = ORDERS[kind]
    rng = random.Random(6)
    rows = [(rng.choice([1.5, None, float("nan")]), rng.choice(["x", None]), rng.choice(values), rng.choice([None, 1, 2, 3]), i % 40) for i in range(500)]
    df = spark.createDataFrame(rows, f"a double, b string, at {type_}, value int, other int").repartition(5)
    one = with_previous(df, ["a", "b"], "at", ["value", "other"])
    two = with_previous(df, ["a", "b"], "at", ["value", "other"], slice_rows=10)
    assert one.schema.fieldNames() == two.schema.fieldNames()
    assert Counter(map(str, one.collect())) == Counter(map(str, two.collect()))


def test_small_ranges_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, n, n) for n in range(5)] + [(2, 1, 9)], "game int, number int, value int")
    found = scanned(df.repartition(3), ["game"], "number", ["value"])
    assert sorted((r[0], r[1], r[3]) for r in found.collect()) == [(1, 0, None), (1, 1, 0), (1, 2, 1), (1, 3, 2), (1, 4, 3), (2, 1, None)]
    assert scanned(df.limit(0), ["game"], "number", ["value"]).count() == 0
    assert with_previous(df.limit(0), ["game"], "number", ["value"]).count() == 0


EVENTS = "game_id long, eventnum long, player1_id long, period long, eventmsgtype int, score string"


def test_points_go_to_the_side_that_moved(spark):
    rows = [
        (1, 1, 7, 1, 1, "2 - 0"),  # first of the game: nothing to compare with
        (1, 2, 8, 1, 1, "2 - 3"),
        (1, 3, 7, 1, 3, "3 - 4"),  # both moved: home counts
        (1, 4, 7, 1, 2, "9 - 9"),  # not a scoring event
        (1, 5, 8, 1, 1, "bad"),
        (1, 6, 8, 1, 1, "5 - 6"),  # previous score unreadable
        (1, 7, 8, 1, 1, None),
        (2, 1, 9, 1, 1, "1 - 1"),
    ]
    found = score_deltas(spark.createDataFrame(rows, EVENTS)).orderBy("game_id", "eventnum")
    assert [r["points_scored"] for r in found.collect()] == [0, 3, 1, 0, 0, 0]


def test_rows_without_a_player_count_but_do_not_join(spark):
    rows = [
        (1, 1, None, 1, 1, "2 - 0"),
        (1, 2, None, 1, 3, "5 - 0"),
        (1, 3, 4, 1, 1, "7 - 0"),
        (1, 4, 4, 2, 5, None),
    ]
    found = player_features(spark.createDataFrame(rows, EVENTS)).orderBy("player1_id", "period")
    assert found.columns == [
        "game_id", "player1_id", "period", "total_events", "event_type_1", "event_type_3", "event_type_5", "total_points",
    ]
    assert [tuple(r) for r in found.collect()] == [
        (1, 0, 1, 2, 0, 0, 0, 0),
        (1, 4, 1, 1, 1, 0, 0, 2),
        (1, 4, 2, 1, 0, 0, 1, 0),
    ]
