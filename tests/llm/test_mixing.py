from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from courtside.llm import mixing as m
from tests.llm.conftest import awkward, space_words, told


def brute_targets(sizes):
    """Shares by weight; what is above three times a source is shared again among the others."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        unit = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] >= 3 * sizes[s]]
        if not over:
            return {**fixed, **{s: unit * weight[s] for s in free}}
        fixed |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 1, "b": 1000}, {"a": 5, "b": 90, "c": 7, "d": 1, None: 40}, {"é": 0, "z": 9, "Z": 3}, {"a": 0}])
def test_targets_by_brute_force(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in m.targets(table).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def some(spark, n=900):
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([0, 1, 3, 10, 80]), "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_sources_come_to_their_targets(spark):
    docs = some(spark)
    found = m.mixed(docs)
    by = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size"), F.first("source_size").alias("s"))
    for r in by.collect():
        assert abs(r["taken"] - r["target"]) <= 0.5 and r["size"] == r["s"]
    assert found.where("taken > 3 * size or taken < 0").count() == 0
    again = m.mixed(docs.repartition(7))
    assert told(found, "doc_id", "taken", "positions") == told(again, "doc_id", "taken", "positions")
    whole = m.mixed(docs, whole=True)
    assert whole.where("size > 0 and taken % size <> 0").count() == 0
    near = whole.groupBy("source").agg((F.sum("taken") - F.first("target")).alias("off"), F.max("size").alias("most")).collect()
    assert all(abs(r["off"]) <= r["most"] for r in near)


def test_due_inverts_the_schedule(spark):
    rows = [(t / 20, k / 4) for t in range(21) for k in range(-4, 5)]
    df = spark.createDataFrame(rows, "t double, k double").withColumn("share", F.expr("t + k * (t * t - t)"))
    back = df.select("t", m.due(F.col("share"), F.col("k")).alias("back")).collect()
    assert all(abs(r["t"] - r["back"]) < 1e-6 for r in back)


def test_early_sources_come_early(spark):
    rows = [(i, "w " * 5, "abc"[i % 3]) for i in range(600)]
    found = m.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    mean = {r["source"]: r["p"] for r in found.select("source", F.explode("positions").alias("p")).groupBy("source").agg(F.avg("p").alias("p")).collect()}
    assert mean["a"] < mean["b"] < mean["c"]


def test_rows_as_often_as_taken(spark):
    docs = some(spark)
    line = m.curriculum(docs)
    assert line.columns == docs.columns
    want = {r["doc_id"]: r["copies"] for r in m.mixed(docs, True).where("copies > 0").collect()}
    got = {r["doc_id"]: r["count"] for r in line.groupBy("doc_id").count().collect()}
    assert got == want and set(want.values()) <= {1, 2, 3}


def test_rows_with_repeated_or_no_ids_are_taken(spark):
    rows = [(None if i % 2 else i // 8, f"w{i} " * 5, "a") for i in range(40)] + [(None, "same " * 5, "a")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert told(m.curriculum(docs), "doc_id", "text", "source") == sorted(rows, key=repr)


def test_many_sources_come_to_the_same_targets(spark):
    rng = random.Random(8)
    sizes = {f"host{rng.randrange(10**6)}.é" if i % 9 else f"{i}": rng.choice([0, 1, 7, 500, 10**6]) for i in range(700)} | {None: 12}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["source"]: r["target"] for r in m.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == pytest.approx(brute_targets(sizes))


def test_rows_without_an_id_are_spread_over_the_ranges(spark):
    docs = spark.range(20_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('w ', id) AS text", "'a' AS source", "0 AS position")
    line = m.curriculum(docs, position="at")
    assert line.columns == ["doc_id", "text", "source", "position", "at"]
    rows = line.collect()
    assert len({r["text"] for r in rows}) == len(rows) == 20_000 and [r["at"] for r in rows] == sorted(r["at"] for r in rows)


def test_awkward_rows(docs, no_docs):
    got = told(m.mixed(docs), "doc_id", "size", "source")
    assert got == sorted(((r[0], len(space_words(r[1])), r[3]) for r in awkward()), key=repr)
    assert m.mixed(no_docs).count() == 0 and m.curriculum(no_docs).count() == 0
    assert m.curriculum(docs).columns == docs.columns


def test_no_python_in_the_plan(docs):
    plan = m.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
