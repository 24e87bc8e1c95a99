from __future__ import annotations

from math import floor

import numpy as np
import pytest

from courtside.llm import top_k as t
from courtside.llm.top_k import top_k

VECTORS = "vec_id long, embedding array<double>, query_id long, rank int, score long, query int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], VECTORS).repartition(parts)


def brute(rows, k=5, every=50):
    counted = [(i, [floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for q, a in counted:
        if q is None or q % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i or 0, i) for i, b in counted if i != q)
        out += [(q, rank, i, -s) for rank, (s, _, _, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def told(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def rows_of(seed, n, dims=4):
    return [(i, v) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, dims)).tolist())]


AWKWARD = [
    (None, [9.0] * 4), (None, [9.0] * 4), (50, [1.0, -1.0]), (50, [1.0, -1.0]), (100, []), (1050, None), (1100, [1.0, None, 0.0, 0.0]),
    (1150, [float("inf")] * 4), (1200, [float("nan"), 0.0, 0.0, 0.0]), (-50, [-5.0, 0.0, 1e-7, -1e-7]), (1001, [9.0] * 4), (1001, [9.0] * 4),
]


def test_against_brute_force(spark):
    rows = rows_of(1, 400) + AWKWARD
    assert told(top_k(frame(spark, rows))) == brute(rows)
    assert told(top_k(frame(spark, rows, 1), k=3)) == brute(rows, 3)


def test_ties_at_the_kth_score(spark):
    rows = [(i, [1.0, float(i % 3 == 0)]) for i in range(300)]
    assert told(top_k(frame(spark, rows))) == brute(rows)
    same = [(i, [0.5]) for i in range(200, 0, -1)]
    assert told(top_k(frame(spark, same))) == brute(same)


def test_small_blocks_waves_and_rounds(spark, monkeypatch):
    rows = rows_of(2, 500, 3)
    monkeypatch.setattr(t, "BLOCK_ROWS", 17)
    monkeypatch.setattr(t, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(t, "WAVE_BYTES", 100)
    monkeypatch.setattr(t, "ROUND_BITS", 5)
    assert told(top_k(frame(spark, rows))) == brute(rows)


def test_fewer_candidates_than_asked_for(spark):
    assert told(top_k(frame(spark, [(0, [1.0]), (1, [-1.0]), (2, [-2.0])]))) == [(0, 1, 1, -65536), (0, 2, 2, -131072)]
    assert top_k(frame(spark, [(0, [1.0])])).count() == 0
    for rows in ([], [(0, None)], [(1, [1.0])]):
        assert top_k(frame(spark, rows)).count() == 0
    assert told(top_k(frame(spark, [(0, []), (1, []), (2, [])]))) == [(0, 1, 1, 0), (0, 2, 2, 0)]


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [float((1 << 18) + i), float((1 << 17) - i), 1 / 256]) for i in range(120)]
    assert told(top_k(frame(spark, rows))) == brute(rows)
    with pytest.raises(ArithmeticError):
        top_k(frame(spark, [(0, [1e30]), (1, [1.0])]))


def test_own_queries(spark):
    from pyspark.sql import functions as F

    rows = rows_of(4, 60)
    assert told(top_k(frame(spark, rows), F.col("vec_id") % 7 == 0, k=2)) == brute(rows, 2, 7)


def test_a_block_tells_no_more_bins_than_its_own_best(spark):
    import pyarrow as pa

    rows = np.random.default_rng(3).normal(size=(2000, 8))
    batch = pa.RecordBatch.from_pydict({"vec_id": pa.array(range(2000), pa.int64()), "embedding": pa.array(rows.tolist(), pa.list_(pa.float64()))})
    wave = t._Wave(np.arange(0, 100, 50), np.floor(256 * rows[:100:50]), 1 << 24, 5, 256)
    for found in wave.histogram([batch], wave.bits - t.ROUND_BITS):
        assert found.num_rows <= 5 * 2
