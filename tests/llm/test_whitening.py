from __future__ import annotations

from collections import defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from courtside.llm import whitening as w
from courtside.llm.vectors import exact_products, exact_squares, exact_sums, scaled

VECTORS = "vec_id long, embedding array<double>, label int, n long, component int, s double, i int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 0.5, 4) for i, v in rows], VECTORS).repartition(3)


def some_rows(seed=3, n=60, dims=6):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims))
    return [(i, row) for i, row in enumerate(mixed.tolist())]


AWKWARD = [
    (None, [0.25] * 6), (7, [0.5, 1.0]), (7, [0.5, 1.0]), (8, []), (9, None), (10, [1.0, None, 2.0, 0.0, 0.0, 0.0]),
    (11, [float("nan")] * 6), (12, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0]), (13, [-3.0, 0.0, -0.0, 1e-9, -1e-9, 7.0]),
]


def brute(rows):
    """n, exact deviations by row, covariance by definition in fractions."""
    dims = max(len(v) for _, v in rows)
    x = [[floor(1024 * Fraction(c)) + 100_000 for c in [*v, *[0.0] * (dims - len(v))]] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    away = [[c - Fraction(s, n) for c, s in zip(row, sums)] for row in x]
    covariance = [[sum(r[i] * r[j] for r in away) / n for j in range(dims)] for i in range(dims)]
    return n, deviations, np.array(away, float), np.array(covariance, float)


def test_against_the_definition(spark):
    rows = some_rows() + AWKWARD
    counted = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n, deviations, away, covariance = brute(counted)
    found = w.whiten(frame(spark, rows)).collect()
    assert len(found) == 6 * n and {r["n"] for r in found} == {n}
    assert sorted((r["vec_id"] or -1, r["deviation"]) for r in found if r["component"] == 1) == sorted((i or -1, d) for (i, _), d in zip(counted, deviations))
    assert all(int(r["deviation_exact"]) == r["deviation"] for r in found)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    for k in range(6):
        part = {(r["vec_id"], r["deviation"]): r for r in found if r["component"] == k + 1}
        got = np.array([part[i, d]["whitened"] for (i, _), d in zip(counted, deviations)])
        want = away @ vectors[:, k] / np.sqrt(values[k])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-9
        assert [*{r["explained"] for r in part.values()}] == [pytest.approx(values[k] / values.sum(), rel=1e-12)]
    assert [*{r["identity_error"] for r in found}] == [pytest.approx(0, abs=1e-9)]


def test_result_does_not_depend_on_partitions(spark):
    df = frame(spark, some_rows())
    key = lambda d: sorted((r["vec_id"], r["component"], r["deviation"], r["explained"]) for r in d.collect())
    assert key(w.whiten(df.repartition(7))) == key(w.whiten(df.coalesce(1)))


def test_a_far_offset_costs_no_digits(spark):
    rows = some_rows(5)
    near, far = (w.whiten(frame(spark, [(i, [c + shift for c in v]) for i, v in rows])).collect() for shift in (0.0, float(1 << 40)))
    assert max(r["identity_error"] for r in far) < 1e-9
    # The shift takes the low bits of the entries, not digits of the covariance of what is left.
    away = {(r["vec_id"], r["component"]): r["whitened"] for r in near}
    assert all(abs(abs(r["whitened"]) - abs(away[r["vec_id"], r["component"]])) < 0.01 for r in far)


def test_no_variance_and_nothing_at_all(spark):
    one = w.whiten(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None), (2, 0, None, None, None)]
    line = w.whiten(frame(spark, [(i, [float(i), 1.0, 2.0 * i]) for i in range(5)])).collect()
    told = defaultdict(set)
    for r in line:
        told[r["component"]].add(r["whitened"] is None)
    assert told == {1: {False}, 2: {True}, 3: {True}} and [*{r["identity_error"] for r in line}] == [pytest.approx(0, abs=1e-9)]
    for rows in ([], [(1, None)], [(1, [])]):
        assert w.whiten(frame(spark, rows)).count() == 0


def test_deviations_beyond_64_bits_are_told_exactly(spark):
    rows = [(1, [float(1 << 40)]), (2, [-float(1 << 40)]), (3, [0.0])]
    n, deviations, _, _ = brute(rows)
    found = w.whiten(frame(spark, rows)).collect()
    assert {r["vec_id"]: int(r["deviation_exact"]) for r in found} == dict(zip((1, 2, 3), deviations))
    assert {r["vec_id"]: r["deviation"] for r in found} == {1: None, 2: None, 3: deviations[2]}


@pytest.mark.parametrize("top", [5, 600, (1 << 20) - 1, 1 << 20, 1 << 33, 1 << 52])
def test_exact_sums_of_whole_numbers(top):
    values = np.random.default_rng(top % 97).integers(-top, top + 1, (50, 5))
    plain = values.astype(object)
    assert (exact_products(values) == plain.T @ plain).all()
    assert exact_sums(values) == plain.sum(0).tolist() and exact_squares(values) == (plain * plain).sum(1).tolist()


SPECTRA = {
    "apart": np.linspace(1, 2, 40),
    "clusters": np.r_[np.ones(5) + 1e-9 * np.arange(5), 1e-3 * np.linspace(1, 2, 35)],
    "clusters of clusters": np.r_[1, 1 + 1e-13, 1 + 2e-13, 1.5, 1.5 - 1e-6, np.full(5, 1e-3) + 1e-11 * np.arange(5), np.zeros(30)],
    "graded": 10.0 ** -np.arange(40),
    "all the same": np.ones(40),
}


@pytest.mark.parametrize("spectrum", SPECTRA)
def test_refined_vectors_have_more_than_double_precision(spectrum):
    values = SPECTRA[spectrum].astype(w.WIDE)
    turn = np.linalg.qr(np.random.default_rng(1).normal(size=(40, 40)))[0].astype(w.WIDE)
    for _ in range(3):
        turn = turn + turn @ ((np.eye(40) - turn.T @ turn) / 2)
    a = (turn * values) @ turn.T
    a = (a + a.T) / 2
    found, x = w.eigenvectors(a)
    tiny = 100 * np.finfo(w.WIDE).eps
    assert np.abs(x.T @ x - np.eye(40)).max() < tiny and np.abs(a @ x - x * found).max() < tiny
    assert np.abs(found - np.sort(values)[::-1]).max() < tiny and (np.diff(found) <= tiny).all()


def test_vectors_of_a_batch():
    import pyarrow as pa

    batch = pa.array([[9.0], [1.0, 2.5], None, [1.0, None], [], [float("nan")], [-0.3]], pa.list_(pa.float32())).slice(1)
    kept, x = scaled(batch, 2.0)
    assert kept.tolist() == [True, False, False, True, False, True] and x.tolist() == [[2, 5], [0, 0], [-1, 0]]
