from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.operators import phik, quantiles, stats

RNG = np.random.default_rng(3)
SHAPES = {
    "uniform": RNG.uniform(-5, 5, 3000),
    "heavy_tail": RNG.standard_cauchy(3000) ** 3,
    "two_values": np.where(RNG.random(3000) < 0.4, 1.0, 7.5),
    "one_value": np.full(3000, 2.5),
    "hot_value": np.where(RNG.random(3000) < 0.5, 0.0, RNG.normal(size=3000)),
    "huge": RNG.uniform(-1, 1, 3000) * 1.7e308,
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("sort_rows", [20, 10**6])
def test_quantiles_are_exact(spark, shape, sort_rows):
    data = SHAPES[shape]
    df = spark.createDataFrame([(float(v),) for v in data], "v double").union(
        spark.createDataFrame([(None,), (math.nan,)], "v double")
    )
    points = (0.0, 0.013, 0.25, 0.5, 0.999, 1.0)
    row = quantiles.exact_quantiles(df, ["v"], points, sort_rows=sort_rows).first()
    assert row["n"] == len(data)
    with np.errstate(over="ignore"):
        expected = np.quantile(data, points)
    if shape != "huge":
        assert np.allclose(row["quantiles"], expected, rtol=1e-12)


@pytest.mark.parametrize("sort_rows", [50, 10**6])
def test_quantiles_by_group(spark, sort_rows):
    rows = [(g, float(i * i % 97)) for g, n in (("a", 400), ("b", 3), (None, 60)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = quantiles.exact_quantiles(df, ["v"], (0.25, 0.5), by="g", sort_rows=sort_rows).collect()
    for r in found:
        data = [v for g, v in rows if g == r["group"]]
        assert np.allclose(r["quantiles"], np.quantile(data, (0.25, 0.5)))
    assert len(found) == 3


def test_many_long_groups_leave_only_counts_on_the_driver(spark, monkeypatch):
    df = spark.range(60_000).selectExpr("CAST(id % 3000 AS STRING) AS g", "CAST((id * 7919) % 60013 AS DOUBLE) AS v")
    collected = []
    plain = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: collected.append(plain(self)) or collected[-1])
    found = quantiles.exact_quantiles(df, ["v"], (0.25, 0.5, 0.9), by="g", sort_rows=4)
    assert all(len(rows) <= 1 for rows in collected)
    monkeypatch.undo()
    rows = {r["group"]: r for r in found.collect()}
    wide = df.toPandas().groupby("g")["v"]
    assert len(rows) == 3000 and all(r["n"] == 20 for r in rows.values())
    for g, values in wide:
        assert np.allclose(rows[g]["quantiles"], np.quantile(values, (0.25, 0.5, 0.9)))


@pytest.mark.parametrize("shape", ["smooth", "far apart", "few values"])
def test_kernel_density_by_cells_is_the_plain_sum(spark, shape):
    rng = np.random.default_rng(5)
    data = {
        "smooth": rng.normal(1e6, 3.0, 4000),
        "far apart": np.concatenate([rng.normal(0, 1, 3000), [1e7, -1e7]]),
        "few values": np.array([1.0, 1.0, 2.0, 50.0]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,), (math.nan,)], "v double")
    cells = stats.kernel_density(df, "v", points=120).orderBy("point").toPandas()
    plain = stats.kernel_density_exact(df, "v", points=120).orderBy("point").toPandas()
    assert len(cells) == 120 and np.allclose(cells["x"], plain["x"])
    peak = plain["density"].max()
    assert np.abs(cells["density"] - plain["density"]).max() <= 1e-10 * peak


def test_box_summary(spark):
    data = [float(v) for v in [*range(1, 21), 100, -50]]
    row = stats.box_summary(spark.createDataFrame([(v,) for v in data], "v double"), ["v"]).first()
    assert (row["n"], row["whisker_low"], row["whisker_high"], row["n_outliers"]) == (22, 1.0, 20.0, 2)


def test_histogram_matches_numpy(spark):
    data = SHAPES["uniform"]
    df = spark.createDataFrame([(float(v), 4.0) for v in data], "v double, same double")
    rows = stats.histogram(df, ["v", "same"]).orderBy("bin").collect()
    counts, edges = np.histogram(data, bins=30)
    assert [r["count"] for r in rows if r["column"] == "v"] == list(counts)
    assert np.allclose([r["low"] for r in rows if r["column"] == "v"], edges[:-1])
    same = [r for r in rows if r["column"] == "same"]
    assert [r["count"] for r in same] == [0] * 15 + [3000] + [0] * 14
    assert (same[0]["low"], same[-1]["high"]) == (3.5, 4.5)


@pytest.mark.parametrize("data", [SHAPES["uniform"], np.round(SHAPES["uniform"])], ids=["scattered", "repeated"])
def test_density_matches_numpy(spark, data):
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    rows = stats.kernel_density(df, "v", points=50).orderBy("point").collect()
    x = np.linspace(data.min(), data.max(), 50)
    h = data.std(ddof=1) * len(data) ** -0.2
    expected = np.exp(-0.5 * ((x[:, None] - data) / h) ** 2).sum(axis=1) / (len(data) * h * math.sqrt(2 * math.pi))
    assert np.allclose([r["x"] for r in rows], x) and np.allclose([r["density"] for r in rows], expected)


def power(x, lam):
    up = np.log1p(np.abs(x)) if lam == 0 else ((np.abs(x) + 1) ** lam - 1) / lam
    down = np.log1p(np.abs(x)) if lam == 2 else ((np.abs(x) + 1) ** (2 - lam) - 1) / (2 - lam)
    return np.where(x >= 0, up, -down)


def likelihood(x, lam):
    return -len(x) / 2 * math.log(power(x, lam).var()) + (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


@pytest.mark.parametrize("lam", [-1.0, 0.0, 0.5, 1.0, 2.0, 3.3])
def test_power_transform(spark, lam):
    x = np.array([-20.0, -1.5, -1e-9, 0.0, 1e-9, 2.0, 300.0])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, v double").orderBy("i")
    found = [r[0] for r in df.select(stats.yeo_johnson(F.col("v"), F.lit(lam))).collect()]
    assert np.allclose(found, power(x, lam), rtol=1e-6, atol=1e-15)
    assert all(a < b for a, b in zip(found, found[1:]))


def test_fitted_exponent_has_the_greatest_likelihood(spark):
    columns = {
        "log": np.exp(RNG.normal(2, 0.6, 2000)),
        "left": 50 - np.exp(RNG.normal(2, 0.5, 2000)),
        "whole": RNG.poisson(4, 2000).astype(float),
        "steep": 1e4 - np.exp(RNG.normal(6, 1, 2000)),
        "same": np.full(2000, 3.0),
    }
    rows = list(zip(*[[float(v) for v in c] for c in columns.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    fitted = stats.fit_yeo_johnson(df, list(columns))
    assert set(fitted) == set(columns) - {"same"}
    for c, fit in fitted.items():
        best = likelihood(columns[c], fit["lambda"])
        assert all(best >= likelihood(columns[c], fit["lambda"] + d) for d in (-0.5, -0.01, -0.0005, 0.0005, 0.01, 0.5))
    scaled = stats.apply_yeo_johnson(df, fitted).agg(F.avg("log"), F.stddev_pop("log"), F.max("same")).first()
    assert abs(scaled[0]) < 1e-6 and abs(scaled[1] - 1) < 1e-6 and scaled[2] == 3.0


def test_grouped_quartiles_skip_hues(spark):
    df = spark.range(200).select(
        (F.col("id") * 1.0).alias("v"), (F.col("id") % 3).alias("three"), (F.col("id") % 11).alias("eleven")
    )
    found = stats.grouped_quartiles(df, ["v"], ["three", "eleven", "absent"])
    assert {r["hue"] for r in found.collect()} == {"three", "eleven"}
    found = stats.grouped_quartiles(df, ["v"], ["three", "eleven", "absent"], max_values=10)
    assert {r["hue"] for r in found.collect()} == {"three"}
    assert stats.grouped_quartiles(df, ["v"], ["eleven"], max_values=10) is None
    assert stats.left_out(df, ["v", "three"], ["eleven", "absent"], 1, 10) == {
        "three": "past the number of columns", "eleven": "too many values", "absent": "not a column"
    }


def test_infinities_and_nan_are_no_measurements_at_any_size(spark):
    rows = [(float(i),) for i in range(31)] + [(math.inf,), (-math.inf,), (math.nan,), (None,)]
    df = spark.createDataFrame(rows, "v double")
    for sort_rows in (5, 1000):
        box = stats.box_summary(df, ["v"], sort_rows=sort_rows).first()
        assert (box["n"], box["q1"], box["median"], box["q3"]) == (31, 7.5, 15.0, 22.5)


def test_quantiles_of_the_widest_interval(spark):
    df = spark.createDataFrame([(s * 1.7e308 / (i + 1),) for i in range(50) for s in (1, -1)], "v double")
    narrowed = stats.box_summary(df, ["v"], sort_rows=4).first()
    assert narrowed["median"] == pytest.approx(0.0, abs=1e300) and narrowed["n"] == 100


def test_no_density_without_two_values(spark):
    for rows in ([], [(3.0,)], [(3.0,), (3.0,)]):
        assert stats.kernel_density(spark.createDataFrame(rows, "v double"), "v").count() == 0


def test_id_density(spark):
    ids = sorted({int(v) for v in RNG.integers(0, 100_000, 3000)})
    df = spark.createDataFrame([(i,) for i in ids * 2] + [(None,)], "id long").repartition(7)
    row = stats.id_density(df, "id").first()
    gaps = np.diff(ids)
    assert (row["n_ids"], row["min_id"], row["max_id"]) == (len(ids), ids[0], ids[-1])
    assert (row["min_gap"], row["max_gap"], row["n_gaps"]) == (gaps.min(), gaps.max(), (gaps > 1).sum())
    assert row["mean_gap"] == pytest.approx(gaps.mean()) and row["n_missing"] == ids[-1] - ids[0] + 1 - len(ids)
    alone = stats.id_density(spark.createDataFrame([(5,)], "id long"), "id").first()
    assert (alone["n_ids"], alone["min_gap"], alone["mean_gap"], alone["n_missing"]) == (1, None, None, 0)


def correlations(df, intervals):
    return {(r["column_1"], r["column_2"]): r["phik"] for r in phik.phik_pairs(df, intervals).collect()}


def test_correlation_of_equal_and_independent_columns(spark):
    n = 4000
    df = spark.range(n).select(
        (F.col("id") % 4).cast("string").alias("a"),
        (F.col("id") % 4).cast("string").alias("b"),
        (F.floor(F.col("id") / 4) % 5).cast("string").alias("c"),
        F.lit("same").alias("constant"),
    )
    found = correlations(df, [])
    assert set(found) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert found["a", "b"] == pytest.approx(1.0) and found["a", "c"] == 0.0
    assert all(0 <= v <= 1 for v in found.values())
    high = phik.high_correlations(phik.phik_pairs(df, [])).collect()
    assert [tuple(r) for r in high] == [("a", "b", 1.0)]


@pytest.mark.parametrize("rho", [0.0, 0.3, 0.6, 0.9])
def test_correlation_of_normal_columns_is_about_theirs(spark, rho):
    rng = np.random.default_rng(11)
    x = rng.normal(size=20000)
    y = rho * x + math.sqrt(1 - rho * rho) * rng.normal(size=20000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    found = correlations(df, ["x", "y"])["x", "y"]
    assert found == pytest.approx(rho, abs=0.06)
    assert correlations(df.select("y", "x"), ["x", "y"])["y", "x"] == pytest.approx(found, abs=1e-5)


def model_chi2(spark, rows):
    shapes = spark.createDataFrame([(a, b, round(rho * 1000)) for rho, a, b in rows], "small long, large long, place long")
    found = phik.normal_chi2(shapes, 1000).collect()
    return {(r["place"] / 1000, r["small"], r["large"]): r["model"] for r in found}


def plain_chi2(rho, n_1, n_2):
    """All cells by a fine rule of midpoints."""
    def middles(n):
        return (np.arange(n * (4000 // n)) + 0.5) * (10 / (n * (4000 // n))) - 5

    x, y = middles(n_1), middles(n_2)
    density = np.exp(-(x[:, None] ** 2 - 2 * rho * x[:, None] * y + y * y) / (2 * (1 - rho * rho)))
    cells = density.reshape(n_1, len(x) // n_1, n_2, len(y) // n_2).sum(axis=(1, 3))
    cells /= cells.sum()
    return (cells**2 / (cells.sum(axis=1, keepdims=True) * cells.sum(axis=0, keepdims=True))).sum() - 1


def test_chi_square_of_the_binned_normal_distribution(spark):
    rows = [(rho, a, b) for rho in (0.2, 0.7, 0.95) for a, b in ((2, 2), (3, 10), (6, 1500), (40, 4000))]
    for key, found in model_chi2(spark, rows).items():
        assert found == pytest.approx(plain_chi2(*key), rel=1e-4)
    steps = model_chi2(spark, [(r / 30, 5, 8) for r in range(31)])
    values = [v for _, v in sorted(steps.items())]
    assert len(values) == 31 and all(b > a for a, b in zip(values, values[1:])) and values[0] == pytest.approx(0, abs=1e-9)


def test_chi_square_of_equal_sides_is_full(spark):
    found = model_chi2(spark, [(1.0, n, n) for n in (2, 10, 5000)] + [(1.0, 3, 9), (1.0, 7, 3_000_000)])
    assert [found[1.0, n, n] for n in (2, 10, 5000)] == pytest.approx([1, 9, 4999])
    assert found[1.0, 3, 9] == pytest.approx(2) and found[1.0, 7, 3_000_000] == pytest.approx(6, rel=1e-4)


def test_blocks_of_a_large_table_are_spread_and_add_up(spark, monkeypatch):
    whole = model_chi2(spark, [(0.6, 50, 20_000), (0.998, 300, 300)])
    monkeypatch.setattr(phik, "BLOCK_POINTS", 20_000)
    assert model_chi2(spark, [(0.6, 50, 20_000), (0.998, 300, 300)]) == pytest.approx(whole, rel=1e-9)
    shapes = spark.createDataFrame([(100_000, 100_000, 500)], "small long, large long, place long")
    rows = shapes.withColumn("blocks", phik._block_count(F.lit(0.5))).first()["blocks"]
    assert rows > 64


def test_correlation_is_found_again_from_its_chi_square(spark):
    rows = []
    for i, (rho, a, b) in enumerate([(0.001, 2, 9), (0.37, 10, 10), (0.81, 4, 700), (0.999, 30, 30), (0.6, 1200, 900)]):
        n = 10**9
        full, model = phik._share(1.0, *sorted((a, b))) - 1, phik._share(rho, *sorted((a, b))) - 1
        noise, greatest = (a - 1) * (b - 1), n * (min(a, b) - 1)
        rows.append((str(i), str(rho), n, a, b, noise + model / full * (greatest - noise)))
    rows += [("none", "0", 0, 0, 0, 0.0), ("one bin", "0", 50, 1, 4, 0.0), ("equal", "1", 50, 2, 2, 50.0)]
    pairs = spark.createDataFrame(rows, "column_1 string, column_2 string, n long, n_1 long, n_2 long, chi2 double")
    found = phik.phik_from_chi2(pairs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["phik"] == pytest.approx(float(r["column_2"]), abs=2e-6)
    assert phik.phik_from_chi2(pairs.limit(0)).count() == 0


def test_contingency_ignores_rows_with_nulls(spark):
    df = spark.createDataFrame([("x", "1"), ("x", None), ("y", "2"), (None, "1")], "a string, b string")
    row = phik.contingency_chi2(df).first()
    assert (row["n"], row["n_1"], row["n_2"], row["chi2"]) == (2, 2, 2, pytest.approx(2.0))
