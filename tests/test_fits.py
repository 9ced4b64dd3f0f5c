"""Fits, mixtures and densities against numpy and brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline.operators import density, fit, mixture
from firnline.plans.conductivity import conductivity_mixture


def xy(spark, seed=0, n=250):
    rng = np.random.default_rng(seed)
    x = rng.uniform(0, 20, n)
    y = 0.04 * x**3 - 2 * x**2 + 7 * x - 3 + rng.normal(0, 1, n)
    return x, y, spark.createDataFrame([("a", float(u), float(v), i) for i, (u, v) in enumerate(zip(x, y))], "k string, x double, y double, i int")


@pytest.mark.parametrize("degree", [1, 2, 3])
def test_poly_fit_matches_numpy(spark, degree):
    x, y, df = xy(spark)
    got = fit.poly_fit(df, "k", "x", "y", degree, "i").first()
    want, res, *_ = np.polyfit(x, y, degree, full=True)
    assert got["coefs"] == pytest.approx(list(want), rel=1e-8, abs=1e-9)
    assert got["rss"] == pytest.approx(res[0], rel=1e-8)
    assert (got["pairs"], got["first_x"], got["last_x"]) == (250, x[0], x[-1])


def test_poly_fit_groups_and_degenerate(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, 4.0), (1, 3.0, 6.0), (2, 5.0, 1.0), (2, 5.0, 3.0), (3, 1.0, None)], "k int, x double, y double")
    got = {r["k"]: r for r in fit.poly_fit(df, "k", "x", "y", 1).collect()}
    assert got[1]["coefs"] == pytest.approx([2.0, 0.0], abs=1e-9) and got[1]["rss"] == pytest.approx(0, abs=1e-18)
    assert got[2]["coefs"] is None and 3 not in got
    with pytest.raises(ValueError):
        fit.poly_fit(df, "k", "x", "y", 4)


def test_poly_curve(spark):
    df = spark.createDataFrame([("a", float(v), float(v * v)) for v in range(5)], "k string, x double, y double")
    curve = fit.poly_curve(fit.poly_fit(df, "k", "x", "y", 2), "k").orderBy("point").collect()
    assert len(curve) == 50 and curve[49]["x"] == pytest.approx(4) and curve[49]["y"] == pytest.approx(16)


def test_linear_regression(spark):
    x, y, df = xy(spark, 1)
    got = fit.linear_regression(df, "x", "y").first()
    slope, cut = np.polyfit(x, y, 1)
    r2 = 1 - np.sum((y - slope * x - cut) ** 2) / np.sum((y - y.mean()) ** 2)
    assert (got["slope"], got["intercept"], got["r2"]) == (pytest.approx(slope), pytest.approx(cut), pytest.approx(r2))


def values(spark, data):
    return spark.createDataFrame([(None if v is None else float(v),) for v in data], "slt double")


def test_mixture_finds_two_clusters(spark):
    df = values(spark, [100, 101, 102, 103, 104, 199, 200, 201, 202, 203, None, float("nan")])
    got = mixture.gaussian_mixture(df, "slt", 2, n_init=3).orderBy("mean").collect()
    assert [r["mean"] for r in got] == pytest.approx([102, 201], abs=1e-6)
    assert [r["std"] for r in got] == pytest.approx([math.sqrt(2)] * 2, abs=1e-4)
    assert sum(r["weight"] for r in got) == pytest.approx(1)


def test_mixture_likelihood_beats_one_component_and_order(spark):
    rng = np.random.default_rng(5)
    data = np.round(np.concatenate([rng.normal(150, 6, 600), rng.normal(190, 4, 300), rng.normal(230, 5, 100)]), 1)
    got = mixture.gaussian_mixture(values(spark, data), "slt", 3, n_init=4).orderBy("component").collect()
    assert [r["mean"] for r in got] == pytest.approx([150, 190, 230], abs=1.5)
    assert [r["weight"] for r in got] == sorted((r["weight"] for r in got), reverse=True)
    assert [r["weight"] for r in got] == pytest.approx([0.6, 0.3, 0.1], abs=0.02)


def test_single_component(spark):
    got = mixture.gaussian_mixture(values(spark, [1, 2, 3, 4]), "slt", 1, n_init=1).first()
    assert got["mean"] == pytest.approx(2.5) and got["std"] == pytest.approx(math.sqrt(1.25), abs=1e-5) and got["weight"] == 1.0


def test_kernel_density_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    data = np.round(rng.uniform(120, 300, 700), 1)
    got = density.kernel_density(values(spark, data), "slt", points=101).orderBy("point").collect()
    end = density.grid_end(values(spark, data), "slt")
    grid = np.linspace(100, end, 101)
    want = np.exp(-0.5 * ((grid[:, None] - data[None, :]) / 5) ** 2).sum(axis=1) / (len(data) * 5 * math.sqrt(2 * math.pi))
    assert [r["x"] for r in got] == pytest.approx(list(grid)) and [r["density"] for r in got] == pytest.approx(list(want), abs=1e-14)


@pytest.mark.parametrize("top, end", [(298.0, 300.0), (299.5, 400.0), (199.0, 200.0), (99.0, 200.0)])
def test_grid_end_rounds_half_to_even(spark, top, end):
    assert density.grid_end(values(spark, [1.0, top]), "slt") == end


def test_component_curves(spark):
    comps = mixture.rank_components(spark.createDataFrame([(150.0, 0.3, 4.0), (200.0, 0.7, 5.0)], "mean double, weight double, std double"))
    curves = density.component_curves(comps, 300.0, points=201)
    peaks = {r["component"]: r["peak"] for r in density.component_peaks(curves).collect()}
    assert peaks == {1: pytest.approx(0.7 / (5 * math.sqrt(2 * math.pi))), 2: pytest.approx(0.3 / (4 * math.sqrt(2 * math.pi)))}


def test_conductivity_mixture(spark):
    df = spark.sql("SELECT CAST('2019-04-14 00:00:00' AS timestamp_ntz) AS ts, CAST(v AS double) AS slt FROM VALUES (120), (121), (122), (180), (181), (182), (181) AS t(v)")
    late = df.selectExpr("ts + INTERVAL 400 DAY AS ts", "slt + 500 AS slt")
    comps, kde, curves = conductivity_mixture(df.union(late), 2, "2019-04-14", "2020-01-20", points=50, n_init=2)
    assert [round(r["mean"]) for r in comps.orderBy("component").collect()] == [181, 121]
    assert kde.count() == 50 and curves.count() == 100


def test_residuals_of_a_very_good_fit(spark):
    """Noise of a millionth of the spread: nine digits of the residual sum are right."""
    rng = np.random.default_rng(1)
    x = rng.uniform(-3, 7, 3000)
    for degree in (1, 2, 3):
        y = np.polyval(rng.normal(size=degree + 1), x) + 1e-6 * rng.normal(size=len(x))
        frame = spark.createDataFrame([("a", *p) for p in zip(x.tolist(), y.tolist())], "k string, x double, y double")
        want = np.polyfit(x - x.mean(), y, degree, full=True)[1][0]
        assert fit.poly_fit(frame, "k", "x", "y", degree).first()["rss"] == pytest.approx(want, rel=1e-9)


def test_binned_density_within_its_bound(spark):
    data = np.random.default_rng(2).gamma(3, 60, 3000) + 80
    frame = values(spark, [*data.tolist(), float("nan"), -5000.0])
    direct = density.kernel_density(frame, "slt", end=400.0, points=500, bandwidth=9.0).orderBy("point").toPandas()
    binned = density.binned_density(frame, "slt", end=400.0, points=500, bandwidth=9.0).orderBy("point").toPandas()
    bound = density.binned_error(300 / 499, 9.0)
    assert list(binned["point"]) == list(range(500)) and np.abs(direct["density"] - binned["density"]).max() < bound < 1e-3


def test_mixture_of_bins(spark):
    """However many values, the rows are few; the components move by less than the square of bin width over deviation."""
    rng = np.random.default_rng(3)
    frame = values(spark, np.concatenate([rng.normal(100, 7, 4000), rng.normal(150, 11, 6000)]).tolist()).cache()
    exact = mixture.gaussian_mixture(frame, "slt", 2, n_init=1, tol=1e-7).collect()
    few = mixture.gaussian_mixture(frame, "slt", 2, n_init=1, tol=1e-7, bins=256).collect()
    assert mixture.binned(frame, "slt", 256).count() <= 256
    for a, b in zip(exact, few, strict=True):
        assert b["mean"] == pytest.approx(a["mean"], abs=0.02) and b["std"] == pytest.approx(a["std"], abs=0.02) and b["weight"] == pytest.approx(a["weight"], abs=1e-3)
    sums = mixture.binned(frame, "slt", 64).agg(F.sum("cnt"), F.sum(F.col("cnt") * F.col("value")), F.sum(F.col("within") + F.col("cnt") * F.col("value") * F.col("value"))).first()
    raw = frame.agg(F.count("slt"), F.sum("slt"), F.sum(F.col("slt") * F.col("slt"))).first()
    assert list(sums) == pytest.approx(list(raw), rel=1e-12)
