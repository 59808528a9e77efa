import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociflow.functions.stats import chi2_upper, incomplete_beta, normal_two_sided, t_two_sided, upper_gamma, z_of_p
from lociflow.operators.estimators import colocalisation, interpolated_median_ratio, inverse_variance_meta, mendelian_estimates, weighted_lower_median


def test_mendelian_three_instruments(spark):
    rows = [("a", 0.5, 0.05, 0.2, 0.03), ("a", 0.3, 0.04, 0.15, 0.03), ("a", 0.4, 0.06, 0.1, 0.04), ("b", -0.2, 0.02, 0.1, 0.05), ("c", 0.1, 0.0, 0.1, 0.1), ("c", None, 0.1, 0.1, 0.1)]
    out = {r.g: r for r in mendelian_estimates(spark.createDataFrame(rows, "g string, bx double, sx double, by double, sy double"), "g", "bx", "sx", "by", "sy").collect()}
    a = out["a"]
    assert a.ivw == pytest.approx(0.3895348837209303, rel=1e-9)
    assert a.ivw_se == pytest.approx(0.045749571099781394, rel=1e-9)
    assert a.q == pytest.approx(3.197674418604652, rel=1e-9)
    x, y, w = np.array([0.5, 0.3, 0.4]), np.array([0.2, 0.15, 0.1]), 1 / np.array([0.03, 0.03, 0.04]) ** 2
    design = np.c_[np.ones(3), x]
    fit = np.linalg.solve(design.T @ (w[:, None] * design), design.T @ (w * y))
    assert (a.intercept, a.egger) == pytest.approx(tuple(fit), rel=1e-9)
    assert out["b"].ivw is None and out["b"].wald == pytest.approx(-0.5) and "c" not in out


def test_meta_analysis(spark):
    rows = [("x", 0.1, 0.05, 0.04, "s1"), ("x", 0.3, 0.1, 0.003, "s2"), ("y", 0.2, 0.1, None, "s1"), ("y", 0.2, 0.0, 0.1, "s2"), ("y", float("nan"), 0.1, 0.1, "s3")]
    out = {r.k0: r for r in inverse_variance_meta(spark.createDataFrame(rows, "k0 string, b double, s double, p double, study string"), ["k0"], "b", "s", "study", "p").collect()}
    assert out["x"].beta == pytest.approx(0.14) and out["x"].q == pytest.approx(3.2) and out["x"].i2 == pytest.approx(68.75) and out["x"].best == "s2"
    assert (out["y"].k, out["y"].q, out["y"].i2, out["y"].best) == (1, 0.0, 0.0, "s1")


def test_colocalisation_as_by_hand(spark):
    rng = np.random.default_rng(3)
    one, two = rng.normal(0, 3, 30), rng.normal(0, 3, 30)
    one[4] = two[4] = 20
    e1, e2 = np.exp(one), np.exp(two)
    h = np.array([1, 1e-4 * e1.sum(), 1e-4 * e2.sum(), 1e-8 * (e1.sum() * e2.sum() - (e1 * e2).sum()), 1e-5 * (e1 * e2).sum()])
    rows = [("g", float(a), float(b)) for a, b in zip(one, two, strict=True)] + [("single", 5.0, 5.0), ("g", None, 1.0)]
    out = {r.g: r for r in colocalisation(spark.createDataFrame(rows, "g string, a double, b double"), ["g"], "a", "b").collect()}
    assert [out["g"][f"h{i}"] for i in range(5)] == pytest.approx(list(h / h.sum()), abs=1e-9)
    assert out["single"].h3 == 0.0 and out["g"].n_snps == 30


def test_weighted_lower_median(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(v), int(w)) for g in "ab" for v, w in zip(rng.integers(0, 9, 50), rng.integers(0, 4, 50), strict=True)] + [("z", 1.0, 0), ("a", None, 5)]
    out = {r.g: r.v for r in weighted_lower_median(spark.createDataFrame(rows, "g string, v double, w long"), ["g"], "v", "w").collect()}
    for g in "ab":
        spread = sorted(v for h, v, w in rows if h == g and v is not None for _ in range(w))
        assert out[g] == spread[(len(spread) + 1) // 2 - 1]
    assert "z" not in out


def test_interpolated_median_ratio(spark):
    rng = np.random.default_rng(2)
    rows = [(g, i, float(rng.normal(0.4, 0.2)), 0.05, float(rng.normal(0.2, 0.2)), float(rng.uniform(0.02, 0.2))) for g, n in (("a", 41), ("b", 3), ("two", 2)) for i in range(n)]
    rows += [("tie", i, 0.5, 0.05, y, s) for i, (y, s) in enumerate([(0.1, 0.03), (0.1, 0.09), (0.3, 0.05), (0.1, 0.03)])]
    out = {r.g: r for r in interpolated_median_ratio(spark.createDataFrame(rows, "g string, i long, bx double, sx double, by double, sy double"), "g", "i", "bx", "sx", "by", "sy").collect()}
    assert set(out) == {"a", "b", "tie"}
    for g in out:
        bx, sx, by, sy = np.array([r[2:] for r in rows if r[0] == g]).T
        w = 1 / (sy**2 / bx**2 + by**2 * sx**2 / bx**4)
        order = np.argsort(by / bx, kind="stable")
        mid = (np.cumsum(w[order]) - w[order] / 2) / w.sum()
        assert out[g].ratio == pytest.approx(np.interp(0.5, mid, (by / bx)[order])) and out[g].k == len(bx)


def test_tails(spark):
    assert incomplete_beta(2.0, 3.0, 0.4) == pytest.approx(0.5248, rel=1e-12)
    assert upper_gamma(0.5, 1.920729410347062) == pytest.approx(0.05, rel=1e-9)
    df = spark.createDataFrame([(1.959963984540054, 10.0), (None, 1.0)], "z double, df double")
    r = df.select(normal_two_sided("z").alias("n"), t_two_sided(F.lit(2.228138852), "df").alias("t"), chi2_upper(F.lit(18.307038053275146), "df").alias("c")).collect()
    assert r[0].n == pytest.approx(0.05, rel=1e-9) and r[1].n is None
    assert r[0].t == pytest.approx(0.05, rel=1e-6) and r[0].c == pytest.approx(0.05, rel=1e-9)
    z = spark.range(1).select(z_of_p(F.lit(0.05)).alias("z")).first().z
    assert math.isclose(z, 1.959964, abs_tol=5e-4)
