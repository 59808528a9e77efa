import numpy as np
import pytest

from lociflow.operators.components import connected_components
from lociflow.operators.enrichment import class_regression, permutation_test
from lociflow.plans import drugs
from lociflow.schemas import conform, problems


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, 5), (5, 9), (9, 1), (7, 7), (None, 3), (140, 50)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == {i: 50 for i in [50, *range(100, 141)]} | {1: 1, 5: 1, 9: 1, 7: 7}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_permutation(spark):
    scores = spark.createDataFrame([(f"g{i:02d}", float(i)) for i in range(30)] + [("x", None)], "g string, s double")
    members = spark.createDataFrame([("top", f"g{i}") for i in (27, 28, 29)] + [("low", f"g0{i}") for i in range(3)] + [("top", "x"), ("none", "zz")], "d string, g string")
    out = {r.d: r for r in permutation_test(scores, members, "g", "s", "d", draws=300).collect()}
    assert set(out) == {"top", "low"} and out["top"].p < 0.02 and out["low"].p == 1.0
    rng = np.random.default_rng([42, 3])
    null = [np.arange(30.0)[rng.choice(30, 3, replace=False)].mean() for _ in range(300)]
    assert out["top"].p == pytest.approx((sum(m >= 28 for m in null) + 1) / 301)


def test_registered_permutation_and_classes(spark, tmp_path):
    columns = "drug_chembl_id string, gene_symbol string, pchembl_value double, atc_codes array<string>"
    rows = [(f"D{d}", f"G{(7 * d + g) % 60}", 1.0 + (7 * d + g) % 60 / 6, [["N02BA01", "N02BE01", "C10AA05"][d % 3] if d < 18 else "A01"]) for d in range(30) for g in range(2 + d % 5)]
    rows += [("TOP", f"G{g}", 1.0 + g / 6, None) for g in range(51, 60)]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/drug_targets.parquet")
    p = {r.drug: r.p for r in drugs.d_permutation(spark, str(tmp_path)).collect()}
    assert len(p) == 31 and p["TOP"] < 1 / 201
    classes = {r["class"]: r.n_members for r in drugs.d_class_regression(spark, str(tmp_path)).collect()}
    assert classes == {"A": 12, "A01": 12, "N": 12, "N02": 12, "N02B": 12, "N02BA": 6, "N02BE": 6, "C": 6, "C10": 6, "C10A": 6, "C10AA": 6}


def test_class_regression(spark):
    rng = np.random.default_rng(0)
    n = rng.integers(1, 40, 60)
    member = rng.random(60) < 0.3
    y = 0.5 + 0.8 * member + 0.02 * n + rng.normal(0, 0.3, 60)
    items = spark.createDataFrame([(f"d{i}", float(a), int(b)) for i, (a, b) in enumerate(zip(y, n, strict=True))] + [("bad", None, 3)], "d string, y double, n int")
    members = spark.createDataFrame([(f"d{i}", "N") for i in np.flatnonzero(member)] + [(f"d{i}", "ALL") for i in range(60)] + [("d1", "ONE")], "d string, c string")
    out = {r.c: r for r in class_regression(items, members, "d", "y", "n", "c").collect()}
    x = np.c_[np.ones(60), member, n, np.log(n)]
    fit, rest, *_ = np.linalg.lstsq(x, y, rcond=None)
    se = np.sqrt(rest[0] / 56 * np.linalg.inv(x.T @ x)[1, 1])
    assert out["N"].beta == pytest.approx(fit[1]) and out["N"].se == pytest.approx(se)
    assert out["ALL"].beta is None and "ONE" not in out


def test_schemas(spark):
    df = spark.createDataFrame([("rs1", "x", 1.5)], "SNP string, CHR string, N double")
    assert "BETA is missing" in problems(df, "variants") and "CHR is string, not int" in problems(df, "variants")
    fixed = conform(df, "variants")
    assert problems(fixed, "variants") == [] and fixed.first().CHR is None and fixed.first().N == 1
