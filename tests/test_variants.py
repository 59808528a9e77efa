"""Whole-job variant queries, without SQL, against brute force on small fixtures."""

import math
import random

import numpy as np
import pytest

from lociflow.operators.estimators import mendelian_estimates
from lociflow.plans import causal, variants
from tests.conftest import against_sql

COLUMNS = "row_id long, study_id string, snp string, chr int, pos long, a1 string, a2 string, beta double, se double, p double, maf double, info double, n long, n_cas long, n_con long"
FLIP = str.maketrans("ACGT", "TGCA")


def _folder(spark, path, rows) -> str:
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/gwas_variants.parquet")
    studies = [("GS00001", None, None, "EAF"), ("GS00002", None, None, "EAF"), ("GS00003", None, None, "MAF")]
    spark.createDataFrame(studies, "study_id string, n_cases long, n_controls long, frequency_column_is string").write.parquet(f"{path}/gwas_studies.parquet")
    return str(path)


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    """Two studies and the outcome: 40 variants in 2 regions, spelt in all orientations; (folder, truth of each variant).

    A variant's truth is (number, palindrome kept in GS00002 or None, region, study -> (effect of the first allele, se, row)).
    """
    rng, rows, truth = random.Random(7), [], []
    for v in range(40):
        a1, a2 = rng.choice([("A", "C"), ("A", "G"), ("C", "T"), ("A", "T")])
        pos, names = 1_000_000 * (1 + v % 2) + 10 * v, [f"rs{v}", f"RS{v}_x", f"rs{v}"]
        if v % 5 == 0:
            names[1] = None  # by place only
        kept, eaf = {}, rng.choice([0.2, 0.45, 0.8])
        other = rng.choice([0.25, 0.7])
        for s, study in enumerate(("GS00001", "GS00002", "GS00003")):
            beta, se = rng.gauss(0, 0.3), rng.uniform(0.02, 0.1)
            kept[study] = (beta, se, len(rows))
            flipped = s > 0 and v % 3 == 0
            x, y = (a2, a1) if flipped else (a1, a2)
            if v % 4 == 1 and s and (a1, a2) != ("A", "T"):
                x, y = x.translate(FLIP), y.translate(FLIP)
            f = eaf if s == 0 else other
            rows.append((len(rows), study, names[s], 1, pos + (s == 2), x, y, -beta if flipped else beta, se, 0.01, 1 - f if flipped else f, 1.0, 1000 + s, None, None))
        told = None if (a1, a2) != ("A", "T") else eaf != 0.45 and (eaf < 0.5) == (other < 0.5)
        truth.append((v, told, 1 + v % 2, kept))
    rows.append((len(rows), "GS00002", "rs1", 1, 5_000_000, "AAA", "G", 9.0, 0.1, 0.5, 0.2, 1.0, 1000, None, None))  # other alleles
    rows.append((len(rows), "GS00002", "rs2", 1, 2, *rows[2 * 3 + 1][5:7], 9.0, 0.1, 0.5, 0.2, 1.0, 1000, None, None))  # a repeat
    rows.append((len(rows), "GS00002", "rs999", 1, 7_000_000, "A", "G", 9.0, 0.1, 0.5, 0.2, 1.0, 1000, None, None))  # not in the outcome
    return _folder(spark, tmp_path_factory.mktemp("shared"), rows), truth


def _expected(truth):
    """(study, effect, se, row, outcome's effect, se, row, region) of every pair that must come out."""
    for _, told, region, kept in truth:
        for s in ("GS00002", "GS00003"):
            if told is None or (told and s == "GS00002"):  # GS00003 doesn't say whose frequency it gives
                yield (s, *kept[s], *kept["GS00001"], region)


def test_every_shared_variant_is_paired(spark, shared):
    folder, truth = shared
    want = list(_expected(truth))
    assert any(told for _, told, *_ in truth) and any(told is False for _, told, *_ in truth)
    got = {(r.study_id, r.row_id): r for r in causal.shared_variants(spark, folder).collect()}
    assert got.keys() == {(w[0], w[3]) for w in want}
    for s, beta, _, row, o_beta, _, o_row, _ in want:
        r = got[s, row]
        assert r.o_row_id == o_row and abs(r.beta) == pytest.approx(abs(beta)) and r.o_beta / r.beta == pytest.approx(o_beta / beta)
    assert {r.how for r in got.values()} == {"direct", "flipped", "complement", "complement_flipped"}


def test_variant_estimates(spark, shared):
    folder, truth = shared
    want = list(_expected(truth))
    strong = [(w[0], w[1], w[2], w[4], w[5]) for w in want if (w[1] / w[2]) ** 2 >= 4]
    estimates = {r[0]: r for r in mendelian_estimates(spark.createDataFrame(strong, "s string, bx double, sx double, by double, sy double"), "s", "bx", "sx", "by", "sy").collect()}
    got = {r.study_id: r for r in causal.v_mendelian(spark, folder).collect()}
    assert got.keys() == estimates.keys() and all(list(got[s])[1:12] == pytest.approx(list(estimates[s])[1:], abs=2e-5) for s in got)
    for s, r in got.items():
        e = estimates[s]
        assert r.wald_p == pytest.approx(math.erfc(abs(e.wald / e.wald_se) / math.sqrt(2)), abs=2e-5) and r.ivw_re_p == pytest.approx(math.erfc(abs(e.ivw / e.ivw_re_se) / math.sqrt(2)), abs=2e-5)
    coloc = {(r.study_id, r.mb): r for r in causal.v_coloc(spark, folder).collect()}
    labf = lambda b, s: math.sqrt(1 - 0.04 / (0.04 + s * s)) * math.exp(0.5 * 0.04 / (0.04 + s * s) * b * b / (s * s))
    assert coloc.keys() == {(w[0], w[7]) for w in want}
    for (s, mb), r in coloc.items():
        here = [w for w in want if w[0] == s and w[7] == mb]
        one, two = np.array([labf(w[1], w[2]) for w in here]), np.array([labf(w[4], w[5]) for w in here])
        h = np.array([1, 1e-4 * one.sum(), 1e-4 * two.sum(), 1e-8 * (one.sum() * two.sum() - (one * two).sum()), 1e-5 * (one * two).sum()])
        assert r.n_snps == len(here) and [r[f"h{i}"] for i in range(5)] == pytest.approx(list(h / h.sum()), abs=2e-6)
    assert causal.v_steiger(spark, folder).count() == len(want)


@pytest.mark.parametrize("name", sorted(causal.SQL))
def test_shared_variants_same_as_sql(spark, shared, name):
    got, want = against_sql(spark, causal.QUERIES[name], causal.SQL[name], shared[0])
    assert got == want and len(got) > 0


def test_quantiles_and_fdr_of_every_value(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), None, 1, i, "A", "C", 0.1, 0.1, rng.choice([1.0, 0.5, 1e-9, rng.random()]), 0.2, 1.0, 10, None, None) for i in range(200)]
    folder, got = _folder(spark, tmp_path, rows), {}
    for r in variants.v_quantiles(spark, folder).collect():
        got[r.study_id, r.p] = (r.observed, r.expected)
    want = {}
    for s in "ab":
        ps = sorted(r[9] for r in rows if r[1] == s)
        for p in set(ps):
            ranks = [i for i, x in enumerate(ps, 1) if x == p]
            want[s, p] = (-math.log10(p), -math.log10((sum(ranks) / len(ranks) - 0.5) / len(ps)))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)
    ps = sorted(r[9] for r in rows)
    q = {r.p: (r["rank"], r.q) for r in variants.v_fdr_all(spark, folder).collect()}
    assert q.keys() == set(ps)
    for p in ps:
        assert q[p] == (sum(x <= p for x in ps), pytest.approx(min(1.0, *(x * len(ps) / sum(y <= x for y in ps) for x in ps if x >= p)), abs=2e-9))


def test_windows_and_links_of_every_hit(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), None, rng.choice([1, 2]), rng.choice([700_000, rng.randrange(30_000_000)]), "A", "C", 0.1, 0.1, rng.choice([0.4, 1e-8, 1e-25, 1e-40]), 0.2, 1.0, 10, None, None) for i in range(150)]
    folder = _folder(spark, tmp_path, rows)
    hits = [r for r in rows if r[9] < 5e-8]
    want = {}
    for h in hits:
        near = [r for r in rows if r[3] == h[3] and abs(r[4] - h[4]) <= 500_000]
        want[h[0]] = (len(near), min(r[9] for r in near), min(r[4] for r in near))
    assert {r.lead: (r.n_near, r.best_p, r.first_pos) for r in variants.v_windows(spark, folder).collect()} == want
    cluster = {h[0]: h[0] for h in hits}
    for _ in hits:
        for a in hits:
            cluster[a[0]] = min(cluster[b[0]] for b in hits if b[3] == a[3] and abs(b[4] - a[4]) <= 500_000)
    assert {r.row_id: r.component for r in variants.v_linked_leads(spark, folder).collect()} == cluster
