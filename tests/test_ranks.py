import random

import pytest

from lociflow.operators.ranks import average_ranks, benjamini_hochberg, order_statistics, rank_sum_test, with_fdr


def _rows(n=3000):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}", rng.choice([0.0, 1e-300, 0.02, rng.random(), round(rng.random(), 2)])) for _ in range(n)]
    return rows + [("hot", None), ("g1", float("nan")), (None, 0.5), ("g1", 1.5), ("only", 0.3)]


def _bh(ps):
    m, out, low = len(ps), {}, 1.0
    for rank, p in sorted(enumerate(sorted(ps), 1), reverse=True):
        low = min(low, p * m / rank)
        out[p] = min(low, out.get(p, 1.0))
    return out


def test_fdr_of_hot_groups_and_ties(spark):
    rows = _rows()
    found = {(r.g, r.p): r.q for r in benjamini_hochberg(spark.createDataFrame(rows, "g string, p double"), ["g"], "p").collect()}
    want = {}
    for g in {g for g, _ in rows if g}:
        ps = [p for h, p in rows if h == g and p is not None and 0 <= p <= 1]
        want |= {(g, p): q for p, q in _bh(ps).items()}
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k], rel=1e-12, abs=1e-300) for k in want)


def test_fdr_keeps_every_row(spark):
    df = spark.createDataFrame(_rows(), "g string, p double")
    out = with_fdr(df, ["g"], "p")
    assert out.count() == df.count()
    assert out.where("p is null or p > 1 or isnan(p) or g is null").where("q is not null").count() == 0


def test_average_ranks_and_quantiles(spark):
    rows = [("a", v) for v in (3.0, 1.0, 1.0, 2.0)] + [("b", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert {(r.g, r.v): r["rank"] for r in average_ranks(df, ["g"], "v").collect()} == {("a", 1.0): 1.5, ("a", 2.0): 3.0, ("a", 3.0): 4.0, ("b", 7.0): 1.0}
    assert {r.g: r.v for r in order_statistics(df, ["g"], "v", 0.5).collect()} == {"a": 1.5, "b": 7.0}


def test_empty(spark):
    df = spark.createDataFrame([], "g string, p double")
    assert benjamini_hochberg(df, ["g"], "p").count() == 0
    assert order_statistics(df, ["g"], "p", 0.5).count() == 0
    members = spark.createDataFrame([], "s string, g string")
    assert rank_sum_test(df, members, "g", "p", "s").count() == 0


def test_rank_sum_counts_pairs(spark):
    scores = {f"i{k}": float(k % 7) for k in range(40)}
    members = {"low": ["i0", "i7", "i1"], "one": ["i3"], "high": ["i6", "i13", "i5", "i5"]}
    s = spark.createDataFrame(list(scores.items()), "item string, score double")
    m = spark.createDataFrame([(g, i) for g, items in members.items() for i in items] + [("none", "zz")], "g string, item string")
    found = {r.g: r for r in rank_sum_test(s, m, "item", "score", "g").collect()}
    assert "none" not in found and found["one"].auc == 0.5
    for g in ("low", "high"):
        inside = set(members[g])
        u = sum((scores[a] > scores[b]) + 0.5 * (scores[a] == scores[b]) for a in inside for b in scores if b not in inside)
        assert found[g].u == pytest.approx(u) and found[g].auc == pytest.approx(u / (len(inside) * (40 - len(inside))))


def test_rank_sum_of_more_items_than_an_int_can_square(spark):
    n = 50_000
    s = spark.range(n).selectExpr("id AS item", "CAST(id % 7 AS DOUBLE) AS score")
    m = spark.range(0, n, 5).where("id % 7 < 5").selectExpr("'g' AS g", "id AS item")
    found = rank_sum_test(s, m, "item", "score", "g").first()
    counts, inside = [sum(i % 7 == v for i in range(n)) for v in range(7)], [i for i in range(0, n, 5) if i % 7 < 5]
    ranks = [sum(counts[:v]) + (counts[v] + 1) / 2 for v in range(7)]
    n1, n2 = len(inside), n - len(inside)
    u = sum(ranks[i % 7] for i in inside) - n1 * (n1 + 1) / 2
    sd = (n1 * n2 / 12 * (n + 1 - sum(c**3 - c for c in counts) / (n * (n - 1)))) ** 0.5
    assert (found.n_in, found.n_out) == (n1, n2) and found.u == pytest.approx(u)
    assert found.auc == pytest.approx(u / (n1 * n2)) and found.z == pytest.approx((u - n1 * n2 / 2 - 0.5) / sd)
