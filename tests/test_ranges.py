import random

from lociflow.operators.ranges import collapse_loci, range_join


def test_range_join_as_nested_loops(spark):
    rng = random.Random(2)
    points = [(rng.randrange(3), rng.randrange(-500, 5000), i) for i in range(400)] + [(1, None, 999), (None, 5, 998)]
    spans = [(rng.randrange(3), a, a + rng.choice([0, 3, 90, 1500]), j) for j, a in enumerate(rng.randrange(-400, 4500) for _ in range(60))] + [(1, 10, 5, 900), (2, None, 7, 901)]
    got = range_join(spark.createDataFrame(points, "k int, x long, i int"), spark.createDataFrame(spans, "k int, lo long, hi long, j int"), "k", "x", "lo", "hi", 100)
    want = sorted((i, j) for k, x, i in points for g, lo, hi, j in spans if None not in (k, x, lo) and k == g and lo <= x <= hi)
    assert sorted((r.i, r.j) for r in got.collect()) == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_loci_as_one_scan(spark):
    rng = random.Random(4)
    hits = [(rng.choice("ab"), rng.randrange(2), rng.randrange(20000), rng.choice([1e-9, 1e-12, rng.random() * 1e-8]), f"v{i}") for i in range(500)]
    got = collapse_loci(spark.createDataFrame([*hits, ("a", 1, None, 1e-9, "n"), ("a", 1, 5, None, "m")], "g string, c int, pos long, p double, name string"), "g", "c", "pos", "p", 60, "name")
    want = []
    for key in sorted({h[:2] for h in hits}):
        best: dict = {}
        for *_, pos, p, name in (h for h in hits if h[:2] == key):
            best[pos] = min(best.get(pos, (9, "")), (p, name))
        lead = None
        for pos, (p, name) in sorted(best.items()):
            if lead is None or pos - lead[1] > 60:
                lead = [pos, pos, p, name, 1]
                want.append((*key, lead))
            else:
                lead[4] += 1
                if p < lead[2]:
                    lead[1:4] = [pos, p, name]
    assert sorted((r.g, r.c, r.locus_start, r.lead_position, r.lead_p, r.lead_label, r.n_positions) for r in got.collect()) == sorted((g, c, *lead) for g, c, lead in want)
