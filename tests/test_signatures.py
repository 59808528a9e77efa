from itertools import permutations

import pytest

from lociflow.operators.profiles import extreme_sum_p
from lociflow.plans.signatures import s_label_pivot


def test_pivot_has_all_items(spark, tmp_path):
    rows = [(i, "ab"[i % 2], [float(i * k) for k in range(64)]) for i in range(6)]
    spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.label: r for r in s_label_pivot(spark, str(tmp_path)).collect()}
    assert set(got) == {"a", "b"}
    for k in range(64):
        assert (got["a"][f"item_{k}"], got["b"][f"item_{k}"]) == (pytest.approx(2 * k), pytest.approx(3 * k))


def test_extreme_sum_p_against_all_permutations(spark):
    ours = {"x": [3.0, -1.0, 0.5, 2.0, -2.5, 1.0], "y": [1.0, 1.0, 1.0, 1.0, 1.0, 1.0]}
    theirs = {1: [9.0, -8.0, 7.0, 0.1, 0.2, 0.3], 2: [-9.0, -8.0, -7.0, 0.1, 0.2, 0.3], 3: [1.0, 2.0], 4: [9.0, -8.0, 7.0, 0.1, 0.2, 0.3]}
    frame = lambda named, kind, key: spark.createDataFrame([(k, i, v) for k, vs in named.items() for i, v in enumerate(vs)], f"{key} {kind}, item int, value double")
    found = {(r.label, r.vec): r for r in extreme_sum_p(frame(ours, "string", "label"), frame(theirs, "long", "vec"), "label", "vec", 3, draws=4000).collect()}
    assert set(found) == {(label, vec) for label in "xy" for vec in (1, 2, 4)}
    for (label, vec), row in found.items():
        signs = [1 if v > 0 else -1 for v in theirs[vec][:3]]
        total = sum(s * v for s, v in zip(signs, ours[label], strict=False))
        null = [sum(s * v for s, v in zip(sorted(signs, reverse=True), p, strict=False)) for p in permutations(ours[label])]
        assert row.xsum == pytest.approx(total)
        assert row.p == pytest.approx(sum(n <= total + 1e-9 for n in null) / len(null), abs=0.04)
