import numpy as np
import pytest

from lociflow.llm.percentiles import merge_states, percentiles, value_state
from lociflow.llm.queries import QUERIES


def test_exact_with_hot_group_ties_and_dirt(spark):
    rng = np.random.default_rng(7)
    rows = [("hot" if i % 3 else f"g{i % 5}", float(v), i % 4) for i, v in enumerate(np.round(rng.random(4000) ** 6, 3))] + [("hot", None, 0), ("hot", float("nan"), 1), ("hot", 1.5, 1), ("hot", -0.1, 1), ("dirty", None, 0), (None, 0.25, 0)]
    df = spark.createDataFrame(rows, "g string, p double, day int")
    found = {(r.grp, r.q): (r.n, r.value) for r in percentiles(value_state(df, "g", "p"), (0.0, 0.1, 0.5, 0.99, 1.0)).collect()}
    groups: dict = {}
    for g, p, _ in rows:
        if p is not None and 0 <= p <= 1:
            groups.setdefault(g, []).append(p)
    assert {g for g, _ in found} == set(groups)
    for (g, q), (n, value) in found.items():
        assert n == len(groups[g]) and value == pytest.approx(np.quantile(groups[g], q), rel=1e-12, abs=1e-15)


def test_days_combine(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 as string) g", "(id * 37 % 101) / 101 p", "cast(id % 7 as int) day")
    days = [value_state(df.where(f"day = {i}"), "g", "p") for i in range(7)]
    whole = {(r.grp, r.q): r.value for r in percentiles(value_state(df, "g", "p")).collect()}
    assert {(r.grp, r.q): r.value for r in percentiles(merge_states(*days)).collect()} == whole


def test_empty(spark):
    assert percentiles(value_state(spark.createDataFrame([], "g string, p double"), "g", "p")).count() == 0


def test_null_day_is_its_own_group(spark, tmp_path):
    rows = [("a", None, p / 10) for p in range(3)] + [("a", "2024-01-01", p / 10) for p in range(5, 10)] + [(None, None, 0.4)]
    spark.createDataFrame(rows, "study_id string, batch_date string, p double").selectExpr("study_id", "date(batch_date) batch_date", "p").write.parquet(f"{tmp_path}/gwas_variants.parquet")
    got = sorted((str(r.study_id), str(r.batch_date), r.n, r.p_value) for r in QUERIES["p5_percentiles"](spark, str(tmp_path)).where("q = 0.5").collect())
    assert got == [("None", "None", 1, 0.4), ("None", "None", 1, 0.4), ("a", "2024-01-01", 5, 0.7), ("a", "None", 3, 0.1), ("a", "None", 8, 0.55)]
