import datetime
import random

from lociflow.llm.fusion import fused_records, retained_values, source_quality, survivors
from lociflow.llm.queries import QUERIES, SQL
from tests.conftest import against_sql

FIELDS = "record_id long, drug_chembl_id string, gene_symbol string, confidence string, source string, pchembl_value double, mechanism_of_action string, updated_at timestamp, clash string"
SOURCES = [("chembl", "t", 1), ("pdsp", "t", 2), ("bad", "x", 3), (None, None, None)]


def _day(n):
    return datetime.datetime(2024, 1, n)


def _frames(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], FIELDS), spark.createDataFrame(SOURCES, "source string, family string, trust_rank int")


def test_precedence(spark):
    rows = [
        (5, " chembl1 ", "g1", "LOW", "chembl", 5.0, "TBD", _day(3)), (6, "CHEMBL1", "G1", "Hi", "PDSP , chembl", float("nan"), " ", None), (7, "CHEMBL1", "G1", "high", "pdsp", 16.0, "Inhibitor", _day(9)),
        (8, "CHEMBL1", "G1", "?", None, 7.0, None, _day(1)), (9, "CHEMBL1", "G1", "low", "chembl", 5.5, "blocker", _day(4)), (10, "CHEMBL2", "G1", "high", "chembl", 5.0, "x", _day(1)), (11, None, "G1", "high", "chembl", 5.0, "x", None), (12, None, "G1", "high", "chembl", 5.0, "x", None),
    ]
    records, sources = _frames(spark, rows)
    out = {(r.group_id, r.field): r.record_id for r in survivors(records, sources).collect()}
    assert out == {(5, "confidence"): 6, (5, "source"): 6, (5, "pchembl_value"): 9, (5, "mechanism_of_action"): 7}
    wide = fused_records(records, sources).collect()
    assert len(wide) == 1 and wide[0].pchembl_value_from == 9 and wide[0].mechanism_of_action == "Inhibitor"


def test_model_finds_the_bad_source(spark):
    rows, n = [], 0
    for g in range(40):
        for source in ("chembl", "pdsp", "bad"):
            n += 1
            rows.append((n, f"CHEMBL{g}", "G", "high", source, 6.0 if source != "bad" else 3.0 + g / 10, f"true {g}" if source != "bad" else f"wrong {g}", None))
    records, sources = _frames(spark, rows)
    quality = {(r.field, r.source): r for r in source_quality(records, sources).collect()}
    assert quality["mechanism_of_action", "bad"].sensitivity < quality["mechanism_of_action", "chembl"].sensitivity
    kept = [r.value for r in retained_values(records, sources).where("field = 'mechanism_of_action'").collect()]
    assert len(kept) == 40 and all(v.startswith("true") for v in kept)


def test_empty(spark):
    records, sources = _frames(spark, [])
    assert survivors(records, sources).count() == 0 and retained_values(records, sources).count() == 0 and source_quality(records, sources).count() == 0


def test_queries_with_sql(spark):
    for name, sql in SQL.items():
        got, want = against_sql(spark, QUERIES[name], sql)
        assert got == want, name


def test_recovers_planted_quality(spark):
    """Sources that report a true value with a known chance, and a false one with another: both come back, and so do the true values."""
    rng = random.Random(5)
    planted = {"chembl": (0.9, 0.97), "pdsp": (0.7, 0.95), "bad": (0.4, 0.6)}
    rows, truth, wrong, n = [], {}, {}, 0
    for g in range(600):
        values = {f"true {g}"} | ({f"also {g}"} if g % 3 == 0 else set())
        lies = {f"false {g} {i}" for i in range(3)}
        truth[g], wrong[g] = values, lies
        for source, (sensitivity, specificity) in planted.items():
            told = {v for v in values if rng.random() < sensitivity} | {v for v in lies if rng.random() > specificity}
            for v in sorted(told):
                n += 1
                rows.append((n, f"CHEMBL{g}", "G", "high", source, None, v, None))
    records, sources = _frames(spark, rows)
    quality = {r.source: r for r in source_quality(records, sources).where("field = 'mechanism_of_action'").collect()}
    claimed = {r[6] for r in rows}
    for source, (sensitivity, specificity) in planted.items():
        assert abs(quality[source].sensitivity - sensitivity) < 0.12, (source, quality[source])
        lies = [v for g in wrong for v in wrong[g] if v in claimed]
        told = {(r[6]) for r in rows if r[4] == source}
        actual = 1 - sum(v in told for v in lies) / len(lies)  # of the false values that anyone claims
        assert abs(quality[source].specificity - actual) < 0.15, (source, quality[source], actual)
    kept = {r.value for r in retained_values(records, sources).where("field = 'mechanism_of_action'").collect()}
    groups = {r[1] for r in rows if sum(x[1] == r[1] for x in rows) > 1}
    true = {v for g, values in truth.items() if f"CHEMBL{g}" in groups for v in values if v in claimed}
    precision, recall = len(kept & true) / len(kept), len(kept & true) / len(true)
    print(f"kept values: precision {precision:.3f}, recall {recall:.3f}", {s: (round(q.sensitivity, 3), round(q.specificity, 3)) for s, q in quality.items()})
    claimed_precision = len(true) / len(claimed)
    print(f"all claimed values: precision {claimed_precision:.3f}")
    assert precision > max(0.8, claimed_precision) and recall > 0.9
