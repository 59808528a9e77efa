import random

from lociflow.llm.matching import drug_segments, match_drugs, near_segments, rule_report
from pyspark.sql import functions as F

DRUG = "drug_id long, drug_name string, drug_chembl_id string, drug_inchikey string, drug_pubchem_cid string, mol_weight double, synonyms array<string>, extra string"
COMPOUND = "compound_id long, drug_name string, drug_chembl_id string, drug_inchikey string, drug_pubchem_cid string, mol_weight double, extra string"
KEY = ["AAAAAAAAAAAAAA-BBBBBBBBBB-N", "CCCCCCCCCCCCCC-BBBBBBBBBB-N", "DDDDDDDDDDDDDD-BBBBBBBBBB-N"]


def _match(spark, drugs, compounds):
    out = match_drugs(spark.createDataFrame([(*d, None) for d in drugs], DRUG), spark.createDataFrame([(*c, None) for c in compounds], COMPOUND))
    return {r.compound_id: (r.drug_id, r.rule, r.confidence) for r in out.collect()}


def test_cascade(spark):
    drugs = [(1, "Flarotinib", "CHEMBL1", KEY[0], "1001", 300.5, ["AB-12"]), (2, "Flarotinab", "CHEMBL2", KEY[1], "2002", 410.2, None), (3, "Sevomide", "CHEMBL3", None, "3003", 222.2, [None]), (4, None, None, None, None, None, None)]
    compounds = [
        (10, "code-77", None, KEY[0].lower(), None, None), (11, "FLAROTINIB hydrochloride", None, None, None, 336.96), (12, "AB 12", None, None, None, None), (13, "sevomlde", "placeholder", None, "CID 3,003", 222.2),
        (14, "Flarotinab", "CHEMBL_X", None, None, 410.2), (15, "unknown thing", None, None, None, 300.5), (16, None, None, None, None, None), (17, "sevomide", None, None, None, None), (18, "x" * 100_000, None, None, None, None), (19, "", None, "", "", 222.2),
    ]
    out = _match(spark, drugs, compounds)
    assert {k: v[0] for k, v in out.items()} == {10: 1, 11: 1, 12: 1, 13: 3, 14: 2, 17: 3}
    assert all(0 < v[2] <= 1 for v in out.values()) and out[10][1] == "inchikey" and out[12][1] == "synonym"


def test_near_names(spark):
    drugs = [(i, f"{stem}tinib", f"CHEMBL{i}", None, str(9000 + i), 200.0 + 7 * i, None) for i, stem in enumerate(["Bolaru", "Cisevo", "Dumaxi", "Fegolu"])]
    compounds = [(100 + i, name, None, None, None, 200.0 + 7 * i) for i, name in enumerate(["Bolarrutinib", "Ciseovtinib", "Dumaxitinb", "Fegolutinib"])]
    assert {k: v[0] for k, v in _match(spark, drugs, compounds).items()} == {100: 0, 101: 1, 102: 2, 103: 3}


def test_empty(spark):
    assert _match(spark, [], []) == {} and _match(spark, [(1, "a", None, None, None, None, None)], []) == {}


def test_names_of_two_edits_share_a_third(spark):
    rng = random.Random(4)
    rows = [("abcdef", "abdfeg"), ("kitten", "kiten"), ("same", "same"), ("ab", "ba"), ("a", "abc")]
    for _ in range(400):
        word = [rng.choice("abc") for _ in range(rng.randrange(1, 14))]
        other = list(word)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(other) + 1)
            other[at : at + rng.randrange(2)] = [rng.choice("abcx")] * rng.randrange(2)
        rows.append(("".join(word), "".join(other) or "a"))
    df = spark.createDataFrame(rows, "a string, b string")
    met = df.select(F.levenshtein("a", "b").alias("d"), F.arrays_overlap(near_segments(F.col("a")), drug_segments(F.col("b"))).alias("met"))
    assert all(r.met for r in met.collect() if r.d <= 2)


def test_long_names_and_report(spark):
    stem = "pentacyclo" * 12
    drugs = [(1, f"{stem}mab", "CHEMBL1", None, "1001", 900.5, None), (2, "Sevomide", "CHEMBL2", KEY[0], "2002", 222.2, None)]
    compounds = [(10, f"{stem}maab", None, None, None, 900.5), (11, "Sevomide", None, KEY[0], None, 222.2)]
    assert {k: v[0] for k, v in _match(spark, drugs, compounds).items()} == {10: 1, 11: 2}
    report = {r.rule: r for r in rule_report(spark.createDataFrame([(*d, None) for d in drugs], DRUG), spark.createDataFrame([(*c, None) for c in compounds], COMPOUND)).collect()}
    assert {r: (x.found, x.returned) for r, x in report.items()} == {"near_name_and_mass": (1, 1), "inchikey": (1, 1)}
