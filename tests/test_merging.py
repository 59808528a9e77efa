from pyspark.sql import functions as F

from lociflow.functions.identifiers import atc_level, chembl_id, json_or_text_list, plain_name, pubchem_cid, rsid, text_list
from lociflow.operators.merging import class_members, identical_sets, item_sets, keep_first, membership_patterns, richest_record, tiered_match


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), (None, 3, "n"), (None, 4, "m")], "k string, i int, v string")
    assert {tuple(r) for r in keep_first(df, ["k"], [F.col("i")]).collect()} == {("a", 1, None), (None, 3, "n")}


def test_richest_record(spark):
    rows = [(1, "k", None, 5, ["p"], "B, a"), (2, "k", "m", None, [], None), (3, "k", "z", 7, None, "a"), (4, "e", None, None, None, None)]
    out = {r.k: r for r in richest_record(spark.createDataFrame(rows, "id long, k string, m string, n int, l array<string>, source string"), ["k"], "id", ["m", "n"], ["l"], "source").collect()}
    k = out["k"]
    assert (k.kept, k.n_records, k.source, k.m, k.n, k.l) == (1, 3, "a,b", "m", 5, ["p"])
    assert (out["e"].m, out["e"].n, out["e"].l, out["e"].source) == (None, None, [], "")


def test_sets_and_classes(spark):
    pairs = spark.createDataFrame([("d1", "g2"), ("d1", "g1"), ("d1", "g1"), ("d2", "g1"), ("d2", "g2"), ("d3", None), (None, "g1")], "d string, g string")
    sets = item_sets(pairs, "d", "g")
    assert {r.d: r.items for r in sets.collect()} == {"d1": ["g1", "g2"], "d2": ["g1", "g2"]}
    assert [tuple(r)[:3] for r in identical_sets(sets, "d", [F.lit(0)]).collect()] == [("d1", 2, 2)]
    codes = spark.createDataFrame([(1, ["N05AB", "n05"]), (2, ["N05A"]), (3, None), (4, [None, " "])], "i long, codes array<string>")
    assert {(r.code, r.n_items) for r in class_members(codes, "i", "codes", (1, 3, 4, 5), 2).collect()} == {("N", 2), ("N05", 2), ("N05A", 2)}


def test_tiers_and_patterns(spark):
    left = spark.createDataFrame([(1, "x", "n1"), (2, None, "n2"), (3, "dup", "n3"), (4, None, None)], "l long, key string, name string")
    right = spark.createDataFrame([(10, "x", "n9"), (11, "dup", "n2"), (12, "dup", "n3")], "r long, key string, name string")
    assert {tuple(r) for r in tiered_match(left, right, "l", "r", [("key", "key"), ("name", "name")]).collect()} == {(1, 10, "key"), (2, 11, "name"), (3, 12, "name")}
    a, b = spark.createDataFrame([("p",), ("q",), ("q",)], "k string"), spark.createDataFrame([("q",), (None,)], "k string")
    assert {tuple(r) for r in membership_patterns({"a": a, "b": b}, "k").collect()} == {(1, 0, 1, 1), (1, 1, 1, 2)}


def test_identifiers(spark):
    df = spark.createDataFrame([("RS12:1:A", "x chembl77", "CID 21,0.0", "A-b c", "a | |b", '["p","q"]', "N05AB"), (None,) * 7], "a string, b string, c string, d string, e string, f string, g string")
    r, n = df.select(rsid(F.col("a")), chembl_id(F.col("b")), pubchem_cid(F.col("c")), plain_name(F.col("d")), text_list(F.col("e")), json_or_text_list(F.col("f")), atc_level(F.col("g"))).collect()
    assert tuple(r) == ("rs12", "CHEMBL77", "210", "abc", ["a", "b"], ["p", "q"], 4)
    assert tuple(n) == (None, None, None, None, None, None, 0)
