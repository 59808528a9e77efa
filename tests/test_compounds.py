"""Parents by name, placeholder ids, directions and gene ids on small fixtures with nulls, ties and repeats."""

import hashlib

from lociflow.operators.compounds import one_direction, parents_by_name, with_placeholder_id
from lociflow.operators.gene_ids import column_kind, filled_ids, full_records, pair_index, tiered_targets
from lociflow.sources.genomic_text import gene_history, gene_info, interaction_claims, latest_ids, set_results

RECORD = "record_id long, symbol string, ensembl string, uniprot string, entrez string"


def rows_of(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_parents_by_name(spark):
    parents = spark.createDataFrame([(1, "Abc acid"), (2, "Abc"), (3, "Dup"), (4, "dup"), (5, None), (6, "Éon")], "drug_id long, drug_name string")
    names = ["abc acid sodium salt", "ABC hydrate", "a-bc acid", "dup salt", "eon x y", "zzz", "", None, "w " * 5000, "abc acid sodium salt"]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    found = rows_of(parents_by_name(rows, parents, "name", "drug_id", "drug_name"), "name", "drug_id", "n_dropped")
    assert found == {("abc acid sodium salt", 1, 2), ("ABC hydrate", 2, 1), ("a-bc acid", 1, 0), ("eon x y", 6, 2)}
    assert parents_by_name(rows, parents.limit(0), "name", "drug_id", "drug_name").count() == 0
    assert parents_by_name(rows.limit(0), parents, "name", "drug_id", "drug_name").count() == 0


def test_placeholder_ids(spark):
    names = ["(+)-abc", "(-)-abc", "Déf 1", None, "Déf 1"]
    rows = spark.createDataFrame(list(enumerate(names)), "i long, name string")
    found = {r.i: r.out for r in with_placeholder_id(rows, "name", "X_", "i", "out").collect()}
    tail = lambda s: hashlib.md5(s.encode()).hexdigest()[:8]
    assert found == {0: "X_ABC_" + tail("(+)-abc"), 1: "X_ABC_" + tail("(-)-abc"), 2: "X_DEF_1", 3: "X_", 4: "X_DEF_1"}


def test_one_direction(spark):
    claims = [("a", "Inhibitor|blocker"), ("a", "inhibitor"), ("b", "inhibitor|agonist"), ("c", "binder|inhibitor"), ("d", " | "), ("e", None), ("f", "agonist")]
    known = {"inhibitor": "negative", "blocker": "negative", "agonist": "positive"}
    found = one_direction(spark.createDataFrame(claims, "k string, t string"), ["k"], "t", known)
    assert rows_of(found, "k", "n_terms", "direction") == {("a", 2, "negative"), ("b", 2, "none"), ("c", 2, "none"), ("f", 1, "positive")}


def test_full_records(spark):
    rows = spark.createDataFrame(
        [(1, "A", "E1", "U1", "1"), (2, "A", "E9", None, "9"), (3, None, "E2", "U2", "2"), (4, "B", None, None, "2"), (5, "C", None, "U3", None), (6, None, None, None, None)], RECORD
    )
    index = pair_index(rows, "record_id")
    look = lambda kind, *ids: rows_of(full_records(spark.createDataFrame([(i,) for i in ids], "id string"), kind, index), "id", "symbol", "ensembl", "uniprot", "entrez")
    assert look("symbol", "A", "B", "new", None, "A") == {("A", "A", "E1", "U1", "1"), ("B", "B", None, None, "2"), ("new", "new", None, None, None)}
    assert look("ensembl", "E2") == {("E2", "B", "E2", "U2", "2")}
    assert look("uniprot", "U1", "U3") == {("U1", "A", "E1", "U1", "1"), ("U3", None, None, "U3", None)}
    assert look("entrez", "2", "9") == {("2", "B", "E2", "U2", "2"), ("9", "A", "E9", None, "9")}
    filled = rows_of(filled_ids(rows, "symbol", "record_id", index), *rows.columns)
    assert filled == {(1, "A", "E1", "U1", "1"), (2, "A", "E9", "U1", "9"), (3, None, "E2", "U2", "2"), (4, "B", None, None, "2"), (5, "C", None, "U3", None), (6, None, None, None, None)}
    assert full_records(rows.select(rows.symbol.alias("id")).limit(0), "symbol", index).count() == 0


def test_column_kinds(spark):
    rows = spark.createDataFrame([("ENSG01.2", "7", "x", None), ("ENSMUSG02", "8", "9", None), (None, None, None, None)], "a string, b string, c string, d string")
    assert tuple(rows.agg(*[column_kind(rows[c]) for c in "abcd"]).first()) == ("ensembl", "entrez", "mixed", "mixed")


def test_tiered_targets(spark):
    kinds = "symbol string, ensembl string, uniprot string, entrez string"
    genes = spark.createDataFrame([("g1", "A", "E1", "U1", "1"), ("g2", "B", None, "U2", "2"), ("g3", "C", "E3", None, None), ("g4", "D", None, None, None), ("g5", None, None, None, None)], f"gene string, {kinds}")
    targets = [("A", "E1", None, None)] * 3 + [("Z", "E7", "U2", "2"), ("Y", None, "U2", None), ("C", "E8", None, None), ("D", "E4", None, None), ("D", "E5", None, None), (None, None, None, None)]
    found = tiered_targets(genes, spark.createDataFrame(targets, kinds))
    assert rows_of(found, "gene", "tier", "n_rows", "n_keys") == {("g1", "ensembl", 3, 1), ("g2", "uniprot", 1, 1), ("g3", "symbol", 1, 1)}


def test_gene_files(spark, tmp_path):
    w = lambda name, text: str((tmp_path / name).write_text(text) and tmp_path / name)
    info = "#tax_id\tGeneID\n9606\t1\tA\t-\t-\tMIM:2|Ensembl:E1|Ensembl:E0\n9606\t2\t-\t-\t-\t-\n10090\t3\tM\t-\t-\t-\n9606\tx\tB\t-\t-\t-\n9606\t4\n"
    assert rows_of(gene_info(spark, w("i.tsv", info), "9606"), "entrez", "symbol", "ensembl") == {(1, "A", "E1"), (2, None, None)}
    history = gene_history(spark, w("h.tsv", "#x\n9606\t5\t6\n9606\t-\t7\n9606\t4\t5\n1\t1\t2\n9606\ta\t8\n"), "9606")
    assert rows_of(history, "old", "new") == {(6, 5), (5, 4)}
    assert rows_of(latest_ids(history), "old", "current") == {(6, 4), (5, 4)}
    claims = "claim_id\tdrug_name\tdrug_concept_id\tgene_name\tinteraction_type\tpmids\n1\t a \tchembl:CHEMBL5\tG\tinhibitor\t1, ,2\n2\t\"b\t\tG\t\t\n3\t \t\tG\t\t\n4\tc\tCHEMBL1|CHEMBL2\tH\t\t3\n"
    found = {(r.claim_id, r.drug_name, r.drug_chembl_id, tuple(r.pmids or ()), r.confidence) for r in interaction_claims(spark, w("c.tsv", claims)).collect()}
    assert found == {("1", "a", "CHEMBL5", ("1", "2"), "medium"), ("2", '"b', None, (), "low"), ("4", "c", None, ("3",), "medium")}


def test_set_results(spark, tmp_path):
    w = lambda name, text: str((tmp_path / name).write_text(text) and tmp_path / name)
    long = "# MODEL\nVARIABLE TYPE NGENES BETA SE P FULL_NAME\nabc SET 5 0.1 0.2 0.03 abcdef\nabc SET 6 0.1 0.2 0.02 abcdef\nx SET 2 NA 0.1 0.5 NA\nbad SET 2\n"
    columns = ("set_id", "n_genes", "beta", "se", "p")
    assert rows_of(set_results(spark, w("l.out", long)), *columns) == {("abcdef", 6, 0.1, 0.2, 0.02), ("x", 2, None, 0.1, 0.5)}
    short = "VARIABLE NGENES BETA SE P\ny 3 1 2 NA\ny 4 1 2 0.9\n"
    assert rows_of(set_results(spark, w("s.out", short)), *columns) == {("y", 4, 1.0, 2.0, 0.9)}
