from pyspark.sql import functions as F

from lociflow.operators.units import harmonise_units, milli
from lociflow.sources.genomic_text import covariance_triplets, gene_locations, gene_sets, id_pairs, json_list_csv, latest_ids, quadratic_scores, white_space_table
from lociflow.sources.schema_drift import layout_versions, migration_steps, migrations, unify
from lociflow.sources.summary_lines import load_or_reject

ALIASES = [("CHR", "CHROM"), ("P", "PVAL"), ("BETA", "EFFECT"), ("SNP", "RSID")]
LINES = "line_id long, file_id long, line_no int, line string, extra string"


def _tables(spark, *files):
    rows, n = [], 0
    for f, lines in enumerate(files):
        for k, line in enumerate(lines):
            rows.append((n, f, k, line, None))
            n += 1
    return spark.createDataFrame(rows, LINES), spark.createDataFrame(ALIASES, "canonical string, alias string")


def test_rejects(spark):
    lines, aliases = _tables(spark, [
        "## note", "﻿CHROM,PVAL,EFFECT,SNP\r", "# late comment", "", None, "1,0.5,0.1,rs1\r", '"chr22",1e-3,-.5,"r""s"', '1,0.5,0.1,"open', '1,0.5,"0.1"x,rs1', "1,0.5,0.1",
        "X,0.5,0.1,rs", "1,1.5,0.1,rs", "1,NA,0.1,rs", "1,0.5,1e999,rs", "CHROM,PVAL,EFFECT,SNP", " 2 , 0.5 , 1. , ", "1,0.5,0.1,rs,", "1,0.5,0.1," + "a" * 200_000, '"1" ,0.5,0.1,rs',
    ])
    valid, rejected = load_or_reject(lines, aliases)
    assert {r.line_id: r.reason for r in rejected.collect()} == {7: "quoting", 8: "quoting", 9: "columns", 10: "chr", 11: "p", 12: "p", 13: "beta", 14: "chr", 16: "columns"}
    rows = {r.line_id: r for r in valid.collect()}
    assert set(rows) == {5, 6, 15, 17, 18} and rows[6].CHR == 22 and rows[6].SNP == 'r"s' and rows[15].SNP is None


def test_odds_ratio_and_empty(spark):
    lines, aliases = _tables(spark, ["CHR P OR", "1  0.5   2", "1 0.5 0", "1 0.5 -1"], ["## only"], [])
    valid, rejected = load_or_reject(lines, aliases)
    assert [round(r.BETA, 6) for r in valid.collect()] == [0.693147] and sorted(r.reason for r in rejected.collect()) == ["beta", "beta"]
    none, _ = load_or_reject(lines.where("false"), aliases)
    assert none.count() == 0


def test_drift(spark):
    lines, aliases = _tables(spark, ["CHR,P,BETA,N", "1,0.5,0.1,7", "2,NA,0.2,8"], ["#CHROM;P;BETA;SNP", "1;0.5;1;a", "1;0.1;2;b"], ['"P";"chrom";BETA;snp', "1;0.5;1;a"], ["## no header"])
    files = spark.createDataFrame([(0, "s", "2024-01-01 00:00:00"), (1, "s", "2024-01-02 00:00:00"), (2, "s", "2024-01-05 00:00:00"), (3, "s", "2024-01-03 00:00:00")], "file_id long, stream string, t string").select("file_id", "stream", F.to_timestamp("t").alias("received_at"))
    found = {(r.file_id, r.field, r.change) for r in migrations(files, lines, aliases).collect()}
    assert found == {
        (1, "CHR", "renamed"), (1, "N", "removed"), (1, "SNP", "added"), (1, "BETA", "retyped"), (1, "delimiter", "changed"), (1, "header_starts_with_hash", "changed"),
        (2, "P", "retyped"), (2, "CHR", "retyped"), (2, "header_starts_with_hash", "changed"),
    }
    assert sorted(r.version for r in layout_versions(files, lines, aliases).collect()) == [1, 2, 3]
    table = unify(files, lines, aliases)
    assert table.count() == 5 and {"SNP", "CHR", "P", "BETA"} <= set(table.columns)
    assert migrations(files.where("false"), lines, aliases).count() == 0
    rows = {(r.file_id, r.CHR, r.P, r.version) for r in table.collect()}
    assert rows == {(0, 1, 0.5, 1), (0, 2, None, 1), (1, 1, 0.5, 2), (1, 1, 0.1, 2), (2, None, 1.0, 3)}
    steps = {(r.version, r.action, r.field): (r.source, r.target) for r in migration_steps(files, lines, aliases).collect()}
    assert steps[2, "rename", "CHR"] == ("CHROM", "CHR") and steps[2, "default", "N"] == (None, "null") and steps[1, "cast", "BETA"] == ("float", "double")
    assert (1, "rename", "CHR") not in steps and unify(files.where("false"), lines, aliases).where("version is null and stream is null").count() == 5
    assert unify(files, lines.where("false"), aliases).count() == 0


def test_units(spark):
    studies = spark.createDataFrame([("or", True, "MAF"), ("ln", False, "EAF"), ("?", None, None)], "study_id string, has_or boolean, frequency_column_is string")
    rows = [
        (1, "or", "1.10", None, "0.9", None), (2, "ln", "0.1", None, "0.2", None), (3, "ln", "OR 2 [1.5-2.5]", None, "AC=30;AN=100", None), (4, "or", "−0,5", "log2(OR)", "15 %", None),
        (5, "or", "10% lower odds", None, "40", "minor alleles per thousand"), (6, "ln", "20.0 x10^-3 (ln OR)", None, "NA", None), (7, "or", None, None, None, None), (8, "missing", "0.3", None, "0.6", None),
    ]
    hits = spark.createDataFrame([(i, s, b, bn, m, mn, 0.1, 0.5) for i, s, b, bn, m, mn in rows], "row_id long, study_id string, beta string, beta_note string, maf string, maf_note string, se double, p double")
    out = {(r.row_id, r.field): (r.m, r.converted, r.unit) for r in harmonise_units(hits, studies).withColumn("m", milli(F.col("value"))).collect()}
    assert out[1, "beta"][:2] == (95, True) and out[1, "maf"][:2] == (100, True) and out[2, "beta"] == (100, False, "ln") and out[2, "maf"][:2] == (200, False)
    assert out[3, "beta"][:2] == (693, True) and out[3, "maf"][0] == 300 and out[4, "beta"][0] == -347 and out[4, "maf"][0] == 150
    assert out[5, "beta"][0] == -105 and out[5, "maf"][0] == 40 and out[6, "beta"][0] == 20 and (6, "maf") not in out and (7, "beta") not in out


def test_identity_finds_the_unit(spark):
    import math

    from lociflow.functions.stats import z_of_p

    studies = spark.createDataFrame([("?", None, None)], "study_id string, has_or boolean, frequency_column_is string")
    base = spark.range(200).select("id", (F.lit(0.02) + F.col("id") / 4000).alias("ln"), F.lit(1e-4).alias("p"))
    hits = base.select(F.col("id").alias("row_id"), F.lit("?").alias("study_id"), F.round(F.col("ln") / math.log(10), 6).cast("string").alias("beta"), F.lit(None).cast("string").alias("beta_note"), F.lit(None).cast("string").alias("maf"), F.lit(None).cast("string").alias("maf_note"), (F.col("ln") / z_of_p(F.col("p"))).alias("se"), "p")
    units = {(r.unit, r.unit_from, r.unique) for r in harmonise_units(hits, studies).collect()}
    assert units == {("log10", "identity", True)}


def test_readers(spark, tmp_path):
    w = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    sets = {r.set_id: r for r in gene_sets(spark, w("a.gmt", "S1\td\tg1\tg2\tg2\t\nS2\td\nS3\te\tg1\n#x\n"), 2).collect()}
    assert set(sets) == {"S1"} and sets["S1"].genes == ["g1", "g2"]
    assert [tuple(r) for r in gene_locations(spark, w("g.loc", "ENSG1.5 chr6 10 20 + AB\nbad\n")).collect()] == [("ENSG1", "6", 10, 20, "+", "AB")]
    assert [tuple(r) for r in white_space_table(spark, w("t.txt", "# c\n A  B\n1 x\n2\nz y\n"), {"B": "string", "A": "int"}).orderBy("B").collect()] == [("x", 1), ("y", None)]
    assert {tuple(r) for r in id_pairs(spark, w("p.tsv", "k\tb\nk\ta\n\tq\nz\t\n")).collect()} == {("k", "a")}
    history = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("n", None)], "old string, new string")
    assert {(r.old, r.current) for r in latest_ids(history).collect()} >= {("a", "c"), ("b", "c"), ("x", "y")}
    cov = covariance_triplets(spark, w("c.txt", "GENE RSID1 RSID2 VALUE\ng r1 r1 1\ng r1 r2 0.5\ng r2 r2 2\n"))
    got = quadratic_scores(spark.createDataFrame([("g", "r1", 1.0), ("g", "r2", -1.0), ("h", "r1", 1.0)], "gene string, snp string, w double"), spark.createDataFrame([("r1", 3.0), ("r2", 1.0)], "snp string, z double"), cov)
    r = {x.gene: x for x in got.collect()}
    assert abs(r["g"].zscore - 2 / 2**0.5) < 1e-12 and r["h"].zscore is None
    json_list_csv(spark.createDataFrame([(1, ["a"])], "i int, l array<string>"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True, escape='"').first().l == '["a"]'
