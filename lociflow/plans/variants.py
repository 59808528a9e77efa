"""Queries over variant tables: canonical rows, quality control, joins, ranks and estimators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociflow.functions.alleles import clean_allele, complement, is_palindromic, minor_frequency
from lociflow.functions.identifiers import rsid
from lociflow.functions.stats import CHI2_MEDIAN, finite, z_of_p
from lociflow.operators.components import connected_components
from lociflow.operators.merging import keep_first
from lociflow.operators.ranges import collapse_loci, range_join
from lociflow.operators.ranks import benjamini_hochberg, order_statistics, running_counts, value_counts
from lociflow.operators.skew import salted_join
from lociflow.session import shared_path, table
from lociflow.sources.genomic_text import allele_frequencies, bim_variants

#: The extended major histocompatibility region on chromosome 6, GRCh37.
MHC_START, MHC_END = 25_000_000, 34_000_000
#: Genome-wide significance.
GENOME_WIDE = 5e-8
MEGABASE = 1_000_000


def canonical(spark: SparkSession, d: str) -> DataFrame:
    """Variants under canonical names: alleles cleaned, rs number cut out, N filled from cases and controls and then the study's."""
    v = table(spark, d, "gwas_variants")
    s = table(spark, d, "gwas_studies").select("study_id", F.col("n_cases").alias("s_cas"), F.col("n_controls").alias("s_con")).dropDuplicates(["study_id"])
    total = F.nullif(F.coalesce("n_cas", "s_cas") + F.coalesce("n_con", "s_con"), F.lit(0))
    rows = v.join(s, "study_id", "left").select("row_id", "study_id", rsid(F.col("snp")).alias("snp"), "chr", "pos", clean_allele(F.col("a1")).alias("a1"), clean_allele(F.col("a2")).alias("a2"), *[finite(F.col(c)).alias(c) for c in ("beta", "se", "p", "maf", "info")], F.coalesce(F.nullif("n", F.lit(0)), total).alias("n"))
    return rows.withColumn("variant_id", F.concat_ws(":", F.col("chr").cast("string"), F.col("pos").cast("string"), "a2", "a1"))


def quality_controlled(rows: DataFrame, info: float = 0.8, maf: float = 0.01, keep_mhc: bool = True) -> DataFrame:
    """Rows that pass INFO and MAF (null passes), 0 < p <= 1 and have what is required; the first of a study's repeated variants."""
    ok = F.coalesce(F.col("info") >= info, F.lit(True)) & F.coalesce(F.col("maf") >= maf, F.lit(True)) & (F.col("p") > 0) & (F.col("p") <= 1)
    for c in ("chr", "pos", "a1", "a2", "beta", "se"):
        ok = ok & F.col(c).isNotNull()
    if not keep_mhc:
        ok = ok & ~((F.col("chr") == 6) & F.col("pos").between(MHC_START, MHC_END))
    return keep_first(rows.where(ok), ["study_id", "variant_id"], [F.col("row_id")])


def v_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Canonical column mapping."""
    return canonical(spark, d).select("row_id", "snp", "a1", "a2", "n", "variant_id", F.round("maf", 6).alias("maf"))


def v_quality_control(spark: SparkSession, d: str) -> DataFrame:
    """Rows that pass quality control outside the histocompatibility region, without repeats."""
    return quality_controlled(canonical(spark, d), keep_mhc=False).select("row_id", "study_id", "variant_id", "p")


def v_filter_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many rows of each study each filter drops, by itself."""
    c = F.col
    return canonical(spark, d).groupBy("study_id").agg(
        F.count("*").alias("total"), F.count_if(c("info") < 0.8).alias("low_info"), F.count_if(c("maf") < 0.01).alias("low_maf"),
        F.count_if(c("p").isNull() | (c("p") <= 0) | (c("p") > 1)).alias("bad_p"), F.count_if(c("snp").isNull()).alias("no_snp"), F.count_if(is_palindromic(c("a1"), c("a2"))).alias("palindromic"),
    )


def v_case_control_n(spark: SparkSession, d: str) -> DataFrame:
    """Cases and controls of a study: as registered, else the rounded median of its rows, with where it is from."""
    v, s = table(spark, d, "gwas_variants"), table(spark, d, "gwas_studies").select("study_id", "n_cases", "n_controls")
    out = s
    for column, registered in (("n_cas", "n_cases"), ("n_con", "n_controls")):
        middle = order_statistics(v.select("study_id", F.col(column).cast("double").alias(column)), ["study_id"], column, 0.5).select("study_id", F.floor(F.col(column) + 0.5).cast("long").alias(column))
        out = out.join(middle, "study_id", "left").withColumn(f"{column}_from", F.when(F.col(registered).isNotNull(), "registered").when(F.col(column).isNotNull(), "median").otherwise("none")).withColumn(column, F.coalesce(registered, column))
    return out.drop("n_cases", "n_controls")


def v_palindromes(spark: SparkSession, d: str) -> DataFrame:
    """Allele pairs, their complements and whether they are palindromic."""
    rows = canonical(spark, d).where(F.col("a1").isNotNull() & F.col("a2").isNotNull())
    return rows.groupBy("a1", "a2").agg(F.count("*").alias("n")).select("a1", "a2", complement(F.col("a1")).alias("c1"), complement(F.col("a2")).alias("c2"), is_palindromic(F.col("a1"), F.col("a2")).alias("palindromic"), "n")


def v_effect_from_z(spark: SparkSession, d: str) -> DataFrame:
    """Effect and standard error on the standardised scale from z, frequency and N: 1 / sqrt(2 f (1 - f) (N + z^2))."""
    rows = canonical(spark, d).where("se > 0").withColumn("z", F.col("beta") / F.col("se")).withColumn("f", minor_frequency(F.col("maf")))
    size = 2 * F.col("f") * (1 - F.col("f")) * (F.col("n") + F.col("z") * F.col("z"))
    return rows.withColumn("size", size).where("size > 0").select("row_id", F.round(F.col("z") / F.sqrt("size"), 9).alias("std_beta"), F.round(1 / F.sqrt("size"), 9).alias("std_se"))


def v_fdr(spark: SparkSession, d: str) -> DataFrame:
    """False discovery rates of each study's distinct p values."""
    q = benjamini_hochberg(table(spark, d, "gwas_variants"), ["study_id"], "p")
    return q.select("study_id", "p", "n", "rank", F.round("q", 9).alias("q"))


def v_fdr_all(spark: SparkSession, d: str) -> DataFrame:
    """False discovery rates over all rows at once, of every distinct p value."""
    q = benjamini_hochberg(table(spark, d, "gwas_variants"), [], "p")
    return q.select("p", "n", "rank", F.round("q", 9).alias("q"))


def v_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    """Per study: tests, Bonferroni cut-off, the largest p with q below 0.05, and how many rows pass either."""
    q = benjamini_hochberg(table(spark, d, "gwas_variants"), ["study_id"], "p")
    line = 0.05 / F.col("total")
    passed = q.withColumn("b", F.when(F.col("p") < line, F.col("n")).otherwise(0)).withColumn("f", F.when(F.col("q") < 0.05, F.col("n")).otherwise(0))
    out = passed.groupBy("study_id").agg(F.max("total").alias("tests"), F.sum("b").alias("n_bonferroni"), F.sum("f").alias("n_fdr"), F.max(F.when(F.col("q") < 0.05, F.col("p"))).alias("fdr_p"))
    return out.withColumn("bonferroni_p", F.round(0.05 / F.col("tests"), 12)).withColumn("fdr_p", F.round("fdr_p", 12))


def v_lambda_gc(spark: SparkSession, d: str) -> DataFrame:
    """Genomic inflation of each study, from the exact median p, and scaled to 1000."""
    v = table(spark, d, "gwas_variants")
    middle = order_statistics(v.where((F.col("p") > 0) & (F.col("p") <= 1)), ["study_id"], "p", 0.5)
    inflation = z_of_p(F.col("p")) * z_of_p(F.col("p")) / CHI2_MEDIAN
    return middle.select("study_id", "n", F.round(inflation, 6).alias("lambda_gc"), F.round(1 + (inflation - 1) * 1000 / F.col("n"), 6).alias("lambda_1000"))


def v_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Observed against expected -log10 p of every distinct value of each study."""
    v = table(spark, d, "gwas_variants")
    placed = running_counts(value_counts(v.where((F.col("p") > 0) & (F.col("p") <= 1)), ["study_id"], "p"), ["study_id"], "p")
    middle = (F.col("below") + (F.col("n") + 1) / 2 - 0.5) / F.col("total")
    return placed.select("study_id", "p", F.round(-F.log10("p"), 6).alias("observed"), F.round(-F.log10(middle), 6).alias("expected"))


def v_windows(spark: SparkSession, d: str) -> DataFrame:
    """Variants within 500 kb of every genome-wide significant hit: how many, and the best of them."""
    return windows(canonical(spark, d), GENOME_WIDE)


def windows(rows: DataFrame, p: float) -> DataFrame:
    """Per lead below ``p``. Positions of variants and of leads are joined, not their rows, so dense places don't multiply."""
    leads = rows.where(F.col("p") < p).select("chr", F.col("pos").alias("at"), F.col("row_id").alias("lead"))
    spans = leads.select("chr", "at").distinct().withColumns({"lo": F.col("at") - 500_000, "hi": F.col("at") + 500_000})
    places = rows.groupBy("chr", "pos").agg(F.count("*").alias("n"), F.min("p").alias("p"))
    near = range_join(places, spans, "chr", "pos", "lo", "hi", MEGABASE)
    found = near.groupBy("chr", "at").agg(F.sum("n").alias("n_near"), F.min("p").alias("best_p"), F.min("pos").alias("first_pos"))
    return leads.join(found, ["chr", "at"]).select("lead", "n_near", "best_p", "first_pos")


def v_linked_leads(spark: SparkSession, d: str) -> DataFrame:
    """Genome-wide significant hits of all studies linked where they are within 500 kb: the smallest row of each cluster."""
    return linked(canonical(spark, d).where(F.col("p") < GENOME_WIDE))


def linked(hits: DataFrame) -> DataFrame:
    # neighbours of one window are linked through its first hit of each half, so a dense window has no all-pairs list
    cells = hits.select("row_id", "chr", "pos", F.floor(F.col("pos") / 500_000).alias("cell"))
    ends = cells.groupBy("chr", "cell").agg(F.min(F.struct("pos", "row_id")).alias("lo"), F.max(F.struct("pos", "row_id")).alias("hi"))
    inside = cells.join(ends, ["chr", "cell"]).select(F.col("row_id").alias("a"), F.col("lo.row_id").alias("b"))
    after = ends.select("chr", (F.col("cell") - 1).alias("cell"), F.col("lo").alias("next"))
    across = ends.join(after, ["chr", "cell"]).where(F.col("next.pos") - F.col("hi.pos") <= 500_000).select(F.col("hi.row_id").alias("a"), F.col("next.row_id").alias("b"))
    return connected_components(inside.unionByName(across), "a", "b").select(F.col("node").alias("row_id"), "component")


def v_loci(spark: SparkSession, d: str) -> DataFrame:
    """Genome-wide significant hits collapsed to loci, 500 kb apart."""
    hits = canonical(spark, d).where(F.col("p") < GENOME_WIDE)
    return collapse_loci(hits, "study_id", "chr", "pos", "p", 500_000, "variant_id")


def v_loci_mhc(spark: SparkSession, d: str) -> DataFrame:
    """Loci, and whether the span from their first to their leading position overlaps the histocompatibility region."""
    loci = v_loci(spark, d)
    lo, hi = F.least("locus_start", "lead_position"), F.greatest("locus_start", "lead_position")
    inside = F.coalesce((F.col("chr") == 6) & (lo <= MHC_END) & (hi >= MHC_START), F.lit(False))
    return loci.select("study_id", "chr", "locus_start", "lead_position", inside.alias("in_mhc"))


def v_top_hits(spark: SparkSession, d: str) -> DataFrame:
    """The ten smallest p values of every study (ties: the smallest row_id); each task keeps ten a study before the shuffle."""
    valid = table(spark, d, "gwas_variants").where("p > 0 and p <= 1").select("study_id", "row_id", "p")
    order = Window.partitionBy("study_id").orderBy("p", "row_id")
    return valid.withColumn("place", F.row_number().over(order)).where("place <= 10")


def v_hit_bins(spark: SparkSession, d: str) -> DataFrame:
    """Studies of each source by how many genome-wide significant places they have: 1, 2, 3-5 or 6+, with the places' total."""
    hits = table(spark, d, "gwas_variants").where((F.col("p") >= 0) & (F.col("p") < GENOME_WIDE) & F.col("chr").isNotNull() & F.col("pos").isNotNull())
    counts = hits.select("study_id", "chr", "pos").distinct().groupBy("study_id").agg(F.count("*").alias("n"))
    named = counts.join(table(spark, d, "gwas_studies").select("study_id", "source").dropDuplicates(["study_id"]), "study_id")
    bins = F.when(F.col("n") <= 2, F.col("n").cast("string")).when(F.col("n") <= 5, "3-5").otherwise("6+")
    return named.groupBy("source", bins.alias("bin")).agg(F.count("*").alias("n_studies"), F.sum("n").alias("n_places"))


def v_places(spark: SparkSession, d: str) -> DataFrame:
    """Place of every distinct position on its chromosome, from 0, from one distributed sort."""
    spots = table(spark, d, "gwas_variants").where("chr is not null and pos is not null").select("chr", "pos").distinct()
    return running_counts(spots.withColumn("n", F.lit(1).cast("long")), ["chr"], "pos").select("chr", "pos", F.col("below").alias("place"), F.col("total").alias("n_positions"))


def v_study_best(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose p equals the smallest of their study and chromosome."""
    rows = table(spark, d, "gwas_variants").where("p > 0 and p <= 1 and chr is not null").select("row_id", "study_id", "chr", "p")
    least = rows.groupBy("study_id", "chr").agg(F.min("p").alias("least"))
    return salted_join(rows, least, ["study_id", "chr"], F.col("row_id"), salts=8).where("p = least").select("row_id", "study_id", "chr", "p")


def panel(spark: SparkSession, d: str) -> DataFrame:
    """One named variant a place, of all studies: the reference panel that the tables give."""
    rows = canonical(spark, d).where("snp is not null and chr is not null and pos is not null and a1 is not null and a2 is not null")
    return keep_first(rows.select("chr", "pos", "snp", "a1", "a2", "maf", "row_id"), ["chr", "pos"], [F.col("row_id")])


def v_panel_file(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose variant is in the panel, by chromosome, where the panel is written as a panel file and read again."""
    path = shared_path(spark, "texts")
    fields = [F.concat(F.lit("chr"), F.col("chr")), F.col("snp"), F.lit("0"), F.col("pos"), F.lower("a1"), F.col("a2")]
    panel(spark, d).select(F.concat_ws("\t", *fields).alias("value")).write.text(path)
    known = bim_variants(spark, path).select(F.col("chr").cast("int").alias("chr"), "snp").distinct()
    rows = canonical(spark, d).where("snp is not null").select("row_id", "study_id", "chr", "snp")
    return salted_join(rows, known, ["chr", "snp"], F.col("row_id"), "left_semi", salts=4).groupBy("study_id", "chr").agg(F.count("*").alias("n_in_panel"))


def v_minor_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Minor allele frequency of every named row: its own, else the panel's frequency file's; and where it is from."""
    path = shared_path(spark, "texts")
    lines = panel(spark, d).where("maf is not null").select(F.concat_ws("  ", "chr", "snp", "a1", "a2", F.col("maf").cast("string"), F.lit("100")).alias("value"))
    spark.range(1).select(F.lit(" CHR  SNP  A1  A2  MAF  NCHROBS").alias("value")).unionByName(lines).write.text(path)
    reference = allele_frequencies(spark, path).select("snp", F.col("maf").alias("panel_maf"))
    rows = canonical(spark, d).where("snp is not null").select("row_id", "snp", minor_frequency(F.col("maf")).alias("own"))
    both = salted_join(rows, reference, "snp", F.col("row_id"), "left", salts=4).withColumn("theirs", minor_frequency(F.col("panel_maf")))
    source = F.when(F.col("own").isNotNull(), "own").when(F.col("theirs").isNotNull(), "panel").otherwise("none")
    return both.select("row_id", F.round(F.coalesce("own", "theirs"), 6).alias("maf"), source.alias("maf_from"))


def v_best_per_region(spark: SparkSession, d: str) -> DataFrame:
    """The row with the smallest p of each study, chromosome and megabase (ties: the smallest row_id)."""
    return region_leads(canonical(spark, d)).select("study_id", "chr", "mb", "row_id", "p")


def region_leads(rows: DataFrame) -> DataFrame:
    usable = rows.where((F.col("p") > 0) & (F.col("p") <= 1) & (F.col("se") > 0) & F.col("beta").isNotNull()).withColumn("mb", F.floor(F.col("pos") / MEGABASE))
    return keep_first(usable, ["study_id", "chr", "mb"], [F.col("p"), F.col("row_id")])


QUERIES = {
    q.__name__: q
    for q in (
        v_canonical, v_quality_control, v_filter_counts, v_case_control_n, v_palindromes, v_effect_from_z, v_fdr, v_fdr_all, v_cutoffs,
        v_lambda_gc, v_quantiles, v_windows, v_linked_leads, v_loci, v_loci_mhc, v_top_hits, v_hit_bins, v_places, v_study_best, v_panel_file, v_minor_frequency, v_best_per_region,
    )
}

_FINITE = lambda c: f"CASE WHEN NOT isnan({c}) AND abs({c}) < 'inf'::DOUBLE THEN {c} END"
CANONICAL_SQL = f"""
    raw AS (
      SELECT row_id, study_id, nullif(regexp_extract(lower(trim(snp)), '^rs[0-9]+'), '') AS snp, chr, pos,
             CASE WHEN regexp_full_match(upper(trim(a1)), '[ACGT]+') THEN upper(trim(a1)) END AS a1,
             CASE WHEN regexp_full_match(upper(trim(a2)), '[ACGT]+') THEN upper(trim(a2)) END AS a2,
             {", ".join(f"{_FINITE('v.' + c)} AS {c}" for c in ("beta", "se", "p", "maf", "info"))},
             coalesce(nullif(n, 0), nullif(coalesce(n_cas, n_cases) + coalesce(n_con, n_controls), 0)) AS n
      FROM gwas_variants v LEFT JOIN gwas_studies s USING (study_id)),
    c AS (SELECT *, concat_ws(':', CAST(chr AS VARCHAR), CAST(pos AS VARCHAR), a2, a1) AS variant_id FROM raw)"""
_LEADS = f"""{CANONICAL_SQL},
    leads AS (
      SELECT *, CAST(floor(pos / 1000000) AS BIGINT) AS mb FROM c WHERE p > 0 AND p <= 1 AND se > 0 AND beta IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY study_id, chr, CAST(floor(pos / 1000000) AS BIGINT) ORDER BY p, row_id) = 1)"""
_PANEL = f"""{CANONICAL_SQL},
    panel AS (SELECT * FROM c WHERE snp IS NOT NULL AND chr IS NOT NULL AND pos IS NOT NULL AND a1 IS NOT NULL AND a2 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY chr, pos ORDER BY row_id) = 1)"""
_VALID = "p IS NOT NULL AND NOT isnan(p) AND p >= 0 AND p <= 1"


def _bh(keys: str) -> str:
    part, group = (f"PARTITION BY {keys}", f"{keys}, ") if keys else ("", "")
    return f"""
    d AS (SELECT {group}p, count(*) AS n FROM gwas_variants WHERE {_VALID} GROUP BY {group}p),
    r AS (SELECT *, CAST(sum(n) OVER ({part} ORDER BY p) AS BIGINT) AS rank, CAST(sum(n) OVER ({part}) AS BIGINT) AS total FROM d),
    q AS (SELECT *, min(least(p * total / rank, 1.0)) OVER ({part} ORDER BY p DESC) AS q FROM r)"""


def _z(p: str) -> str:
    t = f"sqrt(-2 * ln(greatest({p}, 1e-300) / 2))"
    return f"greatest({t} - (2.515517 + 0.802853 * {t} + 0.010328 * {t} * {t}) / (1 + 1.432788 * {t} + 0.189269 * {t} * {t} + 0.001308 * {t} * {t} * {t}), 0.0)"


SQL = {
    "v_canonical": f"WITH {CANONICAL_SQL} SELECT row_id, snp, a1, a2, n, variant_id, round(maf, 6) AS maf FROM c",
    "v_quality_control": f"""WITH {CANONICAL_SQL} SELECT row_id, study_id, variant_id, p FROM c
        WHERE coalesce(info >= 0.8, true) AND coalesce(maf >= 0.01, true) AND p > 0 AND p <= 1 AND chr IS NOT NULL AND pos IS NOT NULL AND a1 IS NOT NULL
          AND a2 IS NOT NULL AND beta IS NOT NULL AND se IS NOT NULL AND NOT (chr = 6 AND pos BETWEEN {MHC_START} AND {MHC_END})
        QUALIFY row_number() OVER (PARTITION BY study_id, variant_id ORDER BY row_id) = 1""",
    "v_filter_counts": f"""WITH {CANONICAL_SQL} SELECT study_id, count(*) AS total, count(*) FILTER (info < 0.8) AS low_info, count(*) FILTER (maf < 0.01) AS low_maf,
        count(*) FILTER (p IS NULL OR p <= 0 OR p > 1) AS bad_p, count(*) FILTER (snp IS NULL) AS no_snp,
        count(*) FILTER (a1 || a2 IN ('AT', 'TA', 'CG', 'GC')) AS palindromic FROM c GROUP BY study_id""",
    "v_case_control_n": """
        WITH m AS (SELECT study_id, CAST(floor(quantile_cont(CAST(n_cas AS DOUBLE), 0.5) + 0.5) AS BIGINT) AS a, CAST(floor(quantile_cont(CAST(n_con AS DOUBLE), 0.5) + 0.5) AS BIGINT) AS b FROM gwas_variants GROUP BY study_id)
        SELECT s.study_id, coalesce(n_cases, a) AS n_cas, CASE WHEN n_cases IS NOT NULL THEN 'registered' WHEN a IS NOT NULL THEN 'median' ELSE 'none' END AS n_cas_from,
               coalesce(n_controls, b) AS n_con, CASE WHEN n_controls IS NOT NULL THEN 'registered' WHEN b IS NOT NULL THEN 'median' ELSE 'none' END AS n_con_from
        FROM gwas_studies s LEFT JOIN m USING (study_id)""",
    "v_palindromes": f"""WITH {CANONICAL_SQL} SELECT a1, a2, translate(a1, 'ACGT', 'TGCA') AS c1, translate(a2, 'ACGT', 'TGCA') AS c2,
        a1 || a2 IN ('AT', 'TA', 'CG', 'GC') AS palindromic, count(*) AS n FROM c WHERE a1 IS NOT NULL AND a2 IS NOT NULL GROUP BY a1, a2""",
    "v_effect_from_z": f"""WITH {CANONICAL_SQL}, z AS (SELECT row_id, beta / se AS z, CASE WHEN maf > 0 AND maf < 1 THEN least(maf, 1 - maf) END AS f, n FROM c WHERE se > 0),
        s AS (SELECT *, 2 * f * (1 - f) * (n + z * z) AS size FROM z)
        SELECT row_id, round(z / sqrt(size), 9) AS std_beta, round(1 / sqrt(size), 9) AS std_se FROM s WHERE size > 0""",
    "v_fdr": f"WITH {_bh('study_id')} SELECT study_id, p, n, rank, round(q, 9) AS q FROM q",
    "v_fdr_all": f"WITH {_bh('')} SELECT p, n, rank, round(q, 9) AS q FROM q",
    "v_cutoffs": f"""WITH {_bh("study_id")} SELECT study_id, max(total) AS tests, CAST(sum(CASE WHEN p < 0.05 / total THEN n ELSE 0 END) AS BIGINT) AS n_bonferroni,
        CAST(sum(CASE WHEN q < 0.05 THEN n ELSE 0 END) AS BIGINT) AS n_fdr, round(max(CASE WHEN q < 0.05 THEN p END), 12) AS fdr_p, round(0.05 / max(total), 12) AS bonferroni_p FROM q GROUP BY study_id""",
    "v_lambda_gc": f"""WITH m AS (SELECT study_id, count(*) AS n, quantile_cont(p, 0.5) AS p FROM gwas_variants WHERE {_VALID} AND p > 0 GROUP BY study_id),
        l AS (SELECT study_id, n, {_z("p")} * {_z("p")} / 0.4549364231195724 AS l FROM m)
        SELECT study_id, n, round(l, 6) AS lambda_gc, round(1 + (l - 1) * 1000 / n, 6) AS lambda_1000 FROM l""",
    "v_quantiles": f"""WITH d AS (SELECT study_id, p, count(*) AS n FROM gwas_variants WHERE {_VALID} AND p > 0 GROUP BY study_id, p),
        r AS (SELECT *, sum(n) OVER (PARTITION BY study_id ORDER BY p) - n AS below, sum(n) OVER (PARTITION BY study_id) AS total FROM d)
        SELECT study_id, p, round(-log10(p), 6) AS observed, round(-log10((below + (n + 1) / 2 - 0.5) / total), 6) AS expected FROM r""",
    "v_windows": f"""WITH {CANONICAL_SQL}, l AS (SELECT chr, row_id AS lead, pos - 500000 AS lo, pos + 500000 AS hi FROM c WHERE p < {GENOME_WIDE})
        SELECT lead, count(*) AS n_near, min(p) AS best_p, min(pos) AS first_pos FROM c JOIN l ON c.chr = l.chr AND pos BETWEEN lo AND hi GROUP BY lead""",
    "v_linked_leads": f"""WITH {CANONICAL_SQL}, h AS (SELECT row_id, chr, pos, CAST(coalesce(pos - lag(pos) OVER (PARTITION BY chr ORDER BY pos, row_id) > 500000, true) AS INT) AS new FROM c WHERE p < {GENOME_WIDE}),
        i AS (SELECT *, sum(new) OVER (PARTITION BY chr ORDER BY pos, row_id) AS island FROM h) SELECT row_id, min(row_id) OVER (PARTITION BY chr, island) AS component FROM i""",
    "v_best_per_region": f"WITH {_LEADS} SELECT study_id, chr, mb, row_id, p FROM leads",
    "v_top_hits": f"SELECT study_id, row_id, p, row_number() OVER (PARTITION BY study_id ORDER BY p, row_id) AS place FROM gwas_variants WHERE {_VALID} AND p > 0 QUALIFY place <= 10",
    "v_hit_bins": """WITH n AS (SELECT study_id, count(*) AS n FROM (SELECT DISTINCT study_id, chr, pos FROM gwas_variants WHERE p >= 0 AND p < 5e-8 AND chr IS NOT NULL AND pos IS NOT NULL) GROUP BY study_id)
        SELECT source, CASE WHEN n <= 2 THEN CAST(n AS VARCHAR) WHEN n <= 5 THEN '3-5' ELSE '6+' END AS bin, count(*) AS n_studies, CAST(sum(n) AS BIGINT) AS n_places FROM n JOIN gwas_studies USING (study_id) GROUP BY 1, 2""",
    "v_places": "SELECT chr, pos, row_number() OVER (PARTITION BY chr ORDER BY pos) - 1 AS place, count(*) OVER (PARTITION BY chr) AS n_positions FROM (SELECT DISTINCT chr, pos FROM gwas_variants WHERE chr IS NOT NULL AND pos IS NOT NULL)",
    "v_study_best": f"SELECT row_id, study_id, chr, p FROM gwas_variants WHERE {_VALID} AND p > 0 AND chr IS NOT NULL QUALIFY p = min(p) OVER (PARTITION BY study_id, chr)",
    "v_panel_file": f"""WITH {_PANEL} SELECT study_id, chr, count(*) AS n_in_panel FROM c WHERE EXISTS (SELECT 1 FROM panel WHERE panel.chr = c.chr AND panel.snp = c.snp) GROUP BY study_id, chr""",
    "v_minor_frequency": f"""WITH {_PANEL}, f AS (SELECT snp, maf FROM panel WHERE maf > 0 AND maf < 1 QUALIFY row_number() OVER (PARTITION BY snp ORDER BY a1, a2, maf) = 1),
        r AS (SELECT row_id, CASE WHEN c.maf > 0 AND c.maf < 1 THEN least(c.maf, 1 - c.maf) END AS own, least(f.maf, 1 - f.maf) AS theirs FROM c LEFT JOIN f USING (snp) WHERE snp IS NOT NULL)
        SELECT row_id, round(coalesce(own, theirs), 6) AS maf, CASE WHEN own IS NOT NULL THEN 'own' WHEN theirs IS NOT NULL THEN 'panel' ELSE 'none' END AS maf_from FROM r""",
    # hits are opened one after the other: a hit further than the window from the present locus' best opens a locus, a better one leads it
    "v_loci": f"""WITH RECURSIVE {CANONICAL_SQL},
        h AS (SELECT study_id, chr, pos, min(struct_pack(p := p, name := variant_id)) AS m FROM c WHERE p < {GENOME_WIDE} AND pos IS NOT NULL GROUP BY study_id, chr, pos),
        i AS (SELECT study_id, chr, pos, m.p AS p, m.name AS name, row_number() OVER (PARTITION BY study_id, chr ORDER BY pos) AS i FROM h),
        w AS (SELECT study_id, chr, i, pos AS locus_start, pos AS lead_position, p AS lead_p, name AS lead_label, 1 AS n FROM i WHERE i = 1
              UNION ALL
              SELECT i.study_id, i.chr, i.i, CASE WHEN i.pos - lead_position > 500000 THEN i.pos ELSE locus_start END, CASE WHEN i.pos - lead_position > 500000 OR i.p < lead_p THEN i.pos ELSE lead_position END,
                     CASE WHEN i.pos - lead_position > 500000 OR i.p < lead_p THEN i.p ELSE lead_p END, CASE WHEN i.pos - lead_position > 500000 OR i.p < lead_p THEN i.name ELSE lead_label END,
                     CASE WHEN i.pos - lead_position > 500000 THEN 1 ELSE n + 1 END
              FROM w JOIN i ON i.study_id = w.study_id AND i.chr IS NOT DISTINCT FROM w.chr AND i.i = w.i + 1)
        SELECT study_id, chr, locus_start, lead_position, lead_p, lead_label, CAST(n AS BIGINT) AS n_positions FROM w
        QUALIFY row_number() OVER (PARTITION BY study_id, chr, locus_start ORDER BY n DESC) = 1""",
}
SQL["v_loci_mhc"] = f"""SELECT study_id, chr, locus_start, lead_position, coalesce(chr = 6 AND least(locus_start, lead_position) <= {MHC_END} AND greatest(locus_start, lead_position) >= {MHC_START}, false) AS in_mhc
    FROM ({SQL["v_loci"]}) loci"""
