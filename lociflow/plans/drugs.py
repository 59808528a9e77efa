"""Queries over drug-target records and the drug registry: merging, sets, classes, matching, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.identifiers import atc_level, json_or_text_list, plain_name, pubchem_cid
from lociflow.functions.stats import normal_two_sided
from lociflow.operators.enrichment import class_regression, permutation_test
from lociflow.operators.merging import class_members, identical_sets, item_sets, list_counts, membership_patterns, ordered_unions, richest_record, source_names, tiered_match
from lociflow.operators.ranks import average_ranks, rank_sum_test, running_counts, with_fdr
from lociflow.operators.skew import salted_join
from lociflow.plans.tails import normal_upper_sql
from lociflow.session import shared_path, table
from lociflow.sources.genomic_text import gene_sets, json_list_csv

#: Least number of drugs in a class and genes in a set.
LEAST_DRUGS, LEAST_GENES = 5, 3
#: Most genes of a set that is read from a file.
MOST_GENES = 500
ATC_LENGTHS = (1, 3, 4, 5)
#: Sources of which two together make a pair's confidence high.
MAIN_SOURCES = ("chembl", "pdsp", "dgidb")
#: Interaction types that are standard as they are.
STANDARD_TYPES = ("agonist", "antagonist", "blocker", "inhibitor", "modulator", "opener", "partial agonist", "degrader")


def potency(c: Column) -> Column:
    """A pchembl value that is finite, above 0 and at most 15."""
    return F.when((c > 0) & (c <= 15) & ~F.isnan(c), c)


def records(spark: SparkSession, d: str) -> DataFrame:
    """Drug-target records under clean keys; those without a drug or gene are left out."""
    r = table(spark, d, "drug_targets")
    rows = r.withColumns({"drug": F.upper(F.trim("drug_chembl_id")), "gene": F.upper(F.trim("gene_symbol")), "potency": potency(F.col("pchembl_value"))})
    return rows.where("drug <> '' and gene <> ''")


def d_merged(spark: SparkSession, d: str) -> DataFrame:
    """One record a drug and gene: the richest row, gaps filled, lists and sources united; confidence is high where two of the main sources agree on the pair."""
    scalars = ["mechanism_of_action", "action_type", "interaction_type", "potency", "affinity_value", "max_phase", "molecule_type", "confidence"]
    m = richest_record(records(spark, d), ["drug", "gene"], "record_id", scalars, ["atc_codes", "indication_mesh", "source_pmids"], "source")
    main = F.size(F.array_intersect(F.split("source", ","), F.array(*map(F.lit, MAIN_SOURCES))))
    joined = {"atc_codes": F.array_join("atc_codes", ","), "confidence": F.when(main >= 2, "high").otherwise(F.lower(F.trim("confidence")))}
    m = m.withColumns({"n_pmids": F.size("source_pmids"), "potency": F.round("potency", 4), **joined})
    return m.select("drug", "gene", "kept", "n_records", "source", "confidence", "mechanism_of_action", "action_type", "interaction_type", "potency", "max_phase", "n_pmids", "atc_codes")


def d_best_affinity(spark: SparkSession, d: str) -> DataFrame:
    """The most potent measurement of each drug and protein, with its record (ties: the smallest)."""
    r = records(spark, d).where("potency is not null and gene_uniprot_id is not null")
    best = r.groupBy("drug", "gene_uniprot_id").agg(F.min(F.struct(-F.col("potency"), F.col("record_id").alias("record_id"), F.col("potency").alias("potency"))).alias("b"), F.count("*").alias("n"))
    return best.select("drug", "gene_uniprot_id", "b.record_id", F.round("b.potency", 6).alias("potency"), "n")


def d_mechanism_affinity(spark: SparkSession, d: str) -> DataFrame:
    """Full outer join of what is known by mechanism and by affinity for each drug and gene."""
    r = records(spark, d)
    mechanism = r.where("action_type is not null and trim(action_type) <> ''").groupBy("drug", "gene").agg(F.count("*").alias("n_mechanism"), F.max("max_phase").alias("phase_m"))
    affinity = r.where("potency is not null").groupBy("drug", "gene").agg(F.count("*").alias("n_affinity"), F.max("potency").alias("potency"), F.max("max_phase").alias("phase_a"))
    j = mechanism.join(affinity, ["drug", "gene"], "full")
    return j.select("drug", "gene", "n_mechanism", "n_affinity", F.round("potency", 6).alias("potency"), F.coalesce("phase_m", "phase_a").alias("phase"), F.col("n_mechanism").isNotNull().alias("from_mechanism"))


def d_gene_sets(spark: SparkSession, d: str) -> DataFrame:
    """Sorted distinct genes of every drug with enough of them."""
    return item_sets(records(spark, d), "drug", "gene", LEAST_GENES).select("drug", "n_items", F.array_join("items", ",").alias("genes"))


def d_set_file(spark: SparkSession, d: str) -> DataFrame:
    """The drugs' gene sets written as a gene-set file and read again, within the size limits."""
    path = shared_path(spark, "texts")
    sets = item_sets(records(spark, d), "drug", "gene", 1)
    sets.select(F.concat_ws("\t", "drug", F.lit("drug"), F.array_join("items", "\t")).alias("value")).write.text(path)
    return gene_sets(spark, path, LEAST_GENES, MOST_GENES).select(F.col("set_id").alias("drug"), F.col("n_genes").cast("long").alias("n_items"), F.array_join(F.array_sort("genes"), ",").alias("genes"))


def d_list_file(spark: SparkSession, d: str) -> DataFrame:
    """The drugs' gene sets written as CSV with lists as JSON and read again."""
    path = shared_path(spark, "texts")
    json_list_csv(item_sets(records(spark, d), "drug", "gene", LEAST_GENES), path)
    back = spark.read.schema("drug string, n_items long, items string").option("header", True).option("escape", '"').csv(path)
    return back.select("drug", "n_items", F.array_join(json_or_text_list(F.col("items")), ",").alias("genes"))


def d_identical_sets(spark: SparkSession, d: str) -> DataFrame:
    """Drugs with the very same genes, as one representative: most potent on average, then by id."""
    r = records(spark, d)
    sets = item_sets(r, "drug", "gene").join(r.groupBy("drug").agg(F.round(F.avg("potency"), 6).alias("mean")), "drug")
    return identical_sets(sets, "drug", [F.coalesce(-F.col("mean"), F.lit(0.0))]).where("n_members > 1").drop("set_key")


def d_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of each drug: phase, genes, indications, sources, and how many records are withdrawn."""
    r = records(spark, d)
    counts = r.groupBy("drug").agg(F.max("max_phase").alias("max_phase"), F.count("*").alias("n_records"), F.count_distinct("gene").alias("n_genes"), F.count_if(F.col("is_withdrawn")).alias("n_withdrawn"))
    lists = ordered_unions(r, ["drug"], "record_id", {"indications": F.col("indication_mesh"), "sources": source_names(F.col("source"))})
    text = {c: F.coalesce(F.array_join(F.array_sort(c), by), F.lit("")) for c, by in (("indications", ";"), ("sources", ","))}
    return counts.join(lists, "drug", "left").withColumns(text)


def d_classes(spark: SparkSession, d: str) -> DataFrame:
    """Drug classes of every level with enough drugs."""
    c = class_members(table(spark, d, "drug_registry"), "drug_id", "atc_codes", ATC_LENGTHS, LEAST_DRUGS)
    return c.select("code", atc_level(F.col("code")).alias("level"), "n_items")


def drug_classes(spark: SparkSession, d: str) -> DataFrame:
    """(drug, gene, class): class codes of every level, cut from the records' codes."""
    codes = records(spark, d).where("atc_codes is not null").select("drug", "gene", F.explode("atc_codes").alias("code")).withColumn("code", F.upper(F.trim("code")))
    levels = codes.withColumn("l", F.explode(F.array(*map(F.lit, ATC_LENGTHS)))).where(F.length("code") >= F.col("l"))
    return levels.select("drug", "gene", F.expr("left(code, l)").alias("class")).distinct()


def d_class_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Genes shared by the drugs of a class of any level: distinct genes and the most targeted of them."""
    counts = drug_classes(spark, d).groupBy("class", "gene").agg(F.count("*").alias("n"))
    top = F.min(F.struct(-F.col("n"), F.col("gene").alias("gene"))).alias("m")
    return counts.groupBy("class").agg(F.count("*").alias("n_genes"), F.sum("n").alias("n_pairs"), top).select("class", "n_genes", "n_pairs", F.col("m.gene").alias("top_gene"))


def gene_scores(r: DataFrame) -> DataFrame:
    """Mean potency of each gene, from whole hundredths, so that it doesn't depend on the order of adding up."""
    return r.where("potency is not null").groupBy("gene").agg((F.sum(F.round(F.col("potency") * 100).cast("long")) / F.count("*") / 100).alias("score"))


def upper_p(z: Column) -> Column:
    """One-sided p of a normal z."""
    return F.when(z > 0, normal_two_sided(z) / 2).otherwise(1 - normal_two_sided(z) / 2)


def rank_summary(t: DataFrame, group: str) -> DataFrame:
    p = F.when(F.col("z") == 0, 0.5).otherwise(upper_p(F.col("z")))
    return t.select(group, "n_in", "n_out", F.round("u", 3).alias("u"), F.round("auc", 6).alias("auc"), F.round("z", 6).alias("z"), F.round(p, 6).alias("greater_p"))


def d_rank_sum(spark: SparkSession, d: str) -> DataFrame:
    """Mann-Whitney test of each drug's genes against all other genes, by the genes' mean potency."""
    r = records(spark, d)
    return rank_summary(rank_sum_test(gene_scores(r), r.select("drug", "gene"), "gene", "score", "drug"), "drug")


def d_class_rank_sum(spark: SparkSession, d: str) -> DataFrame:
    """Mann-Whitney test of each class's drugs against all other drugs, by the drugs' own z, two at least on either side."""
    tested, classes = d_rank_sum(spark, d).select("drug", "z"), drug_classes(spark, d).select("drug", "class").distinct()
    return rank_summary(rank_sum_test(tested, classes, "drug", "z", "class").where("n_in >= 2 and n_out >= 2"), "class")


def d_class_permutation(spark: SparkSession, d: str) -> DataFrame:
    """Permutation test of each class's drugs by their mean z, for classes of enough drugs."""
    tested, classes = d_rank_sum(spark, d).select("drug", "z"), drug_classes(spark, d).select("drug", "class").distinct()
    enough = classes.join(tested, "drug").groupBy("class").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_DRUGS).select("class")
    t = permutation_test(tested, classes.join(enough, "class"), "drug", "z", "class")
    return t.select("class", "n_in", F.round("mean", 6).alias("mean"), F.round("p", 6).alias("p"))


def d_masked_fdr(spark: SparkSession, d: str) -> DataFrame:
    """Rank-test p of every drug, with false discovery rates among drugs of enough tested genes only; null for the others."""
    tested = d_rank_sum(spark, d).select("drug", "n_in", F.col("greater_p").alias("p"))
    eligible = tested.withColumn("eligible_p", F.when(F.col("n_in") >= LEAST_GENES, F.col("p")))
    return with_fdr(eligible, [], "eligible_p").select("drug", "n_in", "p", F.round("q", 6).alias("q"))


def d_gene_drug_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Place of each drug among a gene's drugs: by phase, then potency (missing last), then id; from one distributed sort."""
    best = records(spark, d).groupBy("gene", "drug").agg(F.max("max_phase").alias("phase"), F.max("potency").alias("potency"))
    key = F.struct(F.coalesce(-F.col("phase"), F.lit(99)).alias("p"), F.coalesce(-F.col("potency"), F.lit(99.0)).alias("a"), F.col("drug").alias("d"))
    placed = running_counts(best.select("gene", key.alias("at"), F.lit(1).cast("long").alias("n")), ["gene"], "at")
    return placed.select("gene", F.col("at.d").alias("drug"), (F.col("below") + 1).alias("place"), F.col("total").alias("n_drugs"))


def d_types(spark: SparkSession, d: str) -> DataFrame:
    """The one standard interaction type of each drug and gene, 'other' where records disagree or name no known type."""
    known = F.when(F.lower(F.trim("interaction_type")).isin(*STANDARD_TYPES), F.lower(F.trim("interaction_type"))).otherwise("other")
    typed = records(spark, d).withColumn("type", known).groupBy("drug", "gene").agg(F.count_distinct("type").alias("n_types"), F.min("type").alias("lo"))
    return typed.select("drug", "gene", "n_types", F.when(F.col("n_types") == 1, F.col("lo")).otherwise("other").alias("type"))


def d_least_affinity(spark: SparkSession, d: str) -> DataFrame:
    """Records whose affinity equals the smallest of their gene and affinity type."""
    r = records(spark, d).where("affinity_value > 0 and not isnan(affinity_value)").withColumn("kind", F.upper(F.trim("affinity_type")))
    least = r.groupBy("gene", "kind").agg(F.min("affinity_value").alias("least"))
    kept = salted_join(r.select("record_id", "gene", "kind", "affinity_value"), least, ["gene", "kind"], F.col("record_id"), salts=8)
    return kept.where("affinity_value = least").select("record_id", "gene", "kind", F.round("least", 6).alias("least"))


def d_gene_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Average rank of each distinct gene score."""
    return average_ranks(gene_scores(records(spark, d)), [], "score").select("score", "n", "total", "rank")


def d_permutation(spark: SparkSession, d: str) -> DataFrame:
    """Permutation test of each drug's genes by mean score, 10,000 draws a set size."""
    r = records(spark, d)
    t = permutation_test(gene_scores(r), r.select("drug", "gene"), "gene", "score", "drug")
    return t.select("drug", "n_in", F.round("mean", 6).alias("mean"), F.round("p", 6).alias("p"))


def d_class_regression(spark: SparkSession, d: str) -> DataFrame:
    """Regression of the drugs' rank-test z on membership in each class of every level with enough drugs, given the size of their gene sets."""
    tested = d_rank_sum(spark, d).select("drug", "z", "n_in")
    t = class_regression(tested, drug_classes(spark, d).select("drug", "class").distinct(), "drug", "z", "n_in", "class", LEAST_DRUGS)
    return t.select("class", "n_members", *[F.round(c, 5).alias(c) for c in ("beta", "se", "t")])


def d_three_pass(spark: SparkSession, d: str) -> DataFrame:
    """Compounds matched to the registry by InChIKey, then compound number, then plain name; ambiguous keys match nothing."""
    shape = lambda df, i: df.select(i, F.upper(F.trim("drug_inchikey")).alias("inchikey"), pubchem_cid(F.col("drug_pubchem_cid")).alias("cid"), plain_name(F.col("drug_name")).alias("name"))
    return tiered_match(shape(table(spark, d, "screen_compounds"), "compound_id"), shape(table(spark, d, "drug_registry"), "drug_id"), "compound_id", "drug_id", [("inchikey", "inchikey"), ("cid", "cid"), ("name", "name")])


def d_synonyms(spark: SparkSession, d: str) -> DataFrame:
    """Every plain name of the registry, with the tier it resolves in (preferred name, else synonym) or that it is ambiguous."""
    r = table(spark, d, "drug_registry")
    named = r.select("drug_id", plain_name(F.col("drug_name")).alias("name"), F.lit(1).alias("tier"))
    also = r.select("drug_id", F.explode("synonyms").alias("s")).select("drug_id", plain_name(F.col("s")).alias("name"), F.lit(2).alias("tier"))
    tiers = named.unionByName(also).where("name is not null").groupBy("name", "tier").agg(F.count_distinct("drug_id").alias("n"), F.min("drug_id").alias("drug_id"))
    first = tiers.groupBy("name").agg(F.min(F.struct("tier", "n", "drug_id")).alias("m"))
    return first.select("name", F.when(F.col("m.n") > 1, "ambiguous").when(F.col("m.tier") == 1, "preferred").otherwise("synonym").alias("outcome"), F.when(F.col("m.n") == 1, F.col("m.drug_id")).alias("drug_id"))


def d_directions(spark: SparkSession, d: str) -> DataFrame:
    """The one action of each drug and gene; none where its records name several."""
    r = records(spark, d).where("action_type is not null").withColumn("action", F.upper(F.trim("action_type"))).where("action <> ''")
    a = r.groupBy("drug", "gene").agg(F.count_distinct("action").alias("n_actions"), F.min("action").alias("lo"))
    return a.select("drug", "gene", "n_actions", F.when(F.col("n_actions") == 1, F.col("lo")).alias("action"))


def d_overlap(spark: SparkSession, d: str) -> DataFrame:
    """How many drugs are in which of: potent, late-phase, curated."""
    r = records(spark, d)
    return membership_patterns({"potent": r.where("potency >= 7"), "late": r.where("max_phase >= 3"), "curated": r.where("lower(source) like '%chembl%'")}, "drug")


def d_counts(spark: SparkSession, d: str) -> DataFrame:
    """Significance-style counts over the records."""
    c = F.col
    return list_counts(records(spark, d), {"with_potency": c("potency").isNotNull(), "potent": c("potency") >= 7, "late": c("max_phase") >= 3, "withdrawn": c("is_withdrawn"), "no_source": c("source").isNull()})


def d_missing_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Drugs of the registry without any record (anti-join), and those with (semi-join), per molecule type."""
    g = table(spark, d, "drug_registry").withColumn("drug", F.upper(F.trim("drug_chembl_id")))
    known = records(spark, d).select("drug").distinct()
    out = g.join(known, "drug", "left_anti").withColumn("side", F.lit("missing")).unionByName(g.join(known, "drug", "left_semi").withColumn("side", F.lit("known")))
    return out.groupBy("molecule_type", "side").agg(F.count("*").alias("n"))


def d_phase_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Drugs by molecule type and phase, phases as columns."""
    p = table(spark, d, "drug_registry").groupBy("molecule_type").pivot("max_phase", [0, 1, 2, 3, 4]).agg(F.count("drug_id"))
    return p.select("molecule_type", *[F.coalesce(F.col(str(i)), F.lit(0)).alias(f"phase_{i}") for i in range(5)])


QUERIES = {
    q.__name__: q
    for q in (
        d_merged, d_best_affinity, d_mechanism_affinity, d_gene_sets, d_set_file, d_list_file, d_identical_sets, d_rollup, d_classes, d_class_pairs, d_rank_sum, d_gene_ranks,
        d_permutation, d_class_rank_sum, d_class_permutation, d_class_regression, d_masked_fdr, d_gene_drug_ranks, d_types, d_least_affinity,
        d_three_pass, d_synonyms, d_directions, d_overlap, d_counts, d_missing_pairs, d_phase_pivot,
    )
}

_R = """r AS (SELECT *, upper(trim(drug_chembl_id)) AS drug, upper(trim(gene_symbol)) AS gene, CASE WHEN pchembl_value > 0 AND pchembl_value <= 15 AND NOT isnan(pchembl_value) THEN pchembl_value END AS potency
          FROM drug_targets WHERE trim(drug_chembl_id) <> '' AND trim(gene_symbol) <> '')"""
_SCALARS = ("mechanism_of_action", "action_type", "interaction_type", "potency", "affinity_value", "max_phase", "molecule_type", "confidence")
_LISTS = ("atc_codes", "indication_mesh", "source_pmids")
_FILLED = " + ".join([f"CAST({c} IS NOT NULL AS INT)" for c in _SCALARS] + [f"CAST(coalesce(len({c}), 0) > 0 AS INT)" for c in _LISTS])
_U = "(SELECT drug, gene, {c} AS x, record_id FROM r WHERE {c} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY drug, gene ORDER BY record_id) = 1)"
_SCORES = "g AS (SELECT gene, CAST(sum(CAST(round(potency * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS score FROM r WHERE potency IS NOT NULL GROUP BY gene)"
_RANKS = "k AS (SELECT gene, score, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rank FROM g)"
_CLASSES = """cls AS (SELECT DISTINCT drug, gene, left(code, l.n) AS class FROM (SELECT drug, gene, upper(trim(unnest(atc_codes))) AS code FROM r), (VALUES (1), (3), (4), (5)) l(n) WHERE length(code) >= l.n)"""


def _mann_whitney(group: str, members: str, ranks: str, item: str, score: str, mark: str = "") -> str:
    """CTEs up to tested<mark>: the rank-sum test of each group's items."""
    z = "CASE WHEN lo = hi OR n2 = 0 THEN 0.0 ELSE (u - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((n + 1) - ties / (CAST(n AS DOUBLE) * (n - 1)))) END"
    return f"""m{mark} AS (SELECT DISTINCT {group}, {item} FROM {members}),
        s{mark} AS (SELECT {group}, count(*) AS n1, sum(rank) AS rs, min({score}) AS lo, max({score}) AS hi FROM m{mark} JOIN {ranks} USING ({item}) GROUP BY {group}),
        t{mark} AS (SELECT count(*) AS n FROM {ranks}), ties{mark} AS (SELECT sum(c * c * c - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM {ranks} GROUP BY {score})),
        u{mark} AS (SELECT *, n - n1 AS n2, rs - n1 * (n1 + 1) / 2 AS u FROM s{mark}, t{mark}, ties{mark}), z{mark} AS (SELECT *, {z} AS z FROM u{mark}),
        tested{mark} AS (SELECT {group}, n1 AS n_in, n2 AS n_out, round(u, 3) AS u, round(CASE WHEN lo = hi OR n2 = 0 THEN 0.5 ELSE u / (n1 * n2) END, 6) AS auc, round(z, 6) AS z,
                         round(CASE WHEN z = 0 THEN 0.5 ELSE {normal_upper_sql("z")} END, 6) AS greater_p FROM z{mark})"""


_TESTED = f"{_R}, {_SCORES}, {_RANKS}, " + _mann_whitney("drug", "r", "k", "gene", "score")
_CID = "nullif(regexp_replace(regexp_replace(trim(drug_pubchem_cid), '\\.0+$', ''), '[^0-9]', '', 'g'), '')"
_NAME = "nullif(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]', '', 'g'), '')"
_UNIQUE = "(SELECT {c}, min(drug_id) AS drug_id FROM b WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(DISTINCT drug_id) = 1)"

SQL = {
    "d_merged": f"""WITH {_R},
        b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY drug, gene ORDER BY {_FILLED} DESC, record_id) = 1),
        n AS (SELECT drug, gene, count(*) AS n_records FROM r GROUP BY drug, gene),
        s AS (SELECT drug, gene, string_agg(x, ',' ORDER BY x) AS source FROM (SELECT DISTINCT drug, gene, trim(unnest(string_split(lower(source), ','))) AS x FROM r) WHERE x <> '' GROUP BY drug, gene),
        m AS (SELECT drug, gene, count(DISTINCT x) AS n_pmids FROM (SELECT drug, gene, unnest(source_pmids) AS x FROM r) GROUP BY drug, gene),
        a0 AS (SELECT drug, gene, record_id, unnest(atc_codes) AS x, generate_subscripts(atc_codes, 1) AS i FROM r),
        a1 AS (SELECT drug, gene, x, min(struct_pack(record_id := record_id, i := i)) AS f FROM a0 WHERE x IS NOT NULL GROUP BY drug, gene, x),
        a AS (SELECT drug, gene, string_agg(x, ',' ORDER BY f) AS codes FROM a1 GROUP BY drug, gene)
        SELECT drug, gene, b.record_id AS kept, n_records, coalesce(s.source, '') AS source,
               CASE WHEN len(list_intersect(string_split(coalesce(s.source, ''), ','), ['chembl', 'pdsp', 'dgidb'])) >= 2 THEN 'high' ELSE lower(trim(coalesce(b.confidence, f6.x))) END AS confidence, coalesce(b.mechanism_of_action, f1.x) AS mechanism_of_action, coalesce(b.action_type, f2.x) AS action_type,
               coalesce(b.interaction_type, f3.x) AS interaction_type, round(coalesce(b.potency, f4.x), 4) AS potency, coalesce(b.max_phase, f5.x) AS max_phase, coalesce(n_pmids, 0) AS n_pmids, coalesce(codes, '') AS atc_codes
        FROM b JOIN n USING (drug, gene) LEFT JOIN s USING (drug, gene) LEFT JOIN m USING (drug, gene) LEFT JOIN a USING (drug, gene)
        LEFT JOIN {_U.format(c="mechanism_of_action")} f1 USING (drug, gene) LEFT JOIN {_U.format(c="action_type")} f2 USING (drug, gene) LEFT JOIN {_U.format(c="interaction_type")} f3 USING (drug, gene)
        LEFT JOIN {_U.format(c="potency")} f4 USING (drug, gene) LEFT JOIN {_U.format(c="max_phase")} f5 USING (drug, gene)
        LEFT JOIN {_U.format(c="confidence")} f6 USING (drug, gene)""",
    "d_best_affinity": f"""WITH {_R} SELECT drug, gene_uniprot_id, record_id, round(potency, 6) AS potency, n FROM
        (SELECT *, count(*) OVER (PARTITION BY drug, gene_uniprot_id) AS n, row_number() OVER (PARTITION BY drug, gene_uniprot_id ORDER BY potency DESC, record_id) AS i FROM r WHERE potency IS NOT NULL AND gene_uniprot_id IS NOT NULL) WHERE i = 1""",
    "d_mechanism_affinity": f"""WITH {_R}, m AS (SELECT drug, gene, count(*) AS n_mechanism, max(max_phase) AS pm FROM r WHERE trim(action_type) <> '' GROUP BY drug, gene),
        a AS (SELECT drug, gene, count(*) AS n_affinity, max(potency) AS potency, max(max_phase) AS pa FROM r WHERE potency IS NOT NULL GROUP BY drug, gene)
        SELECT drug, gene, n_mechanism, n_affinity, round(potency, 6) AS potency, coalesce(pm, pa) AS phase, n_mechanism IS NOT NULL AS from_mechanism FROM m FULL JOIN a USING (drug, gene)""",
    "d_gene_sets": f"WITH {_R}, x AS (SELECT DISTINCT drug, gene FROM r) SELECT drug, count(*) AS n_items, string_agg(gene, ',' ORDER BY gene) AS genes FROM x GROUP BY drug HAVING count(*) >= {LEAST_GENES}",
    "d_set_file": f"WITH {_R}, x AS (SELECT DISTINCT drug, gene FROM r) SELECT drug, count(*) AS n_items, string_agg(gene, ',' ORDER BY gene) AS genes FROM x GROUP BY drug HAVING count(*) BETWEEN {LEAST_GENES} AND {MOST_GENES}",
    "d_list_file": f"WITH {_R}, x AS (SELECT DISTINCT drug, gene FROM r) SELECT drug, count(*) AS n_items, string_agg(gene, ',' ORDER BY gene) AS genes FROM x GROUP BY drug HAVING count(*) >= {LEAST_GENES}",
    "d_identical_sets": f"""WITH {_R}, x AS (SELECT DISTINCT drug, gene FROM r), s AS (SELECT drug, count(*) AS n_items, string_agg(gene, '|' ORDER BY gene) AS genes FROM x GROUP BY drug),
        m AS (SELECT drug, round(avg(potency), 6) AS mean FROM r GROUP BY drug),
        k AS (SELECT *, count(*) OVER (PARTITION BY genes) AS n_members, row_number() OVER (PARTITION BY genes ORDER BY coalesce(-mean, 0.0), drug) AS i FROM s JOIN m USING (drug))
        SELECT drug AS representative, n_members, n_items FROM k WHERE i = 1 AND n_members > 1""",
    "d_rollup": f"""WITH {_R}, b AS (SELECT drug, max(max_phase) AS max_phase, count(*) AS n_records, count(DISTINCT gene) AS n_genes, count(*) FILTER (is_withdrawn) AS n_withdrawn FROM r GROUP BY drug),
        i AS (SELECT drug, string_agg(x, ';' ORDER BY x) AS indications FROM (SELECT DISTINCT drug, unnest(indication_mesh) AS x FROM r) WHERE x IS NOT NULL GROUP BY drug),
        s AS (SELECT drug, string_agg(x, ',' ORDER BY x) AS sources FROM (SELECT DISTINCT drug, trim(unnest(string_split(lower(source), ','))) AS x FROM r) WHERE x <> '' GROUP BY drug)
        SELECT b.*, coalesce(indications, '') AS indications, coalesce(sources, '') AS sources FROM b LEFT JOIN i USING (drug) LEFT JOIN s USING (drug)""",
    "d_classes": f"""WITH c AS (SELECT drug_id, upper(trim(unnest(atc_codes))) AS code FROM drug_registry), x AS (SELECT DISTINCT drug_id, left(code, l.n) AS code FROM c, (VALUES (1), (3), (4), (5)) l(n) WHERE length(code) >= l.n)
        SELECT code, CASE length(code) WHEN 1 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 4 ELSE 0 END AS level, count(*) AS n_items FROM x GROUP BY code HAVING count(*) >= {LEAST_DRUGS}""",
    "d_class_pairs": f"""WITH {_R}, {_CLASSES},
        n AS (SELECT class, gene, count(*) AS n FROM cls GROUP BY class, gene), t AS (SELECT class, gene FROM n QUALIFY row_number() OVER (PARTITION BY class ORDER BY n DESC, gene) = 1)
        SELECT class, count(*) AS n_genes, CAST(sum(n) AS BIGINT) AS n_pairs, any_value(t.gene) AS top_gene FROM n JOIN t USING (class) GROUP BY class""",
    "d_rank_sum": f"WITH {_TESTED} SELECT * FROM tested",
    "d_class_rank_sum": f"""WITH {_TESTED}, {_CLASSES}, g2 AS (SELECT drug, z FROM tested), k2 AS (SELECT drug, z, rank() OVER (ORDER BY z) + (count(*) OVER (PARTITION BY z) - 1) / 2 AS rank FROM g2),
        {_mann_whitney("class", "(SELECT DISTINCT drug, class FROM cls)", "k2", "drug", "z", "2")} SELECT * FROM tested2 WHERE n_in >= 2 AND n_out >= 2""",
    "d_masked_fdr": f"""WITH {_TESTED}, e AS (SELECT drug, greater_p AS p FROM tested WHERE n_in >= {LEAST_GENES}),
        rk AS (SELECT drug, p, count(*) OVER (ORDER BY p RANGE UNBOUNDED PRECEDING) AS rank, count(*) OVER () AS total FROM e),
        qv AS (SELECT drug, min(least(p * total / rank, 1.0)) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING) AS q FROM rk)
        SELECT drug, n_in, greater_p AS p, round(q, 6) AS q FROM tested LEFT JOIN qv USING (drug)""",
    "d_gene_drug_ranks": f"""WITH {_R}, b AS (SELECT gene, drug, max(max_phase) AS phase, max(potency) AS potency FROM r GROUP BY gene, drug)
        SELECT gene, drug, row_number() OVER (PARTITION BY gene ORDER BY phase DESC NULLS LAST, potency DESC NULLS LAST, drug) AS place, count(*) OVER (PARTITION BY gene) AS n_drugs FROM b""",
    "d_types": f"""WITH {_R}, t AS (SELECT drug, gene, CASE WHEN lower(trim(interaction_type)) IN {STANDARD_TYPES} THEN lower(trim(interaction_type)) ELSE 'other' END AS type FROM r)
        SELECT drug, gene, count(DISTINCT type) AS n_types, CASE WHEN count(DISTINCT type) = 1 THEN min(type) ELSE 'other' END AS type FROM t GROUP BY drug, gene""",
    "d_least_affinity": f"""WITH {_R}, a AS (SELECT record_id, gene, upper(trim(affinity_type)) AS kind, affinity_value FROM r WHERE affinity_value > 0 AND NOT isnan(affinity_value) AND affinity_type IS NOT NULL)
        SELECT record_id, gene, kind, round(affinity_value, 6) AS least FROM a QUALIFY affinity_value = min(affinity_value) OVER (PARTITION BY gene, kind)""",
    # membership is freed of what the set's size and its logarithm explain, as is z; then one slope a class
    "d_class_regression": f"""WITH {_TESTED}, {_CLASSES},
        i AS (SELECT drug, z AS y, CAST(n_in AS DOUBLE) AS n, ln(n_in) AS l FROM tested WHERE n_in > 0),
        mean_ AS (SELECT avg(y) AS my, avg(n) AS mn, avg(l) AS ml, count(*) AS total, regr_slope(l, n) AS ln_, regr_slope(y, n) AS yn FROM i),
        j AS (SELECT drug, n - mn AS nc, l - ml - ln_ * (n - mn) AS lc, y - my - yn * (n - mn) AS yc FROM i, mean_),
        b AS (SELECT sum(yc * lc) / sum(lc * lc) AS yl FROM j), v AS (SELECT drug, nc, lc, yc - yl * lc AS yr FROM j, b),
        c AS (SELECT DISTINCT drug, class FROM cls), big AS (SELECT class, count(*) AS n_members FROM c JOIN i USING (drug) GROUP BY class HAVING count(*) >= {LEAST_DRUGS}),
        x AS (SELECT big.class, n_members, v.*, CASE WHEN c.drug IS NULL THEN 0.0 ELSE 1.0 END AS x FROM big CROSS JOIN v LEFT JOIN c ON c.drug = v.drug AND c.class = big.class),
        w AS (SELECT class, avg(x) AS mx, sum(x * nc) / sum(nc * nc) AS xn, sum(x * lc) / sum(lc * lc) AS xl FROM x GROUP BY class),
        e AS (SELECT class, n_members, yr, x - mx - xn * nc - xl * lc AS xr FROM x JOIN w USING (class)),
        f AS (SELECT class, n_members, sum(xr * yr) / sum(xr * xr) AS beta, sum(xr * xr) AS xx, sum(yr * yr) AS yy, count(*) AS total FROM e GROUP BY class, n_members),
        last_ AS (SELECT *, sqrt((yy - beta * beta * xx) / (total - 4) / xx) AS se FROM f)
        SELECT class, n_members, round(beta, 5) AS beta, round(se, 5) AS se, round(beta / se, 5) AS t FROM last_""",
    "d_gene_ranks": f"WITH {_R}, {_SCORES}, {_RANKS} SELECT score, count(*) AS n, (SELECT count(*) FROM g) AS total, any_value(rank) AS rank FROM k GROUP BY score",
    "d_three_pass": f"""WITH a AS (SELECT compound_id, upper(trim(drug_inchikey)) AS inchikey, {_CID} AS cid, {_NAME.format(c="drug_name")} AS name FROM screen_compounds),
        b AS (SELECT drug_id, upper(trim(drug_inchikey)) AS inchikey, {_CID} AS cid, {_NAME.format(c="drug_name")} AS name FROM drug_registry)
        SELECT compound_id, coalesce(i.drug_id, c.drug_id, n.drug_id) AS drug_id, CASE WHEN i.drug_id IS NOT NULL THEN 'inchikey' WHEN c.drug_id IS NOT NULL THEN 'cid' ELSE 'name' END AS tier
        FROM a LEFT JOIN {_UNIQUE.format(c="inchikey")} i USING (inchikey) LEFT JOIN {_UNIQUE.format(c="cid")} c USING (cid) LEFT JOIN {_UNIQUE.format(c="name")} n USING (name) WHERE coalesce(i.drug_id, c.drug_id, n.drug_id) IS NOT NULL""",
    "d_synonyms": f"""WITH a AS (SELECT drug_id, {_NAME.format(c="drug_name")} AS name, 1 AS tier FROM drug_registry UNION ALL SELECT drug_id, {_NAME.format(c="s")}, 2 FROM (SELECT drug_id, unnest(synonyms) AS s FROM drug_registry)),
        t AS (SELECT name, tier, count(DISTINCT drug_id) AS n, min(drug_id) AS drug_id FROM a WHERE name IS NOT NULL GROUP BY name, tier)
        SELECT name, CASE WHEN n > 1 THEN 'ambiguous' WHEN tier = 1 THEN 'preferred' ELSE 'synonym' END AS outcome, CASE WHEN n = 1 THEN drug_id END AS drug_id FROM t QUALIFY row_number() OVER (PARTITION BY name ORDER BY tier) = 1""",
    "d_directions": f"WITH {_R}, a AS (SELECT drug, gene, upper(trim(action_type)) AS action FROM r WHERE trim(action_type) <> '') SELECT drug, gene, count(DISTINCT action) AS n_actions, CASE WHEN count(DISTINCT action) = 1 THEN min(action) END AS action FROM a GROUP BY drug, gene",
    "d_overlap": f"""WITH {_R}, f AS (SELECT drug, max(CAST(coalesce(potency >= 7, false) AS INT)) AS potent, max(CAST(coalesce(max_phase >= 3, false) AS INT)) AS late, max(CAST(coalesce(lower(source) LIKE '%chembl%', false) AS INT)) AS curated FROM r GROUP BY drug)
        SELECT potent, late, curated, count(*) AS n, potent + late + curated AS degree FROM f WHERE potent + late + curated > 0 GROUP BY potent, late, curated""",
    "d_counts": f"WITH {_R} SELECT count(*) AS total, count(potency) AS with_potency, count(*) FILTER (potency >= 7) AS potent, count(*) FILTER (max_phase >= 3) AS late, count(*) FILTER (is_withdrawn) AS withdrawn, count(*) FILTER (source IS NULL) AS no_source FROM r",
    "d_missing_pairs": f"WITH {_R}, g AS (SELECT molecule_type, upper(trim(drug_chembl_id)) AS drug FROM drug_registry) SELECT molecule_type, CASE WHEN drug IN (SELECT drug FROM r) THEN 'known' ELSE 'missing' END AS side, count(*) AS n FROM g GROUP BY 1, 2",
    "d_phase_pivot": "SELECT molecule_type, " + ", ".join(f"count(*) FILTER (max_phase = {i}) AS phase_{i}" for i in range(5)) + " FROM drug_registry GROUP BY molecule_type",
}
