"""Queries over drugs and what is claimed of them: parents of salts, compound numbers, claims files, directions, potency calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.identifiers import pubchem_cid
from lociflow.operators.compounds import one_direction, parents_by_name, with_placeholder_id
from lociflow.operators.merging import source_names
from lociflow.operators.ranks import with_fdr
from lociflow.operators.skew import salted_join
from lociflow.plans.drugs import _CID, _R, _SCORES, _TESTED, d_rank_sum, gene_scores, records
from lociflow.session import shared_path, table
from lociflow.sources.genomic_text import interaction_claims, set_results

#: Which way a term of action points.
DIRECTIONS = {
    "agonist": "positive",
    "partial agonist": "positive",
    "opener": "positive",
    "antagonist": "negative",
    "blocker": "negative",
    "inhibitor": "negative",
    "degrader": "negative",
}
#: Least potency of a functional measurement (IC50, Ki) and of a binding constant (Kd) that is read as inhibition.
FUNCTIONAL, BINDING = 6.0, 7.5
#: Least phase and potency of records that count.
LEAST_PHASE, LEAST_POTENCY = 1, 5.0
#: Mean potency of genes that drive a drug's set.
DRIVING = 7.0


def d_parents(spark: SparkSession, d: str) -> DataFrame:
    """The registry's drug of every compound by the longest leading part of its name, with the drug's classes."""
    compounds, registry = table(spark, d, "screen_compounds"), table(spark, d, "drug_registry")
    found = parents_by_name(compounds, registry, "drug_name", "drug_id", "drug_name")
    classes = registry.select("drug_id", F.coalesce(F.array_join(F.array_sort("atc_codes"), ","), F.lit("")).alias("atc_codes"))
    named = found.join(classes, "drug_id")
    return salted_join(compounds.select("compound_id", "drug_name"), named, "drug_name", F.col("compound_id"), salts=8).select("compound_id", "drug_id", "n_dropped", "atc_codes")


def d_cid_filled(spark: SparkSession, d: str) -> DataFrame:
    """Each record's compound number, where it has none the smallest of its drug's, and all numbers of its drug in order."""
    cid = pubchem_cid(F.col("drug_pubchem_cid")).try_cast("long").alias("own")
    rows = records(spark, d).select("record_id", "drug", cid)
    registry = table(spark, d, "drug_registry").select(F.upper(F.trim("drug_chembl_id")).alias("drug"), cid)
    pairs = rows.select("drug", "own").unionByName(registry).where("drug is not null and own is not null").distinct()
    numbers = pairs.groupBy("drug").agg(F.min("own").alias("least"), F.array_sort(F.collect_list("own")).alias("all"))
    listed = numbers.select("drug", "least", F.array_join(F.transform("all", lambda x: x.cast("string")), ",").alias("cids"))
    joined = salted_join(rows, listed, "drug", F.col("record_id"), "left", salts=8)
    return joined.select("record_id", F.coalesce("own", "least").alias("cid"), F.coalesce("cids", F.lit("")).alias("cids"))


def d_claims_file(spark: SparkSession, d: str) -> DataFrame:
    """Records written as a tab file of claims and read again; only records of one source carry a drug id, others get a placeholder."""
    path = shared_path(spark, "texts")
    concept = F.when(F.lower(F.trim("source")) == "chembl", F.concat(F.lit("chembl:"), F.upper(F.trim("drug_chembl_id"))))
    claims = table(spark, d, "drug_targets").select(
        F.col("record_id").alias("claim_id"), F.regexp_replace("drug_name", "[\t\r\n]", " ").alias("drug_name"), concept.alias("drug_concept_id"),
        F.col("gene_symbol").alias("gene_name"), "interaction_type", F.array_join("source_pmids", ", ").alias("pmids"),
    )
    claims.write.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    read = with_placeholder_id(interaction_claims(spark, path), "drug_name", "DGIDB_", "claim_id", "placeholder")
    drug = F.coalesce("drug_chembl_id", "placeholder")
    return read.select(F.col("claim_id").cast("long").alias("record_id"), drug.alias("drug"), F.upper("gene_symbol").alias("gene"), F.coalesce(F.size("pmids"), F.lit(0)).alias("n_pmids"), "confidence")


def signed_pairs(spark: SparkSession, d: str) -> DataFrame:
    """(drug, gene, n_terms, direction) by all terms of the pair's records."""
    terms = F.concat_ws("|", "interaction_type", "action_type").alias("terms")
    return one_direction(records(spark, d).select("drug", "gene", terms), ["drug", "gene"], "terms", DIRECTIONS)


def d_signed_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The one direction of each drug and gene over all terms of its records, none where they disagree or any has none."""
    return signed_pairs(spark, d)


def d_compound_summary(spark: SparkSession, d: str) -> DataFrame:
    """Each drug's genes with their directions, and whether those are all positive, all negative, mixed or undirected."""
    up, down = F.count_if(F.col("direction") == "positive").alias("n_up"), F.count_if(F.col("direction") == "negative").alias("n_down")
    named = F.concat("gene", F.lit(" ("), "direction", F.lit(")"))
    s = signed_pairs(spark, d).groupBy("drug").agg(F.count("*").alias("n_genes"), up, down, F.array_join(F.array_sort(F.collect_list(named)), "; ").alias("genes"))
    mixed = (F.col("n_up") > 0) & (F.col("n_down") > 0)
    summary = F.when(mixed, "mixed").when(F.col("n_up") > 0, "positive").when(F.col("n_down") > 0, "negative").otherwise("undirected")
    return s.withColumn("summary", summary)


def d_potent_calls(spark: SparkSession, d: str) -> DataFrame:
    """Drugs and proteins read as inhibition from potency alone: by a functional measurement, by a binding constant, or both."""
    kind = F.upper(F.trim("affinity_type"))
    best = lambda kinds: F.max(F.when(kind.isin(*kinds), F.col("potency")))
    r = records(spark, d).where("gene_uniprot_id is not null and potency is not null")
    b = r.groupBy("drug", "gene_uniprot_id").agg(best(["IC50", "KI"]).alias("functional"), best(["KD"]).alias("binding"))
    passed = [F.coalesce(F.col("functional") >= FUNCTIONAL, F.lit(False)).alias("by_function"), F.coalesce(F.col("binding") >= BINDING, F.lit(False)).alias("by_binding")]
    calls = b.select("drug", "gene_uniprot_id", *passed, F.round("functional", 4).alias("functional"), F.round("binding", 4).alias("binding"))
    return calls.where("by_function or by_binding")


def nanomolar() -> Column:
    """An affinity in nM as a negative logarithm of mol/l; null for other units and values not above 0."""
    usable = (F.lower(F.trim("affinity_unit")) == "nm") & (F.col("affinity_value") > 0) & ~F.isnan("affinity_value")
    return F.when(usable, 9 - F.log10("affinity_value"))


def d_affinity_potency(spark: SparkSession, d: str) -> DataFrame:
    """Potency worked out from each record's affinity, whether the given one agrees, and the confidence that follows."""
    r = records(spark, d).withColumn("derived", nanomolar())
    agrees = F.abs(F.col("derived") - F.col("potency")) < 0.05
    level = F.when(F.col("derived").isNotNull(), "high").otherwise("medium")
    return r.select("record_id", F.round("derived", 4).alias("derived"), agrees.alias("agrees"), level.alias("level"))


def d_filter_levels(spark: SparkSession, d: str) -> DataFrame:
    """Each drug and gene with how many of its records pass phase and potency, and a level: mechanism and affinity, either, or none."""
    passes = (F.coalesce("max_phase", F.lit(0)) >= LEAST_PHASE) & (F.col("potency").isNull() | (F.col("potency") >= LEAST_POTENCY))
    mechanism = F.max((F.coalesce(F.trim("action_type"), F.lit("")) != "").cast("int"))
    affinity = F.max(F.col("potency").isNotNull().cast("int"))
    pairs = records(spark, d).groupBy("drug", "gene").agg(F.count_if(passes).alias("n_passed"), (mechanism + affinity).alias("known"))
    level = F.when(F.col("known") == 2, "high").when(F.col("known") == 1, "medium").otherwise("low")
    return pairs.select("drug", "gene", "n_passed", level.alias("level"))


def d_driving_genes(spark: SparkSession, d: str) -> DataFrame:
    """Each drug's scored genes and those of a high mean score, best first."""
    r = records(spark, d)
    scored = r.select("drug", "gene").distinct().join(gene_scores(r), "gene")
    drives = F.when(F.col("score") >= DRIVING, F.struct((-F.col("score")).alias("s"), F.col("gene").alias("gene")))
    sets = scored.groupBy("drug").agg(F.count("*").alias("n_scored"), F.array_sort(F.collect_list(drives)).alias("best"))
    return sets.select("drug", "n_scored", F.size("best").alias("n_driving"), F.array_join(F.transform("best", lambda x: x["gene"]), ",").alias("driving"))


def d_source_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Whether the sources of a drug and gene agree on its direction: how many have one, and the status of the pair."""
    terms = F.concat_ws("|", "interaction_type", "action_type").alias("terms")
    claims = records(spark, d).select("drug", "gene", F.explode(source_names(F.col("source"))).alias("by"), terms)
    each = one_direction(claims, ["drug", "gene", "by"], "terms", DIRECTIONS)
    way = F.when(F.col("direction") != "none", F.col("direction"))
    pairs = each.groupBy("drug", "gene").agg(F.count("*").alias("n_sources"), F.count(way).alias("n_directed"), F.min(way).alias("lo"), F.max(way).alias("hi"))
    status = F.when(F.col("n_sources") < 2, "unavailable").when(F.col("n_directed") < 2, "untestable").when(F.col("lo") == F.col("hi"), "concordant").otherwise("discordant")
    return pairs.select("drug", "gene", "n_sources", "n_directed", status.alias("status"))


def d_results_file(spark: SparkSession, d: str) -> DataFrame:
    """Rank tests of the drugs written as a table of set tests, with names cut to 8 letters, and read again with false discovery rates."""
    path = shared_path(spark, "texts")
    tested = d_rank_sum(spark, d).select(F.concat_ws("  ", F.left("drug", F.lit(8)), "n_in", "z", F.lit("NA"), F.col("greater_p").cast("string"), "drug").alias("value"))
    head = spark.range(1).select(F.lit("VARIABLE  NGENES  BETA  SE  P  FULL_NAME").alias("value"))
    tested.unionByName(head).write.text(path)
    results = with_fdr(set_results(spark, path), [], "p")
    return results.select(F.col("set_id").alias("drug"), "n_genes", F.round("beta", 6).alias("z"), "p", F.round("q", 6).alias("q"))


QUERIES = {
    q.__name__: q
    for q in (d_parents, d_cid_filled, d_claims_file, d_signed_pairs, d_compound_summary, d_potent_calls, d_affinity_potency, d_filter_levels, d_driving_genes, d_source_agreement, d_results_file)
}

_WORDS = "list_filter(regexp_split_to_array(lower(strip_accents({c})), '[^a-z0-9]+'), lambda w: w <> '')"
_SLUG = "trim(regexp_replace(strip_accents(upper(name)), '[^A-Z0-9]+', '_', 'g'), '_')"
_WAY = "CASE " + " ".join(f"WHEN term = '{t}' THEN '{w}'" for t, w in DIRECTIONS.items()) + " ELSE 'none' END"
_SIGNED = f"""{_R}, e AS (SELECT DISTINCT drug, gene, trim(unnest(string_split(lower(concat_ws('|', interaction_type, action_type)), '|'))) AS term FROM r),
    sp AS (SELECT drug, gene, count(*) AS n_terms, CASE WHEN count(DISTINCT {_WAY}) = 1 THEN min({_WAY}) ELSE 'none' END AS direction FROM e WHERE term <> '' GROUP BY drug, gene)"""

SQL = {
    "d_parents": f"""WITH p AS (SELECT drug_id, atc_codes, array_to_string({_WORDS.format(c="drug_name")}, '') AS key FROM drug_registry),
        u AS (SELECT key, min(drug_id) AS drug_id, count(DISTINCT drug_id) AS n FROM p WHERE key <> '' GROUP BY key),
        c AS (SELECT compound_id, {_WORDS.format(c="drug_name")} AS w FROM screen_compounds WHERE drug_name IS NOT NULL),
        x AS (SELECT compound_id, len(w) AS n_all, l, array_to_string(w[1:l], '') AS key FROM (SELECT *, unnest(range(1, len(w) + 1)) AS l FROM c)),
        b AS (SELECT * FROM x JOIN u USING (key) QUALIFY row_number() OVER (PARTITION BY compound_id ORDER BY l DESC) = 1)
        SELECT compound_id, b.drug_id, n_all - l AS n_dropped, coalesce(array_to_string(list_sort(g.atc_codes), ','), '') AS atc_codes FROM b JOIN drug_registry g USING (drug_id) WHERE n = 1""",
    "d_cid_filled": f"""WITH {_R}, own AS (SELECT record_id, drug, TRY_CAST({_CID} AS BIGINT) AS own FROM r),
        pr AS (SELECT drug, own FROM own UNION SELECT upper(trim(drug_chembl_id)), TRY_CAST({_CID} AS BIGINT) FROM drug_registry),
        n AS (SELECT drug, min(own) AS least, string_agg(CAST(own AS VARCHAR), ',' ORDER BY own) AS cids FROM pr WHERE drug IS NOT NULL AND own IS NOT NULL GROUP BY drug)
        SELECT record_id, coalesce(own, least) AS cid, coalesce(cids, '') AS cids FROM own LEFT JOIN n USING (drug)""",
    "d_claims_file": f"""WITH c AS (SELECT record_id, trim(regexp_replace(drug_name, '[\t\r\n]', ' ', 'g')) AS name, upper(trim(gene_symbol)) AS gene, list_filter(list_transform(source_pmids, lambda x: trim(x)), lambda x: x <> '') AS pmids,
            CASE WHEN lower(trim(source)) = 'chembl' THEN nullif(regexp_extract(upper(drug_chembl_id), 'CHEMBL[0-9]+'), '') END AS id FROM drug_targets WHERE trim(drug_name) <> '' AND trim(gene_symbol) <> ''),
        s AS (SELECT *, {_SLUG} AS slug FROM c), t AS (SELECT slug, count(DISTINCT name) AS n FROM s GROUP BY slug)
        SELECT record_id, coalesce(id, 'DGIDB_' || slug || CASE WHEN n > 1 THEN '_' || left(md5(name), 8) ELSE '' END) AS drug, gene, coalesce(len(pmids), 0) AS n_pmids,
               CASE WHEN coalesce(len(pmids), 0) > 0 THEN 'medium' ELSE 'low' END AS confidence FROM s JOIN t USING (slug)""",
    "d_signed_pairs": f"WITH {_SIGNED} SELECT * FROM sp",
    "d_compound_summary": f"""WITH {_SIGNED}, s AS (SELECT drug, count(*) AS n_genes, count(*) FILTER (direction = 'positive') AS n_up, count(*) FILTER (direction = 'negative') AS n_down,
            string_agg(gene || ' (' || direction || ')', '; ' ORDER BY gene || ' (' || direction || ')') AS genes FROM sp GROUP BY drug)
        SELECT *, CASE WHEN n_up > 0 AND n_down > 0 THEN 'mixed' WHEN n_up > 0 THEN 'positive' WHEN n_down > 0 THEN 'negative' ELSE 'undirected' END AS summary FROM s""",
    "d_potent_calls": f"""WITH {_R}, b AS (SELECT drug, gene_uniprot_id, max(potency) FILTER (upper(trim(affinity_type)) IN ('IC50', 'KI')) AS f, max(potency) FILTER (upper(trim(affinity_type)) = 'KD') AS k
            FROM r WHERE gene_uniprot_id IS NOT NULL AND potency IS NOT NULL GROUP BY drug, gene_uniprot_id)
        SELECT drug, gene_uniprot_id, coalesce(f >= {FUNCTIONAL}, false) AS by_function, coalesce(k >= {BINDING}, false) AS by_binding, round(f, 4) AS functional, round(k, 4) AS binding
        FROM b WHERE coalesce(f >= {FUNCTIONAL}, false) OR coalesce(k >= {BINDING}, false)""",
    "d_affinity_potency": f"""WITH {_R}, a AS (SELECT record_id, potency, CASE WHEN lower(trim(affinity_unit)) = 'nm' AND affinity_value > 0 AND NOT isnan(affinity_value) THEN 9 - log10(affinity_value) END AS x FROM r)
        SELECT record_id, round(x, 4) AS derived, abs(x - potency) < 0.05 AS agrees, CASE WHEN x IS NOT NULL THEN 'high' ELSE 'medium' END AS level FROM a""",
    "d_filter_levels": f"""WITH {_R}, p AS (SELECT drug, gene, count(*) FILTER (coalesce(max_phase, 0) >= {LEAST_PHASE} AND (potency IS NULL OR potency >= {LEAST_POTENCY})) AS n_passed,
            CAST(bool_or(coalesce(trim(action_type), '') <> '') AS INT) + CAST(bool_or(potency IS NOT NULL) AS INT) AS known FROM r GROUP BY drug, gene)
        SELECT drug, gene, n_passed, CASE known WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS level FROM p""",
    "d_driving_genes": f"""WITH {_R}, {_SCORES}, m AS (SELECT DISTINCT drug, gene FROM r)
        SELECT drug, count(*) AS n_scored, count(*) FILTER (score >= {DRIVING}) AS n_driving, coalesce(string_agg(gene, ',' ORDER BY score DESC, gene) FILTER (score >= {DRIVING}), '') AS driving
        FROM m JOIN g USING (gene) GROUP BY drug""",
    "d_source_agreement": f"""WITH {_R}, e AS (SELECT DISTINCT drug, gene, b AS by_, trim(unnest(string_split(terms, '|'))) AS term FROM
            (SELECT drug, gene, trim(unnest(string_split(lower(source), ','))) AS b, lower(concat_ws('|', interaction_type, action_type)) AS terms FROM r)),
        o AS (SELECT drug, gene, by_, CASE WHEN count(DISTINCT {_WAY}) = 1 THEN nullif(min({_WAY}), 'none') END AS way FROM e WHERE term <> '' AND by_ <> '' GROUP BY drug, gene, by_)
        SELECT drug, gene, count(*) AS n_sources, count(way) AS n_directed,
               CASE WHEN count(*) < 2 THEN 'unavailable' WHEN count(way) < 2 THEN 'untestable' WHEN count(DISTINCT way) = 1 THEN 'concordant' ELSE 'discordant' END AS status FROM o GROUP BY drug, gene""",
    "d_results_file": f"""WITH {_TESTED}, rk AS (SELECT drug, greater_p AS p, count(*) OVER (ORDER BY greater_p RANGE UNBOUNDED PRECEDING) AS rank, count(*) OVER () AS total FROM tested),
        qv AS (SELECT drug, min(least(p * total / rank, 1.0)) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING) AS q FROM rk)
        SELECT drug, n_in AS n_genes, z, greater_p AS p, round(q, 6) AS q FROM tested JOIN qv USING (drug)""",
}
