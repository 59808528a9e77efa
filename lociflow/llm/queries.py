"""Registered queries of the training-corpus problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.llm.fusion import retained_values, source_quality, survivors
from lociflow.llm.matching import match_drugs, rule_report
from lociflow.llm.mixing import mix_report, mixed_documents
from lociflow.llm.percentiles import merge_states, percentiles, value_state
from lociflow.llm.spam import find_spam, spam_signs
from lociflow.llm.tokens import encode_documents, token_counts
from lociflow.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The record whose value survives, per duplicate group and field."""
    return survivors(table(spark, d, "drug_targets"), table(spark, d, "drug_sources")).select("group_id", "field", "record_id")


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """All values the latent truth model judges true."""
    return retained_values(table(spark, d, "drug_targets"), table(spark, d, "drug_sources"))


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    """Surviving values with the model's posterior."""
    return survivors(table(spark, d, "drug_targets"), table(spark, d, "drug_sources"))


def p1_quality(spark: SparkSession, d: str) -> DataFrame:
    """Sensitivity and specificity of every source in every field."""
    return source_quality(table(spark, d, "drug_targets"), table(spark, d, "drug_sources"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a registered drug and a screened compound that are the same active substance."""
    return match_drugs(table(spark, d, "drug_registry"), table(spark, d, "screen_compounds")).select("drug_id", "compound_id")


def p3_matches(spark: SparkSession, d: str) -> DataFrame:
    """The matches with their rule and confidence."""
    return match_drugs(table(spark, d, "drug_registry"), table(spark, d, "screen_compounds"))


def p3_rules(spark: SparkSession, d: str) -> DataFrame:
    """What each rule of the cascade found, how its labelled pairs came out, and what it returned."""
    return rule_report(table(spark, d, "drug_registry"), table(spark, d, "screen_compounds"))


def p5_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of the valid p values of every study and batch date, and (batch_date null) of every study.

    The whole study's come from its days' states, added up; all are read from one sort.
    """
    days = value_state(table(spark, d, "gwas_variants"), "study_id", "p", "batch_date")
    # the level tells a null day, which the name leaves out, from the whole study
    name = lambda level, *fields: F.to_json(F.struct(F.lit(level).alias("l"), *fields)).alias("grp")
    daily = days.select(name("day", F.col("grp").alias("s"), F.col("day").cast("string").alias("d")), "value", "n")
    whole = merge_states(days).select(name("all", F.col("grp").alias("s")), "value", "n")
    found = percentiles(daily.unionByName(whole)).withColumn("g", F.from_json("grp", "s string, d string"))
    digits = F.round(-F.log10(F.when(F.col("value") > 0, F.col("value"))), 6)
    return found.select(F.col("g.s").alias("study_id"), F.col("g.d").alias("batch_date"), "q", "n", F.round("value", 9).alias("p_value"), digits.alias("neglog10_p"))


def p5_medians(spark: SparkSession, d: str) -> DataFrame:
    """The median of every study's valid p values."""
    return percentiles(value_state(table(spark, d, "gwas_variants"), "study_id", "p"), (0.5,)).select(F.col("grp").alias("study_id"), "n", F.round("value", 12).alias("median_p"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every whole text."""
    return encode_documents(table(spark, d, "documents"))


def p7_counts(spark: SparkSession, d: str) -> DataFrame:
    """Number of tokens of every whole text."""
    return token_counts(table(spark, d, "documents"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mixed corpus: one row per document and copy."""
    return mixed_documents(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share of every source."""
    return mix_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages of strung-together keywords, links or product tags."""
    return find_spam(table(spark, d, "documents"))


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    """Mean PMI and the shares of incoherent and of over-repeated pairs of every document, and the verdict."""
    signs = spam_signs(table(spark, d, "documents"))
    rounded = [F.round(c, 4).alias(c) for c in ("pmi", "incoherent", "repeated")]
    return signs.select("doc_id", "n_pairs", *rounded, "suspected", "spam")


QUERIES = {q.__name__: q for q in (p1_found, p1_survivors, p1_values, p1_quality, p3_found, p3_matches, p3_rules, p5_percentiles, p5_medians, p7_ids, p7_counts, p8_mix, p8_shares, p9_found, p9_scores)}
_VALID_P = "p IS NOT NULL AND NOT isnan(p) AND p BETWEEN 0 AND 1"
_AT = "[0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]"

SQL: dict[str, str] = {
    "p1_found": """
        WITH named AS (
          SELECT record_id, upper(trim(drug_chembl_id)) AS drug, upper(trim(gene_symbol)) AS gene, updated_at,
                 CASE WHEN upper(trim(confidence)) IN ('HIGH', 'HI', 'H') THEN 1 WHEN upper(trim(confidence)) IN ('MEDIUM', 'MED', 'MED.', 'M') THEN 2
                      WHEN upper(trim(confidence)) IN ('LOW', 'LO', 'L') THEN 3 ELSE 4 END AS conf,
                 pchembl_value > 0 AND pchembl_value <= 15 AND NOT isnan(pchembl_value) AS real_p,
                 upper(trim(mechanism_of_action)) NOT IN ('', '-', '--', 'NA', 'N/A', 'N.A.', 'NONE', 'NULL', 'NAN', 'UNKNOWN', 'UNSPECIFIED', 'NOT AVAILABLE', 'NOT KNOWN', 'N.D.', 'ND', 'TBD', '?', '.', 'MISSING', 'NIL') AS real_m,
                 source
          FROM drug_targets WHERE trim(drug_chembl_id) <> '' AND trim(gene_symbol) <> ''),
        parts AS (SELECT record_id, lower(trim(unnest(string_split(source, ',')))) AS name FROM named),
        trust AS (SELECT record_id, min(trust_rank) AS rank FROM parts JOIN drug_sources s ON s.source = parts.name GROUP BY record_id),
        rows_ AS (SELECT n.*, t.rank, min(record_id) OVER g AS group_id, count(*) OVER g AS size
                  FROM named n LEFT JOIN trust t USING (record_id) WINDOW g AS (PARTITION BY drug, gene)),
        long AS (
          SELECT *, 'confidence' AS field FROM rows_ WHERE conf < 4
          UNION ALL SELECT *, 'source' FROM rows_ WHERE rank IS NOT NULL
          UNION ALL SELECT *, 'pchembl_value' FROM rows_ WHERE real_p
          UNION ALL SELECT *, 'mechanism_of_action' FROM rows_ WHERE real_m)
        SELECT group_id, field, record_id FROM long WHERE size > 1
        QUALIFY row_number() OVER (PARTITION BY group_id, field ORDER BY conf, rank NULLS LAST, updated_at DESC NULLS LAST, record_id) = 1""",
    "p5_percentiles": f"""
        WITH v AS (SELECT study_id, CAST(batch_date AS VARCHAR) AS batch_date, p FROM gwas_variants WHERE {_VALID_P}),
        g AS (SELECT study_id, batch_date, count(*) AS n, quantile_cont(p, {_AT}) AS qs FROM v GROUP BY study_id, batch_date
              UNION ALL SELECT study_id, NULL, count(*), quantile_cont(p, {_AT}) FROM v GROUP BY study_id),
        u AS (SELECT study_id, batch_date, n, unnest({_AT}) AS q, unnest(qs) AS value FROM g)
        SELECT study_id, batch_date, CAST(q AS DOUBLE) AS q, n, round(value, 9) AS p_value,
               round(-log10(CASE WHEN value > 0 THEN value END), 6) AS neglog10_p FROM u""",
    "p5_medians": f"SELECT study_id, count(*) AS n, round(quantile_cont(p, 0.5), 12) AS median_p FROM gwas_variants WHERE {_VALID_P} GROUP BY study_id",
}
