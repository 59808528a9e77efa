"""Queries over the gene identifiers of drug-target records: kinds, conversion, gaps, files and matches by tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.identifiers import versionless
from lociflow.operators.gene_ids import KINDS, column_kind, filled_ids, full_records, pair_index, tiered_targets
from lociflow.session import shared_path, table
from lociflow.sources.genomic_text import gene_info

#: The records' columns of each kind.
COLUMNS = {"symbol": "gene_symbol", "ensembl": "gene_ensembl_id", "uniprot": "gene_uniprot_id", "entrez": "gene_entrez_id"}
#: Fixed value: the taxonomy number of humans.
HUMAN = "9606"


def identified(spark: SparkSession, d: str) -> DataFrame:
    """(record_id, one clean text a kind, measured): blank ids are null, Ensembl ids have no version."""
    clean = {k: F.nullif(F.upper(F.trim(F.col(c).cast("string"))), F.lit("")).alias(k) for k, c in COLUMNS.items()}
    clean["ensembl"] = versionless(clean["ensembl"]).alias("ensembl")
    measured = F.coalesce((F.col("pchembl_value") > 0) & ~F.isnan("pchembl_value"), F.lit(False)).alias("measured")
    return table(spark, d, "drug_targets").select("record_id", *[clean[k] for k in KINDS], measured)


def g_id_kinds(spark: SparkSession, d: str) -> DataFrame:
    """What kind of id each gene column of the records holds."""
    kinds = table(spark, d, "drug_targets").agg(*[column_kind(F.col(c)).alias(k) for k, c in COLUMNS.items()])
    return kinds.unpivot([], list(KINDS), "field", "kind").select("field", "kind")


def g_full_records(spark: SparkSession, d: str) -> DataFrame:
    """All ids of every id of every kind, by the pairs that the records give."""
    rows = identified(spark, d)
    index = pair_index(rows, "record_id")
    out = None
    for kind in KINDS:
        found = full_records(rows.select(F.col(kind).alias("id")), kind, index).withColumn("kind", F.lit(kind))
        out = found if out is None else out.unionByName(found)
    return out


def g_filled_ids(spark: SparkSession, d: str) -> DataFrame:
    """Every record with the ids it lacks filled by its symbol, and how many were."""
    rows = identified(spark, d).drop("measured")
    filled = filled_ids(rows.withColumn("before", known_ids()), "symbol", "record_id", pair_index(rows, "record_id"))
    return filled.select("record_id", *KINDS, (known_ids() - F.col("before")).alias("n_filled"))


def known_ids() -> Column:
    return sum((F.col(k).isNotNull().cast("int") for k in KINDS), F.lit(0))


def g_info_file(spark: SparkSession, d: str) -> DataFrame:
    """The records' genes written as a gene information file and read again: symbol and Ensembl id of each Entrez id."""
    path = shared_path(spark, "texts")
    rows = identified(spark, d).where("entrez is not null")
    cross = F.concat(F.lit("MIM:1|Ensembl:"), F.col("ensembl"))
    line = F.concat_ws("\t", F.lit(HUMAN), "entrez", F.coalesce("symbol", F.lit("-")), F.lit("-"), F.lit("-"), F.coalesce(cross, F.lit("-")))
    rows.select(line.alias("value")).distinct().write.text(path)
    return gene_info(spark, path, HUMAN)


def g_tiered_targets(spark: SparkSession, d: str) -> DataFrame:
    """Genes of measured records matched to the records without a measurement, by Ensembl, Entrez, UniProt, then symbol."""
    rows = identified(spark, d)
    firsts = [F.min(F.when(F.col(k).isNotNull(), F.struct("record_id", k))).alias(f"m_{k}") for k in KINDS if k != "symbol"]
    genes = rows.where("measured and symbol is not null").groupBy("symbol").agg(*firsts)
    genes = genes.select(F.col("symbol").alias("gene"), "symbol", *[F.col(f"m_{k}.{k}").alias(k) for k in KINDS if k != "symbol"])
    return tiered_targets(genes, rows.where("not measured"))


QUERIES = {q.__name__: q for q in (g_id_kinds, g_full_records, g_filled_ids, g_info_file, g_tiered_targets)}

_CLEAN = ", ".join(f"nullif(upper(trim(CAST({c} AS VARCHAR))), '') AS {k}" for k, c in COLUMNS.items())
_ROWS = f"""c AS (SELECT record_id, {_CLEAN}, coalesce(pchembl_value > 0 AND NOT isnan(pchembl_value), false) AS measured FROM drug_targets),
    r AS (SELECT * REPLACE (regexp_replace(ensembl, '\\.[0-9]+$', '') AS ensembl) FROM c)"""
_FIRST = "(SELECT {a} AS k, arg_min({b}, record_id) AS v FROM r WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a})"


def _pairs() -> str:
    names = {"es": ("ensembl", "symbol"), "eu": ("ensembl", "uniprot"), "ez": ("ensembl", "entrez"), "se": ("symbol", "ensembl"), "sz": ("symbol", "entrez"), "ue": ("uniprot", "ensembl"), "zs": ("entrez", "symbol"), "ze": ("entrez", "ensembl")}
    return ", ".join(f"{n} AS {_FIRST.format(a=a, b=b)}" for n, (a, b) in names.items())


_INDEX = f"{_ROWS}, {_pairs()}"
_BY_SYMBOL = """SELECT i.id, i.id AS symbol, se.v AS ensembl, eu.v AS uniprot, sz.v AS entrez FROM (SELECT DISTINCT symbol AS id FROM r WHERE symbol IS NOT NULL) i
    LEFT JOIN se ON se.k = i.id LEFT JOIN sz ON sz.k = i.id LEFT JOIN eu ON eu.k = se.v"""
_RECORDS = f"""SELECT 'symbol' AS kind, * FROM ({_BY_SYMBOL})
    UNION ALL SELECT 'ensembl', i.id, coalesce(es.v, zs.v), i.id, eu.v, ez.v FROM (SELECT DISTINCT ensembl AS id FROM r WHERE ensembl IS NOT NULL) i
        LEFT JOIN es ON es.k = i.id LEFT JOIN eu ON eu.k = i.id LEFT JOIN ez ON ez.k = i.id LEFT JOIN zs ON zs.k = ez.v
    UNION ALL SELECT 'uniprot', i.id, es.v, ue.v, i.id, ez.v FROM (SELECT DISTINCT uniprot AS id FROM r WHERE uniprot IS NOT NULL) i
        LEFT JOIN ue ON ue.k = i.id LEFT JOIN es ON es.k = ue.v LEFT JOIN ez ON ez.k = ue.v
    UNION ALL SELECT 'entrez', i.id, zs.v, coalesce(ze.v, se.v), eu.v, i.id FROM (SELECT DISTINCT entrez AS id FROM r WHERE entrez IS NOT NULL) i
        LEFT JOIN zs ON zs.k = i.id LEFT JOIN ze ON ze.k = i.id LEFT JOIN se ON se.k = zs.v LEFT JOIN eu ON eu.k = coalesce(ze.v, se.v)"""
_KIND = """SELECT '{k}' AS field, CASE WHEN avg(CAST(regexp_matches(trim(CAST({c} AS VARCHAR)), '^ENS[A-Z]*G[0-9]+') AS DOUBLE)) > 0.9 THEN 'ensembl'
    WHEN avg(CAST(regexp_matches(trim(CAST({c} AS VARCHAR)), '^[0-9]+$') AS DOUBLE)) > 0.9 THEN 'entrez' ELSE 'mixed' END AS kind FROM drug_targets"""
_OWN = " WHERE t.ensembl IS NULL OR t.ensembl = g.ensembl"
_TIER = "SELECT {i} AS i, '{k}' AS tier, g.gene, t.symbol, t.ensembl, t.uniprot, t.entrez FROM g JOIN t ON g.{k} = t.{k}"

SQL = {
    "g_id_kinds": " UNION ALL ".join(_KIND.format(k=k, c=c) for k, c in COLUMNS.items()),
    "g_full_records": f"WITH {_INDEX} SELECT id, symbol, ensembl, uniprot, entrez, kind FROM ({_RECORDS})",
    "g_filled_ids": f"""WITH {_INDEX}, b AS ({_BY_SYMBOL})
        SELECT record_id, r.symbol, coalesce(r.ensembl, b.ensembl) AS ensembl, coalesce(r.uniprot, b.uniprot) AS uniprot, coalesce(r.entrez, b.entrez) AS entrez,
               CAST(r.ensembl IS NULL AND b.ensembl IS NOT NULL AS INT) + CAST(r.uniprot IS NULL AND b.uniprot IS NOT NULL AS INT) + CAST(r.entrez IS NULL AND b.entrez IS NOT NULL AS INT) AS n_filled
        FROM r LEFT JOIN b ON b.id = r.symbol""",
    "g_info_file": f"""WITH {_ROWS} SELECT CAST(entrez AS BIGINT) AS entrez, min(symbol) AS symbol, min(ensembl) AS ensembl FROM r WHERE entrez IS NOT NULL GROUP BY entrez""",
    "g_tiered_targets": f"""WITH {_ROWS}, g AS (SELECT symbol AS gene, symbol, arg_min(ensembl, record_id) FILTER (ensembl IS NOT NULL) AS ensembl, arg_min(uniprot, record_id) FILTER (uniprot IS NOT NULL) AS uniprot,
            arg_min(entrez, record_id) FILTER (entrez IS NOT NULL) AS entrez FROM r WHERE measured AND symbol IS NOT NULL GROUP BY symbol),
        t AS (SELECT symbol, ensembl, uniprot, entrez FROM r WHERE NOT measured),
        one AS (SELECT g.gene FROM g JOIN t ON g.symbol = t.symbol GROUP BY g.gene HAVING count(DISTINCT t.ensembl) <= 1),
        hits AS ({_TIER.format(i=0, k="ensembl")} UNION ALL {_TIER.format(i=1, k="entrez")}{_OWN} UNION ALL {_TIER.format(i=2, k="uniprot")}{_OWN}
            UNION ALL {_TIER.format(i=3, k="symbol")} WHERE g.gene IN (SELECT gene FROM one)),
        best AS (SELECT * FROM hits QUALIFY i = min(i) OVER (PARTITION BY gene))
        SELECT gene, tier, count(*) AS n_rows, count(DISTINCT (symbol, ensembl, uniprot, entrez)) AS n_keys FROM best GROUP BY gene, tier""",
}
