"""Readers of gene sets, white-space tables, gene locations, id pairs and correlation files, as lazy all-text scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.identifiers import chembl_id, text_list


def text_lines(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    """(value) of the lines that are neither blank nor comments; gzip by suffix."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "[\r\n]+$", "").alias("value"))
    return lines.where((F.trim("value") != "") & ~F.col("value").startswith(comment))


def white_space_table(spark: SparkSession, path: str, columns: dict[str, str], comment: str = "#") -> DataFrame:
    """Columns by name from a table split at white space, whose header names them; text that doesn't cast is null.

    Every file's header is the line that has all the names. Lines with another number of fields are left out.
    """
    fields = text_lines(spark, path, comment).select(F.split(F.trim("value"), r"\s+").alias("f"))
    heads = fields.where(F.forall(F.array(*map(F.lit, columns)), lambda c: F.array_contains("f", c))).limit(1).collect()
    if not heads:
        raise ValueError(f"no header with {', '.join(columns)}")
    names = heads[0].f
    rows = fields.where((F.size("f") == len(names)) & (F.col("f") != F.array(*map(F.lit, names))))
    return rows.select(*[F.col("f")[names.index(c)].try_cast(kind).alias(c) for c, kind in columns.items()])


def bim_variants(spark: SparkSession, path: str) -> DataFrame:
    """(chr, snp, pos, a1, a2) of a headerless panel file of six columns; chromosomes without chr, alleles in upper case.

    Lines with another number of fields or without a whole position are left out.
    """
    f = text_lines(spark, path).select(F.split(F.trim("value"), r"\s+").alias("f")).where(F.size("f") == 6)
    chromosome = F.regexp_replace(F.upper(F.col("f")[0]), "^CHR", "")
    rows = f.select(chromosome.alias("chr"), F.col("f")[1].alias("snp"), F.col("f")[3].try_cast("long").alias("pos"), F.upper(F.col("f")[4]).alias("a1"), F.upper(F.col("f")[5]).alias("a2"))
    return rows.where("pos is not null")


def allele_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """(snp, a1, a2, maf) of a white-space frequency file CHR SNP A1 A2 MAF NCHROBS, one row a variant; 0, 1 and NA are no frequencies."""
    f = white_space_table(spark, path, {"SNP": "string", "A1": "string", "A2": "string", "MAF": "double"}).where("MAF > 0 and MAF < 1")
    return f.groupBy(F.col("SNP").alias("snp")).agg(F.min(F.struct(F.col("A1").alias("a1"), F.col("A2").alias("a2"), F.col("MAF").alias("maf"))).alias("v")).select("snp", "v.*")


def gene_sets(spark: SparkSession, path: str, least: int = 1, most: int = 2**31 - 1) -> DataFrame:
    """(set_id, description, genes, n_genes) of a GMT file: distinct non-empty genes, sets within the size limits.

    Lines of fewer than three fields are left out; of sets with one name the smallest line stays.
    """
    parts = text_lines(spark, path).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 3)
    genes = F.array_distinct(F.filter(F.transform(F.slice("f", F.lit(3), F.size("f") - 2), lambda g: F.trim(g)), lambda g: g != ""))
    sets = parts.select(F.trim(F.col("f")[0]).alias("set_id"), F.trim(F.col("f")[1]).alias("description"), genes.alias("genes"))
    one = sets.groupBy("set_id").agg(F.min(F.struct("description", "genes")).alias("s")).select("set_id", "s.*")
    return one.withColumn("n_genes", F.size("genes")).where(F.col("n_genes").between(least, most))


def gene_locations(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, chr, start, end, strand, symbol) of a headerless location file of four to six columns."""
    f = text_lines(spark, path).select(F.split(F.trim("value"), r"\s+").alias("f")).where(F.size("f") >= 4)
    get = lambda i: F.try_element_at("f", F.lit(i))
    return f.select(F.regexp_replace(get(1), r"\.[0-9]+$", "").alias("gene_id"), F.regexp_replace(F.upper(get(2)), "^CHR", "").alias("chr"), get(3).try_cast("long").alias("start"), get(4).try_cast("long").alias("end"), get(5).alias("strand"), get(6).alias("symbol"))


def id_pairs(spark: SparkSession, path: str, order: Column | None = None) -> DataFrame:
    """(key, value) of a two-column tab file, one value a key: the first by ``order`` (by default the smallest)."""
    f = text_lines(spark, path).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 2)
    pairs = f.select(F.trim(F.col("f")[0]).alias("key"), F.trim(F.col("f")[1]).alias("value")).where("key <> '' and value <> ''")
    return pairs.groupBy("key").agg(F.min_by("value", order if order is not None else F.col("value")).alias("value"))


def gene_info(spark: SparkSession, path: str, taxon: str) -> DataFrame:
    """(entrez, symbol, ensembl) of a tab file of genes: taxon, Entrez id, symbol, two unread fields, cross references split by '|'.

    Other taxa, short lines and ids that are no whole numbers are left out; '-' is no symbol. Of several
    Ensembl references of a line the first counts, of several lines of a gene the smallest value.
    """
    f = text_lines(spark, path).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 6)
    human = f.where(F.col("f")[0] == taxon)
    references = F.filter(F.split(F.col("f")[5], r"\|"), lambda x: x.startswith("Ensembl:"))
    ensembl = F.regexp_replace(F.try_element_at(references, F.lit(1)), "^Ensembl:", "")
    symbol = F.nullif(F.nullif(F.col("f")[2], F.lit("-")), F.lit(""))
    genes = human.select(F.col("f")[1].try_cast("long").alias("entrez"), symbol.alias("symbol"), ensembl.alias("ensembl"))
    return genes.where("entrez is not null").groupBy("entrez").agg(F.min("symbol").alias("symbol"), F.min("ensembl").alias("ensembl"))


def gene_history(spark: SparkSession, path: str, taxon: str) -> DataFrame:
    """(old, new) Entrez ids of a tab file taxon, replacement, discontinued id; ids without a replacement ('-') are left out.

    An id replaced several times keeps the largest replacement. ``latest_ids`` follows the chains.
    """
    f = text_lines(spark, path).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 3)
    pairs = f.where(F.col("f")[0] == taxon).select(F.col("f")[2].try_cast("long").alias("old"), F.col("f")[1].try_cast("long").alias("new"))
    return pairs.where("old is not null and new is not null").groupBy("old").agg(F.max("new").alias("new"))


def interaction_claims(spark: SparkSession, path: str) -> DataFrame:
    """(claim_id, drug_name, drug_chembl_id, gene_symbol, interaction_type, pmids, confidence) of a tab file of claims with a header.

    Claims with a null or blank drug or gene are left out. The drug id is the one ChEMBL id in
    drug_concept_id, else null; pmids are split at commas; confidence is medium with any, else low.
    """
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    pmids = text_list(F.col("pmids"), ",")
    read = raw.select(
        "claim_id", F.trim("drug_name").alias("drug_name"), chembl_id(F.col("drug_concept_id")).alias("drug_chembl_id"), F.trim("gene_name").alias("gene_symbol"),
        "interaction_type", pmids.alias("pmids"), F.when(pmids.isNotNull(), "medium").otherwise("low").alias("confidence"),
    )
    return read.where("drug_name <> '' and gene_symbol <> ''")


def set_results(spark: SparkSession, path: str) -> DataFrame:
    """(set_id, n_genes, beta, se, p) of a white-space table of set tests VARIABLE NGENES BETA SE P and maybe FULL_NAME.

    VARIABLE may be cut short, so FULL_NAME is taken where the file has it and the line isn't NA there.
    Text that is no number is null; a set listed several times keeps its smallest p.
    """
    columns = {"VARIABLE": "string", "NGENES": "long", "BETA": "double", "SE": "double", "P": "double"}
    named = text_lines(spark, path).where(F.array_contains(F.split(F.trim("value"), r"\s+"), "FULL_NAME")).limit(1).count()
    rows = white_space_table(spark, path, columns | ({"FULL_NAME": "string"} if named else {}))
    name = F.coalesce(F.nullif("FULL_NAME", F.lit("NA")), "VARIABLE") if named else F.col("VARIABLE")
    tested = rows.select(name.alias("set_id"), F.col("NGENES").alias("n_genes"), F.col("BETA").alias("beta"), F.col("SE").alias("se"), F.col("P").alias("p"))
    first = F.min(F.struct(F.col("p").isNull(), "p", "n_genes", "beta", "se")).alias("s")
    return tested.groupBy("set_id").agg(first).select("set_id", "s.n_genes", "s.beta", "s.se", "s.p")


def latest_ids(history: DataFrame, hops: int = 10) -> DataFrame:
    """(old, current, hops) by following (old, new) replacements at most ``hops`` times; cycles stop where they close.

    Each round is one join; ids whose end is reached leave the loop's left side unchanged.
    """
    steps = history.where("old is not null and new is not null and old <> new").groupBy("old").agg(F.min("new").alias("new"))
    out = steps.select("old", F.col("new").alias("current"), F.lit(1).alias("hops"))
    for _ in range(hops - 1):
        follow = steps.select(F.col("old").alias("current"), F.col("new").alias("__next"))
        moved = out.join(follow, "current", "left")
        go = F.col("__next").isNotNull() & (F.col("__next") != F.col("old"))
        out = moved.select("old", F.when(go, F.col("__next")).otherwise(F.col("current")).alias("current"), (F.col("hops") + go.cast("int")).alias("hops"))
    return out


def covariance_triplets(spark: SparkSession, path: str) -> DataFrame:
    """(gene, key1, key2, value) of a white-space file GENE RSID1 RSID2 VALUE, both directions, each pair once."""
    one = white_space_table(spark, path, {"GENE": "string", "RSID1": "string", "RSID2": "string", "VALUE": "double"}).toDF("gene", "key1", "key2", "value").where("value is not null")
    both = one.unionByName(one.where("key1 <> key2").select("gene", F.col("key2").alias("key1"), F.col("key1").alias("key2"), "value"))
    return both.groupBy("gene", "key1", "key2").agg(F.max("value").alias("value"))


def quadratic_scores(weights: DataFrame, z: DataFrame, covariance: DataFrame) -> DataFrame:
    """(gene, n_snps, zscore, effect, se) of a gene from its variants' weights: w.z / sqrt(w' S w), by joins on the triplets.

    ``weights``: gene, snp, w; ``z``: snp, z. Genes without a positive variance have null scores.
    """
    used = weights.join(z, "snp").where("w is not null and z is not null")
    top = used.groupBy("gene").agg(F.sum(F.col("w") * F.col("z")).alias("wz"), F.count("*").alias("n_snps"))
    one = used.select("gene", F.col("snp").alias("key1"), F.col("w").alias("w1"))
    two = used.select("gene", F.col("snp").alias("key2"), F.col("w").alias("w2"))
    variance = covariance.join(one, ["gene", "key1"]).join(two, ["gene", "key2"]).groupBy("gene").agg(F.sum(F.col("w1") * F.col("w2") * F.col("value")).alias("v"))
    v = F.when(F.col("v") > 0, F.col("v"))
    return top.join(variance, "gene", "left").select("gene", "n_snps", (F.col("wz") / F.sqrt(v)).alias("zscore"), (F.col("wz") / v).alias("effect"), (1 / F.sqrt(v)).alias("se"))


def json_list_csv(df: DataFrame, path: str) -> None:
    """Write as CSV with a header, array and struct columns as JSON text; quotes are doubled."""
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "struct", "map")]
    df.withColumns({c: F.to_json(c) for c in nested}).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
