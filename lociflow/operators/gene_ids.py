"""Gene identifiers of four kinds: an index of pairs, full records by chained lookups, gaps filled, matches by tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.operators.skew import salted_join

KINDS = ("symbol", "ensembl", "uniprot", "entrez")
#: Which kind is known to lead to which: only these pairs are ever looked up.
PAIRS = (
    ("ensembl", "symbol"),
    ("ensembl", "uniprot"),
    ("ensembl", "entrez"),
    ("symbol", "ensembl"),
    ("symbol", "entrez"),
    ("uniprot", "ensembl"),
    ("entrez", "symbol"),
    ("entrez", "ensembl"),
)
#: Share of a column's values that must look like a kind for the column to be of it.
KIND_SHARE = 0.9

Index = dict[tuple[str, str], DataFrame]


def pair_index(rows: DataFrame, order: str) -> Index:
    """For every pair of kinds: (key, value), the value first seen with the key by ``order``.

    ``rows`` has one text column a kind. Null on either side is no pair; a key has one row, being a
    minimum that is reduced before the shuffle.
    """
    return {
        (key, value): rows.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(F.struct(order, value)).alias("m"))
        .select("key", F.col(f"m.{value}").alias("value"))
        for key, value in PAIRS
    }


def looked_up(rows: DataFrame, index: Index, key: str, value: str, name: str) -> DataFrame:
    """Adds ``name``: what the ids in ``key`` lead to, null where they lead nowhere."""
    pairs = index[key, value].select(F.col("key").alias(f"__{key}"), F.col("value").alias(name))
    return rows.join(pairs, F.col(key) == F.col(f"__{key}"), "left").drop(f"__{key}")


def full_records(ids: DataFrame, kind: str, index: Index) -> DataFrame:
    """(id, symbol, ensembl, uniprot, entrez) of every distinct id of one kind; the id itself always comes back.

    An Ensembl id takes its symbol directly or by its Entrez id; a symbol or Entrez id reaches UniProt by
    Ensembl; a UniProt id reaches everything by Ensembl; an Entrez id's own Ensembl outweighs its symbol's.
    Null ids are left out, unknown ones keep their own kind only.
    """
    known = ids.where(F.col("id").isNotNull()).select("id").distinct().withColumn(kind, F.col("id"))
    if kind == "ensembl":
        found = looked_up(looked_up(known, index, kind, "uniprot", "uniprot"), index, kind, "entrez", "entrez")
        found = looked_up(looked_up(found, index, kind, "symbol", "own"), index, "entrez", "symbol", "other")
        found = found.withColumn("symbol", F.coalesce("own", "other"))
    elif kind == "symbol":
        found = looked_up(looked_up(known, index, kind, "ensembl", "ensembl"), index, kind, "entrez", "entrez")
        found = looked_up(found, index, "ensembl", "uniprot", "uniprot")
    elif kind == "uniprot":
        found = looked_up(known, index, kind, "ensembl", "ensembl")
        found = looked_up(looked_up(found, index, "ensembl", "symbol", "symbol"), index, "ensembl", "entrez", "entrez")
    elif kind == "entrez":
        found = looked_up(looked_up(known, index, kind, "symbol", "symbol"), index, kind, "ensembl", "own")
        found = looked_up(found, index, "symbol", "ensembl", "other").withColumn("ensembl", F.coalesce("own", "other"))
        found = looked_up(found, index, "ensembl", "uniprot", "uniprot")
    else:
        raise ValueError(f"unknown kind {kind}")
    return found.select("id", *KINDS)


def filled_ids(rows: DataFrame, kind: str, identity: str, index: Index) -> DataFrame:
    """``rows`` with the kinds they lack filled by what their id of ``kind`` leads to; what is there stays.

    Each distinct id is converted once; the rows of a frequent id are spread by ``identity``.
    Rows without that id come out unchanged.
    """
    records = full_records(rows.select(F.col(kind).alias("id")), kind, index)
    found = records.select(F.col("id").alias(kind), *[F.col(k).alias(f"__{k}") for k in KINDS if k != kind])
    joined = salted_join(rows, found, kind, F.col(identity), "left", salts=8)
    filled = {k: F.coalesce(k, f"__{k}") for k in KINDS if k != kind}
    return joined.withColumns(filled).select(*rows.columns)


def column_kind(values: Column) -> Column:
    """Aggregate: 'ensembl' or 'entrez' where nearly all non-null values look like it, else 'mixed' (also without values)."""
    text = F.trim(values.cast("string"))
    share = lambda pattern: F.avg(text.rlike(pattern).cast("double"))
    ensembl, numeric = share("^ENS[A-Z]*G[0-9]+"), share("^[0-9]+$")
    return F.when(ensembl > KIND_SHARE, "ensembl").when(numeric > KIND_SHARE, "entrez").otherwise("mixed")


def tiered_targets(genes: DataFrame, targets: DataFrame) -> DataFrame:
    """(gene, tier, n_rows, n_keys): each gene's target rows by the first kind of id that finds any.

    ``genes`` has ``gene`` and one column a kind, one row a gene; ``targets`` one column a kind. Ensembl
    comes first, then Entrez and UniProt, which pass over rows of another Ensembl gene, then a symbol
    whose rows name at most one Ensembl gene. Genes that nothing finds have no row. Target rows
    with the same ids are counted first, so a frequent gene meets as a few rows.
    """
    keys = targets.groupBy(*KINDS).agg(F.count("*").alias("n"))
    right = keys.select("n", *[F.col(k).alias(f"t_{k}") for k in KINDS])
    left = genes.select("gene", *KINDS)
    same_gene = F.col("t_ensembl").isNull() | F.coalesce(F.col("t_ensembl") == F.col("ensembl"), F.lit(False))
    tiers = []
    for place, kind in enumerate(("ensembl", "entrez", "uniprot", "symbol")):
        met = left.join(right, F.col(kind) == F.col(f"t_{kind}"))
        if kind in ("entrez", "uniprot"):
            met = met.where(same_gene)
        found = met.groupBy("gene").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.count_distinct("t_ensembl").alias("n_genes"))
        if kind == "symbol":
            found = found.where("n_genes <= 1")
        tiers.append(found.select("gene", F.struct(F.lit(place).alias("place"), F.lit(kind).alias("tier"), "n_rows", "n_keys").alias("hit")))
    every = tiers[0]
    for tier in tiers[1:]:
        every = every.unionByName(tier)
    return every.groupBy("gene").agg(F.min("hit").alias("hit")).select("gene", "hit.tier", "hit.n_rows", "hit.n_keys")
