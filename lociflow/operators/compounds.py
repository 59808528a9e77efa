"""Drugs written in several ways: placeholder ids, parents of salts by their names, and directions of claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.functions.identifiers import ascii_folded, plain_name
from lociflow.operators.skew import salted_join


def with_placeholder_id(rows: DataFrame, name: str, prefix: str, identity: str, out: str) -> DataFrame:
    """Adds ``out``: ``prefix`` and the name in upper-case ASCII, all else as single underscores.

    Where different names come to the same id, eight digits of the name's md5 follow. A null name
    counts as empty and gets the bare prefix. Names are compared once each; rows of a frequent
    name are spread by ``identity``.
    """
    key, slug = "__name", "__slug"
    trimmed = rows.withColumn(key, F.coalesce(F.trim(name), F.lit("")))
    folded = F.upper(ascii_folded(F.upper(F.col(key))))
    names = trimmed.select(key).distinct().withColumn(slug, F.regexp_replace(F.regexp_replace(folded, "[^A-Z0-9]+", "_"), "^_+|_+$", ""))
    taken = names.groupBy(slug).agg(F.count("*").alias("__n"))
    digest = F.concat(F.lit("_"), F.substring(F.md5(F.encode(key, "UTF-8")), 1, 8))
    suffix = F.when((F.col("__n") > 1) & (F.col(key) != ""), digest).otherwise("")
    made = names.join(taken, slug).select(key, F.concat(F.lit(prefix), slug, suffix).alias(out))
    return salted_join(trimmed, made, key, F.col(identity), "left", salts=8).drop(key)


def name_words(name: Column) -> Column:
    """The words of a name, lower case, accents decomposed; null stays null."""
    return F.filter(F.split(ascii_folded(name), "[^a-z0-9]+"), lambda w: w != "")


def parents_by_name(rows: DataFrame, parents: DataFrame, name: str, parent_id: str, parent_name: str) -> DataFrame:
    """(name, parent_id, n_dropped): each distinct name with the parent that its longest run of leading words names.

    So "x sulfate salt" finds "x". Names are compared without case, accents and marks. A parent name
    that several parents have is ambiguous: as the longest one it gives no row. Runs have at most as
    many words as the longest parent name has letters, as longer ones can't match.
    """
    known = parents.withColumn("__key", plain_name(F.col(parent_name))).where("__key is not null")
    most = known.agg(F.max(F.length("__key"))).first()[0] or 0
    one = known.groupBy("__key").agg(F.min(parent_id).alias(parent_id), F.count_distinct(parent_id).alias("__n"))
    words = rows.where(F.col(name).isNotNull()).select(name).distinct().withColumn("__words", name_words(F.col(name)))
    runs = words.where((F.size("__words") > 0) & (F.lit(most) > 0)).withColumn("__len", F.explode(F.sequence(F.lit(1), F.least(F.size("__words"), F.lit(max(most, 1))))))
    keyed = runs.select(name, F.size("__words").alias("__all"), "__len", F.array_join(F.slice("__words", F.lit(1), F.col("__len")), "").alias("__key"))
    found = keyed.join(one, "__key").groupBy(name, "__all").agg(F.max(F.struct("__len", "__n", parent_id)).alias("m"))
    return found.where("m.__n = 1").select(name, F.col(f"m.{parent_id}").alias(parent_id), (F.col("__all") - F.col("m.__len")).alias("n_dropped"))


def one_direction(claims: DataFrame, keys: list[str], terms: str, directions: dict[str, str]) -> DataFrame:
    """(keys, n_terms, direction) of texts that hold terms split by '|': the one direction all terms have, else 'none'.

    A term without a direction makes the whole 'none'. Blank terms don't count; keys without any
    term have no row. ``directions`` gives lower-case terms.
    """
    known = F.create_map(*[F.lit(x) for pair in directions.items() for x in pair])
    each = claims.select(*keys, F.explode(F.split(F.lower(F.col(terms)), r"\|")).alias("term")).withColumn("term", F.trim("term")).where("term <> ''")
    seen = each.distinct().withColumn("way", F.coalesce(F.try_element_at(known, F.col("term")), F.lit("none")))
    found = seen.groupBy(*keys).agg(F.count("*").alias("n_terms"), F.min("way").alias("lo"), F.max("way").alias("hi"))
    return found.select(*keys, "n_terms", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("none").alias("direction"))
