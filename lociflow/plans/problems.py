"""Queries of the general data problems: units, rejected lines and drifting schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.operators.units import harmonise_units, milli
from lociflow.plans.lines_sql import P4_FOUND, P4_ROWS, P6_FOUND
from lociflow.plans.units_sql import P2_FOUND
from lociflow.session import table
from lociflow.sources.schema_drift import layout_versions, migration_steps, migrations, unify
from lociflow.sources.summary_lines import load_or_reject


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Reported values that were not yet in the common unit, with the converted value in thousandths."""
    values = harmonise_units(table(spark, d, "assoc_hits"), table(spark, d, "gwas_studies"))
    return values.where(F.col("converted") & F.col("value").isNotNull()).select("row_id", "field", milli(F.col("value")).alias("value_milli"))


def p2_values(spark: SparkSession, d: str) -> DataFrame:
    """All reported values in the common unit, and where the unit was known from."""
    values = harmonise_units(table(spark, d, "assoc_hits"), table(spark, d, "gwas_studies"))
    return values.select("row_id", "field", "unit", "unit_from", "identity_unit", F.round("value", 6).alias("value"), "unique")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Data lines that can't be loaded, each with the first reason."""
    _, rejected = load_or_reject(table(spark, d, "gwas_lines"), table(spark, d, "column_aliases"))
    return rejected.select("line_id", "reason")


def p4_rows(spark: SparkSession, d: str) -> DataFrame:
    """The loadable lines as typed rows."""
    valid, _ = load_or_reject(table(spark, d, "gwas_lines"), table(spark, d, "column_aliases"))
    return valid


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change of layout between a file and its predecessor in the stream."""
    return migrations(table(spark, d, "gwas_files"), table(spark, d, "gwas_lines"), table(spark, d, "column_aliases")).select("file_id", "field", "change")


def p6_versions(spark: SparkSession, d: str) -> DataFrame:
    """The distinct layouts of every stream, numbered as they appeared."""
    return layout_versions(table(spark, d, "gwas_files"), table(spark, d, "gwas_lines"), table(spark, d, "column_aliases"))


def p6_steps(spark: SparkSession, d: str) -> DataFrame:
    """The rename, default and cast steps of every version of every stream."""
    return migration_steps(table(spark, d, "gwas_files"), table(spark, d, "gwas_lines"), table(spark, d, "column_aliases"))


def p6_table(spark: SparkSession, d: str) -> DataFrame:
    """All files as one table with the canonical columns."""
    out = unify(table(spark, d, "gwas_files"), table(spark, d, "gwas_lines"), table(spark, d, "column_aliases"))
    return out.withColumn("extra", F.to_json("extra"))


QUERIES = {q.__name__: q for q in (p2_found, p2_values, p4_found, p4_rows, p6_found, p6_versions, p6_steps, p6_table)}
SQL = {"p2_found": P2_FOUND, "p4_found": P4_FOUND, "p4_rows": P4_ROWS, "p6_found": P6_FOUND}
