"""Canonical tables and the check of a frame against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Required columns, then optional ones, by table.
TABLES = {
    "variants": ("SNP string, VARIANT_ID string, CHR int, POS long, A1 string, A2 string, BETA double, SE double, P double, N long", "MAF double, INFO double, N_CAS long, N_CON long"),
    "drug_targets": ("drug_name string, drug_chembl_id string, gene_symbol string, source string, confidence string", "drug_inchikey string, drug_pubchem_cid string, pchembl_value double, mechanism_of_action string, max_phase int, atc_codes array<string>, indication_mesh array<string>, source_pmids array<string>"),
    "gene_sets": ("set_id string, genes array<string>, n_genes int", "description string"),
    "gene_locations": ("gene_id string, chr string, start long, end long", "strand string, symbol string"),
}
#: What a wider or equal type may stand for.
_WIDENS = {"int": {"int", "smallint", "tinyint"}, "bigint": {"bigint", "int", "smallint", "tinyint"}, "double": {"double", "float", "bigint", "int"}}


def problems(df: DataFrame, table: str) -> list[str]:
    """Missing required columns and incompatible types, as sentences; optional columns may be absent."""
    required, optional = (StructType.fromDDL(x) for x in TABLES[table])
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    found = [f"{f.name} is missing" for f in required if f.name not in have]
    for f in (*required, *optional):
        want = f.dataType.simpleString()
        if f.name in have and have[f.name] not in _WIDENS.get(want, {want}):
            found.append(f"{f.name} is {have[f.name]}, not {want}")
    return found


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order: absent ones null, others dropped, values that don't cast null."""
    fields = [f for part in TABLES[table] for f in StructType.fromDDL(part)]
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields])
