"""Identifier and name expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Level of a drug class code by its length.
ATC_LEVELS = {1: 1, 3: 2, 4: 3, 5: 4, 7: 5}


def matched(text: Column, pattern: str, group: int = 0) -> Column:
    """The group of the first match, null without one."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found)


def rsid(snp: Column) -> Column:
    """The rs number at the start of an identifier, lower case."""
    return matched(F.lower(F.trim(snp)), "^rs[0-9]+")


def chembl_id(text: Column) -> Column:
    """The one ChEMBL id in a text; null if there is none or several different ones."""
    found = F.array_distinct(F.regexp_extract_all(F.upper(text), F.lit("CHEMBL[0-9]+"), F.lit(0)))
    return F.when(F.size(found) == 1, found[0])


def pubchem_cid(text: Column) -> Column:
    """Digits of the compound number, without thousands marks, prefixes or a trailing '.0'."""
    digits = F.regexp_replace(F.regexp_replace(F.trim(text), r"\.0+$", ""), "[^0-9]", "")
    return F.when(digits != "", digits)


def versionless(text: Column) -> Column:
    """An identifier without its '.n' version."""
    return F.regexp_replace(text, r"\.[0-9]+$", "")


@F.pandas_udf(StringType())
def ascii_folded(names: pd.Series) -> pd.Series:
    """Compatibility-decomposed, ASCII only, case-folded; null stays null."""

    def fold(name: str | None) -> str | None:
        return None if name is None else unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().casefold()

    return names.map(fold)


def plain_name(name: Column) -> Column:
    """Lower case letters and digits only, accents and compatibility forms decomposed; null if none is left."""
    key = F.regexp_replace(ascii_folded(name), "[^a-z0-9]", "")
    return F.when(key != "", key)


def atc_level(code: Column) -> Column:
    """1 to 5 by the code's length, else 0."""
    out = F
    for length, level in ATC_LEVELS.items():
        out = out.when(F.length(code) == length, level)
    return out.otherwise(0)


def text_list(raw: Column, separator: str = r"\|") -> Column:
    """A separated text as an array of trimmed non-blank parts; null if there are none."""
    parts = F.filter(F.transform(F.split(raw, separator), lambda x: F.trim(x)), lambda s: s != "")
    return F.when(F.size(parts) > 0, parts)


def json_or_text_list(raw: Column) -> Column:
    """A JSON array, a JSON text or a bare text as an array; null and blank give null."""
    text = F.trim(raw)
    many = F.from_json(F.when(text.startswith("["), text), "array<string>")
    one = F.coalesce(matched(text, '^"(.*)"$', 1), text)
    out = F.coalesce(many, F.when((text != "") & ~text.startswith("["), F.array(one)))
    return F.when(F.size(out) > 0, out)
