"""Summary-statistics text kept line by line: headers, dialects, strict parsing and rejects."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.operators.skew import salted_join
from lociflow.session import written

BOM = "﻿"
#: Delimiters tried on a header, in order of preference when equally frequent; else white space.
DELIMITERS = "\t,;|"
PLAIN_NUMBER = re.compile(r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")
WHOLE_NUMBER = re.compile(r"[+-]?[0-9]+")
AUTOSOME = re.compile(r"(?:chr)?0*(?:[1-9]|1[0-9]|2[0-2])", re.IGNORECASE)

csv.field_size_limit(2**31 - 1)


def clean_line(line: Column) -> Column:
    """The line without a byte-order mark in front and line ends behind; null counts as empty."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(line, F.lit("")), "^﻿", ""), r"[\r\n]+$", "")


def is_comment(line: Column) -> Column:
    return line.rlike(r"^#[# \t]")


def is_blank(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r﻿ ", "    ")) == ""


def with_headers(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(data lines with their file's ``header``, one header row a file).

    ``lines`` has line_id, file_id, line_no and line. The header is the first line of a file that
    is neither blank nor a comment (ties in line_no: the smaller line_id). The lines are cleaned
    once and written; the first of a file is found by a pre-aggregated minimum of its numbers, not
    its text, and its header joined back with salts, as one file may hold most lines. A file of
    comments only yields neither header nor data.
    """
    cleaned = lines.select("file_id", "line_id", "line_no", clean_line(F.col("line")).alias("text"))
    content = written(cleaned.where(~is_blank(F.col("text")) & ~is_comment(F.col("text"))))
    firsts = content.groupBy("file_id").agg(F.min(F.struct("line_no", "line_id")).alias("h")).select("file_id", F.col("h.line_id").alias("line_id"))
    headers = written(content.select("file_id", "line_id", F.col("text").alias("header")).join(firsts, ["file_id", "line_id"]).dropDuplicates(["file_id"]))
    one = headers.select("file_id", F.col("line_id").alias("header_line"), "header")
    data = salted_join(content, one, "file_id", F.col("line_id"))
    return data.where(F.col("line_id") != F.col("header_line")).drop("header_line"), headers.drop("line_id")


@lru_cache(maxsize=4096)
def delimiter_of(header: str) -> str:
    """The most frequent of tab, comma, semicolon and pipe in the header; a blank if there is none."""
    found = max(DELIMITERS, key=header.count)
    return found if found in header else " "


@lru_cache(maxsize=4096)
def _tail_after_quote(delimiter: str) -> re.Pattern[str]:
    d = re.escape(delimiter)
    return re.compile(rf'((?:^|{d})[ ]*"(?:[^"]|"")*")[ ]+(?={d}|$)')


def split_record(text: str, delimiter: str) -> list[str] | None:
    """The fields of one record by the strict csv reader, blanks around them removed; None if its quoting is broken."""
    text = text.replace("\r", " ")
    text = text.replace("\t", " ").strip() if delimiter == " " else text
    for attempt in (text, None):
        if attempt is None:  # blanks between a closing quote and the delimiter are allowed
            attempt = _tail_after_quote(delimiter).sub(r"\1", text)
            if attempt == text:
                return None
        try:
            fields = next(csv.reader([attempt], delimiter=delimiter, strict=True, skipinitialspace=True), [""])
            return [f.strip() for f in fields]
        except csv.Error:
            continue
    return None


@lru_cache(maxsize=4096)
def header_names(header: str) -> tuple[str, ...]:
    """Header names in upper case without quotes, blanks, byte-order mark and leading hash."""
    bare = header.lstrip(BOM).lstrip("#").strip() if delimiter_of(header) == " " else header.lstrip(BOM).lstrip("#")
    fields = split_record(bare, delimiter_of(header))
    if fields is None:
        fields = bare.split(delimiter_of(header))
    return tuple(re.sub(r"[\s\"'﻿]", "", f).lstrip("#").upper() for f in fields)


def alias_map(aliases: DataFrame) -> dict[str, str]:
    """alias -> canonical name. The alias table is a fixed vocabulary (tens of rows), checked here."""
    rows = aliases.where(F.col("alias").isNotNull()).select(F.upper("alias").alias("alias"), "canonical").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("the alias table is meant to be a small vocabulary of at most 10,000 names")
    return {r.alias: r.canonical for r in rows}


def canonical_position(names: tuple[str, ...], aliases: dict[str, str], wanted: str) -> int | None:
    """Where the first column of that canonical name is."""
    return next((i for i, n in enumerate(names) if aliases.get(n, n) == wanted), None)


def reject_reason(text: str, header: str, aliases: dict[str, str]) -> tuple[str | None, list[str] | None]:
    """(first reason why a data line can't be loaded or None, its fields)."""
    fields = split_record(text, delimiter_of(header))
    if fields is None:
        return "quoting", None
    names = header_names(header)
    if len(fields) != len(names):
        return "columns", fields
    value = lambda wanted: None if (i := canonical_position(names, aliases, wanted)) is None else fields[i]
    chrom, p, beta, odds = (value(x) for x in ("CHR", "P", "BETA", "OR"))
    if chrom is None or not AUTOSOME.fullmatch(chrom):
        return "chr", fields
    if p is None or not PLAIN_NUMBER.fullmatch(p) or not 0 <= float(p) <= 1:
        return "p", fields
    effect = beta if canonical_position(names, aliases, "BETA") is not None else odds
    if effect is None or not PLAIN_NUMBER.fullmatch(effect) or abs(float(effect)) == float("inf"):
        return "beta", fields
    if effect is odds and beta is None and float(effect) <= 0:
        return "beta", fields
    return None, fields


def parsed_lines(lines: DataFrame, aliases: DataFrame) -> DataFrame:
    """Every data line with its ``reason`` (null: it loads) and its ``fields`` under canonical names.

    Columns: line_id, file_id, line_no, reason, fields (map of canonical name to trimmed text, the
    first of several columns of one name; empty where quoting or field count is broken). Empty or null tables give no rows; null lines count as
    blank. Python only splits and checks single records, in Arrow batches; Spark does the rest.
    """
    data, _ = with_headers(lines)
    names = alias_map(aliases)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            reasons, maps = [], []
            for text, header in zip(batch["text"], batch["header"], strict=True):
                reason, fields = reject_reason(text, header, names)
                reasons.append(reason)
                pairs = {} if reason in ("quoting", "columns") else {names.get(n, n): f for n, f in reversed(list(zip(header_names(header), fields, strict=True)))}
                maps.append(pairs)
            yield pd.DataFrame({"line_id": batch["line_id"], "file_id": batch["file_id"], "line_no": batch["line_no"], "reason": reasons, "fields": maps})

    return data.select("line_id", "file_id", "line_no", "text", "header").mapInPandas(parse, "line_id long, file_id long, line_no int, reason string, fields map<string,string>")


def load_or_reject(lines: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed valid rows, rejected lines with their reason).

    Valid rows: line_id, file_id, SNP, CHR, POS, A1, A2, BETA (the logarithm of OR where the file
    has no BETA), SE, P, N, MAF, INFO. Text that doesn't parse in an optional column is null there.
    """
    parsed = parsed_lines(lines, aliases)
    text = lambda c: F.when(~F.upper(F.col("fields")[c]).isin("", "NA", "NAN", "."), F.col("fields")[c])
    number = lambda c: text(c).try_cast("double")
    odds = number("OR")
    valid = parsed.where(F.col("reason").isNull()).select(
        "line_id", "file_id", text("SNP").alias("SNP"),
        F.regexp_replace(F.lower(F.col("fields")["CHR"]), "^chr", "").try_cast("int").alias("CHR"),
        number("POS").try_cast("long").alias("POS"), F.upper(text("A1")).alias("A1"), F.upper(text("A2")).alias("A2"),
        F.when(F.col("fields")["BETA"].isNotNull(), number("BETA")).when(odds > 0, F.ln(odds)).alias("BETA"),
        number("SE").alias("SE"), number("P").alias("P"), F.round(number("N")).try_cast("long").alias("N"), number("MAF").alias("MAF"), number("INFO").alias("INFO"),
    )
    return valid, parsed.where(F.col("reason").isNotNull()).select("line_id", "file_id", "line_no", "reason")
