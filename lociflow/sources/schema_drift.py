"""Schemas that drift between the files of a stream: fingerprints, versions and migration steps.

A file's layout is the set of its columns (canonical name, header, type) with its delimiter and
hash mark; equal layouts have equal fingerprints, and each new fingerprint of a stream is a new
version of it. Every version has explicit steps to the canonical table: rename (header to
canonical name), default (a canonical column it lacks) and cast (its type to the canonical type).
Lines are routed through the steps of their file's version.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.operators.skew import bucketed_lag, salted_join
from lociflow.session import written
from lociflow.sources.summary_lines import PLAIN_NUMBER, WHOLE_NUMBER, alias_map, delimiter_of, header_names, split_record, with_headers

#: Canonical columns of the unified table and the type each is cast to.
CANONICAL = {"SNP": "string", "CHR": "int", "POS": "long", "A1": "string", "A2": "string", "BETA": "double", "OR": "double", "SE": "double", "P": "double", "N": "double", "N_CAS": "double", "N_CON": "double", "INFO": "double", "MAF": "double", "Z": "double"}
#: Values that say nothing about a column's type.
SKIPPED = {"", "NA"}


def _kind(value: str) -> str:
    """One letter a value: int, float, text, or - where it says nothing of a column's type."""
    if value.upper() in SKIPPED:
        return "-"
    return "i" if WHOLE_NUMBER.fullmatch(value) else "f" if PLAIN_NUMBER.fullmatch(value) else "t"


def split_lines(lines: DataFrame, with_fields: bool) -> tuple[DataFrame, DataFrame]:
    """(file_id, line_id, kinds, fields) of the data lines of the right number of fields, and (file_id, header).

    ``kinds`` has one letter a field; ``fields`` is null unless asked for. Each line is split once.
    """
    data, headers = with_headers(lines)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kinds, kept = [], []
            for text, header in zip(batch["text"], batch["header"], strict=True):
                fields = split_record(text, delimiter_of(header))
                whole = fields is not None and len(fields) == len(header_names(header))
                kinds.append("".join(map(_kind, fields)) if whole else None)
                kept.append(fields if whole and with_fields else None)
            yield pd.DataFrame({"file_id": batch["file_id"], "line_id": batch["line_id"], "kinds": kinds, "fields": kept})

    schema = "file_id long, line_id long, kinds string, fields array<string>"
    records = data.select("file_id", "line_id", "text", "header").mapInPandas(split, schema)
    return records.where(F.col("kinds").isNotNull()), headers


def column_types(records: DataFrame) -> DataFrame:
    """(file_id, position, type): int, float or text, whichever more than half of the values have, else null.

    Lines of the same kinds are counted before the shuffle, so what is shuffled is a few rows a file and task.
    """
    patterns = records.groupBy("file_id", "kinds").agg(F.count("*").alias("n"))
    each = patterns.select("file_id", "n", F.posexplode(F.split("kinds", "")).alias("position", "kind")).where("kind in ('i', 'f', 't')")
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in "ift"]
    half = (F.col("i") + F.col("f") + F.col("t")) / 2
    kind = F.when(F.col("i") > half, "int").when(F.col("f") > half, "float").when(F.col("t") > half, "text")
    return each.groupBy("file_id", "position").agg(*sums).select("file_id", "position", kind.alias("type"))


LAYOUT = "array<struct<field:string,header:string,type:string>>"


def layouts(files: DataFrame, records: DataFrame, headers: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row a file: file_id, stream, received_at, delimiter, hashed, layout, places, fingerprint.

    ``layout`` lists the columns sorted by canonical name, as their order is no part of it;
    ``places`` maps each canonical name to its position in this file. Of two columns of one
    canonical name the first stands for it. Files without a header are left out.
    """
    names = alias_map(aliases)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for file_id, header in zip(batch["file_id"], batch["header"], strict=True):
                taken: set[str] = set()
                for i, name in enumerate(header_names(header)):
                    field = names.get(name, name)
                    if name and field not in taken:
                        taken.add(field)
                        rows.append((file_id, i, field, name))
            yield pd.DataFrame(rows, columns=["file_id", "position", "field", "header"])

    columns = headers.mapInPandas(describe, "file_id long, position int, field string, header string")
    typed = columns.join(column_types(records), ["file_id", "position"], "left")
    described = typed.groupBy("file_id").agg(
        F.array_sort(F.collect_list(F.struct("field", "header", "type"))).alias("layout"),
        F.map_from_entries(F.collect_list(F.struct("field", "position"))).alias("places"),
    )
    tabs, commas, semis, pipes = (F.length("header") - F.length(F.replace(F.col("header"), F.lit(c))) for c in "\t,;|")
    most = F.greatest(tabs, commas, semis, pipes)
    delimiter = F.when(most == 0, " ").when(tabs == most, "\t").when(commas == most, ",").when(semis == most, ";").otherwise("|")
    dialects = headers.select("file_id", delimiter.alias("delimiter"), F.col("header").startswith("#").alias("hashed"))
    known = files.select("file_id", "stream", "received_at").dropDuplicates(["file_id"]).join(dialects, "file_id").join(described, "file_id", "left")
    known = known.withColumn("layout", F.coalesce("layout", F.array().cast(LAYOUT)))
    return known.withColumn("fingerprint", _fingerprint(F.col("layout"), F.col("delimiter"), F.col("hashed")))


def _fingerprint(fields: Column, delimiter: Column, hashed: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.to_json(fields), delimiter, hashed.cast("string")), 256)


def _change(when: Column, change: str, old: Column, new: Column) -> Column:
    return F.when(when, F.struct(F.lit(change).alias("change"), old.alias("old"), new.alias("new")))


def migrations(files: DataFrame, lines: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row per change between a file and the one received before it in its stream.

    Columns: file_id, stream, fingerprint, prev_file_id, field, change (added, removed, renamed,
    retyped, changed), old, new. A stream's first file has no rows; files without a header are
    skipped; a mere change of order is none. Files received at the same time go by file_id.
    """
    records, headers = split_lines(lines, with_fields=False)
    known = layouts(files, records, headers, aliases).drop("places")
    steps = bucketed_lag(known, "stream", ["received_at", "file_id"], "received_at", ["file_id", "delimiter", "hashed", "layout", "fingerprint"])
    # equal fingerprints need no comparison; a layout is a few dozen names, so it travels with its file
    steps = steps.where(F.col("prev_exists") & (F.col("fingerprint") != F.col("prev_fingerprint")))
    keys = ["file_id", "stream", "fingerprint", "prev_file_id"]
    changed = _layout_changes(steps, keys)
    return changed.unionByName(_dialect_changes(steps, keys))


def _layout_changes(steps: DataFrame, keys: list[str]) -> DataFrame:
    """Columns added, removed, renamed or retyped between prev_layout and layout."""

    def tagged(column: str, side: str) -> Column:
        return F.transform(column, lambda x: F.struct(x["field"].alias("field"), F.lit(side).alias("side"), x["header"].alias("header"), x["type"].alias("type")))

    def pick(side: str, what: str) -> Column:
        return F.max(F.when(F.col("c.side") == side, F.col(f"c.{what}"))).alias(f"{side}_{what}")

    sides = steps.select(*keys, F.explode(F.concat(tagged("layout", "new"), tagged("prev_layout", "old"))).alias("c"))
    picked = [pick(side, what) for what in ("header", "type") for side in ("old", "new")]
    pairs = sides.groupBy(*keys, F.col("c.field").alias("field")).agg(*picked)
    old, new, was, now = (F.col(c) for c in ("old_header", "new_header", "old_type", "new_type"))
    both = old.isNotNull() & new.isNotNull()
    found = F.array(
        _change(old.isNull(), "added", old, new), _change(new.isNull(), "removed", old, new),
        _change(both & (old != new), "renamed", old, new), _change(both & (was != now), "retyped", was, now),
    )
    return pairs.select(*keys, "field", F.explode(F.array_compact(found)).alias("s")).select(*keys, "field", "s.*")


def _dialect_changes(steps: DataFrame, keys: list[str]) -> DataFrame:
    """Changes of the delimiter and of the header's hash mark."""
    marks = []
    for field, column in (("delimiter", "delimiter"), ("header_starts_with_hash", "hashed")):
        old, new = F.col(f"prev_{column}").cast("string"), F.col(column).cast("string")
        change = _change(old != new, "changed", old, new)
        marks.append(F.when(change.isNotNull(), F.struct(F.lit(field).alias("field"), change.alias("s"))))
    each = steps.select(*keys, F.explode(F.array_compact(F.array(*marks))).alias("m"))
    return each.select(*keys, "m.field", "m.s.*")


def versions_of(known: DataFrame) -> DataFrame:
    """Per stream and distinct layout: fingerprint, version from 1 in order of appearance, first file, number of files, layout."""
    groups = known.groupBy("stream", "fingerprint").agg(F.min(F.struct("received_at", "file_id")).alias("first"), F.count("*").alias("n_files"), F.first("layout").alias("layout"))
    order = Window.partitionBy("stream").orderBy("first.received_at", "first.file_id")
    return groups.select("stream", "fingerprint", F.row_number().over(order).alias("version"), F.col("first.file_id").alias("first_file_id"), "n_files", "layout")


def layout_versions(files: DataFrame, lines: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per stream and distinct layout: fingerprint, first file, number of files, version from 1 in order of appearance."""
    records, headers = split_lines(lines, with_fields=False)
    return versions_of(layouts(files, records, headers, aliases)).drop("layout")


def steps_of(versions: DataFrame) -> DataFrame:
    """(stream, version, fingerprint, step, action, field, source, target): what leads a version to the canonical table.

    Steps run in order: renames (source is the header), then defaults (target is the value given),
    then casts (source and target are types). Columns that are no canonical name are renamed too and
    go to ``extra``. A column whose values tell no type is cast as text.
    """
    canonical = F.create_map(*[F.lit(x) for kv in CANONICAL.items() for x in kv])

    def step(action: str, field: Column, source: Column, target: Column) -> Column:
        return F.struct(F.lit(action).alias("action"), field.alias("field"), source.alias("source"), target.alias("target"))

    renames = F.transform(F.filter("layout", lambda c: c["field"] != c["header"]), lambda c: step("rename", c["field"], c["header"], c["field"]))
    names = F.array(*map(F.lit, CANONICAL))
    present = F.transform("layout", lambda c: c["field"])
    defaults = F.transform(F.array_except(names, present), lambda n: step("default", n, F.lit(None).cast("string"), F.lit("null")))
    cast = F.filter("layout", lambda c: F.array_contains(names, c["field"]))
    casts = F.transform(cast, lambda c: step("cast", c["field"], F.coalesce(c["type"], F.lit("text")), F.element_at(canonical, c["field"])))
    every = versions.select("stream", "version", "fingerprint", F.posexplode(F.concat(renames, defaults, casts)).alias("step", "s"))
    return every.select("stream", "version", "fingerprint", (F.col("step") + 1).alias("step"), "s.*")


def migration_steps(files: DataFrame, lines: DataFrame, aliases: DataFrame) -> DataFrame:
    """The steps of every version of every stream, with the number of files that went through them."""
    records, headers = split_lines(lines, with_fields=False)
    versions = written(versions_of(layouts(files, records, headers, aliases)))
    return steps_of(versions).join(versions.select("stream", "version", "n_files"), ["stream", "version"])


def _cast(value: Column, name: str, kind: str) -> Column:
    """The value as the canonical type: chr prefixes and thousands separators removed, per cent signs divided out."""
    text = F.when(~F.upper(value).isin("", "NA", "NAN", "."), value)
    if kind == "string":
        return F.upper(text) if name in ("A1", "A2") else text
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), "^chr", ""), ",(?=[0-9]{3}(?![0-9]))", "")
    share = F.regexp_replace(bare, "%$", "").try_cast("double") / 100
    number = F.when(bare.endswith("%"), share).otherwise(bare.try_cast("double"))
    return number if kind == "double" else F.when(number == F.floor(number), number.cast(kind))


def unify(files: DataFrame, lines: DataFrame, aliases: DataFrame) -> DataFrame:
    """Every well-formed data line of every file as one row of the canonical table.

    A line is routed by its file's version: the version's steps name the canonical columns that are
    renamed, given their default (null) or cast, and ``version`` and ``fingerprint`` name the route.
    Columns that are no canonical name are kept in the map ``extra``. Lines whose quoting or field
    count is broken are left to the rejects; a value that isn't valid is null and its line stays;
    files that ``files`` doesn't list have no stream, so no version.
    """
    records, headers = split_lines(lines, with_fields=True)
    records = written(records)
    listed = files.select("file_id", "stream", "received_at").dropDuplicates(["file_id"])
    unlisted = headers.select("file_id").join(listed, "file_id", "left_anti").select("file_id", F.lit(None).cast("string").alias("stream"), F.lit(None).cast("timestamp").alias("received_at"))
    known = written(layouts(listed.unionByName(unlisted), records, headers, aliases))
    versions = written(versions_of(known))
    chosen = F.col("action") != "default"
    routed = F.collect_set(F.when(chosen, F.col("field")))
    route = steps_of(versions).groupBy("stream", "fingerprint", "version").agg(routed).toDF("of_stream", "of_fingerprint", "version", "routed")
    same = F.col("stream").eqNullSafe(F.col("of_stream")) & (F.col("fingerprint") == F.col("of_fingerprint"))
    # one row a file: where its columns are, and by which version's steps they go
    files_routed = known.join(route, same).select("file_id", "stream", "received_at", "version", "fingerprint", "places", "routed")
    wide = salted_join(records.select("file_id", "line_id", "fields"), files_routed, "file_id", F.col("line_id"))

    def value(name: str) -> Column:
        place = F.try_element_at("places", F.lit(name))
        return F.when(F.array_contains("routed", name), F.try_element_at("fields", place + 1))

    others = F.filter(F.map_entries("places"), lambda e: ~e["key"].isin(*CANONICAL))
    extra = F.map_from_entries(F.transform(others, lambda e: F.struct(e["key"], F.try_element_at(F.col("fields"), e["value"] + 1))))
    columns = [_cast(value(name), name, kind).alias(name) for name, kind in CANONICAL.items()]
    return wide.select("file_id", "line_id", *columns, extra.alias("extra"), "stream", "received_at", F.when(F.col("stream").isNotNull(), F.col("version")).alias("version"), "fingerprint")
