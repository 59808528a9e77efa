"""Ordered deduplication, record merging, sets and overlaps, all pre-aggregated before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (nulls as the order's structs sort them: first).

    A minimum of structs, so hot keys are reduced before the shuffle and never sorted in one task.
    """
    packed = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*rows.columns).alias("row"))
    kept = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min(packed).alias("__m")).select(*keys, *[F.col(f"__m.row.{c}").alias(c) for c in kept])


def ordered_unions(rows: DataFrame, keys: list[str], identity: str, lists: dict[str, Column]) -> DataFrame:
    """(keys, one array a list): the distinct non-null items of all rows' lists, as they first occur by ``identity``.

    Items are reduced before they meet, so a group holds its vocabulary, not its rows. Groups
    without any item have no row.
    """
    each = F.array(*[F.struct(F.lit(name).alias("list"), c.alias("items")) for name, c in lists.items()])
    named = rows.select(*keys, F.col(identity).alias("__id"), F.explode(each).alias("l"))
    items = named.select(*keys, "__id", "l.list", F.posexplode("l.items").alias("at", "item")).where(F.col("item").isNotNull())
    first = items.groupBy(*keys, "list", "item").agg(F.min(F.struct("__id", "at")).alias("first"))
    entry = F.struct("first", "item")
    lined = [F.array_sort(F.collect_list(F.when(F.col("list") == name, entry))).alias(name) for name in lists]
    return first.groupBy(*keys).agg(*lined).select(*keys, *[F.transform(name, lambda x: x["item"]).alias(name) for name in lists])


def source_names(raw: Column) -> Column:
    """The lower-case names of a field that lists sources separated by commas."""
    names = F.transform(F.split(F.lower(raw), ","), lambda s: F.trim(s))
    return F.filter(names, lambda s: s != "")


def richest_record(rows: DataFrame, keys: list[str], identity: str, scalars: list[str], lists: list[str], sources: str) -> DataFrame:
    """One record per key: the row with most filled cells, its gaps filled from the others.

    Ties go to the smallest ``identity``. Empty lists count as missing. A missing scalar takes the
    first non-null value by ``identity``; lists are united in the order of first occurrence;
    ``sources`` becomes the sorted distinct comma-separated names. Adds ``n_records`` and ``kept``.
    """
    cells = [F.col(c).isNotNull() for c in scalars] + [F.coalesce(F.size(c) > 0, F.lit(False)) for c in lists]
    filled = sum((c.cast("int") for c in cells), F.lit(0))
    best = F.struct(-filled.alias("f"), F.col(identity).alias("id"), *[F.col(c).alias(c) for c in scalars])
    firsts = [F.min(F.when(F.col(c).isNotNull(), F.struct(identity, c))).alias(f"__first_{c}") for c in scalars]
    merged = rows.groupBy(*keys).agg(F.min(best).alias("__best"), F.count("*").alias("n_records"), *firsts)
    unions = ordered_unions(rows, keys, identity, {**{c: F.col(c) for c in lists}, sources: source_names(F.col(sources))})
    nothing = F.array().cast("array<string>")
    united = [F.coalesce(c, nothing).alias(c) for c in lists]
    filled_up = [F.coalesce(F.col(f"__best.{c}"), F.col(f"__first_{c}.{c}")).alias(c) for c in scalars]
    return merged.join(unions, keys, "left").select(
        *keys, F.col("__best.id").alias("kept"), "n_records", F.array_join(F.array_sort(F.coalesce(sources, nothing)), ",").alias(sources), *filled_up, *united,
    )


def item_sets(pairs: DataFrame, group: str, item: str, least: int = 1) -> DataFrame:
    """(group, n_items, items): the sorted distinct items of each group of at least ``least``.

    Pairs are made distinct first, so what meets in a group is its set, not its rows.
    """
    distinct = pairs.where(F.col(group).isNotNull() & F.col(item).isNotNull()).select(group, item).distinct()
    return distinct.groupBy(group).agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list(item)).alias("items")).where(F.col("n_items") >= least)


def identical_sets(sets: DataFrame, group: str, preference: list[Column]) -> DataFrame:
    """(representative, n_members, n_items, set_key): groups with the very same items, as one row each.

    The representative is first by ``preference``. Sets meet by a hash of their items, so no set
    is a shuffle key.
    """
    order = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(preference)], F.col(group).alias("g"))
    keyed = sets.withColumn("set_key", F.md5(F.array_join(F.transform("items", lambda x: x.cast("string")), "|")))
    return keyed.groupBy("set_key", "n_items").agg(F.min(order).alias("o"), F.count("*").alias("n_members")).select(F.col("o.g").alias("representative"), "n_members", "n_items", "set_key")


def class_members(rows: DataFrame, item: str, codes: str, lengths: tuple[int, ...], least: int) -> DataFrame:
    """(code, level length, n_items): code prefixes of the given lengths and how many distinct items have them."""
    exploded = rows.select(item, F.explode(F.transform(codes, lambda c: F.upper(F.trim(c)))).alias("code")).where("code <> ''")
    prefixes = exploded.select(item, F.explode(F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("code")), lambda n: F.struct(F.substring(F.col("code"), F.lit(1), n).alias("code"), n.alias("length")))).alias("x")).select(item, "x.*").distinct()
    return prefixes.groupBy("code", "length").agg(F.count("*").alias("n_items")).where(F.col("n_items") >= least)


def membership_patterns(branches: dict[str, DataFrame], key: str) -> DataFrame:
    """(one flag a branch, degree, n): how many keys are in exactly which branches."""
    parts = [df.select(key).where(F.col(key).isNotNull()).distinct().select(key, F.lit(name).alias("branch")) for name, df in branches.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    flags = union.groupBy(key).agg(*[F.max((F.col("branch") == name).cast("int")).alias(name) for name in branches])
    degree = sum((F.col(n) for n in branches), F.lit(0))
    return flags.groupBy(*branches).agg(F.count("*").alias("n")).withColumn("degree", degree)


def tiered_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: list[tuple[str, str]]) -> DataFrame:
    """(left_id, right_id, tier): each left row with the first tier whose key column finds exactly one right row.

    ``tiers`` are (label, column present on both sides). A key that several right rows share is
    ambiguous and matches nothing; each pass sees only what earlier ones left. Null keys match
    nothing. Keys are aggregated on the right before they meet the left.
    """
    todo, found = left, None
    for label, column in tiers:
        unique = right.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(right_id).alias(right_id), F.count_distinct(right_id).alias("__n")).where("__n = 1").drop("__n")
        hit = todo.join(unique, column).select(left_id, right_id, F.lit(label).alias("tier"))
        found = hit if found is None else found.unionByName(hit)
        todo = todo.join(unique.select(column), column, "left_anti")
    return found


def list_counts(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row of counts, one column a condition, and ``total``."""
    return rows.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])
