"""Exact percentiles per group from one distributed sort, with a state that adds up over days.

The mergeable state is the multiset of values as (group, value, count). Counts of equal values add
up, so the states of days or partitions combine by addition and nothing is lost. To read
percentiles from a state it is range-partitioned by (group, value), sorted within partitions, and
counted along; the partitions' totals per group give each partition's offset, and with it the
place of any order statistic. A group of any size is spread over many partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociflow.session import cut

PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def value_state(rows: DataFrame, group: str, value: str, day: str | None = None) -> DataFrame:
    """(group[, day], value, n): how often each valid value (not null, not NaN, 0 to 1) occurs.

    Counted within partitions before the shuffle, so ties cost one row. Invalid values are left
    out; a null group or day is a group of its own.
    """
    valid = rows.where(F.col(value).isNotNull() & ~F.isnan(value) & F.col(value).between(0, 1))
    keys = [F.col(group).alias("grp"), *([F.col(day).alias("day")] if day else [])]
    return valid.groupBy(*keys, F.col(value).alias("value")).agg(F.count("*").alias("n"))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state of several (of days, partitions or tables): equal values' counts add up."""
    union = states[0].select("grp", "value", "n")
    for s in states[1:]:
        union = union.unionByName(s.select("grp", "value", "n"))
    return union.groupBy("grp", "value").agg(F.sum("n").alias("n"))


def _count_along(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds, within a sorted partition, the rank below each value's first occurrence in its group."""
    last, total = object(), 0
    for batch in batches:
        if batch.empty:
            continue
        n = batch["n"].to_numpy()
        below = np.cumsum(n) - n
        code = batch["grp"].factorize(use_na_sentinel=False)[0]
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        base = np.repeat(below[starts], np.diff(np.r_[starts, len(n)]))
        rank = below - base
        first, same = batch["grp"].iloc[0], False
        same = first == last or (pd.isna(first) and last is None)
        if same:
            end = starts[1] if len(starts) > 1 else len(n)
            rank[:end] += total
        tail = batch["grp"].iloc[-1]
        last = None if pd.isna(tail) else tail
        total = int(rank[-1] + n[-1])
        yield batch.assign(below=rank)


def percentiles(state: DataFrame, at: Sequence[float] = PERCENTILES) -> DataFrame:
    """(grp, q, n, value): each percentile of each group, linear between neighbouring order statistics.

    The rank is q * (n - 1), as in the usual continuous percentile. Exact: no sampling, no sketch.
    The counted sort is written once to the shared folder, as both the offsets and the look-up
    must see the same partitions. Groups without valid values have no rows.
    """
    size = "grp string, value double, n long, below long, part int"
    ordered = state.select(F.col("grp").cast("string").alias("grp"), "value", "n").repartitionByRange("grp", "value").sortWithinPartitions("grp", "value")
    counted = cut(ordered.mapInPandas(_count_along, "grp string, value double, n long, below long").withColumn("part", F.spark_partition_id()).selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) {c.split()[0]}" for c in size.split(", ")]))
    totals = counted.groupBy("grp", "part").agg(F.sum("n").alias("m"), F.min("value").alias("lowest"))
    # partitions are in order of value within a group: one row a group and partition, however many values
    by_part = Window.partitionBy("grp").orderBy("lowest")
    whole = Window.partitionBy("grp")
    offsets = totals.select("grp", "part", (F.sum("m").over(by_part) - F.col("m")).alias("offset"), F.sum("m").over(whole).alias("total"), "m")
    wanted = offsets.select("grp", "part", "offset", "total", "m", F.explode(F.array(*map(F.lit, at))).alias("q"))
    place = F.col("q") * (F.col("total") - 1)
    ends = wanted.withColumn("place", place).select("grp", "part", "q", "total", (place - F.floor(place)).alias("between"), F.explode(F.array(F.struct(F.lit(0).alias("side"), F.floor("place").alias("k")), F.struct(F.lit(1).alias("side"), F.ceil("place").alias("k")))).alias("e"), "offset", "m")
    here = ends.where((F.col("e.k") >= F.col("offset")) & (F.col("e.k") < F.col("offset") + F.col("m"))).select(F.col("grp").alias("g"), F.col("part").alias("p"), "q", "total", "between", "e.side", (F.col("e.k") - F.col("offset")).alias("k"))
    inside = (F.col("k") >= F.col("below")) & (F.col("k") < F.col("below") + F.col("n"))
    hits = counted.join(here, counted.grp.eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")) & inside)
    pick = lambda side: F.max(F.when(F.col("side") == side, F.col("value")))
    got = hits.groupBy("g", "q").agg(F.max("total").alias("n"), F.max("between").alias("w"), pick(0).alias("lo"), pick(1).alias("hi"))
    return got.select(F.col("g").alias("grp"), "q", "n", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("w")).alias("value"))
