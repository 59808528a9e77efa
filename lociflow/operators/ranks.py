"""Ranks, false discovery rates and rank tests from one range-partitioned sort, for groups of any size.

Equal values are counted before anything is sorted, so ties cost one row. The counted values are
range-partitioned by (group, value); what lies before a partition is known from the partitions'
totals, one row a group and partition. No group is ever in one task, unlike with a plain window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociflow.operators.skew import salted_join
from lociflow.session import cut

PART = "__part"


def value_counts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n) over rows with a value that is neither null nor NaN and no null key."""
    known = F.col(value).isNotNull() & ~F.isnan(value)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return rows.where(known).groupBy(*keys, value).agg(F.count("*").alias("n"))


def running_counts(counts: DataFrame, keys: list[str], value: str, weight: str = "n") -> DataFrame:
    """Adds below (weight of smaller values in the group) and total (weight of the group).

    ``counts`` has one row per key and value. Empty input gives no rows.
    """
    ordered = cut(counts.repartitionByRange(*keys, value).withColumn(PART, F.spark_partition_id()))
    inside = Window.partitionBy(*keys, PART).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ordered.groupBy(*keys, PART).agg(F.sum(weight).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, PART, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"), F.sum("__sum").over(Window.partitionBy(*keys)).alias("total"))
    placed = ordered.withColumn("__local", F.sum(weight).over(inside) - F.col(weight)).join(offsets, [*keys, PART])
    return placed.withColumn("below", F.col("__local") + F.col("__offset")).drop("__local", "__offset")


def benjamini_hochberg(rows: DataFrame, keys: list[str], p: str) -> DataFrame:
    """(keys, p, n, rank, total, q) per distinct p value: q = min over p' >= p of p' * total / rank(p'), at most 1.

    ``rank`` is that of the last of equal values. Only p values from 0 to 1 count. The minimum over
    larger values is taken within partitions and then over the partitions' minima.
    """
    counted = running_counts(value_counts(rows.where(F.col(p).between(0, 1)), keys, p), keys, p).withColumn("rank", F.col("below") + F.col("n"))
    raw = counted.withColumn("__raw", F.least(F.col(p) * F.col("total") / F.col("rank"), F.lit(1.0)))
    upward = Window.partitionBy(*keys, PART).orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy(*keys).orderBy(PART).rowsBetween(1, Window.unboundedFollowing)
    tails = raw.groupBy(*keys, PART).agg(F.min("__raw").alias("__least")).select(*keys, PART, F.min("__least").over(later).alias("__later"))
    local = raw.withColumn("__local", F.min("__raw").over(upward)).join(tails, [*keys, PART])
    return local.select(*keys, p, "n", "rank", "total", F.least("__local", "__later").alias("q"))


def with_fdr(rows: DataFrame, keys: list[str], p: str) -> DataFrame:
    """Every row with its q (null where p is no probability); values that occur very often are spread by salts."""
    q = benjamini_hochberg(rows, keys, p).select(*keys, p, "q")
    return salted_join(rows, q, [*keys, p], F.monotonically_increasing_id(), "left", salts=8)


def average_ranks(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n, total, rank): the mean rank of equal values."""
    counted = running_counts(value_counts(rows, keys, value), keys, value)
    return counted.select(*keys, value, "n", "total", (F.col("below") + (F.col("n") + 1) / 2).alias("rank"))


def order_statistics(rows: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """(keys, n, value): the q-quantile of every group, linear between neighbouring order statistics, exact."""
    counted = running_counts(value_counts(rows, keys, value), keys, value)
    place = F.lit(q) * (F.col("total") - 1)
    holds = lambda k: (F.col("below") <= k) & (F.col("below") + F.col("n") > k)
    near = counted.where(holds(F.floor(place)) | holds(F.ceil(place)))
    ends = near.groupBy(*keys).agg(F.max("total").alias("n"), F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    at = F.lit(q) * (F.col("n") - 1)
    return ends.select(*keys, "n", (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * (at - F.floor(at))).alias(value))


def rank_sum_test(scores: DataFrame, members: DataFrame, item: str, score: str, group: str) -> DataFrame:
    """(group, n_in, n_out, u, auc, z) of each group's items against all others.

    ``scores`` has one row per item, ``members`` (group, item). The normal approximation of
    'greater' corrects for ties and continuity. A group whose items have no score, or all the same,
    has auc 0.5 and z 0. Repeated members count once.
    """
    known = scores.where(F.col(item).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score)).select(item, score)
    ranks = cut(average_ranks(known, [], score))
    totals = ranks.agg(F.sum(F.pow("n", F.lit(3)) - F.col("n")).alias("ties"), F.coalesce(F.sum("n"), F.lit(0)).alias("N")).first()
    ranked = known.join(ranks.select(score, "rank"), score)
    sums = members.select(group, item).distinct().join(ranked, item).groupBy(group).agg(F.count("*").alias("n_in"), F.sum("rank").alias("r"), F.min(score).alias("lo"), F.max(score).alias("hi"))
    # a literal of a small number is an int, whose products overflow from 46,342 items on
    total, tied = F.lit(totals["N"]).cast("long"), F.lit(totals["ties"] or 0.0)
    n1, n2 = F.col("n_in"), total - F.col("n_in")
    u = F.col("r") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * ((total + 1) - F.try_divide(tied, total.cast("double") * (total - 1))))
    flat = (F.col("lo") == F.col("hi")) | (n2 == 0)
    return sums.select(group, "n_in", n2.alias("n_out"), u.alias("u"), F.when(flat, 0.5).otherwise(F.try_divide(u, n1 * n2)).alias("auc"), F.when(flat, 0.0).otherwise(F.try_divide(u - n1 * n2 / 2 - 0.5, sd)).alias("z"))
