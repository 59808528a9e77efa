"""Expression-like profiles: long form, group medians, rank correlation and extreme sums."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.operators.ranks import order_statistics, running_counts
from lociflow.operators.skew import salted_join
from lociflow.session import cut

#: Permutations that one row (and so one task) draws.
BLOCK_DRAWS = 500


def long_form(rows: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """(keys, item, value): one row per position of an array column, from 0."""
    return rows.select(*keys, F.posexplode(vector).alias("item", "value")).withColumn("value", F.col("value").cast("double"))


def consensus(long: DataFrame, group: str) -> DataFrame:
    """(group, item, value, n): the exact median per item over a group's profiles; nulls and NaN don't count.

    From one distributed sort, so a label with a third of all profiles is in no single task.
    """
    return order_statistics(long, [group, "item"], "value", 0.5)


def with_rank(long: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the average rank of each value within its profile (a profile is as long as its list of items)."""
    ordered = Window.partitionBy(*keys).orderBy("value")
    ties = Window.partitionBy(*keys, "value")
    return long.withColumn("rank", F.rank().over(ordered) + (F.count("*").over(ties) - 1) / 2)


def spearman(left: DataFrame, right: DataFrame, left_key: str, right_key: str, least: int) -> DataFrame:
    """(left_key, right_key, rho, n): rank correlation of every left profile (few) with every right profile.

    Both are (key, item, value), complete over the same items; profiles meet on their items.
    ``left`` is a set of reference profiles. Pairs with fewer than ``least`` items or a constant
    profile have no row.
    """
    a = with_rank(left, [left_key]).select(left_key, "item", F.col("rank").alias("__a"))
    b = with_rank(right, [right_key]).select(right_key, "item", F.col("rank").alias("__b"))
    n, x, y = F.count("*").alias("n"), F.col("__a"), F.col("__b")
    sums = a.join(b, "item").groupBy(left_key, right_key).agg(n, *[F.sum(v).alias(k) for k, v in {"sx": x, "sy": y, "sxx": x * x, "syy": y * y, "sxy": x * y}.items()]).where(F.col("n") >= least)
    c = F.col
    spread = (c("n") * c("sxx") - c("sx") * c("sx")) * (c("n") * c("syy") - c("sy") * c("sy"))
    return sums.where(spread > 0).select(left_key, right_key, ((c("n") * c("sxy") - c("sx") * c("sy")) / F.sqrt(spread)).alias("rho"), "n")


def directional_p(rho: Column, p: Column) -> Column:
    """One-sided p of a negative correlation from the two-sided one."""
    return F.when(rho < 0, p / 2).when(rho > 0, 1 - p / 2).otherwise(0.5)


def extreme_sum(left: DataFrame, right: DataFrame, left_key: str, right_key: str, top: int) -> DataFrame:
    """(left_key, right_key, xsum): the left values over each right profile's ``top`` largest by size, signed by the right."""
    order = Window.partitionBy(right_key).orderBy(F.abs(F.col("value")).desc(), "item")
    strong = right.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= top).select(right_key, "item", F.signum("value").alias("__s"))
    return left.join(strong, "item").groupBy(left_key, right_key).agg(F.sum(F.col("value") * F.col("__s")).alias("xsum"))


def extreme_sum_p(left: DataFrame, right: DataFrame, left_key: str, right_key: str, top: int, draws: int = 1_000, seed: int = 42) -> DataFrame:
    """(left_key, right_key, xsum, p): extreme sums and how often the left profile, shuffled, gives one as small.

    p = (hits + 1) / (draws + 1). Shuffling only changes which values meet the ups and which the downs,
    so a left profile and a number of each share one null distribution, drawn in seeded blocks. Draws and
    observed sums are sorted together, once, to count the draws at or below every sum. Sums are
    compared to nine digits. Right profiles of fewer than ``top`` items have no row.
    """
    order = Window.partitionBy(right_key).orderBy(F.abs(F.col("value")).desc(), "item")
    strong = right.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= top).select(right_key, "item", F.signum("value").alias("__s"))
    up, down = F.count_if(F.col("__s") > 0).alias("up"), F.count_if(F.col("__s") < 0).alias("down")
    met = left.join(strong, "item").groupBy(left_key, right_key)
    sums = cut(met.agg(F.round(F.sum(F.col("value") * F.col("__s")), 9).alias("xsum"), up, down, F.count("*").alias("__n")).where(F.col("__n") == top).drop("__n"))
    values = left.groupBy(left_key).agg(F.array_sort(F.collect_list(F.struct("item", "value"))).alias("all")).select(left_key, F.transform("all", lambda x: x["value"]).alias("values"))
    blocks = sums.select(left_key, "up", "down").distinct().withColumn("block", F.explode(F.sequence(F.lit(0), F.lit((draws - 1) // BLOCK_DRAWS))))
    spark = left.sparkSession
    # a number of partitions is given, else these few small rows would end up in one task
    tasks = blocks.join(values, left_key).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), left_key, "up", "down", "block")

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, up_, down_, block, profile in batch.itertuples(index=False, name=None):
                rng = np.random.default_rng([seed, zlib.crc32(str(key).encode()), int(up_), int(down_), int(block)])
                size = min(BLOCK_DRAWS, draws - block * BLOCK_DRAWS)
                shuffled = rng.permuted(np.tile(np.asarray(profile, float), (size, 1)), axis=1)
                null = shuffled[:, :up_].sum(axis=1) - shuffled[:, up_ : up_ + down_].sum(axis=1)
                yield pd.DataFrame({"key": key, "up": up_, "down": down_, "xsum": null})

    kind = left.schema[left_key].dataType.simpleString()
    nulls = tasks.select(left_key, "up", "down", "block", "values").mapInPandas(draw, f"key {kind}, up long, down long, xsum double")
    drawn = nulls.select(F.col("key").alias(left_key), "up", "down", F.round("xsum", 9).alias("xsum"), F.lit(1).alias("n"))
    both = drawn.unionByName(sums.select(left_key, "up", "down", "xsum", F.lit(0).alias("n")))
    keys = [left_key, "up", "down"]
    placed = running_counts(both.groupBy(*keys, "xsum").agg(F.sum("n").alias("n")), keys, "xsum")
    hits = placed.select(*keys, "xsum", (F.col("below") + F.col("n")).alias("hits"))
    tested = salted_join(sums, hits, [*keys, "xsum"], F.col(right_key), salts=4)
    return tested.select(left_key, right_key, "xsum", ((F.col("hits") + 1) / (draws + 1)).alias("p"))


def reversal_summary(pairs: DataFrame, left_key: str, right_key: str, strong: float) -> DataFrame:
    """(right_key, best, rho, n_left, n_strong, n_reversing): the left profile each right one reverses most."""
    return pairs.groupBy(right_key).agg(F.min(F.struct("rho", left_key)).alias("m"), F.count("*").alias("n_left"), F.count_if(F.abs("rho") >= strong).alias("n_strong"), F.count_if(F.col("rho") < 0).alias("n_reversing")).select(
        right_key, F.col(f"m.{left_key}").alias("best"), F.col("m.rho").alias("rho"), "n_left", "n_strong", "n_reversing"
    )


def top_contributors(left: DataFrame, right: DataFrame, left_key: str, right_key: str, top: int) -> DataFrame:
    """(left_key, right_key, items): the items whose product of values is largest by size, best first, as a list of text.

    Each task keeps the ``top`` of a pair before the shuffle, so whole profiles are never gathered.
    """
    ours, theirs = left.select(left_key, "item", F.col("value").alias("__l")), right.select(right_key, "item", F.col("value").alias("__v"))
    products = ours.join(theirs, "item").withColumn("__s", -F.abs(F.col("__l") * F.col("__v")))
    order = Window.partitionBy(left_key, right_key).orderBy("__s", "item")
    best = products.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= top)
    listed = best.groupBy(left_key, right_key).agg(F.array_sort(F.collect_list(F.struct("__r", "item"))).alias("all"))
    return listed.select(left_key, right_key, F.array_join(F.transform("all", lambda x: x["item"].cast("string")), ",").alias("items"))
