"""Permutation tests of sets and regressions of classes, from sums and from one null distribution a set size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items (genes) of a permutation test: a vocabulary, checked, as each task draws from all of it.
MOST_ITEMS = 200_000
#: Draws of a set size that one row (and so one task) makes.
BLOCK_DRAWS = 500


def permutation_test(scores: DataFrame, members: DataFrame, item: str, score: str, group: str, draws: int = 10_000, seed: int = 42) -> DataFrame:
    """(group, n_in, mean, p): how often random sets of the same size have a mean score at least as large.

    p = (hits + 1) / (draws + 1). The null means are drawn once per set size in blocks, each seeded by
    its size and number and a row of its own, and the blocks' hits are added up; groups of one size
    share them. The scores are broadcast, their number being checked. Items without a score don't count.
    """
    known = scores.where(F.col(item).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score)).select(item, score)
    rows = known.orderBy(item).limit(MOST_ITEMS + 1).collect()
    if len(rows) > MOST_ITEMS:
        raise ValueError(f"a permutation test is over a vocabulary of at most {MOST_ITEMS} items")
    spark = scores.sparkSession
    shared = spark.sparkContext.broadcast(np.array([r[score] for r in rows], float))
    means = members.select(group, item).distinct().join(known, item).groupBy(group).agg(F.count("*").alias("n_in"), F.avg(score).alias("mean"))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values = shared.value
        for batch in batches:
            for n, block in batch[["n_in", "block"]].itertuples(index=False, name=None):
                rng = np.random.default_rng([seed, int(n), int(block)] if block else [seed, int(n)])
                size = min(BLOCK_DRAWS, draws - block * BLOCK_DRAWS)
                null = [values[rng.choice(len(values), int(n), replace=False)].mean() for _ in range(size)]
                yield pd.DataFrame({"n_in": [n], "null": [null]})

    blocks = means.select("n_in").distinct().withColumn("block", F.explode(F.sequence(F.lit(0), F.lit((draws - 1) // BLOCK_DRAWS))))
    # a number of partitions is given, else these few small rows would end up in one task
    spread = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "n_in", "block")
    nulls = spread.mapInPandas(draw, "n_in long, null array<double>")
    hits = F.size(F.filter("null", lambda m: m >= F.col("mean") - 1e-12))
    counted = means.join(nulls, "n_in").withColumn("__hits", hits).groupBy(group).agg(F.first("n_in").alias("n_in"), F.first("mean").alias("mean"), F.sum("__hits").alias("__hits"))
    return counted.select(group, "n_in", "mean", ((F.col("__hits") + 1) / (draws + 1)).alias("p"))


def class_regression(items: DataFrame, members: DataFrame, item: str, y: str, size: str, cls: str, least: int = 2) -> DataFrame:
    """(class, n_members, beta, se, t): y on membership, set size and its logarithm, by least squares per class.

    ``items`` is one row per item with y and its size (above 0); ``members`` (item, class). The
    cross products of all items are summed once and each class adds those of its members, so a class
    is a row of sums when its 4 x 4 system is solved. Classes that leave no freedom have null estimates.
    """
    usable = items.where(F.col(y).isNotNull() & ~F.isnan(y) & (F.col(size) > 0)).select(item, F.col(y).cast("double").alias("y"), F.col(size).cast("double").alias("n"), F.ln(size).alias("l"))
    terms = {"s1": F.lit(1.0), "sn": F.col("n"), "sl": F.col("l"), "sy": F.col("y"), "snn": F.col("n") * F.col("n"), "snl": F.col("n") * F.col("l"), "sll": F.col("l") * F.col("l"), "sny": F.col("n") * F.col("y"), "sly": F.col("l") * F.col("y"), "syy": F.col("y") * F.col("y")}
    whole = usable.agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(k) for k, v in terms.items()]).first().asDict()
    sums = members.select(item, cls).distinct().join(usable, item).groupBy(F.col(cls).alias("cls")).agg(*[F.sum(terms[k]).alias(k) for k in ("s1", "sn", "sl", "sy")]).where(F.col("s1") >= least)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = whole
        for batch in batches:
            out = []
            for cls_, c1, cn, cl, cy in batch.itertuples(index=False, name=None):
                a = np.array([[w["s1"], c1, w["sn"], w["sl"]], [c1, c1, cn, cl], [w["sn"], cn, w["snn"], w["snl"]], [w["sl"], cl, w["snl"], w["sll"]]])
                right = np.array([w["sy"], cy, w["sny"], w["sly"]])
                free = w["s1"] - 4
                if free < 1 or np.linalg.matrix_rank(a) < 4:
                    out.append((cls_, int(c1), None, None, None))
                    continue
                inverse = np.linalg.inv(a)
                fit = inverse @ right
                se = float(np.sqrt(max(w["syy"] - fit @ right, 0.0) / free * inverse[1, 1]))
                out.append((cls_, int(c1), float(fit[1]), se, float(fit[1]) / se if se > 0 else None))
            yield pd.DataFrame(out, columns=["cls", "n_members", "beta", "se", "t"])

    return sums.mapInPandas(solve, "cls string, n_members long, beta double, se double, t double").withColumnRenamed("cls", cls)
