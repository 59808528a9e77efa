"""Queries over expression-like profiles: the vectors of ``embeddings`` are profiles over 64 items, their labels conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.stats import t_two_sided
from lociflow.operators.estimators import weighted_lower_median
from lociflow.operators.profiles import consensus, directional_p, extreme_sum, extreme_sum_p, long_form, reversal_summary, spearman, top_contributors
from lociflow.plans.tails import t_two_sided_sql
from lociflow.session import table

#: Items of a profile.
ITEMS = 64


def profiles(spark: SparkSession, d: str) -> DataFrame:
    return long_form(table(spark, d, "embeddings"), ["vec_id", "label"], "embedding")


def conditions(spark: SparkSession, d: str) -> DataFrame:
    """The consensus profile of each label."""
    return consensus(profiles(spark, d), "label")


def correlations(spark: SparkSession, d: str) -> DataFrame:
    return spearman(conditions(spark, d), profiles(spark, d).select("vec_id", "item", "value"), "label", "vec_id", 10)


def s_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Median per label and item."""
    return conditions(spark, d).select("label", "item", F.round("value", 6).alias("value"), "n")


def s_spearman(spark: SparkSession, d: str) -> DataFrame:
    """Rank correlation of every profile with every condition, its two-sided p and the one-sided p of a reversal."""
    found = correlations(spark, d)
    t = F.col("rho") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("rho") * F.col("rho")))
    tested = found.withColumn("two_sided_p", t_two_sided(t, (F.col("n") - 2).cast("double")))
    reversal = directional_p(F.col("rho"), F.col("two_sided_p"))
    return tested.select("label", "vec_id", F.round("rho", 6).alias("rho"), "n", F.round("two_sided_p", 6).alias("two_sided_p"), F.round(reversal, 6).alias("reversal_p"))


def s_reversal(spark: SparkSession, d: str) -> DataFrame:
    """The condition each profile reverses most."""
    return reversal_summary(correlations(spark, d).withColumn("rho", F.round("rho", 6)), "label", "vec_id", 0.3)


def s_extreme_sum(spark: SparkSession, d: str) -> DataFrame:
    """Sum of a condition's values over each profile's 10 strongest items, signed."""
    x = extreme_sum(conditions(spark, d), profiles(spark, d).select("vec_id", "item", "value"), "label", "vec_id", 10)
    return x.select("label", "vec_id", F.round("xsum", 5).alias("xsum"))


def s_extreme_p(spark: SparkSession, d: str) -> DataFrame:
    """The same sums with their permutation p."""
    x = extreme_sum_p(conditions(spark, d), profiles(spark, d).select("vec_id", "item", "value"), "label", "vec_id", 10)
    return x.select("label", "vec_id", F.round("xsum", 5).alias("xsum"), F.round("p", 6).alias("p"))


def s_contributors(spark: SparkSession, d: str) -> DataFrame:
    """The 5 items that contribute most to each pair of condition and profile."""
    return top_contributors(conditions(spark, d), profiles(spark, d).select("vec_id", "item", "value"), "label", "vec_id", 5)


def s_weighted_median(spark: SparkSession, d: str) -> DataFrame:
    """Weighted lower median per label and item; profiles of even id count twice."""
    rows = profiles(spark, d).withColumn("w", F.when(F.col("vec_id") % 2 == 0, 2).otherwise(1).cast("long"))
    return weighted_lower_median(rows, ["label", "item"], "value", "w").select("label", "item", F.round("value", 6).alias("value"))


def s_label_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Mean of each label's items, all of them as columns."""
    p = profiles(spark, d).groupBy("label").pivot("item", list(range(ITEMS))).agg(F.avg("value"))
    return p.select("label", *[F.round(F.col(str(i)), 6).alias(f"item_{i}") for i in range(ITEMS)])


QUERIES = {q.__name__: q for q in (s_consensus, s_spearman, s_reversal, s_extreme_sum, s_extreme_p, s_contributors, s_weighted_median, s_label_pivot)}

_L = """l AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS value, generate_subscripts(embedding, 1) - 1 AS item FROM embeddings),
    c AS (SELECT label, item, median(value) AS value, count(*) AS n FROM l GROUP BY label, item)"""
_RHO = f"""{_L}, a AS (SELECT label, item, rank() OVER (PARTITION BY label ORDER BY value) + (count(*) OVER (PARTITION BY label, value) - 1) / 2 AS a FROM c),
    b AS (SELECT vec_id, item, rank() OVER (PARTITION BY vec_id ORDER BY value) + (count(*) OVER (PARTITION BY vec_id, value) - 1) / 2 AS b FROM l),
    raw AS (SELECT label, vec_id, corr(a, b) AS r, count(*) AS n FROM a JOIN b USING (item) GROUP BY label, vec_id),
    rho AS (SELECT *, round(r, 6) AS rho FROM raw)"""

SQL = {
    "s_consensus": f"WITH {_L} SELECT label, item, round(value, 6) AS value, n FROM c",
    "s_spearman": f"""WITH {_RHO}, t AS (SELECT *, {t_two_sided_sql("r * sqrt((n - 2) / (1 - r * r))", "n - 2")} AS p2 FROM rho)
        SELECT label, vec_id, rho, n, round(p2, 6) AS two_sided_p, round(CASE WHEN r < 0 THEN p2 / 2 WHEN r > 0 THEN 1 - p2 / 2 ELSE 0.5 END, 6) AS reversal_p FROM t""",
    "s_reversal": f"""WITH {_RHO}, m AS (SELECT vec_id, label AS best, rho FROM rho QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY rho, label) = 1)
        SELECT vec_id, any_value(best) AS best, any_value(m.rho) AS rho, count(*) AS n_left, count(*) FILTER (abs(r.rho) >= 0.3) AS n_strong, count(*) FILTER (r.rho < 0) AS n_reversing FROM rho r JOIN m USING (vec_id) GROUP BY vec_id""",
    "s_extreme_sum": f"""WITH {_L}, s AS (SELECT vec_id, item, sign(value) AS s FROM l QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY abs(value) DESC, item) <= 10)
        SELECT label, vec_id, round(sum(c.value * s), 5) AS xsum FROM c JOIN s USING (item) GROUP BY label, vec_id""",
    "s_contributors": f"""WITH {_L}, p AS (SELECT c.label, l.vec_id, item, row_number() OVER (PARTITION BY c.label, vec_id ORDER BY abs(c.value * l.value) DESC, item) AS i FROM c JOIN l USING (item))
        SELECT label, vec_id, string_agg(CAST(item AS VARCHAR), ',' ORDER BY i) AS items FROM p WHERE i <= 5 GROUP BY label, vec_id""",
    "s_weighted_median": f"""WITH {_L}, w AS (SELECT label, item, value, sum(CASE WHEN vec_id % 2 = 0 THEN 2 ELSE 1 END) AS w FROM l GROUP BY label, item, value),
        t AS (SELECT *, sum(w) OVER (PARTITION BY label, item ORDER BY value) AS run, sum(w) OVER (PARTITION BY label, item) AS total FROM w)
        SELECT label, item, round(min(value), 6) AS value FROM t WHERE run * 2 >= total GROUP BY label, item""",
    "s_label_pivot": f"WITH {_L} SELECT label, " + ", ".join(f"round(avg(value) FILTER (item = {i}), 6) AS item_{i}" for i in range(ITEMS)) + " FROM l GROUP BY label",
}
