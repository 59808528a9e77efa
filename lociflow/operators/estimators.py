"""Meta-analysis, Mendelian randomisation and colocalisation as sums that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.operators.ranks import running_counts


def inverse_variance_meta(rows: DataFrame, keys: list[str], beta: str, se: str, label: str, p: str) -> DataFrame:
    """(keys, k, beta, se, z, q, i2, best): fixed-effects meta-analysis of each group.

    One row is passed through (q 0, i2 0); ``best`` is the label of the smallest p. Rows without a
    finite effect or a positive standard error are left out. Q comes from the same sums, in one pass.
    """
    b, w = F.col(beta), 1 / (F.col(se) * F.col(se))
    usable = rows.where((F.col(se) > 0) & ~F.isnan(se) & b.isNotNull() & ~F.isnan(b))
    sums = usable.groupBy(*keys).agg(F.count("*").alias("k"), F.sum(w).alias("w"), F.sum(w * b).alias("wb"), F.sum(w * b * b).alias("wbb"), F.min(F.struct(F.coalesce(F.col(p), F.lit(2.0)), F.col(label))).alias("m"))
    q = F.when(F.col("k") > 1, F.greatest(F.col("wbb") - F.col("wb") * F.col("wb") / F.col("w"), F.lit(0.0))).otherwise(0.0)
    i2 = F.when(q > 0, F.greatest((q - (F.col("k") - 1)) / q * 100, F.lit(0.0))).otherwise(0.0)
    return sums.select(*keys, "k", (F.col("wb") / F.col("w")).alias("beta"), (1 / F.sqrt("w")).alias("se"), (F.col("wb") / F.sqrt("w")).alias("z"), q.alias("q"), i2.alias("i2"), F.col(f"m.{label}").alias("best"))


def mendelian_estimates(rows: DataFrame, key: str, bx: str, sx: str, by: str, sy: str) -> DataFrame:
    """Per key: lead Wald ratio, fixed and multiplicative random effects, Cochran's Q and Egger regression.

    The lead is the instrument with the largest |bx / sx| (ties: the larger bx). With one
    instrument only the Wald ratio is given; Egger needs three, and orients every instrument to a
    positive bx. Everything is a closed form of weighted sums, in one partial aggregation.
    """
    x, y, w = F.col(bx), F.col(by), 1 / (F.col(sy) * F.col(sy))
    usable = rows.where((F.col(sx) > 0) & (F.col(sy) > 0) & (x != 0) & ~F.isnan(x) & ~F.isnan(y))
    ox, oy = F.abs(x), y * F.signum(x)
    sums = usable.groupBy(key).agg(
        F.count("*").alias("k"), F.max(F.struct(F.abs(x / F.col(sx)), x.alias("x"), F.col(sx).alias("sx"), y.alias("y"), F.col(sy).alias("sy"))).alias("lead"),
        *[F.sum(v).alias(n) for n, v in {"w": w, "wx": w * ox, "wy": w * oy, "wxx": w * ox * ox, "wxy": w * ox * oy, "wyy": w * oy * oy}.items()],
    )
    c, k = F.col, F.col("k")
    lead = lambda n: F.col(f"lead.{n}")
    wald = lead("y") / lead("x")
    wald_se = F.sqrt(F.pow(lead("sy") / lead("x"), 2) + F.pow(lead("y") * lead("sx") / (lead("x") * lead("x")), 2))
    ivw, ivw_se = c("wxy") / c("wxx"), 1 / F.sqrt("wxx")
    q = F.greatest(c("wyy") - c("wxy") * c("wxy") / c("wxx"), F.lit(0.0))
    d = c("w") * c("wxx") - c("wx") * c("wx")
    slope = F.try_divide(c("w") * c("wxy") - c("wx") * c("wy"), d)
    intercept = F.try_divide(c("wxx") * c("wy") - c("wx") * c("wxy"), d)
    sse = c("wyy") - intercept * c("wy") - slope * c("wxy")
    spread = F.greatest(F.try_divide(sse, k - 2), F.lit(1.0))
    two, three = (lambda v: F.when(k >= 2, v)), (lambda v: F.when(k >= 3, v))
    return sums.select(
        key, "k", wald.alias("wald"), wald_se.alias("wald_se"), two(ivw).alias("ivw"), two(ivw_se).alias("ivw_se"), two(q).alias("q"),
        two(ivw_se * F.greatest(F.lit(1.0), F.sqrt(F.try_divide(q, k - 1)))).alias("ivw_re_se"),
        three(slope).alias("egger"), three(F.sqrt(F.try_divide(spread * c("w"), d))).alias("egger_se"), three(intercept).alias("intercept"), three(F.sqrt(F.try_divide(spread * c("wxx"), d))).alias("intercept_se"),
    )


def weighted_lower_median(rows: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """(keys, value): the smallest value at which the running weight reaches half of the group's; null or NaN values don't count.

    Groups of no or zero weight have no row. Equal values' weights are added up before the sort.
    """
    known = rows.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.col(weight) > 0))
    summed = known.groupBy(*keys, value).agg(F.sum(weight).alias("__w"))
    placed = running_counts(summed, keys, value, "__w")
    return placed.where((F.col("below") + F.col("__w")) * 2 >= F.col("total")).groupBy(*keys).agg(F.min(value).alias(value))


def interpolated_median_ratio(rows: DataFrame, key: str, identity: str, bx: str, sx: str, by: str, sy: str) -> DataFrame:
    """(key, k, ratio): weighted median of the Wald ratios (Bowden et al. 2016), for keys of three or more instruments.

    Weights are inverse second-order variances. Each ratio (ties by ``identity``, unique) is placed
    at the middle of its share of the weight; the median lies between the two around one half.
    """
    x, y = F.col(bx), F.col(by)
    usable = rows.where((F.col(sx) > 0) & (F.col(sy) > 0) & (x != 0) & ~F.isnan(x) & ~F.isnan(y))
    ratios = usable.select(key, F.struct((y / x).alias("ratio"), F.col(identity).alias("i")).alias("__at"), (1 / (F.pow(F.col(sy) / x, 2) + F.pow(y * F.col(sx) / (x * x), 2))).alias("__w"))
    placed = running_counts(ratios, [key], "__at", "__w").withColumn("mid", (F.col("below") + F.col("__w") / 2) / F.col("total"))
    spot = F.struct("mid", F.col("__at.ratio").alias("ratio"), F.col("__at.i").alias("i"))
    ends = placed.groupBy(key).agg(F.count("*").alias("k"), F.max(F.when(F.col("mid") < 0.5, spot)).alias("a"), F.min(F.when(F.col("mid") >= 0.5, spot)).alias("b")).where("k >= 3")
    between = F.col("a.ratio") + (F.col("b.ratio") - F.col("a.ratio")) * (0.5 - F.col("a.mid")) / (F.col("b.mid") - F.col("a.mid"))
    return ends.select(key, "k", F.coalesce(between, "b.ratio", "a.ratio").alias("ratio"))


def log_bayes_factor(beta: Column, se: Column, prior_variance: float) -> Column:
    """Wakefield's log approximate Bayes factor."""
    v = se * se
    r = prior_variance / (prior_variance + v)
    return 0.5 * (F.ln(1 - r) + r * beta * beta / v)


def colocalisation(rows: DataFrame, keys: list[str], one: str, two: str, p1: float = 1e-4, p2: float = 1e-4, p12: float = 1e-5) -> DataFrame:
    """(keys, n_snps, h0 .. h4): posteriors that neither, one, both apart, or one shared variant is causal.

    ``one`` and ``two`` are log Bayes factors per shared variant. Sums of exponentials are taken
    relative to the group's largest, in two aggregations; no group is collected. A prior that the
    group's variants would push to 1 or more is lowered to 1 / (n + 1).
    """
    known = rows.where(F.col(one).isNotNull() & F.col(two).isNotNull())
    tops = known.groupBy(*keys).agg(F.max(one).alias("m1"), F.max(two).alias("m2"), F.max(F.col(one) + F.col(two)).alias("m3"))
    scaled = known.join(tops, keys).groupBy(*keys).agg(
        F.count("*").alias("n_snps"), *[F.first(m).alias(m) for m in ("m1", "m2", "m3")],
        F.sum(F.exp(F.col(one) - F.col("m1"))).alias("e1"), F.sum(F.exp(F.col(two) - F.col("m2"))).alias("e2"), F.sum(F.exp(F.col(one) + F.col(two) - F.col("m3"))).alias("e3"),
    )
    s1, s2, s3 = (F.col(f"m{i}") + F.ln(f"e{i}") for i in (1, 2, 3))
    rest = 1 - F.exp(s3 - s1 - s2)
    apart = F.when(rest > 1e-12, s1 + s2 + F.ln(rest))  # null: no pair of different variants
    l1, l2, l12 = (F.ln(F.when(F.col("n_snps") * p < 1, F.lit(p)).otherwise(1 / (F.col("n_snps") + 1))) for p in (p1, p2, p12))
    logs = [F.lit(0.0), l1 + s1, l2 + s2, l1 + l2 + apart, l12 + s3]
    logged = scaled.select(*keys, "n_snps", *[v.alias(f"l{i}") for i, v in enumerate(logs)])
    top = F.greatest(*[F.col(f"l{i}") for i in range(5)])
    parts = [F.coalesce(F.exp(F.col(f"l{i}") - top), F.lit(0.0)) for i in range(5)]
    return logged.select(*keys, "n_snps", *[(p / sum(parts[1:], parts[0])).alias(f"h{i}") for i, p in enumerate(parts)])


def steiger_z(r2_exposure: Column, r2_outcome: Column, n_exposure: Column, n_outcome: Column) -> Column:
    """Difference of the Fisher-transformed correlations in units of its standard error."""
    return F.try_divide(F.atanh(F.sqrt(r2_exposure)) - F.atanh(F.sqrt(r2_outcome)), F.sqrt(1 / (n_exposure - 3) + 1 / (n_outcome - 3)))
