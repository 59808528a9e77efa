"""Queries over variants that studies share: harmonisation, meta-analysis, Mendelian randomisation, colocalisation.

Studies meet on the same variant, never on a region's best rows: by rs number, then by place for
those whose number the other side hasn't. Effects are laid to the same allele.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.alleles import complement, is_palindromic, orientation
from lociflow.functions.stats import chi2_upper, normal_two_sided, t_two_sided
from lociflow.operators.estimators import colocalisation, interpolated_median_ratio, inverse_variance_meta, log_bayes_factor, mendelian_estimates, steiger_z
from lociflow.operators.merging import keep_first
from lociflow.plans.tails import chi2_upper_sql, normal_two_sided_sql, t_two_sided_sql
from lociflow.plans.variants import CANONICAL_SQL, MEGABASE, canonical
from lociflow.session import table

#: The study that stands for the outcome.
OUTCOME = "GS00001"
#: Fixed value: how far from one half a palindrome's frequencies must be.
PALINDROME_MARGIN = 0.08
#: Least F statistic of an instrument.
LEAST_F = 4
PRIOR_VARIANCE = 0.04


def spellings(a1: Column, a2: Column) -> Column:
    """One name for all four spellings of an allele pair: either order, either strand."""
    c1, c2 = complement(a1), complement(a2)
    pairs = ((a1, a2), (a2, a1), (c1, c2), (c2, c1))
    return F.least(*[F.concat_ws("/", x, y) for x, y in pairs])


def usable_rows(spark: SparkSession, d: str) -> DataFrame:
    """Canonical rows with alleles, effect, standard error and p, and the effect allele's frequency where the study reports that."""
    known = "p > 0 and p <= 1 and se > 0 and beta is not null and a1 is not null and a2 is not null"
    effect_allele = table(spark, d, "gwas_studies").where("frequency_column_is = 'EAF'").select("study_id", F.lit(True).alias("eaf_known")).distinct()
    rows = canonical(spark, d).where(known).join(effect_allele, "study_id", "left")
    frequency = F.when(F.col("eaf_known") & F.col("maf").between(0, 1), F.col("maf"))
    named = rows.withColumns({"eaf": frequency, "alleles": spellings(F.col("a1"), F.col("a2"))})
    return named.select("row_id", "study_id", "snp", "chr", "pos", "a1", "a2", "alleles", "eaf", "beta", "se", "p", "n")


def laid_to(rows: DataFrame, panel: DataFrame) -> DataFrame:
    """Rows beside the panel's row of the same variant, with ``via`` and ``how``; panel columns carry the prefix ``o_``.

    By rs number, then by place for rows whose number the panel hasn't. Of the panel's rows of one
    variant and allele pair the smallest row_id counts; other allele pairs match nothing.
    """
    values = [F.col(c).alias(f"o_{c}") for c in ("row_id", "a1", "a2", "eaf", "beta", "se", "p", "n")]

    def first(keys: list[str]) -> DataFrame:
        known = " and ".join(f"{k} is not null" for k in keys)
        return keep_first(panel.where(known).select(*keys, "alleles", *values), [*keys, "alleles"], [F.col("o_row_id")])

    named = rows.join(first(["snp"]), ["snp", "alleles"]).withColumn("via", F.lit("snp"))
    unnamed = rows.join(panel.select("snp").distinct(), "snp", "left_anti")
    placed = unnamed.join(first(["chr", "pos"]), ["chr", "pos", "alleles"]).withColumn("via", F.lit("place"))
    how = orientation(F.col("a1"), F.col("a2"), F.col("o_a1"), F.col("o_a2"))
    return named.unionByName(placed).withColumn("how", how)


def strand_told(how: Column) -> Column:
    """Whether a palindrome's frequencies tell its strand: both known, apart from one half, on the same side."""
    theirs = F.when(how == "direct", F.col("o_eaf")).when(how == "flipped", 1 - F.col("o_eaf"))
    apart = (F.abs(F.col("eaf") - 0.5) >= PALINDROME_MARGIN) & (F.abs(theirs - 0.5) >= PALINDROME_MARGIN)
    return F.coalesce(apart & ((F.col("eaf") < 0.5) == (theirs < 0.5)), F.lit(False))


def shared_variants(spark: SparkSession, d: str) -> DataFrame:
    """Each other study's variants beside the outcome study's row of the same variant, its effect laid to the same allele.

    Palindromes stay only where frequencies tell their strand. One row a study and outcome row (the
    smallest row_id); the outcome study is no partner of itself.
    """
    rows = usable_rows(spark, d)
    pairs = laid_to(rows.where(F.col("study_id") != OUTCOME), rows.where(F.col("study_id") == OUTCOME))
    kept = pairs.where(~is_palindromic(F.col("a1"), F.col("a2")) | strand_told(F.col("how")))
    signed = kept.withColumn("o_beta", F.when(F.col("how").endswith("flipped"), -F.col("o_beta")).otherwise(F.col("o_beta")))
    return keep_first(signed, ["study_id", "o_row_id"], [F.col("row_id")])


def instruments(spark: SparkSession, d: str) -> DataFrame:
    """Shared variants strong enough in the exposure. The tables tell no linkage, so none is clumped away."""
    return shared_variants(spark, d).where(F.pow(F.col("beta") / F.col("se"), 2) >= LEAST_F)


def v_harmonised(spark: SparkSession, d: str) -> DataFrame:
    """All rows laid to one panel: per place the first spelling of its first allele pair, as the tables themselves give it.

    The panel is derived from all studies: its rs number is the smallest at the place. Palindromes are
    dropped; a flipped row changes the sign of its effect.
    """
    rows = usable_rows(spark, d).where(~is_palindromic(F.col("a1"), F.col("a2")))
    spelt = rows.where("chr is not null and pos is not null").groupBy("chr", "pos").agg(F.min("alleles").alias("alleles"), F.min("snp").alias("snp"), F.min("row_id").alias("row_id"))
    letters = F.split("alleles", "/")
    nothing = {c: F.lit(None).cast("double") for c in ("eaf", "beta", "se", "p")} | {"n": F.lit(None).cast("long")}
    panel = spelt.withColumns({"a1": letters[0], "a2": letters[1], **nothing})
    laid = laid_to(rows, panel)
    beta = F.when(F.col("how").endswith("flipped"), -F.col("beta")).otherwise(F.col("beta"))
    return laid.select("row_id", F.col("o_row_id").alias("panel_row"), "via", "how", F.round(beta, 6).alias("beta"))


def v_shared(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of a study's variant and the outcome's, and how they were laid together."""
    return shared_variants(spark, d).select("row_id", "o_row_id", "via", "how", F.round("beta", 6).alias("beta"), F.round("o_beta", 6).alias("o_beta"))


def v_meta(spark: SparkSession, d: str) -> DataFrame:
    """Fixed-effects meta-analysis of every variant (place and alleles) over all studies, with p of the effect and of Q; no palindromes."""
    rows = usable_rows(spark, d).where("chr is not null and pos is not null").where(~is_palindromic(F.col("a1"), F.col("a2")))
    c1, c2 = complement(F.col("a1")), complement(F.col("a2"))
    same = F.col("alleles").isin(F.concat_ws("/", "a1", "a2"), F.concat_ws("/", c1, c2))
    laid = rows.withColumn("beta", F.when(same, F.col("beta")).otherwise(-F.col("beta")))
    once = keep_first(laid.select("row_id", "study_id", "chr", "pos", "alleles", "beta", "se", "p"), ["study_id", "chr", "pos", "alleles"], [F.col("row_id")])
    m = inverse_variance_meta(once, ["chr", "pos", "alleles"], "beta", "se", "study_id", "p")
    q_p = F.when(F.col("k") > 1, chi2_upper(F.col("q"), (F.col("k") - 1).cast("double"))).otherwise(1.0)
    tails = m.withColumns({"meta_p": normal_two_sided(F.col("z")), "q_p": q_p})
    rounded = [F.round(c, 6).alias(c) for c in ("beta", "se", "z", "meta_p", "q", "q_p", "i2")]
    return tails.select("chr", "pos", "alleles", "k", *rounded, "best")


def v_mendelian(spark: SparkSession, d: str) -> DataFrame:
    """Mendelian randomisation of the outcome study on every other, over all shared instruments, with p values."""
    m = mendelian_estimates(instruments(spark, d), "study_id", "beta", "se", "o_beta", "o_se")
    free = F.col("k").cast("double")
    tails = {
        "wald_p": normal_two_sided(F.col("wald") / F.col("wald_se")), "ivw_p": normal_two_sided(F.col("ivw") / F.col("ivw_se")),
        "ivw_re_p": normal_two_sided(F.col("ivw") / F.col("ivw_re_se")), "q_p": chi2_upper(F.col("q"), free - 1),
        "egger_p": t_two_sided(F.col("egger") / F.col("egger_se"), free - 2), "intercept_p": t_two_sided(F.col("intercept") / F.col("intercept_se"), free - 2),
    }
    estimates = m.columns[2:]
    return m.withColumns(tails).select("study_id", "k", *[F.round(c, 5).alias(c) for c in (*estimates, *tails)])


def v_weighted_median(spark: SparkSession, d: str) -> DataFrame:
    """Interpolated weighted median of the Wald ratios per study of three or more instruments."""
    return interpolated_median_ratio(instruments(spark, d), "study_id", "row_id", "beta", "se", "o_beta", "o_se").withColumn("ratio", F.round("ratio", 6))


def v_coloc(spark: SparkSession, d: str) -> DataFrame:
    """Colocalisation posteriors of every study with the outcome study per region (megabase), over all shared variants."""
    rows = shared_variants(spark, d).where("chr is not null and pos is not null")
    factors = {n: log_bayes_factor(F.col(b), F.col(s), PRIOR_VARIANCE) for n, b, s in (("one", "beta", "se"), ("two", "o_beta", "o_se"))}
    regions = rows.withColumns({"mb": F.floor(F.col("pos") / MEGABASE), **factors})
    post = colocalisation(regions, ["study_id", "chr", "mb"], "one", "two")
    return post.select("study_id", "chr", "mb", "n_snps", *[F.round(f"h{i}", 6).alias(f"h{i}") for i in range(5)])


def v_steiger(spark: SparkSession, d: str) -> DataFrame:
    """Direction of effect of every shared variant: z and p of the difference between the variances explained."""
    z2 = {s: F.pow(F.col(f"{s}beta") / F.col(f"{s}se"), 2) for s in ("", "o_")}
    r2 = {s: v / (v + F.col(f"{s}n")) for s, v in z2.items()}
    rows = shared_variants(spark, d).where("n > 3 and o_n > 3").withColumn("z", steiger_z(r2[""], r2["o_"], F.col("n"), F.col("o_n")))
    return rows.select("row_id", F.round("z", 6).alias("steiger_z"), F.round(normal_two_sided(F.col("z")), 6).alias("steiger_p"), (F.col("z") > 0).alias("forward"))


QUERIES = {q.__name__: q for q in (v_harmonised, v_shared, v_meta, v_mendelian, v_weighted_median, v_coloc, v_steiger)}

_FLIP = "translate({}, 'ACGT', 'TGCA')"
_PALINDROME = "a1 || a2 IN ('AT', 'TA', 'CG', 'GC')"


def _how(a1: str, a2: str, b1: str, b2: str) -> str:
    c1, c2 = _FLIP.format(a1), _FLIP.format(a2)
    return f"""CASE WHEN {a1} = {b1} AND {a2} = {b2} THEN 'direct' WHEN {a1} = {b2} AND {a2} = {b1} THEN 'flipped'
        WHEN {c1} = {b1} AND {c2} = {b2} THEN 'complement' WHEN {c1} = {b2} AND {c2} = {b1} THEN 'complement_flipped' END"""


_USABLE = f"""{CANONICAL_SQL},
    usable AS (SELECT c.*, CASE WHEN frequency_column_is = 'EAF' AND maf BETWEEN 0 AND 1 THEN maf END AS eaf FROM c LEFT JOIN gwas_studies USING (study_id)
               WHERE p > 0 AND p <= 1 AND se > 0 AND beta IS NOT NULL AND a1 IS NOT NULL AND a2 IS NOT NULL)"""
_SHARED = f"""{_USABLE},
    o AS (SELECT row_id AS o_row_id, snp AS o_snp, chr AS o_chr, pos AS o_pos, a1 AS b1, a2 AS b2, eaf AS o_eaf, beta AS o_raw, se AS o_se, p AS o_p, n AS o_n FROM usable WHERE study_id = '{OUTCOME}'),
    e AS (SELECT * FROM usable WHERE study_id <> '{OUTCOME}'),
    met AS (SELECT e.*, o.*, 'snp' AS via FROM e JOIN o ON e.snp = o_snp
            UNION ALL SELECT e.*, o.*, 'place' AS via FROM e JOIN o ON e.chr = o_chr AND e.pos = o_pos WHERE NOT EXISTS (SELECT 1 FROM o x WHERE x.o_snp = e.snp)),
    oriented AS (SELECT * FROM (SELECT *, {_how("a1", "a2", "b1", "b2")} AS how FROM met) WHERE how IS NOT NULL QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY o_row_id) = 1),
    told AS (SELECT *, CASE WHEN how LIKE '%flipped' THEN -o_raw ELSE o_raw END AS o_beta, CASE how WHEN 'direct' THEN o_eaf WHEN 'flipped' THEN 1 - o_eaf END AS f FROM oriented),
    pairs AS (SELECT * FROM told WHERE NOT ({_PALINDROME}) OR coalesce(abs(eaf - 0.5) >= {PALINDROME_MARGIN} AND abs(f - 0.5) >= {PALINDROME_MARGIN} AND (eaf < 0.5) = (f < 0.5), false)
              QUALIFY row_number() OVER (PARTITION BY study_id, o_row_id ORDER BY row_id) = 1)"""
_LABF = "0.5 * (ln(1 - {v} / ({v} + {s} * {s})) + {v} / ({v} + {s} * {s}) * {b} * {b} / ({s} * {s}))"
_ONE, _TWO = (_LABF.format(v=PRIOR_VARIANCE, b=b, s=s) for b, s in (("beta", "se"), ("o_beta", "o_se")))
_MR = f"""{_SHARED},
    u AS (SELECT study_id, row_id, beta AS x0, se AS sx, o_beta AS y0, o_se AS sy, abs(beta) AS x, o_beta * sign(beta) AS y, 1 / (o_se * o_se) AS w FROM pairs WHERE power(beta / se, 2) >= {LEAST_F} AND beta <> 0)"""

SQL = {
    "v_harmonised": f"""WITH {_USABLE}, rows_ AS (SELECT * FROM usable WHERE NOT ({_PALINDROME})),
        s AS (SELECT *, least(a1 || '/' || a2, a2 || '/' || a1, {_FLIP.format("a1")} || '/' || {_FLIP.format("a2")}, {_FLIP.format("a2")} || '/' || {_FLIP.format("a1")}) AS alleles FROM rows_),
        panel AS (SELECT chr AS o_chr, pos AS o_pos, split_part(min(alleles), '/', 1) AS b1, split_part(min(alleles), '/', 2) AS b2, min(snp) AS o_snp, min(row_id) AS panel_row FROM s WHERE chr IS NOT NULL AND pos IS NOT NULL GROUP BY chr, pos),
        met AS (SELECT s.*, panel.*, 'snp' AS via FROM s JOIN panel ON snp = o_snp
                UNION ALL SELECT s.*, panel.*, 'place' AS via FROM s JOIN panel ON chr = o_chr AND pos = o_pos WHERE NOT EXISTS (SELECT 1 FROM panel x WHERE x.o_snp = s.snp)),
        h AS (SELECT *, {_how("a1", "a2", "b1", "b2")} AS how FROM met)
        SELECT row_id, panel_row, via, how, round(CASE WHEN how LIKE '%flipped' THEN -beta ELSE beta END, 6) AS beta FROM h WHERE how IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY panel_row) = 1""",
    "v_shared": f"WITH {_SHARED} SELECT row_id, o_row_id, via, how, round(beta, 6) AS beta, round(o_beta, 6) AS o_beta FROM pairs",
    "v_meta": f"""WITH {_USABLE},
        b AS (SELECT *, least(a1 || '/' || a2, a2 || '/' || a1, {_FLIP.format("a1")} || '/' || {_FLIP.format("a2")}, {_FLIP.format("a2")} || '/' || {_FLIP.format("a1")}) AS alleles
              FROM usable WHERE NOT ({_PALINDROME}) AND chr IS NOT NULL AND pos IS NOT NULL),
        l AS (SELECT study_id, chr, pos, alleles, se, p, CASE WHEN {_how("a1", "a2", "split_part(alleles, '/', 1)", "split_part(alleles, '/', 2)")} LIKE '%flipped' THEN -beta ELSE beta END AS beta
              FROM b QUALIFY row_number() OVER (PARTITION BY study_id, chr, pos, alleles ORDER BY row_id) = 1),
        s AS (SELECT chr, pos, alleles, count(*) AS k, sum(1 / (se * se)) AS w, sum(beta / (se * se)) AS wb, sum(beta * beta / (se * se)) AS wbb, min(struct_pack(p := p, study_id := study_id)).study_id AS best FROM l GROUP BY chr, pos, alleles),
        q AS (SELECT *, wb / sqrt(w) AS z, CASE WHEN k > 1 THEN greatest(wbb - wb * wb / w, 0.0) ELSE 0.0 END AS q FROM s)
        SELECT chr, pos, alleles, k, round(wb / w, 6) AS beta, round(1 / sqrt(w), 6) AS se, round(z, 6) AS z, round({normal_two_sided_sql("z")}, 6) AS meta_p, round(q, 6) AS q,
               round(CASE WHEN k > 1 THEN {chi2_upper_sql("q", "k - 1")} ELSE 1.0 END, 6) AS q_p, round(CASE WHEN q > 0 THEN greatest((q - (k - 1)) / q * 100, 0.0) ELSE 0.0 END, 6) AS i2, best FROM q""",
    "v_mendelian": f"""WITH {_MR},
        l AS (SELECT study_id, y0 / x0 AS wald, sqrt(power(sy / x0, 2) + power(y0 * sx / (x0 * x0), 2)) AS wald_se FROM u
              QUALIFY row_number() OVER (PARTITION BY study_id ORDER BY abs(x0 / sx) DESC, x0 DESC, sx DESC, y0 DESC, sy DESC) = 1),
        s AS (SELECT study_id, count(*) AS k, sum(w) AS w, sum(w * x) AS wx, sum(w * y) AS wy, sum(w * x * x) AS wxx, sum(w * x * y) AS wxy, sum(w * y * y) AS wyy FROM u GROUP BY study_id),
        m AS (SELECT *, CASE WHEN k >= 2 THEN greatest(wyy - wxy * wxy / wxx, 0.0) END AS q0, CASE WHEN k >= 3 THEN nullif(w * wxx - wx * wx, 0) END AS d, CASE WHEN k >= 2 THEN wxy / wxx END AS ivw, CASE WHEN k >= 2 THEN 1 / sqrt(wxx) END AS ivw_se FROM s),
        f AS (SELECT *, (w * wxy - wx * wy) / d AS slope, (wxx * wy - wx * wxy) / d AS icpt, ivw_se * greatest(1.0, sqrt(q0 / (k - 1))) AS re FROM m),
        g AS (SELECT *, greatest((wyy - icpt * wy - slope * wxy) / nullif(k - 2, 0), 1.0) AS spread FROM f),
        h AS (SELECT *, CASE WHEN k >= 3 THEN sqrt(spread * w / d) END AS slope_se, CASE WHEN k >= 3 THEN sqrt(spread * wxx / d) END AS icpt_se FROM g JOIN l USING (study_id))
        SELECT study_id, k, round(wald, 5) AS wald, round(wald_se, 5) AS wald_se, round(ivw, 5) AS ivw, round(ivw_se, 5) AS ivw_se, round(q0, 5) AS q, round(re, 5) AS ivw_re_se,
               round(slope, 5) AS egger, round(slope_se, 5) AS egger_se, round(icpt, 5) AS intercept, round(icpt_se, 5) AS intercept_se,
               round({normal_two_sided_sql("wald / wald_se")}, 5) AS wald_p, round({normal_two_sided_sql("ivw / ivw_se")}, 5) AS ivw_p, round({normal_two_sided_sql("ivw / re")}, 5) AS ivw_re_p,
               round({chi2_upper_sql("q0", "k - 1")}, 5) AS q_p, round({t_two_sided_sql("slope / slope_se", "k - 2")}, 5) AS egger_p, round({t_two_sided_sql("icpt / icpt_se", "k - 2")}, 5) AS intercept_p FROM h""",
    "v_weighted_median": f"""WITH {_MR},
        r AS (SELECT study_id, row_id, y0 / x0 AS ratio, 1 / (power(sy / x0, 2) + power(y0 * sx / (x0 * x0), 2)) AS v FROM u),
        m AS (SELECT *, (sum(v) OVER (PARTITION BY study_id ORDER BY ratio, row_id) - v / 2) / sum(v) OVER (PARTITION BY study_id) AS mid, count(*) OVER (PARTITION BY study_id) AS k FROM r),
        a AS (SELECT study_id, k, max(struct_pack(mid := mid, ratio := ratio)) FILTER (mid < 0.5) AS a, min(struct_pack(mid := mid, ratio := ratio)) FILTER (mid >= 0.5) AS b FROM m WHERE k >= 3 GROUP BY study_id, k)
        SELECT study_id, k, round(coalesce(a.ratio + (b.ratio - a.ratio) * (0.5 - a.mid) / (b.mid - a.mid), b.ratio, a.ratio), 6) AS ratio FROM a""",
    "v_coloc": f"""WITH {_SHARED}, b AS (SELECT study_id, chr, CAST(floor(pos / {MEGABASE}) AS BIGINT) AS mb, {_ONE} AS one, {_TWO} AS two FROM pairs WHERE chr IS NOT NULL AND pos IS NOT NULL),
        m AS (SELECT study_id, chr, mb, max(one) AS m1, max(two) AS m2, max(one + two) AS m3 FROM b GROUP BY ALL),
        s AS (SELECT study_id, chr, mb, count(*) AS n_snps, max(m1) + ln(sum(exp(one - m1))) AS s1, max(m2) + ln(sum(exp(two - m2))) AS s2, max(m3) + ln(sum(exp(one + two - m3))) AS s3 FROM b JOIN m USING (study_id, chr, mb) GROUP BY study_id, chr, mb),
        l AS (SELECT *, 0.0 AS l0, ln(1e-4) + s1 AS l1, ln(1e-4) + s2 AS l2, ln(1e-5) + s3 AS l4,
                     CASE WHEN 1 - exp(s3 - s1 - s2) > 1e-12 THEN 2 * ln(1e-4) + s1 + s2 + ln(CASE WHEN 1 - exp(s3 - s1 - s2) > 1e-12 THEN 1 - exp(s3 - s1 - s2) END) END AS l3 FROM s),
        t AS (SELECT *, greatest(l0, l1, l2, coalesce(l3, l0), l4) AS top FROM l),
        x AS (SELECT *, exp(l0 - top) AS e0, exp(l1 - top) AS e1, exp(l2 - top) AS e2, coalesce(exp(l3 - top), 0.0) AS e3, exp(l4 - top) AS e4 FROM t)
        SELECT study_id, chr, mb, n_snps, {", ".join(f"round(e{i} / (e0 + e1 + e2 + e3 + e4), 6) AS h{i}" for i in range(5))} FROM x""",
    "v_steiger": f"""WITH {_SHARED}, r AS (SELECT row_id, n, o_n, power(beta / se, 2) / (power(beta / se, 2) + n) AS a, power(o_beta / o_se, 2) / (power(o_beta / o_se, 2) + o_n) AS b FROM pairs WHERE n > 3 AND o_n > 3),
        z AS (SELECT row_id, (atanh(sqrt(a)) - atanh(sqrt(b))) / sqrt(1 / (n - 3) + 1 / (o_n - 3)) AS z FROM r)
        SELECT row_id, round(z, 6) AS steiger_z, round({normal_two_sided_sql("z")}, 6) AS steiger_p, z > 0 AS forward FROM z""",
}
