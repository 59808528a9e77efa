"""Effects and frequencies reported in different units, converted to one.

The unit of a value is looked for in the value's own text, then in its note, then in what the
study says of the column. Where none of them tells, the unit is inferred from the identities among
the columns of the study: an effect on the natural log scale, its standard error and its p value
obey ``|beta| = se * z(p)``, and of the candidate units the one is taken whose log residual
``ln |beta_u| - ln (se * z(p))`` is smallest over the study's unlabelled rows. The same is worked
out for rows whose unit is stated, so that the statement can be held against the identity. Two candidates
within ``tie`` of each other make the solution non-unique, which is flagged and not converted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.session import written

#: Texts that stand for an unreported value.
UNREPORTED = ("", "-", "NA", "N/A", "NR", "NAN", "NULL", "NONE", ".", "NOT REPORTED")
EFFECT_UNITS = ("ln", "ln_milli", "log2", "log10", "odds_ratio", "percent_change")
LN2, LN10 = 0.6931471805599453, 2.302585092994046
NUMBER = r"([+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)(?:e[+-]?[0-9]+)?)"


def tidy(value: Column) -> Column:
    """Trimmed, with ASCII minus signs, decimal points for decimal commas and plain blanks."""
    text = F.translate(F.coalesce(value, F.lit("")), "−–‐‑  \t\r\n", "----     ")
    return F.trim(F.regexp_replace(text, r"(?<=[0-9]),(?=[0-9])", "."))


def is_plain(value: Column) -> Column:
    """A sign, digits and a decimal point at most; blanks around it ignored."""
    return F.trim(value).rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)$")


def is_reported(value: Column) -> Column:
    return value.isNotNull() & ~F.upper(tidy(value)).isin(*UNREPORTED)


def without_limits(text: Column) -> Column:
    """The text before its confidence limits, whose level is a per cent figure of another kind."""
    return F.trim(F.regexp_replace(text, r"\(?[0-9.]+ ?% ?ci.*$|\[.*$|\(.*\bto\b.*$", ""))


def effect_unit(text: Column) -> Column:
    """The unit a lower-case text names, or null. Scaled and based logarithms are tried before plain ones."""
    return (
        F.when(text.rlike(r"log ?10|log_10|log₁₀|10\b.{0,12}\blog units"), "log10")
        .when(text.rlike(r"log ?2(?![0-9])|log_2|log₂"), "log2")
        .when(text.rlike(r"x ?1000|\* ?1000|times 1000|multiplied by 1000|per thousand|10 ?\^ ?-3|e-3 ?\(|milli"), "ln_milli")
        .when(text.rlike(r"%|per ?cent|(?:higher|lower|increase[ds]?|reduce[ds]?|decrease[ds]?|raised|lowered).{0,12}odds|odds (?:increased|reduced|decreased|raised|lowered)"), "percent_change")
        .when(text.rlike(r"log[ _-]?odds|log[ _-]?or\b|\bln\b|log of the odds|natural log|base e|\bbeta\b|β"), "ln")
        .when(text.rlike(r"odds|\bor\b|fold"), "odds_ratio")
    )


def effect_number(text: Column) -> Column:
    """The (first) value of a tidied lower-case effect text; names of logarithms and scales are no values."""
    bare = F.regexp_replace(text, r"log ?_?(?:10|2)(?![0-9.])|x ?10 ?\^ ?-3|x ?1000|(?<=[0-9])e-3(?= ?\()", "")
    value = F.regexp_extract(bare, NUMBER, 1).try_cast("double")
    return F.when(text.rlike(r"lower|reduce|decrease"), -F.abs(value)).otherwise(value)


def to_log_odds(value: Column, unit: Column) -> Column:
    """The natural log odds ratio of ``value`` in ``unit``; null where it has none (an odds ratio not above 0)."""
    change = 1 + value / 100
    return (
        F.when(unit == "ln", value)
        .when(unit == "ln_milli", value / 1000)
        .when(unit == "log2", value * LN2)
        .when(unit == "log10", value * LN10)
        .when((unit == "odds_ratio") & (value > 0), F.ln(value))
        .when((unit == "percent_change") & (change > 0), F.ln(change))
    )


def frequency(text: Column, note: Column) -> tuple[Column, Column]:
    """(frequency as a fraction, its unit) of a tidied lower-case text and note.

    Counts, ratios and proportions in the text stand for themselves; a scale (per cent, per mille)
    is taken from the text, else from the note, else the value is a fraction. The effect allele's
    and the minor allele's frequency fold to the same number.
    """
    part = lambda pattern, i: F.regexp_extract(text, pattern, i).try_cast("double")
    counts, pair = r"ac ?= ?([0-9.]+) ?; ?an ?= ?([0-9.]+)", r"^([0-9.]+|one) ?(?:/|:|of|in|per|out of) ?([0-9.]+)"
    first = F.when(F.regexp_extract(text, pair, 1) == "one", F.lit(1.0)).otherwise(part(pair, 1))
    number = F.regexp_extract(text, NUMBER, 1).try_cast("double")
    percent, mille = r"%|per ?cent|percent", r"‰|per ?mille|per (?:1000|thousand)"
    unit = (
        F.when(text.rlike(counts) | text.rlike(pair), "ratio")
        .when(text.rlike(mille), "per_mille").when(text.rlike(percent), "percent")
        .when(note.rlike(mille), "per_mille").when(note.rlike(percent), "percent")
        .otherwise("fraction")
    )
    ratio = F.when(text.rlike(counts), F.try_divide(part(counts, 1), part(counts, 2))).otherwise(F.try_divide(first, part(pair, 2)))
    value = F.when(unit == "ratio", ratio).when(unit == "percent", number / 100).when(unit == "per_mille", number / 1000).otherwise(number)
    return F.when((value >= 0) & (value <= 1), value), unit


def p_to_z(p: Column) -> Column:
    """|z| of a two-sided p by the rational approximation of Abramowitz and Stegun 26.2.23 (error below 4.5e-4)."""
    t = F.sqrt(-2 * F.ln(F.greatest(F.when((p > 0) & (p <= 1), p), F.lit(1e-300)) / 2))
    return F.greatest(t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t), F.lit(0.0))


def inferred_units(rows: DataFrame, tie: float) -> DataFrame:
    """Per study and stated unit: the effect unit with the least mean log residual over the rows.

    ``rows``: study_id, stated ('' where nothing tells the unit), number, se, p. Gives study_id,
    stated, identity_unit (null if not unique) and unique. Aggregation is partial before the
    shuffle, one row a study, stated unit and candidate after it.
    """
    sized = rows.where((F.col("se") > 0) & (F.col("p") > 0) & (F.col("p") <= 1) & F.col("number").isNotNull())
    expected = F.col("se") * p_to_z(F.col("p"))
    each = sized.where(expected > 0).select("study_id", "stated", expected.alias("expected"), "number", F.explode(F.array(*map(F.lit, EFFECT_UNITS))).alias("unit"))
    size = F.abs(to_log_odds(F.col("number"), F.col("unit")))
    residual = F.abs(F.ln(F.greatest(size, F.lit(1e-9))) - F.ln("expected"))
    # a unit in which some value has no meaning (a negative odds ratio) is no candidate
    scored = each.groupBy("study_id", "stated", "unit").agg(F.avg(residual).alias("residual"), F.count_if(size.isNull()).alias("impossible")).where(F.col("impossible") == 0)
    ranked = scored.groupBy("study_id", "stated").agg(F.array_sort(F.collect_list(F.struct("residual", "unit"))).alias("by"))
    unique = (F.size("by") == 1) | (F.try_element_at("by", F.lit(2))["residual"] - F.col("by")[0]["residual"] > tie)
    return ranked.select("study_id", "stated", F.when(unique, F.col("by")[0]["unit"]).alias("identity_unit"), unique.alias("unique"))


def harmonise_units(hits: DataFrame, studies: DataFrame, tie: float = 0.2) -> DataFrame:
    """Every reported effect and frequency in the common unit.

    Gives one row per hit and field (``beta``, ``maf``) with a reported value: row_id, field, raw,
    unit, unit_from (text, note, study, identity), identity_unit (the effect unit that fits the study's
    rows of the same stated unit best, null if several do; a stated unit outweighs it), value
    (natural log odds ratio, or minor allele frequency), unique (false: several units fit and nothing tells which; value is then null) and
    converted (true if the text was not already that plain number). Values that can't be read have
    a null value and unit_from; repeated rows stay; a study that is missing says nothing.
    """
    about = studies.select("study_id", "has_or", "frequency_column_is").dropDuplicates(["study_id"])
    reports = hits.select("row_id", "study_id", "beta", "beta_note", "maf", "maf_note", "se", "p")
    # a generator keeps the texts from being tidied and matched again by every expression that uses them
    once = lambda df, **columns: df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("x")).select(*df.columns, "x.*")
    low = lambda c: F.lower(tidy(F.col(c)))
    rows = once(reports, b=without_limits(low("beta")), bn=low("beta_note"), m=low("maf"), mn=low("maf_note"))
    value, m_unit = frequency(F.col("m"), F.col("mn"))
    rows = once(rows, b_text=effect_unit(F.col("b")), b_note=effect_unit(F.col("bn")), b_number=effect_number(F.col("b")), b_told=is_reported(F.col("beta")), m_value=value, m_unit=m_unit)
    # studies are a dimension, but nothing is assumed of its size: the optimiser broadcasts it only if it is small
    rows = rows.join(about, "study_id", "left")
    study_unit = F.when(F.col("has_or"), "odds_ratio").when(~F.col("has_or"), "ln")
    rows = rows.withColumn("b_known", F.coalesce("b_text", "b_note", study_unit)).withColumn("stated", F.coalesce("b_known", F.lit("")))
    rows = written(rows)  # both branches below read what was matched once
    inferred = inferred_units(rows.where("b_told").select("study_id", "stated", F.col("b_number").alias("number"), "se", "p"), tie)
    rows = rows.join(inferred, ["study_id", "stated"], "left")
    unit = F.coalesce("b_known", "identity_unit")
    source = F.when(F.col("b_text").isNotNull(), "text").when(F.col("b_note").isNotNull(), "note").when(study_unit.isNotNull(), "study").when(F.col("identity_unit").isNotNull(), "identity")
    ln_or = to_log_odds(F.col("b_number"), unit)
    maf = F.least("m_value", 1 - F.col("m_value"))
    m_source = F.when(F.col("m").rlike(r"[a-z%‰=/:]"), "text").when(F.col("m_unit") != "fraction", "note").otherwise("study")

    def entry(field: str, raw: str, unit: Column, source: Column, fits: Column, value: Column, unique: Column, told: Column) -> Column:
        plain = F.when(is_plain(F.col(raw)), F.trim(F.col(raw)).try_cast("double"))
        converted = plain.isNull() | (F.abs(plain - value) > 1e-9)
        return F.when(told, F.struct(F.lit(field).alias("field"), F.col(raw).alias("raw"), unit.alias("unit"), source.alias("unit_from"), fits.alias("identity_unit"), value.alias("value"), unique.alias("unique"), converted.alias("converted")))

    b_unique = F.col("b_known").isNotNull() | F.coalesce(F.col("unique"), F.lit(False))
    both = F.array_compact(F.array(entry("beta", "beta", unit, source, F.col("identity_unit"), ln_or, b_unique, F.col("b_told")), entry("maf", "maf", F.col("m_unit"), m_source, F.lit(None).cast("string"), maf, F.lit(True), is_reported(F.col("maf")))))
    return rows.select("row_id", F.explode(both).alias("e")).select("row_id", "e.*")


def milli(value: Column) -> Column:
    """value times 1000, rounded half away from zero; decimal noise of the last bits is rounded off first."""
    return F.round(F.round(value * 1000, 7)).cast("long")
