"""One surviving record per group of duplicates, with a latent truth model of the sources.

Each (group, field) is an entity, each distinct normalised value claimed for it a fact. A source
supports a fact if one of its records in the group claims the value, and denies it if its records
in the group claim only other values of that field. Every source has a sensitivity (it reports a
true value) and a specificity (it doesn't report a false one), both inferred together with the
facts' truth by expectation-maximisation. A fact needs no rival to be judged false and several
facts of one entity may be true, so multi-valued fields keep every value judged true.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.operators.skew import salted_join
from lociflow.session import written

#: Stand-ins that say a text has no value.
PLACEHOLDERS = ("", "-", "--", "NA", "N/A", "N.A.", "NONE", "NULL", "NAN", "UNKNOWN", "UNSPECIFIED", "NOT AVAILABLE", "NOT KNOWN", "N.D.", "ND", "TBD", "?", ".", "MISSING", "NIL")
#: Spellings of the confidence levels, by rank.
CONFIDENCE = {"high": ("HIGH", "HI", "H"), "medium": ("MEDIUM", "MED", "MED.", "M"), "low": ("LOW", "LO", "L")}
CONFIDENCE_RANK = {"high": 1, "medium": 2, "low": 3}
FIELDS = ("confidence", "source", "pchembl_value", "mechanism_of_action")
#: Sources named in no list count as this one in the quality model.
OTHER = "(unlisted)"


@dataclass(frozen=True)
class TruthModel:
    """Priors as pseudo-counts (Beta), rounds of expectation-maximisation, and when a value is judged true."""

    rounds: int = 8
    sensitivity_prior: tuple[float, float] = (7.0, 3.0)
    specificity_prior: tuple[float, float] = (9.0, 1.0)
    truth_prior: tuple[float, float] = (5.0, 5.0)
    threshold: float = 0.5
    tolerance: float = 1e-4


def read_confidence(raw: Column) -> Column:
    """high, medium or low whatever the spelling; null if unreadable."""
    text = F.upper(F.trim(raw))
    out = F
    for level, spellings in CONFIDENCE.items():
        out = out.when(text.isin(*spellings), level)
    return out


def source_names(raw: Column) -> Column:
    """The sorted distinct lower-case names of a field that lists sources separated by commas; empty for null."""
    parts = F.transform(F.split(F.lower(F.coalesce(raw, F.lit(""))), ","), lambda s: F.trim(s))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda s: s != "")))


def real_text(raw: Column) -> Column:
    """The trimmed text unless it is empty or stands for 'no value'."""
    text = F.trim(raw)
    return F.when(~F.upper(text).isin(*PLACEHOLDERS), text)


def trust_ranks(sources: DataFrame) -> dict[str, int]:
    """name -> trust rank of the listed sources, a vocabulary of at most 1,000 names (checked)."""
    rows = sources.where(F.col("source").isNotNull()).groupBy(F.lower(F.trim("source")).alias("name")).agg(F.min("trust_rank").alias("rank")).limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("the list of sources is meant to be a vocabulary of at most 1,000 names")
    return {r.name: r.rank for r in rows}


def normalised_records(records: DataFrame, sources: DataFrame) -> DataFrame:
    """Records under their group key (drug, gene) with real values only, and the trust in their source.

    Records without a drug or gene belong to no group and are left out.
    """
    ranks = trust_ranks(sources)
    keyed = records.withColumns({"drug": F.upper(F.trim("drug_chembl_id")), "gene": F.upper(F.trim("gene_symbol"))}).where("drug <> '' and gene <> ''")
    activity = F.when((F.col("pchembl_value") > 0) & (F.col("pchembl_value") <= 15), F.col("pchembl_value"))  # NaN is above 15
    slim = keyed.select("record_id", "drug", "gene", "updated_at", read_confidence(F.col("confidence")).alias("confidence"), source_names(F.col("source")).alias("names"), activity.alias("pchembl_value"), real_text(F.col("mechanism_of_action")).alias("mechanism_of_action"))
    listed = F.filter("names", lambda s: s.isin(*ranks))
    order = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv]) if ranks else F.lit(None).cast("map<string,int>")
    trust = F.coalesce(F.array_min(F.transform("names", lambda s: F.try_element_at(order, s))), F.lit(2**31 - 1))
    return slim.withColumn("source", F.when(F.size(listed) > 0, listed)).withColumn("trust", trust)


def precedence() -> Column:
    """The stated order of records as a struct: confidence, trust in the source, newest, smallest id."""
    rank = F
    for level, n in CONFIDENCE_RANK.items():
        rank = rank.when(F.col("confidence") == level, n)
    age = F.coalesce(-F.unix_micros(F.col("updated_at").cast("timestamp")), F.lit(2**62))
    named = {"c": rank.otherwise(4), "t": F.col("trust"), "u": age, "r": F.col("record_id")}
    return F.named_struct(*[x for k, v in named.items() for x in (F.lit(k), v)])


def claims(rows: DataFrame) -> DataFrame:
    """(drug, gene, record_id, field, value, shown, claimants, order): each value of each record, and who claims it.

    The source field claims each listed name. ``shown`` is the value as it is given out. Every
    record also has one row of the empty field, by which its group is counted.
    """
    listed = F.coalesce(F.col("source"), F.array().cast("array<string>"))
    names = F.transform("names", lambda s: F.when(F.array_contains(listed, s), s).otherwise(OTHER))
    claimants = F.array_distinct(F.when(F.size("names") > 0, names).otherwise(F.array(F.lit(OTHER))))
    activity = F.round("pchembl_value", 2).cast("string")

    def entry(field: str, values: Column, shown: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), values.alias("values"), shown.alias("shown"))

    each = F.array(
        entry("", F.array(F.lit("")), F.lit("")),
        entry("confidence", F.array("confidence"), F.col("confidence")),
        entry("source", F.col("source"), F.array_join("source", ",")),
        entry("pchembl_value", F.array(activity), activity),
        entry("mechanism_of_action", F.array(F.lower("mechanism_of_action")), F.col("mechanism_of_action")),
    )
    wide = rows.select("drug", "gene", "record_id", claimants.alias("claimants"), precedence().alias("order"), F.explode(each).alias("v"))
    long = wide.select("drug", "gene", "record_id", "claimants", "order", "v.field", "v.shown", F.explode("v.values").alias("value"))
    return long.where(F.col("value").isNotNull())


def facts_of(rows: DataFrame) -> DataFrame:
    """(group_id, field, value, for, against, best, shown): every fact of every group of two or more records.

    ``for`` are the sorted sources that claim the value, ``against`` those that claim only others;
    both are at most as long as the list of sources. ``best`` is the first claiming record in the
    stated order. The claims are read and reduced once; repeats of a claim count once.
    """
    first = F.min(F.struct("order", "shown"))
    # sets of sources: at most as many as their vocabulary has subsets in use
    supporters = F.array_sort(F.array_distinct(F.flatten(F.collect_set("claimants"))))
    reduced = claims(rows).groupBy("drug", "gene", "field", "value").agg(supporters.alias("for"), first.alias("f"), F.count("*").alias("n"), F.min("record_id").alias("least"))
    told = written(reduced)
    groups = told.where("field = '' and n >= 2").select("drug", "gene", F.col("least").alias("group_id"))
    facts = told.where("field <> ''")
    covering = facts.select("drug", "gene", "field", "for").distinct().groupBy("drug", "gene", "field")
    covered = covering.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("for")))).alias("covering"))
    # a hot group may have a third of the facts, but one row here
    known = covered.join(groups, ["drug", "gene"])
    met = salted_join(facts, known, ["drug", "gene", "field"], F.col("value"), salts=4)
    return met.select("group_id", "field", "value", "for", F.array_except("covering", "for").alias("against"), F.col("f.order").alias("best"), F.col("f.shown").alias("shown"))


def _added(field: Column, sources: Column, weights: dict[tuple[str, str], float]) -> Column:
    """Sum of the weights of the sources in the field; unknown sources weigh nothing."""
    literal = F.create_map(*[F.lit(x) for (f, s), w in weights.items() for x in (f"{f}|{s}", w)])
    weight = F.transform(sources, lambda s: F.coalesce(F.try_element_at(literal, F.concat_ws("|", field, s)), F.lit(0.0)))
    return F.aggregate(weight, F.lit(0.0), lambda total, x: total + x)


def _log_odds(quality: dict[tuple[str, str], tuple[float, float]], prior: dict[str, float]) -> Column:
    """Log odds that a fact is true, under the sources' present quality."""
    up = {key: math.log(sens / (1 - spec)) for key, (sens, spec) in quality.items()}
    down = {key: math.log((1 - sens) / spec) for key, (sens, spec) in quality.items()}
    base = F.create_map(*[F.lit(x) for f, p in prior.items() for x in (f, math.log(p / (1 - p)))])
    field = F.col("field")
    return F.coalesce(F.try_element_at(base, field), F.lit(0.0)) + _added(field, F.col("for"), up) + _added(field, F.col("against"), down)


def _mean(prior: tuple[float, float]) -> float:
    return prior[0] / (prior[0] + prior[1])


def truth_quality(facts: DataFrame, model: TruthModel = TruthModel()) -> tuple[dict[tuple[str, str], tuple[float, float]], dict[str, float]]:
    """Sensitivity and specificity per (field, source), and the share of true facts per field.

    Facts with the same supporters and deniers are alike, so they are counted once, in Spark, and
    each round runs over the counts. The driver sees one row per field and source a round.
    """
    patterns = written(facts.groupBy("field", "for", "against").agg(F.count("*").alias("n")))
    pairs = [(r.field, r.s) for r in patterns.select("field", F.explode(F.array_union("for", "against")).alias("s")).distinct().collect()]
    quality = {p: (_mean(model.sensitivity_prior), _mean(model.specificity_prior)) for p in pairs}
    prior = {f: _mean(model.truth_prior) for f in {f for f, _ in pairs}}
    if not pairs:
        return quality, prior
    vote = lambda sources, yes: F.transform(sources, lambda s: F.struct(s.alias("s"), F.lit(yes).alias("yes")))
    # the empty source counts the field's facts themselves
    votes = F.concat(vote("for", 1), vote("against", 0), F.array(F.struct(F.lit("").alias("s"), F.lit(1).alias("yes"))))
    t, f, yes = F.col("t"), F.col("n") - F.col("t"), F.col("c.yes")
    for _ in range(model.rounds):
        true = F.col("n") / (1 + F.exp(-_log_odds(quality, prior)))
        voted = patterns.select("field", "n", true.alias("t"), F.explode(votes).alias("c"))
        counted = {"tp": t * yes, "fn": t * (1 - yes), "fp": f * yes, "tn": f * (1 - yes)}
        sums = voted.groupBy("field", "c.s").agg(*[F.sum(v).alias(k) for k, v in counted.items()]).collect()
        (a, b), (c, d), (e, g) = model.sensitivity_prior, model.specificity_prior, model.truth_prior
        new = {(r.field, r.s): ((r.tp + a) / (r.tp + r.fn + a + b), (r.tn + c) / (r.tn + r.fp + c + d)) for r in sums if r.s}
        prior = {r.field: (r.tp + e) / (r.tp + r.fp + e + g) for r in sums if not r.s}
        moved = max(abs(x - y) for k in new for x, y in zip(new[k], quality[k], strict=True))
        quality = new
        if moved < model.tolerance:
            break
    return quality, prior


def judged_facts(rows: DataFrame, model: TruthModel = TruthModel()) -> tuple[DataFrame, dict[tuple[str, str], tuple[float, float]]]:
    """Every fact with its probability of being true and whether it is kept, and the sources' quality."""
    facts = written(facts_of(rows))
    quality, prior = truth_quality(facts, model)
    if not quality:
        return facts.withColumn("truth", F.lit(None).cast("double")).withColumn("kept", F.lit(False)), quality
    truth = 1 / (1 + F.exp(-_log_odds(quality, prior)))
    return facts.withColumn("truth", truth).withColumn("kept", F.col("truth") >= model.threshold), quality


def survivors(records: DataFrame, sources: DataFrame, model: TruthModel = TruthModel()) -> DataFrame:
    """The surviving value of every field of every group, the record it is from, and its truth.

    One row per group of two or more records and field with a real value: group_id, field,
    record_id, value, truth (posterior of the value under the latent truth model) and kept (judged
    true). The survivor is chosen among the judged facts by the stated precedence: confidence of the
    record, trust of its source, newest, smallest id. The model can't overrule that order; it decides
    between facts of one record, so of a list of sources truth and kept are those of the likeliest.
    Null or placeholder values are no facts; exact repeats count once as claims. The choice is a
    minimum, aggregated before the shuffle, so a group of any size is never in one place. Empty
    tables give no rows.
    """
    facts, _ = judged_facts(normalised_records(records, sources), model)
    order = F.struct("best", (-F.col("truth")).alias("doubt"), "shown", "kept")
    chosen = facts.groupBy("group_id", "field").agg(F.min(order).alias("m"))
    return chosen.select("group_id", "field", F.col("m.best.r").alias("record_id"), F.col("m.shown").alias("value"), F.round(-F.col("m.doubt"), 6).alias("truth"), F.col("m.kept").alias("kept"))


def retained_values(records: DataFrame, sources: DataFrame, model: TruthModel = TruthModel()) -> DataFrame:
    """Every value judged true (several a field where the model finds several), with its posterior and support."""
    facts, _ = judged_facts(normalised_records(records, sources), model)
    return facts.where("kept").select("group_id", "field", "value", F.round("truth", 6).alias("truth"), F.size("for").alias("n_for"), F.size("against").alias("n_against"))


def source_quality(records: DataFrame, sources: DataFrame, model: TruthModel = TruthModel()) -> DataFrame:
    """Inferred sensitivity and specificity of every source in every field (fields x sources rows)."""
    _, quality = judged_facts(normalised_records(records, sources), model)
    data = [(f, s, round(a, 6), round(b, 6)) for (f, s), (a, b) in sorted(quality.items())]
    return records.sparkSession.createDataFrame(data, "field string, source string, sensitivity double, specificity double")


def fused_records(records: DataFrame, sources: DataFrame, model: TruthModel = TruthModel()) -> DataFrame:
    """One built record a group: its surviving values side by side, with the record each comes from."""
    long = survivors(records, sources, model)
    wide = long.groupBy("group_id").pivot("field", list(FIELDS)).agg(F.first("value").alias("value"), F.first("record_id").alias("record_id"))
    return wide.select("group_id", *[F.col(f"{f}_value").alias(f) for f in FIELDS], *[F.col(f"{f}_record_id").alias(f"{f}_from") for f in FIELDS])
