"""Matching drugs and compounds without a common key: a cascade of deterministic rules.

Each rule is an exact join on a (weaker and weaker) combination of attributes. What a rule resolves
is anti-joined away before the next one. The confidence of a match is its rule's precision on
labelled pairs, smoothed: a pair is labelled by the strong identifiers that the rule did not use
(it is right if more of them agree than disagree, wrong if fewer, unlabelled otherwise).
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lociflow.operators.skew import salted_join
from lociflow.session import cut

#: Words that name a salt, a hydrate or a preparation, not the active substance.
SALT_WORDS = (
    "hydrochloride", "hcl", "sodium", "na", "sulfate", "sulphate", "mesylate", "mesilate", "maleate", "tartrate", "monohydrate", "hydrate",
    "potassium", "citrate", "phosphate", "acetate", "fumarate", "succinate", "besylate", "tosylate", "bromide", "chloride", "calcium",
)
#: Words beside a name that name neither substance nor salt.
LABEL_WORDS = ("salt", "usan", "inn", "racemic")
#: What a salt or hydrate adds to the molar mass (HCl, Na, H2O, sulfate, mesylate, maleate, tartrate, potassium).
SALT_MASSES = (36.46, 21.98, 22.99, 18.02, 98.08, 96.11, 116.07, 150.09, 38.1)
#: Prefixes that name a single isomer.
ISOMER_PREFIXES = ("lev", "dex", "es", "ar")
#: Width of the mass buckets that near names meet in.
BUCKET = 4.0
INCHIKEY = r"^[A-Z]{14}-[A-Z]{10}-[A-Z]$"


@dataclass(frozen=True)
class MatchModel:
    """Edits allowed between names (at most 2), pseudo-counts of the precision estimate and the least accepted precision."""

    edits: int = 2
    prior_right: float = 1.0
    prior_wrong: float = 1.0
    least_precision: float = 0.5


@F.pandas_udf(StringType())
def folded(names: pd.Series) -> pd.Series:
    """Lower case without accents, soft hyphens and compatibility forms; null stays null."""
    fold = lambda s: None if s is None else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").lower()
    return names.map(fold)


def name_key(fold: Column) -> Column:
    """Letters and digits of the name without salts, bracketed remarks and concentrations; null if nothing is left."""
    bare = F.regexp_replace(fold, r"\[[^\]]*\]|\b[0-9.]+ ?m?m in dmso\b", " ")
    bare = F.regexp_replace(bare, r"(?<![a-z0-9])(?:" + "|".join(SALT_WORDS + LABEL_WORDS) + r")(?![a-z0-9])", " ")
    key = F.regexp_replace(bare, r"[^\p{L}\p{N}]", "")
    return F.when(key != "", key)


def skeleton(key: Column) -> Column:
    """The key with letters that look or sound alike made one (0 o, 1 i l, y i, ph f, c k)."""
    return F.translate(F.replace(key, F.lit("ph"), F.lit("f")), "01lyc", "oiiik")


def normalised(df: DataFrame, id_column: str) -> DataFrame:
    """Comparable attributes of either table; identifiers that aren't well-formed are null.

    Only the columns used are read, so further or clashing columns do no harm.
    """
    inchi = F.upper(F.trim("drug_inchikey"))
    cid = F.regexp_replace(F.regexp_replace(F.trim("drug_pubchem_cid"), r"\.0+$", ""), "[^0-9]", "")
    synonyms = F.col("synonyms") if "synonyms" in df.columns else F.array().cast("array<string>")
    rows = df.select(F.col(id_column), folded("drug_name").alias("fold"), inchi.alias("inchi"), F.when(cid != "", cid).alias("cid"), F.upper(F.trim("drug_chembl_id")).alias("chembl"), F.when(F.col("mol_weight") > 0, F.col("mol_weight")).alias("mw"), synonyms.alias("synonyms"))
    rows = rows.withColumn("key", name_key(F.col("fold")))
    return rows.select(
        id_column, "key", skeleton(F.col("key")).alias("skel"), "cid", "mw", "synonyms",
        F.col("key").rlike("^[a-z]{2,4}[0-9]+$").alias("coded"), F.col("fold").rlike(r"(?<![a-z0-9])(?:" + "|".join(SALT_WORDS) + r")(?![a-z0-9])").alias("salted"),
        F.when(F.col("inchi").rlike(INCHIKEY), F.col("inchi")).alias("inchi"), F.when(F.col("inchi").rlike(r"^[A-Z]{14}(-|$)"), F.substring("inchi", 1, 14)).alias("block"),
        F.when(F.col("chembl").rlike(r"^CHEMBL[0-9]+$"), F.col("chembl")).alias("chembl"),
    )


def mass_agrees(mine: Column, theirs: Column, salted: Column) -> Column:
    """Masses equal within the rounding of the measured one (or 0.2 per cent if it has three decimals), a salt's mass aside."""
    slack = F.when(F.abs(mine - F.round(mine)) < 1e-9, 0.51).when(F.abs(mine - F.round(mine, 1)) < 1e-9, 0.0501).when(F.abs(mine - F.round(mine, 2)) < 1e-9, 0.0451).otherwise(theirs * 0.002)
    near = F.abs(mine - theirs) <= slack
    for extra in SALT_MASSES:
        near = near | (salted & (F.abs(mine - theirs - extra) <= slack + 0.03))
    return near


def _thirds(length: Column) -> tuple[Column, Column]:
    return F.floor(length / 3).cast("int"), F.floor(length * 2 / 3).cast("int")


def drug_segments(text: Column) -> Column:
    """The three thirds of a text as keys of (length, which third, letters)."""
    n = F.length(text)
    one, two = _thirds(n)
    parts = ((F.lit(1), one), (one + 1, two - one), (two + 1, n - two))
    return F.array(*[F.concat_ws("|", n, F.lit(i), F.substring(text, start, length)) for i, (start, length) in enumerate(parts)])


def near_segments(text: Column) -> Column:
    """The keys of all texts within two edits: one of their thirds is left whole by two edits (Li et al., Pass-Join, 2011).

    A first third stays in its place, a last one keeps its distance from the end, a middle one moves by one letter at most.
    """
    n = F.length(text)

    def of_length(m: Column) -> Column:
        one, two = _thirds(m)
        ends = [(0, F.lit(1), one), (2, two + 1 + n - m, m - two)]
        middle = [(1, one + 1 + shift, two - one) for shift in (-1, 0, 1)]
        return F.array(*[F.concat_ws("|", m, F.lit(i), F.substring(text, start, length)) for i, start, length in ends + middle])

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.greatest(n - 2, F.lit(0)), n + 2), of_length)))


def mass_buckets(mass: Column, slack: Column) -> Column:
    return F.sequence(F.floor((mass - slack) / BUCKET), F.floor((mass + slack) / BUCKET))


#: What is kept of a candidate pair.
EVIDENCE = ("compound_id", "drug_id", "c_coded", "c_salted", "same_name", "edits", "isomers", "mass", "other_mass", "cid_is", "chembl_is", "inchi_is", "cid_near")


def with_evidence(pairs: DataFrame) -> DataFrame:
    """What agrees between the two records of each candidate pair (columns d_* and c_*)."""
    d, c = (lambda x: F.col(f"d_{x}")), (lambda x: F.col(f"c_{x}"))
    edits = F.when(~c("coded"), F.least(F.levenshtein(d("skel"), c("skel")), F.levenshtein(d("key"), c("key")))).otherwise(99)
    synonym = F.coalesce(F.exists("d_synonyms", lambda s: F.regexp_replace(F.lower(s), r"[^\p{L}\p{N}]", "") == c("key")), F.lit(False))
    prefixed = F.lit(False)
    for prefix in ISOMER_PREFIXES:
        for x, y in ((d("key"), c("key")), (c("key"), d("key"))):
            prefixed = prefixed | (x.startswith(prefix) & (F.levenshtein(F.substring(x, F.lit(len(prefix) + 1), F.length(x)), y) <= 1))
    return pairs.withColumns({
        "same_name": F.coalesce((d("key") == c("key")) | synonym, F.lit(False)), "edits": F.coalesce(edits, F.lit(99)), "isomers": F.coalesce(prefixed & (d("key") != c("key")), F.lit(False)),
        "mass": F.coalesce(mass_agrees(c("mw"), d("mw"), c("salted")), F.lit(False)), "other_mass": F.coalesce(~mass_agrees(c("mw"), d("mw"), c("salted")), F.lit(False)),
        "cid_is": F.when(d("cid") == c("cid"), 1).when(d("cid") != c("cid"), -1).otherwise(0), "chembl_is": F.when(d("chembl") == c("chembl"), 1).when(d("chembl") != c("chembl"), -1).otherwise(0),
        # a salt has an InChIKey of its own, so another block says nothing there
        "inchi_is": F.when(d("inchi") == c("inchi"), 1).when(d("block") == c("block"), F.when(F.length(F.coalesce(c("inchi"), F.lit(""))) > 0, 0).otherwise(1)).when((d("block") != c("block")) & ~c("salted"), -1).otherwise(0),
        # an identifier mistyped by a digit or two is no other identifier
        "cid_near": F.coalesce((F.levenshtein(d("cid"), c("cid")) <= 2) & (F.length(d("cid")) == F.length(c("cid"))) & (F.array_sort(F.split(d("cid"), "")) == F.array_sort(F.split(c("cid"), ""))), F.lit(False)),
    })


#: The cascade: name, columns joined on (drug's, compound's), what a pair must fulfil, identifiers the rule uses.
def rules(model: MatchModel) -> list[tuple[str, str, str, Column, tuple[str, ...]]]:
    col = F.col
    denied = (col("inchi_is") < 0) | (col("chembl_is") < 0) | ((col("cid_is") < 0) & ~col("cid_near"))
    # swapped letters count as two edits, so a name garbled twice is four away
    similar = col("same_name") | (col("edits") <= 2 * model.edits)
    no_mass = ~col("mass") & ~col("other_mass")
    close = ~col("isomers") & (col("edits") <= model.edits)
    return [
        ("inchikey", "inchi", "inchi", F.lit(True), ("inchi_is",)),
        ("chembl_id", "chembl", "chembl", F.lit(True), ("chembl_is",)),
        ("cid_and_name", "cid", "cid", similar & ~col("isomers"), ("cid_is", "name_is")),
        ("cid_and_mass", "cid", "cid", (col("mass") & (col("c_coded") | (col("edits") <= 6))) | (no_mass & col("c_coded")), ("cid_is",)),
        ("name", "key", "key", ~((col("inchi_is") < 0) & (col("cid_is") < 0) & ~col("mass")), ("name_is",)),
        ("synonym", "synonym", "key", F.lit(True), ("name_is",)),
        ("block_and_name", "block", "block", similar & ~col("isomers"), ("inchi_is", "name_is")),
        ("block_and_mass", "block", "block", col("mass") & col("c_coded") & (col("cid_is") >= 0), ("inchi_is",)),
        ("near_name_and_mass", "near", "near", close & col("mass") & ~denied, ("name_is",)),
    ]


def _near(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs within two edits whose masses may agree. Only ids and names meet; the rest joins what remains.

    A third of the name and the mass together are rare, so few pairs meet that the edits then drop.
    """
    mine = F.array(F.col("c_mw"), *[F.when(F.col("c_salted"), F.col("c_mw") - extra) for extra in SALT_MASSES])
    buckets = F.array_distinct(F.transform(F.array_compact(mine), lambda m: F.floor(m / BUCKET)))
    named = left.where(~F.col("c_coded") & F.col("c_skel").isNotNull() & F.col("c_mw").isNotNull())
    wide = named.select("compound_id", "c_skel", near_segments(F.col("c_skel")).alias("v"), F.explode(buckets).alias("bucket"))
    wide = wide.select("compound_id", "c_skel", "bucket", F.explode("v").alias("v"))
    slack = F.greatest(F.lit(0.55), F.col("d_mw") * 0.002 + 0.03)
    known = right.where("d_skel is not null and d_mw is not null")
    known = known.select("drug_id", "d_skel", drug_segments(F.col("d_skel")).alias("v"), F.explode(mass_buckets(F.col("d_mw"), slack)).alias("bucket"))
    known = known.select("drug_id", "d_skel", "bucket", F.explode("v").alias("v"))
    key = F.xxhash64("bucket", "v").alias("k")
    met = salted_join(wide.select("compound_id", "c_skel", key), known.select("drug_id", "d_skel", key), "k", F.col("compound_id"), salts=4)
    pairs = met.where(F.levenshtein("c_skel", "d_skel", 2) >= 0).select("compound_id", "drug_id").distinct()
    return salted_join(pairs.join(left, "compound_id"), right, "drug_id", F.col("compound_id"), salts=4)


def _candidates(drugs: DataFrame, compounds: DataFrame, drug_key: str, compound_key: str) -> DataFrame:
    left = compounds.select(*[F.col(c).alias(f"c_{c}" if c != "compound_id" else c) for c in compounds.columns])
    right = drugs.select(*[F.col(c).alias(f"d_{c}" if c != "drug_id" else c) for c in drugs.columns])
    if drug_key == "near":
        return _near(left, right)
    if drug_key == "synonym":
        right = right.withColumn("k", F.explode(F.transform("d_synonyms", lambda s: F.regexp_replace(F.lower(s), r"[^\p{L}\p{N}]", ""))))
    else:
        right = right.withColumn("k", F.col(f"d_{drug_key}"))
    left = left.withColumn("k", F.col(f"c_{compound_key}")).where(F.col("k").isNotNull())
    return salted_join(left, right.where(F.col("k").isNotNull() & (F.col("k") != "")), "k", F.col("compound_id"), salts=4).drop("k")


def signs() -> dict[str, Column]:
    """Whether each identifier of a pair agrees (1), disagrees (-1) or doesn't tell (0)."""
    col = F.col
    apart = (col("edits") > 5) & ~col("c_coded")
    return {
        "inchi_is": col("inchi_is"), "chembl_is": col("chembl_is"), "cid_is": F.when(col("cid_near"), 0).otherwise(col("cid_is")),
        "name_is": F.when(col("same_name"), 1).when(apart, -1).otherwise(0), "mass_is": F.when(col("mass"), 1).when(col("other_mass"), -1).otherwise(0),
    }


def agreement() -> Column:
    """How well a pair agrees, to choose among the drugs that one rule finds for a compound."""
    col = F.col
    identifiers = (col("cid_is") + col("chembl_is") + col("inchi_is")) * 2
    return col("same_name").cast("int") * 4 + identifiers + col("mass").cast("int") - F.least("edits", F.lit(9)) - col("isomers").cast("int") * 9


def clearest(pairs: DataFrame, label: Column) -> DataFrame:
    """(compound_id, drug_id, label): the drug that agrees best; none where several agree equally."""
    best = pairs.groupBy("compound_id", "drug_id").agg(F.max(agreement()).alias("score"), F.max(label).alias("label"))
    last = F.max(F.struct("score", "drug_id", "label")).alias("t")
    first = F.max(F.struct("score", (-F.col("drug_id")).alias("d"))).alias("first")
    top = best.groupBy("compound_id").agg(last, first)
    return top.where(F.col("t.drug_id") == -F.col("first.d")).select("compound_id", "t.drug_id", "t.label")


def resolve(registry: DataFrame, compounds: DataFrame, model: MatchModel = MatchModel()) -> tuple[DataFrame, DataFrame]:
    """((compound_id, drug_id, label, rule) of all rules' matches, (rule, found, right, wrong, confidence) of each rule)."""
    drugs = cut(normalised(registry, "drug_id").dropDuplicates(["drug_id"]))
    everything = cut(normalised(compounds, "compound_id").dropDuplicates(["compound_id"]))
    cascade = rules(model)
    keys = [drug_key for _, drug_key, _, _, _ in cascade]
    found: DataFrame | None = None
    pairs_by: dict[str, DataFrame] = {}
    for name, drug_key, compound_key, condition, used in cascade:
        # what is resolved is read from what earlier rules wrote, so that no rule's plan holds another's
        left = lambda df, done=found: df if done is None else df.join(done.select("compound_id"), "compound_id", "left_anti")
        if drug_key not in pairs_by:
            pairs = with_evidence(_candidates(drugs, left(everything), drug_key, compound_key)).select(*EVIDENCE)
            pairs_by[drug_key] = cut(pairs) if keys.count(drug_key) > 1 else pairs
            pairs = pairs_by[drug_key].where(condition)
        else:  # rules of one key share its pairs; later ones only filter them
            pairs = left(pairs_by[drug_key]).where(condition)
        label = sum((v for k, v in signs().items() if k not in used), F.lit(0))
        resolved = cut(clearest(pairs, label).withColumn("rule", F.lit(name)))
        found = resolved if found is None else found.unionByName(resolved)
    right, wrong = F.count_if(F.col("label") > 0).alias("right"), F.count_if(F.col("label") < 0).alias("wrong")
    smoothed = (F.col("right") + model.prior_right) / (F.col("right") + F.col("wrong") + model.prior_right + model.prior_wrong)
    return found, found.groupBy("rule").agg(F.count("*").alias("found"), right, wrong).withColumn("confidence", smoothed)


def match_drugs(registry: DataFrame, compounds: DataFrame, model: MatchModel = MatchModel()) -> DataFrame:
    """(drug_id, compound_id, rule, confidence): the drug each compound is, if any.

    A compound has at most one drug: where a rule finds several, the one with most agreeing
    attributes is taken, and none if several agree equally (a later rule may tell). Matches of a
    rule whose precision on labelled pairs is below ``least_precision`` are not returned. Compounds
    without any attribute match nothing; names of any length are compared; repeated compounds are
    matched each; empty tables give no rows.
    """
    found, precision = resolve(registry, compounds, model)
    trusted = precision.where(F.col("confidence") >= model.least_precision).select("rule", "confidence")
    # one row a rule: at most as many as the cascade has rules
    return found.join(F.broadcast(trusted), "rule").select("drug_id", "compound_id", "rule", F.round("confidence", 4).alias("confidence"))


def rule_report(registry: DataFrame, compounds: DataFrame, model: MatchModel = MatchModel()) -> DataFrame:
    """Per rule that found anything: matches found, labelled right and wrong, smoothed precision, and matches returned."""
    _, precision = resolve(registry, compounds, model)
    returned = F.when(F.col("confidence") >= model.least_precision, F.col("found")).otherwise(0)
    return precision.select("rule", "found", "right", "wrong", F.round("confidence", 4).alias("confidence"), returned.alias("returned"))
