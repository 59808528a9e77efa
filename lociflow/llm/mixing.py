"""Mixing sources to target shares of all tokens, with capped repetition of documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.tokens import TOKENIZERS, token_counts
from lociflow.session import cut

MOST_SOURCES = 10_000


@dataclass(frozen=True)
class MixPlan:
    """Seed, wanted size and tokenizer.

    The size asked for is ``total_tokens`` or, where that is None, ``size`` times the tokens of all
    documents of the asked sources. Sources too small for their share of it are used as often as
    allowed and reported as capped; the others aren't enlarged for them.
    """

    seed: int = 42
    size: float = 0.25
    total_tokens: float | None = None
    tokenizer: str = "byte_bpe_50k"
    folder: str = TOKENIZERS


def repetition_rates(sizes: DataFrame, targets: DataFrame, plan: MixPlan) -> list[dict]:
    """Per target source: tokens and documents available, the rate of repetition and a status.

    The table of targets is a plan of at most 10,000 sources (checked); tokens are summed in Spark.
    Status: met, capped (max_repeats binds) or no_documents. A source listed twice has its first
    share only if both rows agree, else it is an error.
    """
    asked = targets.where("source is not null").select("source", "target_share", "max_repeats").distinct()
    sums = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count_if(F.col("n_tokens") > 0).alias("docs"))
    rows = [r.asDict() for r in asked.join(sums, "source", "left").limit(MOST_SOURCES + 1).collect()]
    if len(rows) > MOST_SOURCES or len({r["source"] for r in rows}) < len(rows):
        raise ValueError("mix targets must be at most 10,000 sources, each named once")
    for r in rows:
        r |= {"tokens": r["tokens"] or 0, "docs": r["docs"] or 0, "target_share": r["target_share"] or 0.0, "max_repeats": max(r["max_repeats"] or 0, 0)}
    able = [r for r in rows if r["tokens"] and r["target_share"] > 0]
    total = plan.size * sum(r["tokens"] for r in able) if plan.total_tokens is None else plan.total_tokens
    for r in rows:
        wanted = r["target_share"] * total / r["tokens"] if r["tokens"] else 0.0
        r["rate"] = min(float(r["max_repeats"]), wanted)
        r["status"] = "no_documents" if not r["tokens"] else "capped" if wanted > r["max_repeats"] * (1 + 1e-9) else "met"
    return rows


def copies(rate: Column, key: Column, seed: int) -> Column:
    """floor(rate), and one more with the fraction's probability, drawn by a hash of seed and key."""
    draw = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 52)) / float(1 << 52)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def repeated(sizes: DataFrame, rates: list[dict], plan: MixPlan) -> DataFrame:
    """The documents used, with how many ``copies`` of each.

    Documents of other sources and without tokens (null, empty) are not used. The rates ride along
    as literals, so there is no join and no shuffle, and no source is in one task.
    """
    pairs = [F.lit(x) for r in rates for x in (r["source"], r["rate"])]
    rate = F.try_element_at(F.create_map(*pairs), F.col("source")) if pairs else F.lit(None).cast("double")
    used = sizes.where("n_tokens > 0").withColumn("rate", rate).where(F.col("rate") > 0)
    return used.withColumn("copies", copies(F.col("rate"), F.col("doc_id"), plan.seed)).where("copies > 0")


def mixed_documents(documents: DataFrame, targets: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """One row per document and copy: doc_id, source, copy, n_tokens."""
    sizes = cut(token_counts(documents, plan.tokenizer, plan.folder))
    used = repeated(sizes, repetition_rates(sizes, targets, plan), plan)
    return used.select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "n_tokens")


def mix_report(documents: DataFrame, targets: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """One row per target source: target and reachable share, what there is, rate, status, tokens used and actual share."""
    sizes = cut(token_counts(documents, plan.tokenizer, plan.folder))
    rates = repetition_rates(sizes, targets, plan)
    spent = F.sum(F.col("copies") * F.col("n_tokens"))
    taken = repeated(sizes, rates, plan).groupBy("source").agg(spent.alias("tokens_used"), F.max("copies").alias("most_copies"))
    reachable = sum(r["target_share"] for r in rates if r["tokens"]) or 1.0
    columns = ("source", "target_share", "max_repeats", "docs", "tokens", "rate", "status")
    rows = [(*[r[c] for c in columns], r["target_share"] / reachable if r["tokens"] else 0.0) for r in rates]
    schema = "source string, target_share double, max_repeats int, documents long, tokens_available long, rate double, status string, reachable_share double"
    report = cut(documents.sparkSession.createDataFrame(rows, schema).join(taken, "source", "left").fillna(0, ["tokens_used", "most_copies"]))
    whole = report.agg(F.sum("tokens_used")).first()[0] or 1
    return report.withColumn("actual_share", F.round(F.col("tokens_used") / whole, 6))
