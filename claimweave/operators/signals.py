"""Match signals of a claim against an article, as column expressions.

The terms of a claim that its article holds arrive searched (``term_search``), so each signal is
array work inside one projection. All "token" hits are substring tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.numeric import round4, safe_ratio


def entity_cooccurrence(hits: Column, total: Column) -> Column:
    """Step table over the number of entities found."""

    def steps(*pairs):
        out = F.lit(0.0)
        for least, score in sorted(pairs):
            out = F.when(hits >= least, score).otherwise(out)
        return out

    return (
        F.when(total >= 4, steps((4, 1.0), (3, 0.75), (2, 0.5), (1, 0.15)))
        .when(total == 3, steps((3, 1.0), (2, 0.65), (1, 0.2)))
        .when(total == 2, steps((2, 1.0), (1, 0.3)))
        .when(total == 1, steps((1, 1.0)))
        .otherwise(0.0)
    )


def event_specificity(
    title_ratio: Column, content_ratio: Column, multi_hits: Column, multi_title_hits: Column
) -> Column:
    score = (
        0.30 * title_ratio
        + 0.20 * content_ratio
        + 0.30 * F.least(multi_hits / 5.0, F.lit(1.0))
        + 0.20 * F.least(multi_title_hits / 3.0, F.lit(1.0))
    )
    return F.least(F.lit(1.0), score)


def claim_event_overlap(title_hits: Column, content_hits: Column, terms: Column) -> Column:
    bonus = (
        F.when(title_hits >= 4, 0.30).when(title_hits >= 3, 0.20).when(title_hits >= 2, 0.10)
    ).otherwise(0.0)
    score = 0.55 * safe_ratio(title_hits, terms) + 0.25 * safe_ratio(content_hits, terms) + bonus
    return F.least(F.lit(1.0), score)


def evidence_type(fact: Column) -> Column:
    return F.when(fact > 0, "FACT_CHECK").otherwise("NEWS")


SIGNALS = [
    "entity_match",
    "entity_cooccurrence",
    "phrase_match",
    "event_specificity",
    "claim_event_overlap",
    "number_date_match",
    "fact_check_score",
]


def add_signals(found: DataFrame) -> DataFrame:
    """Signals of pairs with their found terms (``term_search.with_found_terms``), in two projections.

    Phrases of several words, distinctive tokens and specific entities are subsets, counted in the first among what
    was found. The second is arithmetic.
    """
    keep = [c for c in found.columns if c not in FOUND_COLUMNS]
    col = F.col

    def distinctive(tokens: str) -> Column:
        return F.size(F.filter(tokens, lambda t: F.array_contains(col("distinctive"), t)))

    multi = F.filter("phrases", lambda p: F.contains(p, F.lit(" ")))
    hits = found.select(
        *keep,
        "matched_entities",
        "n_entities",
        "n_specific",
        "n_tokens",
        "number_date_match",
        "fact_check_score",
        F.size("event_entities").alias("event_entities"),
        F.size(F.filter("event_entities", lambda e: F.array_contains(col("specific"), e))).alias("specific_hits"),
        safe_ratio(F.size("phrases"), col("n_phrases")).alias("phrase_match"),
        F.size(multi).alias("multi_hits"),
        F.size(F.filter(multi, lambda p: F.array_contains(col("title_phrases"), p))).alias("multi_title_hits"),
        F.size("title_tokens").alias("token_title_hits"),
        F.size("content_tokens").alias("token_content_hits"),
        F.size("distinctive").alias("n_distinctive"),
        distinctive("title_tokens").alias("distinct_title_hits"),
        distinctive("content_tokens").alias("distinct_content_hits"),
    )
    specificity = event_specificity(
        safe_ratio(col("token_title_hits"), col("n_tokens")),
        safe_ratio(col("token_content_hits"), col("n_tokens")),
        col("multi_hits"),
        col("multi_title_hits"),
    )
    overlap = claim_event_overlap(
        col("distinct_title_hits"), col("distinct_content_hits"), col("n_distinctive")
    )
    return hits.select(
        *keep,
        "matched_entities",
        safe_ratio(F.size("matched_entities"), col("n_entities")).alias("entity_match"),
        entity_cooccurrence(col("event_entities"), col("n_entities")).alias("entity_cooccurrence"),
        "phrase_match",
        F.when(col("n_tokens") > 0, specificity).otherwise(0.0).alias("event_specificity"),
        F.when(col("n_tokens") > 0, overlap).otherwise(0.0).alias("claim_event_overlap"),
        "number_date_match",
        "fact_check_score",
        "n_specific",
        "specific_hits",
    )


CLAIM_ARRAYS = [
    "entities_s", "specific_s", "numbers_s", "phrases", "claim_tokens", "distinctive",
]
# What ``add_signals`` counts and does not pass on.
FOUND_COLUMNS = [
    "matched_entities", "event_entities", "number_date_match", "phrases", "title_phrases", "title_tokens", "content_tokens", "fact_check_score",
    "distinctive", "n_entities", "n_specific", "specific", "n_phrases", "n_tokens",
]


def strength_flags(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns(
        {
            "strong_identity": (c("entity_match") >= 0.20) | (c("entity_cooccurrence") >= 0.35),
            "strong_event": (c("phrase_match") >= 0.15)
            | (c("event_specificity") >= 0.25)
            | (c("claim_event_overlap") >= 0.25),
            "strong_claim": (c("claim_lexical_score") >= 0.20) | (c("lexical_score") >= 0.30),
        }
    )


def base_relevance() -> Column:
    """Weighted sum of all signals. The weights add up to 1.14 on purpose; no clamp."""
    c = F.col
    return (
        0.14 * c("semantic_norm")
        + 0.08 * c("lexical_norm")
        + 0.15 * c("claim_norm")
        + 0.15 * c("entity_match")
        + 0.18 * c("entity_cooccurrence")
        + 0.10 * c("phrase_match")
        + 0.08 * c("event_specificity")
        + 0.12 * c("claim_event_overlap")
        + 0.06 * c("number_date_match")
        + 0.08 * c("fact_check_score")
    )


def bonuses() -> Column:
    c = F.col
    event = (c("event_specificity") >= 0.30) | (c("claim_event_overlap") >= 0.30)

    def add(amount, condition):
        return F.when(condition, amount).otherwise(0.0)

    return (
        add(0.12, c("identity_candidate"))
        + add(0.10, c("strong_identity") & c("strong_event"))
        + add(0.10, (c("entity_cooccurrence") >= 0.65) & event)
    )


def penalties() -> Column:
    c = F.col
    nothing = ~c("strong_identity") & ~c("strong_event") & ~c("strong_claim")
    semantic_only = (
        (c("entity_match") == 0)
        & (c("entity_cooccurrence") == 0)
        & (c("phrase_match") < 0.10)
        & (c("claim_lexical_score") < 0.10)
    )
    only_broad = (c("n_specific") > 0) & (c("specific_hits") == 0)

    def times(factor, condition):
        return F.when(condition, factor).otherwise(1.0)

    return times(0.35, nothing) * times(0.45, semantic_only) * times(0.50, only_broad)


ROUNDED = ["semantic_score", "lexical_score", "claim_lexical_score", *SIGNALS, "relevance"]


def score_candidates(df: DataFrame) -> DataFrame:
    """Relevance, evidence type and four-place rounding of every reported number."""
    scored = strength_flags(df).withColumn(
        "relevance", (base_relevance() + bonuses()) * penalties()
    )
    typed = scored.withColumn("evidence_type", evidence_type(F.col("fact_check_score")))
    return typed.withColumns({c: round4(F.col(c)) for c in ROUNDED})
