"""Claims to ranked evidence candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.operators import candidates, signals, term_search
from claimweave.operators.candidates import Depths
from claimweave.scale import materialize
from claimweave.sources.index_store import SearchIndex

CANDIDATE_COLUMNS = [
    "claim_id",
    "retrieval_rank",
    "article_id",
    *["semantic_score", "lexical_score", "claim_lexical_score"],
    *signals.SIGNALS,
    "identity_candidate",
    "relevance",
    "evidence_type",
]


def score_claims(
    claims: DataFrame,
    claim_vectors: DataFrame,
    index: SearchIndex,
    depths: Depths = Depths(),
) -> DataFrame:
    """Every pooled pair of claim and article with scores, signals and relevance.

    One way for any number of claims: they are dealt out in blocks to the chunks of the index.
    """
    # claims are read by every channel: normalise them once
    prepared = materialize(candidates.prepare_claims(claims), "claims")
    pool = materialize(candidates.candidate_pool(prepared, claim_vectors, index, depths), "pool")
    scored = candidates.normalize_pool(candidates.score_pool(pool, claim_vectors, index))
    claim_side = prepared.select("claim_id", "exclude_article_id", *signals.CLAIM_ARRAYS)
    kept = candidates.exclude_source(scored.join(claim_side.select("claim_id", "exclude_article_id"), "claim_id"))
    found = term_search.with_found_terms(kept, index.windows, claim_side)
    return signals.score_candidates(signals.add_signals(found))


def rank_candidates(scored: DataFrame, k: int = 12) -> DataFrame:
    order = Window.partitionBy("claim_id").orderBy(
        F.desc("relevance"),
        F.desc("entity_cooccurrence"),
        F.desc("event_specificity"),
        F.desc("semantic_score"),
        "article_id",
    )
    return (
        scored.withColumn("retrieval_rank", F.row_number().over(order))
        .where(F.col("retrieval_rank") <= k)
        .select(*CANDIDATE_COLUMNS)
    )


def retrieve(
    claims: DataFrame,
    claim_vectors: DataFrame,
    index: SearchIndex,
    k: int = 12,
    depths: Depths = Depths(),
) -> DataFrame:
    """Top-k candidates per claim, without article text."""
    return rank_candidates(score_claims(claims, claim_vectors, index, depths), k)
