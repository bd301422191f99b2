"""Candidate generation: a table of claims against a table of articles.

Five channels propose articles for every claim: dense vectors, words of the source, words
of the claim, characters of the source, and literal entity identity. Their union is the
pool; every pooled pair carries all scores, whichever channel proposed it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions import lexicons
from claimweave.functions.text import (
    at_most,
    digits,
    drop_stopwords,
    entity_variants,
    fold,
    important_phrases,
    nfkc_array,
    normalize_entity,
    normalize_text,
    strip_ws,
    text_or_blank,
    token_set,
    words_array,
)
from claimweave.operators import inverted, lexical
from claimweave.operators.lexical import CHAR, WORD
from claimweave.operators.vectors import SCORE_DECIMALS, best_scores, dot
from claimweave.scale import ROWS_PER_SALT, all_salts, materialize, salt_of, salts_for
from claimweave.sources.index_store import SearchIndex


@dataclass(frozen=True)
class Depths:
    """How many articles each channel may propose per claim."""

    semantic: int = 150
    word_original: int = 150
    word_claim: int = 100
    char_original: int = 150
    identity: int = 300

    @property
    def lexical(self) -> dict[str, int]:
        return {"word_original": self.word_original, "word_claim": self.word_claim, "char_original": self.char_original}


# --- claims --------------------------------------------------------------------------


def build_queries(claims: DataFrame, source_chars: int | None = None) -> DataFrame:
    """Query texts of every claim with a non-blank text.

    The whole source text counts, or its first ``source_chars`` characters (3500 in the behaviour being
    matched).
    """
    claim, title = text_or_blank(F.col("claim")), text_or_blank(F.col("source_title"))
    content = text_or_blank(F.col("source_content"))
    entities, numbers = F.array_join("entities", " "), F.array_join("numbers_dates", " ")
    return (
        claims.withColumn("entities", F.coalesce("entities", F.array().cast("array<string>")))
        .withColumn("numbers_dates", F.coalesce("numbers_dates", F.array().cast("array<string>")))
        .where(strip_ws(claim) != "")
        .withColumns(
            {
                "q_semantic": F.concat_ws(". ", claim, title, entities, numbers),
                "q_original": F.concat_ws(
                    " ", title, F.substring(content, 1, source_chars) if source_chars else content
                ),
                "q_claim": F.concat_ws(" ", claim, entities, numbers),
            }
        )
    )


def prepare_claims(
    claims: DataFrame, source_chars: int | None = None, own_phrases: int | None = None, phrases: int | None = None
) -> DataFrame:
    """Queries plus the arrays the match signals use, each computed once per claim.

    ``own_phrases`` limits the phrases of the claim text and ``phrases`` those with the entity variants
    (15 and 30 in the behaviour being matched); without limits all count.
    """

    def named(entities):
        return F.transform(
            entities, lambda e: F.struct(e.alias("name"), entity_variants(e).alias("variants"))
        )

    with_text = build_queries(claims, source_chars).withColumns(
        {
            "claim_n": normalize_text(F.col("claim")),
            "entities_x": nfkc_array(F.col("entities")),
            "numbers_x": nfkc_array(F.col("numbers_dates")),
        }
    )
    broad = words_array(lexicons.BROAD_ENTITIES)
    with_names = with_text.withColumns(
        {
            "names": F.transform("entities_x", normalize_entity),
            "numbers_n": F.transform("numbers_x", fold),
            "all_tokens": F.filter(
                drop_stopwords(token_set(F.col("claim_n")), lexicons.RETRIEVAL_STOPWORDS),
                lambda t: F.length(t) >= 4,
            ),
        }
    )
    with_arrays = with_names.withColumns(
        {
            "entities_s": named(F.col("names")),
            "specific_s": named(
                F.filter("names", lambda n: (n != "") & ~F.array_contains(broad, n))
            ),
            "numbers_s": F.transform(
                "numbers_n", lambda n: F.struct(n.alias("value"), digits(n).alias("digits"))
            ),
            "claim_tokens": F.col("all_tokens"),
            "not_generic": F.array_except(
                "all_tokens", words_array(lexicons.GENERIC_EVENT_WORDS)
            ),
        }
    )
    variants = F.flatten(F.transform("entities_s", lambda e: e["variants"]))
    return with_arrays.withColumns(
        {
            "distinctive": F.when(F.size("not_generic") > 0, F.col("not_generic")).otherwise(
                F.col("claim_tokens")
            ),
            "phrases": at_most(
                F.array_distinct(F.concat(important_phrases(F.col("claim_n"), own_phrases), variants)), phrases
            ),
            "identity_variants": F.array_distinct(F.filter(variants, lambda v: F.length(v) >= 3)),
        }
    ).drop("claim_n", "entities_x", "numbers_x", "names", "numbers_n", "all_tokens", "not_generic")


def claim_phrases(claims: DataFrame, own_phrases: int | None = None, phrases: int | None = None) -> DataFrame:
    limited = prepare_claims(claims, own_phrases=own_phrases, phrases=phrases)
    return limited.select("claim_id", "phrases")


# --- identity channel ----------------------------------------------------------------


def identity_hits(prepared: DataFrame, index: SearchIndex) -> DataFrame:
    """(article_id, claim_id, hits): distinct variants found, at least one."""
    return inverted.named_entities(_identity_side(prepared), index.lists).select("article_id", "claim_id", "hits")


def _identity_side(prepared: DataFrame) -> DataFrame:
    return prepared.select("claim_id", "exclude_article_id", "identity_variants", "phrases", "numbers_s")


def identity_candidates(prepared: DataFrame, index: SearchIndex, limit: int = 250) -> DataFrame:
    """Articles that name two entities of a claim, or one next to a phrase or number of it.

    The ``limit`` articles with most hits are kept per claim, ties by id; the limit is applied inside each chunk
    before rows are shuffled. Single hits rank behind all others, so they are checked only where a chunk has too few.
    """
    order = Window.partitionBy("claim_id").orderBy(F.desc("hits"), "article_id")
    found = inverted.named_entities(_identity_side(prepared), index.lists, limit)
    ranked = found.withColumn("position", F.row_number().over(order)).where(F.col("position") <= limit)
    return ranked.select("claim_id", "article_id", "hits")


# --- pool ----------------------------------------------------------------------------


def claim_term_weights(prepared: DataFrame, index: SearchIndex, channel: str, **texts) -> DataFrame:
    """(claim_id, term, salts, one weight column per query text)."""
    parts = None
    for name, text in texts.items():
        weights = lexical.query_weights(prepared, text, index.vocabulary(channel), channel)
        part = weights.select(
            "claim_id", "term", "salts", *[(F.col("w") if n == name else F.lit(None).cast("double")).alias(n) for n in texts]
        )
        parts = part if parts is None else parts.unionByName(part)
    if len(texts) == 1:
        return parts
    return parts.groupBy("claim_id", "term", "salts").agg(
        *[F.max(n).alias(n) for n in texts]
    )


def word_scores(prepared: DataFrame, index: SearchIndex) -> DataFrame:
    """Word cosines of every claim with every article that shares a term: a report, not a step of the search."""
    weights = claim_term_weights(
        prepared, index, WORD, word_original="q_original", word_claim="q_claim"
    ).withColumn("channel", F.lit(WORD)).withColumn("char_original", F.lit(None).cast("double"))
    return inverted.score_all(weights, index.lists, ["word_original", "word_claim"], prepared)


def char_scores(prepared: DataFrame, index: SearchIndex) -> DataFrame:
    """Character cosines, as :func:`word_scores`."""
    weights = claim_term_weights(prepared, index, CHAR, char_original="q_original").withColumn("channel", F.lit(CHAR))
    weights = weights.withColumns({k: F.lit(None).cast("double") for k in ("word_original", "word_claim")})
    return inverted.score_all(weights, index.lists, ["char_original"], prepared)


def term_scores(
    prepared: DataFrame, index: SearchIndex, depths: Depths = Depths(), forced: DataFrame | None = None
) -> DataFrame:
    """The pairs that may be among the best of a lexical channel, and the forced ones, with all three scores."""
    word = claim_term_weights(
        prepared, index, WORD, word_original="q_original", word_claim="q_claim"
    ).withColumn("channel", F.lit(WORD))
    char = claim_term_weights(prepared, index, CHAR, char_original="q_original").withColumn("channel", F.lit(CHAR))
    weights = word.unionByName(char, allowMissingColumns=True).drop("salts")
    if forced is None:
        forced = prepared.sparkSession.createDataFrame([], "claim_id bigint, article_id bigint")
    scored = inverted.score_claims(weights, forced, index.lists, depths.lexical, prepared)
    return materialize(scored, "term_scores")


def proposed_pairs(
    prepared: DataFrame,
    claim_vectors: DataFrame,
    index: SearchIndex,
    depths: Depths = Depths(),
) -> DataFrame:
    """(claim_id, article_id, identity_candidate) of the two channels without terms."""
    nearest = best_scores(
        prepared.select("claim_id")
        .join(claim_vectors, "claim_id")
        .select(
            F.col("claim_id").alias("query_id"),
            "embedding",
            # the source article competes for places here and is dropped later
            F.lit(None).cast("bigint").alias("exclude_article_id"),
        ),
        index.vectors,
        depths.semantic,
    ).select(F.col("query_id").alias("claim_id"), "article_id", F.lit(False).alias("identity_candidate"))
    named = identity_candidates(prepared, index, depths.identity).select(
        "claim_id", "article_id", F.lit(True).alias("identity_candidate")
    )
    return (
        nearest.unionByName(named)
        .groupBy("claim_id", "article_id")
        .agg(F.max("identity_candidate").alias("identity_candidate"))
    )


def candidate_pool(
    prepared: DataFrame,
    claim_vectors: DataFrame,
    index: SearchIndex,
    depths: Depths = Depths(),
) -> DataFrame:
    """Distinct (claim, article) pairs proposed by any channel, with the lexical scores.

    The proposals of the other channels are scored together with the best pairs of each chunk of the
    inverted file, so only the best rows per claim, channel and chunk, and the proposals, are ever rows.
    """
    proposed = materialize(proposed_pairs(prepared, claim_vectors, index, depths), "proposed")
    scored = term_scores(prepared, index, depths, proposed)
    kinds = list(depths.lexical)

    def pooled(df: DataFrame, scores, named=F.lit(False)) -> DataFrame:
        return df.select("claim_id", "article_id", *scores, named.alias("identity_candidate"))

    parts = [pooled(best, kinds) for best in inverted.best_by_terms(scored, depths.lexical).values()]
    parts.append(pooled(scored.where("forced"), kinds))
    # proposals outside the inverted file score 0 in every lexical channel
    parts.append(pooled(proposed, [F.lit(0.0).alias(c) for c in kinds], F.col("identity_candidate")))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("claim_id", "article_id").agg(
        *[F.max(c).alias(c) for c in kinds], F.max("identity_candidate").alias("identity_candidate")
    )


def lexical_blend(word, char):
    return 0.55 * word + 0.45 * char


def score_pool(pool: DataFrame, claim_vectors: DataFrame, index: SearchIndex) -> DataFrame:
    """All scores of every pooled pair; a missing vector scores 0."""
    claim_side = claim_vectors.select("claim_id", F.col("embedding").alias("claim_vector"))
    vectors = index.vectors.select("article_id", F.col("embedding").alias("article_vector"))
    joined = pool.join(claim_side, "claim_id", "left").join(vectors, "article_id", "left")
    cosine = F.round(
        F.coalesce(dot(F.col("claim_vector"), F.col("article_vector")), F.lit(0.0)), SCORE_DECIMALS
    )
    return joined.select(
        *pool.columns,
        cosine.alias("semantic_score"),
        lexical_blend(F.col("word_original"), F.col("char_original")).alias("lexical_score"),
        F.col("word_claim").alias("claim_lexical_score"),
    )


def minmax_by(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Min-max scaling within a key; a constant column becomes 1. Groups are bounded pools."""
    group = Window.partitionBy(key)
    scaled = {}
    for source, target in columns.items():
        low, high = F.min(source).over(group), F.max(source).over(group)
        scaled[target] = F.when(high - low < 1e-8, 1.0).otherwise(
            F.try_divide(F.col(source) - low, high - low)
        )
    return df.withColumns(scaled)


def normalize_pool(scored: DataFrame) -> DataFrame:
    return minmax_by(
        scored,
        "claim_id",
        {
            "semantic_score": "semantic_norm",
            "lexical_score": "lexical_norm",
            "claim_lexical_score": "claim_norm",
        },
    )


def exclude_source(df: DataFrame) -> DataFrame:
    """Drop a claim's own source article; a claim without one keeps all rows."""
    return df.where(~F.col("article_id").eqNullSafe(F.col("exclude_article_id")))


def attach_by_article(
    pairs: DataFrame, table: DataFrame, rows_per_task: int = ROWS_PER_SALT, salt: str = "claim_id"
) -> DataFrame:
    """Join per-article columns to pairs.

    An article that occurs in more than ``rows_per_task`` pairs is spread over as many tasks as that asks for: its
    pairs are salted by ``salt``, and its row is copied once per salt. All others meet on the table's own bucketing.
    """
    pairs = materialize(pairs, "pairs")
    hot = materialize(
        pairs.groupBy("article_id").agg(F.count("*").alias("n")).where(F.col("n") > rows_per_task)
        .select("article_id", salts_for(F.col("n"), rows_per_task).alias("salts")),
        "hot_articles",
    )
    if not hot.limit(1).count():
        return pairs.join(table, "article_id")
    cold = pairs.join(hot, "article_id", "left_anti").join(table, "article_id")
    spread = pairs.join(hot, "article_id").withColumn("salt", salt_of(F.col(salt), F.col("salts"))).drop("salts")
    copies = table.join(hot, "article_id").withColumn("salt", all_salts(F.col("salts"))).drop("salts")
    # a text that lies in several tasks must not be broadcast back into one
    return cold.unionByName(spread.hint("merge").join(copies, ["article_id", "salt"]).select(cold.columns))
