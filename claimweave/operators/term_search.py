"""What of a claim is found in an article: the searches behind the match signals, article by article.

A text is searched for the terms of all claims that are paired with its article, so it is read once. A term without a
space lies in a word, and words repeat: it is searched among the distinct words. A longer one is searched in the text
only if all its pieces are there.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.lexicons import RETRIEVAL_FACT_CHECK_TERMS
from claimweave.operators.candidates import attach_by_article
from claimweave.scale import give_back, materialize, measure, small_batches

# Claims whose pairs with an article lie in one row, and bytes of claims that each Python worker may hold.
CLAIMS_PER_ROW, HELD_CLAIMS = 8192, 16 << 20
SEARCHED = ["entities_s", "numbers_s", "phrases", "claim_tokens"]
TEXTS = ["title_n", "content_w", "entity_w", "event_w", "event_digits", "fact_w"]
FOUND = (
    "claim_id bigint, article_id bigint, matched_entities array<string>, event_entities array<string>, number_date_match double, "
    "phrases array<string>, title_phrases array<string>, title_tokens array<string>, content_tokens array<string>, fact_check_score double"
)


class Text:
    """A text that is searched for many terms."""

    def __init__(self, text: str):
        self.text, words = text.encode(), set(text.split(" "))
        self.words, self.joined = words, " ".join(words).encode()
        self.held: dict[str, bool] = {}

    def has(self, term: str) -> bool:
        """Whether the text contains the term."""
        found = self.held.get(term)
        if found is None:
            if " " in term:
                found = all(map(self.has, term.split(" "))) and term.encode() in self.text
            else:
                found = term in self.words or term.encode() in self.joined
            self.held[term] = found
        return found


def _found(claim: dict, title: Text, content: Text, entity: Text, event: Text, found_digits: str) -> tuple:
    def entities(text: Text) -> list[str]:
        return [e["name"] for e in claim["entities_s"] if any(map(text.has, e["variants"]))]

    matched, numbers = entities(entity), claim["numbers_s"]
    hits = sum(x["value"] != "" and (event.has(x["value"]) or (len(x["digits"]) >= 2 and x["digits"] in found_digits)) for x in numbers)
    tokens = claim["claim_tokens"]
    return (
        matched,
        matched if event is entity else entities(event),
        hits / len(numbers) if numbers else 0.0,
        [p for p in claim["phrases"] if title.has(p) or content.has(p)],
        list(filter(title.has, claim["phrases"])),
        list(filter(title.has, tokens)),
        list(filter(content.has, tokens)),
    )


def find_terms(pairs: DataFrame, windows: DataFrame, claims: DataFrame) -> DataFrame:
    """``FOUND`` of every distinct pair (claim_id, article_id): the terms of the claim that the windows of the article hold.

    ``claims`` has claim_id and the arrays of ``SEARCHED``. A small table of claims is held by every worker;
    the terms of a larger one travel with the pairs.
    """
    wanted = claims.select("claim_id", *SEARCHED)
    size = materialize(wanted, "claim_terms")
    bytes_ = size.agg(F.sum(F.octet_length(F.to_json(F.struct(*SEARCHED))))).first()[0] or 0
    small = bytes_ <= HELD_CLAIMS
    blocks = -(-measure(claims.select("claim_id")).rows // CLAIMS_PER_ROW) or 1
    own = pairs.select("claim_id", "article_id").distinct()
    if small:
        known = claims.sparkSession.sparkContext.broadcast({r["claim_id"]: r.asDict(True) for r in size.collect()})
        of_claim = F.struct("claim_id")
        own = own.join(F.broadcast(size.select("claim_id")), "claim_id", "left_semi")
    else:
        known = None
        own = own.join(size, "claim_id")
        of_claim = F.struct("claim_id", *SEARCHED)
    grouped = own.withColumn("block", F.pmod(F.xxhash64("claim_id"), F.lit(blocks)).cast("int")).groupBy("article_id", "block").agg(
        F.collect_list(of_claim).alias("claims"))
    event, fact = F.col("event_w"), F.col("fact_w")
    texts = windows.select("article_id", *TEXTS)
    rows = attach_by_article(grouped, texts, salt="block").select(
        "article_id", "claims", "title_n", "content_w", "entity_w",
        # most windows equal that of the entities
        F.when(event != F.col("entity_w"), event).alias("event_w"), F.when(fact != F.col("entity_w"), fact).alias("fact_w"), "event_digits",
    )

    def search(batches):
        schema = pa.schema([
            ("claim_id", pa.int64()), ("article_id", pa.int64()), *((c, pa.list_(pa.string())) for c in ("matched_entities", "event_entities")),
            ("number_date_match", pa.float64()), *((c, pa.list_(pa.string())) for c in ("phrases", "title_phrases", "title_tokens", "content_tokens")), ("fact_check_score", pa.float64())])
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                title, content, entity = Text(row["title_n"]), Text(row["content_w"]), Text(row["entity_w"])
                event = entity if row["event_w"] is None else Text(row["event_w"])
                fact_text = row["entity_w"] if row["fact_w"] is None else row["fact_w"]
                fact = 1.0 if any(t in fact_text for t in RETRIEVAL_FACT_CHECK_TERMS) else 0.0
                out = []
                for x in row["claims"]:
                    claim = known.value[x["claim_id"]] if known else x
                    out.append((x["claim_id"], row["article_id"], *_found(claim, title, content, entity, event, row["event_digits"]), fact))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), schema.types)], schema=schema)
        give_back()

    with small_batches(claims.sparkSession):
        return materialize(rows.mapInArrow(search, FOUND), "found_terms")


def claim_sizes(claims: DataFrame) -> DataFrame:
    """What the signals of a pair need of its claim besides the terms that were found."""
    return claims.select(
        "claim_id", "distinctive", F.size("entities_s").alias("n_entities"), F.size("specific_s").alias("n_specific"),
        F.transform("specific_s", lambda e: e["name"]).alias("specific"), F.size("phrases").alias("n_phrases"), F.size("claim_tokens").alias("n_tokens"),
    )


def with_found_terms(pairs: DataFrame, windows: DataFrame, claims: DataFrame) -> DataFrame:
    """``pairs`` with the columns that ``signals.add_signals`` counts."""
    pairs = materialize(pairs, "pairs_of_claims")
    found = find_terms(pairs, windows, claims)
    return pairs.join(found, ["claim_id", "article_id"]).join(claim_sizes(claims), "claim_id")
