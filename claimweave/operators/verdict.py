"""Tables before and after the external verdict model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions import lexicons
from claimweave.functions.jsontext import extract_json, is_json_object
from claimweave.functions.numeric import clamp01, round4, to_number
from claimweave.functions.text import collapse_ws, snippet, strip_ws, text_or_blank, truncate_middle
from claimweave.operators.profiling import label_name
from claimweave.schema import CLAIM_RECORD_SCHEMA

NO_EVIDENCE = "NO EVIDENCE WAS RETRIEVED."
NO_EXPLANATION = "The available evidence was insufficient to establish the claim."


def normalize_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) requests. A question stands in for a blank title or content."""
    have = set(requests.columns)

    def optional(name, type_name):
        return F.col(name) if name in have else F.lit(None).cast(type_name)

    def filled(name):
        own = F.nullif(strip_ws(optional(name, "string")), F.lit(""))
        question = F.nullif(strip_ws(optional("question", "string")), F.lit(""))
        return F.coalesce(own, question, F.lit(""))

    ready = requests.select(
        "request_id",
        filled("title").alias("title"),
        filled("content").alias("content"),
        text_or_blank(optional("url", "string")).alias("url"),
        optional("article_id", "bigint").alias("article_id"),
    )
    blank = (F.col("title") == "") & (F.col("content") == "")
    reason = F.lit("provide at least one of question, title, content").alias("reason")
    return ready.where(~blank), ready.where(blank).select("request_id", reason)


def extraction_inputs(articles: DataFrame, key: str) -> DataFrame:
    """Input text of an external claim extractor: title, blank line, content, first 8000 chars."""
    text = F.concat_ws("\n\n", text_or_blank(F.col("title")), text_or_blank(F.col("content")))
    return articles.select(key, text.alias("news_text"), snippet(text, 8000).alias("extractor_input"))


def parse_claims(replies: DataFrame) -> DataFrame:
    """Claim records from (claim_id, news_text, raw); ``error`` tells what went wrong.

    Absent lists become empty, other absent fields blank, and a blank main claim becomes
    the whole input text. Blank input or a reply that is no JSON object gives an error row.
    """
    blank = strip_ws(F.col("news_text")) == ""
    valid = F.coalesce(F.try_parse_json("raw").isNotNull(), F.lit(False)) & is_json_object(F.col("raw"))
    read = replies.withColumns(
        {
            "record": F.when(valid & ~blank, F.from_json("raw", CLAIM_RECORD_SCHEMA)),
            "error": F.when(blank, "news_text cannot be empty").when(~valid, "invalid JSON"),
        }
    )
    record, ok = F.col("record"), F.col("error").isNull()

    def string_field(name):
        return F.when(ok, F.coalesce(record[name], F.lit(""))).alias(name)

    def list_field(name):
        return F.when(ok, F.coalesce(record[name], F.array().cast("array<string>"))).alias(name)

    main = F.when(strip_ws(record["main_claim"]) != "", record["main_claim"])
    return read.select(
        "claim_id",
        F.when(ok, F.coalesce(main, strip_ws(F.col("news_text")))).alias("main_claim"),
        *[list_field(n) for n in ("sub_claims", "entities", "numbers_dates")],
        *[string_field(n) for n in ("claim_type", "is_fact_check_article", "claim_status")],
        "error",
    )


def evidence_block(position: Column) -> Column:
    """Text of one evidence item. The layout is ours, the fields and their precision are fixed."""
    c = F.col
    return F.format_string(
        "EVIDENCE %d\nEvidence ID: %s\nArticle ID: %s\nTitle: %s\nURL: %s\nDataset label: %s\n"
        "Evidence type: %s\nSemantic score: %.4f\nLexical score: %.4f\nEntity match: %.4f\n"
        "Number/date match: %.4f\nClaim match: %.4f\nEvidence score: %.4f\nStrong evidence: %s\n"
        "Article content:\n%s",
        position,
        c("evidence_id"),
        F.coalesce(c("article_id").cast("string"), F.lit("UNKNOWN")),
        strip_ws(c("title")),
        strip_ws(c("url")),
        label_name(c("label")),
        F.coalesce(c("evidence_type"), F.lit("UNKNOWN")),
        *[
            F.coalesce(c(name).cast("double"), F.lit(0.0))
            for name in (
                "semantic_score", "lexical_score", "entity_match", "number_date_match",
                "claim_match", "evidence_score",
            )
        ],
        F.when(c("strong_evidence"), "True").otherwise("False"),
        truncate_middle(c("content"), 3000),
    )


def evidence_blocks(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """(claim_id, evidence_block): numbered items in rank order, or a fixed sentence if none.

    Evidence is at most the reranker's k rows per claim, so the collected list is bounded.
    """
    blocks = evidence.select(
        "claim_id", F.struct("rank", evidence_block(F.col("rank")).alias("block")).alias("item")
    )
    ordered = F.transform(F.array_sort(F.collect_list("item")), lambda i: i["block"])
    joined = blocks.groupBy("claim_id").agg(F.array_join(ordered, "\n\n").alias("evidence_block"))
    return (
        claims.select("claim_id")
        .join(joined, "claim_id", "left")
        .withColumn("evidence_block", F.coalesce("evidence_block", F.lit(NO_EVIDENCE)))
    )


def build_prompts(claims: DataFrame, blocks: DataFrame) -> DataFrame:
    """Prompt and shorter retry prompt per claim; the instruction text is left to the caller."""
    article = truncate_middle(
        F.concat_ws("\n\n", text_or_blank(F.col("source_title")), text_or_blank(F.col("source_content"))),
        5000,
    )
    claim = strip_ws(F.col("claim"))
    prompt = F.format_string(
        "CLAIM\n%s\n\nARTICLE\n%s\n\nEVIDENCE\n%s", claim, article, F.col("evidence_block")
    )
    retry = F.format_string("CLAIM\n%s\n\nEVIDENCE\n%s", claim, F.col("evidence_block"))
    return (
        claims.where(claim != "")
        .join(blocks, "claim_id")
        .select("claim_id", prompt.alias("prompt"), retry.alias("retry_prompt"))
    )


def _field(name: str) -> Column:
    """Scalar field of the parsed reply as text, whatever its JSON type."""
    return F.get_json_object("json", f"$.{name}")


def _json_type(json: str, path: str) -> Column:
    """Type of a field of a JSON text, such as ``BOOLEAN`` or ``STRING``."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant"))


def _confidence() -> Column:
    """Confidence as a number: JSON booleans are 1 and 0, infinite and undefined words lie at the bounds."""
    text = F.lower(F.trim(_field("confidence")))
    return (
        F.when(_json_type("json", "$.confidence") == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
        .when(text.rlike(r"^(?:\+?inf(?:inity)?|[+-]?nan)$"), 1.0)
        .otherwise(F.coalesce(to_number(text), F.lit(0.0)))
    )


def validate_responses(responses: DataFrame) -> DataFrame:
    """Checked verdicts from (claim_id, raw).

    Unknown verdicts become UNCERTAIN, unreadable confidences 0, blank explanations a fixed
    sentence, blank summaries the explanation. A reply without a JSON object is an error row.
    """
    parsed = responses.withColumn("json", extract_json(F.col("raw")))
    ok = is_json_object(F.col("json"))
    verdict = F.upper(strip_ws(_field("verdict")))
    explanation = F.coalesce(F.nullif(strip_ws(_field("explanation")), F.lit("")), F.lit(NO_EXPLANATION))
    read = parsed.select(
        "claim_id",
        "json",
        F.when(F.col("json").isNull(), "no valid JSON").when(~ok, "not a JSON object").alias("error"),
        F.when(verdict.isin(lexicons.VERDICTS), verdict).otherwise("UNCERTAIN").alias("verdict"),
        _confidence().alias("confidence"),
        explanation.alias("explanation"),
        F.nullif(strip_ws(_field("summary")), F.lit("")).alias("summary"),
    )
    good = F.col("error").isNull()
    return read.select(
        "claim_id",
        F.when(good, F.col("verdict")).alias("verdict"),
        F.when(good, round4(clamp01(F.col("confidence")))).alias("confidence"),
        F.when(good, F.col("explanation")).alias("explanation"),
        F.when(good, F.coalesce("summary", "explanation")).alias("summary"),
        "error",
        F.when(good, F.col("json")).alias("json"),
    )


def explode_relations(validated: DataFrame) -> DataFrame:
    """(claim_id, position, evidence_id, relationship) of every evidence relation in a reply.

    Items that are no objects are dropped; an unknown relation becomes ``insufficient``.
    """
    items = F.try_variant_get(F.try_parse_json("json"), "$.evidence_analysis", "array<variant>")
    each = validated.select("claim_id", F.posexplode(items).alias("position", "value"))
    each = each.where(F.schema_of_variant("value").startswith("OBJECT"))
    each = each.withColumn("item", F.to_json("value"))
    relation = F.lower(
        strip_ws(F.coalesce(F.get_json_object("item", "$.relationship"), F.lit("insufficient")))
    )
    return each.select(
        "claim_id",
        "position",
        text_or_blank(F.get_json_object("item", "$.evidence_id")).alias("evidence_id"),
        F.when(relation.isin(lexicons.RELATIONS), relation).otherwise("insufficient").alias("relationship"),
    )


def format_results(claims: DataFrame, evidence: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One response row per claim with the evidence nested in rank order.

    A claim without a valid reply has ``error`` and no verdict, confidence, explanation or summary.
    """
    c = F.col

    def number(*names):
        present = [c(n) for n in names if n in evidence.columns]
        return F.coalesce(*present, F.lit(0.0))

    item = F.struct(
        c("rank"),
        c("evidence_id"),
        c("article_id"),
        text_or_blank(c("title")).alias("title"),
        snippet(c("content"), 350).alias("content_snippet"),
        text_or_blank(c("url")).alias("url"),
        number("semantic_score").alias("semantic_score"),
        number("lexical_score").alias("lexical_score"),
        number("claim_match", "claim_match_score").alias("claim_match"),
        number("entity_match", "entity_match_score").alias("entity_match"),
        number("number_date_match", "number_date_match_score").alias("number_date_match"),
        number("evidence_score").alias("evidence_score"),
        F.coalesce(c("evidence_type"), F.lit("NEWS")).alias("evidence_type"),
        F.coalesce(c("strong_evidence"), F.lit(False)).alias("strong_evidence"),
    )
    nested = evidence.groupBy("claim_id").agg(F.array_sort(F.collect_list(item)).alias("evidence"))
    joined = claims.join(nested, "claim_id", "left").join(verdicts, "claim_id", "left")
    empty = F.array().cast("array<string>")
    return joined.select(
        "claim_id",
        "verdict",
        "confidence",
        "claim",
        F.coalesce("entities", empty).alias("entities"),
        F.coalesce("numbers_dates", empty).alias("numbers_dates"),
        "explanation",
        "summary",
        F.coalesce("evidence", F.array()).alias("evidence"),
        F.when(c("verdict").isNull(), F.coalesce("error", F.lit("no reply"))).alias("error"),
    )


def report_view(results: DataFrame) -> DataFrame:
    """Display values of a response: certainty band, percentages, titles, badges. Failed claims have none."""
    c = F.col
    # a zero confidence counts as missing
    confidence = clamp01(F.when(c("confidence") == 0, 0.5).otherwise(F.coalesce("confidence", F.lit(0.5))))
    score = F.coalesce(F.nullif(c("e.evidence_score"), F.lit(0.0)), F.lit(0.5))
    fact_check = (c("e.evidence_type") == "FACT_CHECK") | F.contains(c("e.title"), F.lit("सच"))
    per_item = results.where(c("error").isNull()).withColumn("e", F.explode_outer(F.slice("evidence", 1, 3)))
    return per_item.select(
        "claim_id",
        F.when(F.upper("verdict") == "FAKE", "FAKE NEWS")
        .when(F.upper("verdict") == "REAL", "AUTHENTIC NEWS")
        .otherwise("UNCERTAIN / UNVERIFIED")
        .alias("verdict_title"),
        F.floor(confidence * 100 + 0.5).cast("int").alias("confidence_percent"),
        F.when(confidence >= 0.85, "High Certainty")
        .when(confidence >= 0.70, "Moderate Certainty")
        .otherwise("Safety Grounded")
        .alias("certainty"),
        F.array_join(F.slice("entities", 1, 4), ", ").alias("entity_tags"),
        c("e.rank").alias("rank"),
        F.coalesce(F.nullif(c("e.title"), F.lit("")), F.lit("Untitled Document")).alias("title"),
        F.when(fact_check, "Fact Check Report").otherwise("News Evidence").alias("badge"),
        F.least(F.floor(score * 100 + 0.5), F.lit(100)).cast("int").alias("match_percent"),
        F.when(c("e.content_snippet") != "", collapse_ws(c("e.content_snippet")))
        .otherwise("Snippet unavailable.")
        .alias("snippet"),
    )
