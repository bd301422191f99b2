"""The article, claim, vector, reply and request tables, derived from a folder of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.text import words_array
from claimweave.operators.evaluation import balanced_sample


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def first_line(text):
    return F.split_part(text, F.lit("\n"), F.lit(1))


def articles(spark: SparkSession, directory: str) -> DataFrame:
    """Documents as articles; the title is the first line, the label the quality mark."""
    documents, labels = table(spark, directory, "documents"), table(spark, directory, "labels")
    joined = documents.join(labels, "doc_id", "left")
    return joined.select(
        F.col("doc_id").alias("article_id"),
        F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string")).alias("url"),
        first_line(F.col("text")).alias("title"),
        F.col("text").alias("content"),
        F.col("quality").cast("int").alias("label"),
    )


def labelled_articles(spark: SparkSession, directory: str) -> DataFrame:
    return articles(spark, directory).where(F.col("label").isNotNull())


def article_vectors(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding")


def _fields(text, content) -> dict:
    """Claim fields by fixed rules, in place of an external extractor."""
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"[\p{L}]{6,}"), F.lit(0))))
    numbers = F.array_sort(F.array_distinct(F.regexp_extract_all(content, F.lit("[0-9]{2,}"), F.lit(0))))
    return {"entities": words, "numbers_dates": numbers}


def sample_claims(spark: SparkSession, directory: str) -> DataFrame:
    """The balanced evaluation sample as claims about its own titles."""
    sample = balanced_sample(articles(spark, directory))
    fields = _fields(F.col("title"), F.col("content"))
    return sample.select(
        F.col("article_id").alias("claim_id"),
        F.col("title").alias("claim"),
        F.col("title").alias("source_title"),
        F.col("content").alias("source_content"),
        *[v.alias(k) for k, v in fields.items()],
        F.col("article_id").alias("exclude_article_id"),
    )


def question_claims(spark: SparkSession, directory: str) -> DataFrame:
    """Every benchmark passage as a question: it stands in for title and content."""
    text = F.col("text")
    fields = _fields(text, text)
    return table(spark, directory, "benchmark").select(
        (-1 - F.col("item_id")).alias("claim_id"),
        text.alias("claim"),
        text.alias("source_title"),
        text.alias("source_content"),
        *[v.alias(k) for k, v in fields.items()],
        F.lit(None).cast("bigint").alias("exclude_article_id"),
    )


def claims(spark: SparkSession, directory: str) -> DataFrame:
    return sample_claims(spark, directory).unionByName(question_claims(spark, directory))


def claim_vectors(spark: SparkSession, directory: str) -> DataFrame:
    """(claim_id, embedding): the stored vector of the claim's article or passage number."""
    vectors = article_vectors(spark, directory)
    keyed = claims(spark, directory).select(
        "claim_id",
        F.when(F.col("claim_id") < 0, -1 - F.col("claim_id")).otherwise(F.col("claim_id")).alias("article_id"),
    )
    return keyed.join(vectors, "article_id").select("claim_id", "embedding")


def predictions(spark: SparkSession, directory: str) -> DataFrame:
    """A verdict for every labelled article, by fixed rules; all four outcomes occur."""
    labels = table(spark, directory, "labels").select(F.col("doc_id").alias("article_id"), "toxic")
    joined = labelled_articles(spark, directory).select("article_id", "label").join(labels, "article_id")
    i = F.col("article_id")
    failed = i % 11 == 0
    return joined.select(
        "article_id",
        F.col("label").alias("true_label"),
        F.when(failed, "ERROR")
        .when(i % 7 == 0, "UNCERTAIN")
        .when((F.col("toxic") == 1) | (i % 5 == 0), "FAKE")
        .otherwise("REAL")
        .alias("predicted_verdict"),
        F.when(~failed, F.lit(0.5) + (i % 50).cast("double") / 100).alias("confidence"),
        F.when(~failed, (i % 400).cast("double") / 10).alias("processing_time_seconds"),
    )


REPLIES = {
    0: '```json\n{"verdict":"fake","confidence":"0.9","explanation":"x"}\n```',
    1: 'Sure: {"verdict":"REAL ","confidence":1.7,"summary":"s","evidence_analysis":'
    '[{"evidence_id":"E1","relationship":"Supports"},{"evidence_id":"E2","relationship":"odd"}]} end',
    2: "no object here",
    3: '{"verdict":"MAYBE","confidence":"high"}',
    5: '{"confidence":-0.2,"evidence_analysis":"none"}',
    6: '{"verdict":"REAL","confidence":"true","explanation":" e "}',
    7: '{"verdict":"REAL","confidence":true}',
    8: '{"verdict":"FAKE","confidence":"0.9d"}',
    9: '{"verdict":"FAKE","confidence":1,"evidence_analysis":["{x",{"evidence_id":"E3","relationship":"CONTRADICTS "},5,null]}',
    10: "[1, 2]",
    11: '{"verdict":"REAL","confidence":"inf","evidence_analysis":[]}',
}
REPLY_KINDS = 12


def responses(spark: SparkSession, directory: str) -> DataFrame:
    """A model reply for every labelled document: fenced, wrapped, broken, null."""
    i = F.col("doc_id")
    raw = F.lit(None).cast("string")
    for remainder, text in REPLIES.items():
        raw = F.when(i % REPLY_KINDS == remainder, F.lit(text)).otherwise(raw)
    return table(spark, directory, "labels").select(i.alias("claim_id"), raw.alias("raw"))


def requests(spark: SparkSession, directory: str) -> DataFrame:
    """Verification requests with the text in different fields, some of them blank."""
    i, text = F.col("item_id"), F.col("text")
    return table(spark, directory, "benchmark").select(
        i.alias("request_id"),
        F.when(i % 4 == 0, F.concat(F.lit(" "), text, F.lit(" "))).alias("question"),
        F.when(i % 4 == 1, text).when(i % 4 == 2, "  ").otherwise("").alias("title"),
        F.when(i % 4 == 2, text).alias("content"),
    )


def raw_sheet(spark: SparkSession, directory: str) -> DataFrame:
    """Uncleaned sheet: every row twice, padded text, null titles, unusable labels."""
    i = F.col("doc_id")
    title = F.concat(F.lit("  "), first_line(F.col("text")), F.lit("\n"))
    labels = words_array(["0", "1", "1.0", "x", None, "0", "1d", "0f"])
    rows = table(spark, directory, "documents").select(
        F.concat(F.lit(" https://"), "source", F.lit(".example/"), i.cast("string")).alias("URL"),
        F.when(i % 13 != 0, title).alias("TITLE"),
        F.col("text").alias("CONTENT"),
        labels[(i % 8).cast("int")].alias("BOOL"),
    )
    return rows.unionAll(rows)


def claim_replies(spark: SparkSession, directory: str) -> DataFrame:
    """(claim_id, news_text, raw): an extractor reply per passage, some incomplete or broken."""
    i, text = F.col("item_id"), F.col("text")
    record = F.to_json(F.struct(text.alias("main_claim"), F.array(F.substring(text, 1, 12)).alias("entities")))
    return table(spark, directory, "benchmark").select(
        i.alias("claim_id"),
        F.when(i % 5 == 4, "  ").otherwise(F.concat(F.lit(" "), text)).alias("news_text"),
        F.when(i % 5 == 0, record)
        .when(i % 5 == 1, '{"main_claim":" ","claim_type":"event","numbers_dates":["2020"]}')
        .when(i % 5 == 2, "not json")
        .when(i % 5 == 3, '["a list"]')
        .otherwise(record)
        .alias("raw"),
    )
