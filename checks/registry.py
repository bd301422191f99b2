"""Registered queries and their DuckDB twins.

Every query runs over whole tables. Lists are reported as joined text and long outputs as
per-article summaries, so that results compare the same way in both engines.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql
from checks.sql import quoted, query
from claimweave.functions import jsontext, lexicons, numeric, text
from claimweave.operators import (
    candidates,
    cleaning,
    evaluation,
    inverted,
    lexical,
    profiling,
    rerank,
    signals,
    term_search,
    vectors,
    verdict,
)
from claimweave.plans import retrieval, verification, views
from claimweave.scale import materialize, shared_dir
from claimweave.schema import missing_columns, require_columns
from claimweave.sources import index_store, tables
from claimweave.streaming.requests import read_log, stream_verify, verify_requests

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


# --- tables shared by several queries: built once per session and folder ----------------

_BUILT: dict[tuple, object] = {}


def _once(spark: SparkSession, directory: str, name: str, build):
    key = (spark.sparkContext.applicationId, directory, name)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def _index(spark, d):
    def build():
        path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
        index_store.save_index(views.articles(spark, d), views.article_vectors(spark, d), path)
        return index_store.load_index(spark, path)

    return _once(spark, d, "index", build)


def _prepared(spark, d):
    return _once(
        spark, d, "prepared",
        lambda: materialize(candidates.prepare_claims(views.claims(spark, d)), "prepared"),
    )


def _scored(spark, d):
    return _once(
        spark, d, "scored",
        lambda: materialize(
            retrieval.score_claims(views.claims(spark, d), views.claim_vectors(spark, d), _index(spark, d)),
            "scored",
        ),
    )


def _retrieved(spark, d):
    return _once(
        spark, d, "retrieved",
        lambda: materialize(retrieval.rank_candidates(_scored(spark, d)), "retrieved"),
    )


def _with_text(spark, d):
    return candidates.attach_by_article(_retrieved(spark, d), _index(spark, d).articles)


def _evidence(spark, d):
    return _once(
        spark, d, "evidence",
        lambda: materialize(rerank.rerank(_with_text(spark, d), views.claims(spark, d)), "evidence"),
    )


def joined(column, by="|"):
    return F.array_join(column, by)


def label_text(df: DataFrame) -> DataFrame:
    """Labels as text, so that a missing one compares the same way in both engines."""
    return df.withColumn("label", F.coalesce(F.col("label").cast("string"), F.lit("none")))


def big(column):
    return F.col(column).cast("bigint").alias(column) if isinstance(column, str) else column.cast("bigint")


ARTICLES = "article_id, url, title, content, label"

# --- sources and sinks ------------------------------------------------------------------


def _csv_copy(spark, d):
    def build():
        path = f"{shared_dir(spark)}/articles-csv-{uuid.uuid4().hex}"
        tables.write_articles(views.articles(spark, d), path)
        return path

    return _once(spark, d, "csv", build)


@register("source_articles_csv", query(
    "SELECT article_id, url, nullif(title, '') AS title, nullif(content, '') AS content, coalesce(CAST(label AS VARCHAR), 'none') AS label FROM articles", "articles"))
def _(spark, d):
    return label_text(tables.read_articles_csv(spark, _csv_copy(spark, d)))


@register("source_fallback", query("SELECT coalesce(CAST(label AS VARCHAR), 'none') AS label, count(*) AS articles FROM articles GROUP BY ALL", "articles"))
def _(spark, d):
    paths = [f"{shared_dir(spark)}/not-there", _csv_copy(spark, d)]
    found = tables.read_first_available(spark, paths)
    return label_text(found.groupBy("label").agg(F.count("*").alias("articles")))


@register("source_raw_sheet", query(
    "SELECT count(*) AS n, count(TITLE) AS titles, count(BOOL) AS labels, sum(length(CONTENT))::BIGINT AS chars FROM raw_sheet",
    "raw_sheet"))
def _(spark, d):
    path = f"{shared_dir(spark)}/raw-{uuid.uuid4().hex}"
    views.raw_sheet(spark, d).write.parquet(path)
    raw = tables.read_raw(spark, path, "parquet")
    return raw.agg(
        F.count("*").alias("n"), F.count("TITLE").alias("titles"), F.count("BOOL").alias("labels"),
        F.sum(F.length("CONTENT")).alias("chars"),
    )


_BY_LABEL = "SELECT coalesce(CAST(label AS VARCHAR), 'none') AS label, {0} FROM articles GROUP BY ALL"
_WHOLE = "SELECT 'all' AS label, {0} FROM articles"
# report: columns with their SQL, and whether it has a row per label
REPORTS = {
    "label_distribution": ({"count": "count(*)"}, True),
    "label_statistics": ({
        "article_count": "count(*)", "avg_title_length": "avg(length(title))", "avg_content_length": "avg(length(content))"}, True),
    "length_statistics": ({
        "average_title_length": "avg(length(title))", "average_content_length": "avg(length(content))",
        "avg_content_length_label_0": "avg(length(content)) FILTER (label = 0)",
        "avg_content_length_label_1": "avg(length(content)) FILTER (label = 1)"}, False),
    "data_quality": ({f"missing_{c}": f"count(*) FILTER ({c} IS NULL)" for c in ARTICLES.split(", ")}, False),
}


@register("sink_reports", query(" UNION ALL ".join(
    f"SELECT '{report}' AS report, label, '{column}' AS metric, round(value, 6) AS value FROM ("
    + (_BY_LABEL if labelled else _WHOLE).format(f"CAST({expression} AS DOUBLE) AS value") + ")"
    for report, (columns, labelled) in REPORTS.items() for column, expression in columns.items()), "articles"))
def _(spark, d):
    from claimweave.plans.profile import profile

    path = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    profile(views.articles(spark, d), path)
    back = []
    for report, (columns, labelled) in REPORTS.items():
        schema = ", ".join((["label int"] if labelled else []) + [f"{c} double" for c in columns])
        df = spark.read.option("header", "true").schema(schema).csv(f"{path}/{report}")
        df = label_text(df) if labelled else df.withColumn("label", F.lit("all"))
        back.append(df.unpivot(["label"], list(columns), "metric", "value").withColumn("report", F.lit(report)))
    every = back[0]
    for df in back[1:]:
        every = every.unionByName(df)
    return every.select("report", "label", "metric", F.round("value", 6).alias("value"))


def _evaluation_files(spark, d):
    def build():
        path = f"{shared_dir(spark)}/evaluation-{uuid.uuid4().hex}"
        p = views.predictions(spark, d)
        record = evaluation.metrics_record(p, views.labelled_articles(spark, d), "articles", 5)
        tables.write_evaluation(p, evaluation.confusion_matrix(p), record, path)
        return path

    return _once(spark, d, "evaluation_files", build)


@register("sink_evaluation_rows", query(
    "SELECT article_id, true_label, predicted_verdict, confidence, processing_time_seconds FROM predictions", "predictions"))
def _(spark, d):
    schema = views.predictions(spark, d).schema
    return spark.read.option("header", "true").option("escape", '"').schema(schema).csv(f"{_evaluation_files(spark, d)}/evaluation_results")


@register("sink_evaluation_record", query(
    "SELECT total AS evaluation_sample_size, valid AS valid_predictions, uncertain AS uncertain_count, errors AS error_count, "
    "(c00 + c11) AS correct_predictions, round((c00 + c11)::DOUBLE / total, 4) AS accuracy_all_cases, round(conf, 4) AS average_confidence, "
    "c00 AS fake_fake, c01 AS fake_real, c10 AS real_fake, c11 AS real_real FROM counts", "counts"))
def _(spark, d):
    path = _evaluation_files(spark, d)
    counts = ("evaluation_sample_size", "valid_predictions", "uncertain_count", "error_count", "correct_predictions")
    record = spark.read.schema(", ".join([f"{c} bigint" for c in counts] + ["accuracy_all_cases double, average_confidence double"]))
    matrix = spark.read.option("header", "true").schema("actual string, fake bigint, real bigint").csv(f"{path}/confusion_matrix")
    cells = matrix.agg(*[
        F.max(F.when(F.col("actual") == f"Actual_{row.upper()}", F.col(column))).alias(f"{row}_{column}")
        for row in ("fake", "real") for column in ("fake", "real")])
    one = F.lit(1).alias("_k")  # two tables of one row
    return record.json(f"{path}/metrics").select(one, "*").join(cells.select(one, "*"), "_k").drop("_k")


# --- cleaning ---------------------------------------------------------------------------


@register("clean_exact_dedup", query("SELECT DISTINCT * FROM raw_sheet", "raw_sheet"))
def _(spark, d):
    return cleaning.drop_exact_duplicates(views.raw_sheet(spark, d))


@register("clean_dedup_stats", query(
    "SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_sheet)) AS rows_after, "
    "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_sheet)) AS duplicates_removed FROM raw_sheet", "raw_sheet"))
def _(spark, d):
    return cleaning.duplicate_stats(views.raw_sheet(spark, d))


@register("clean_text", query(
    f"SELECT {sql.strip('URL')} AS url, {sql.strip('TITLE')} AS title, {sql.strip('CONTENT')} AS content FROM raw_sheet", "raw_sheet"))
def _(spark, d):
    cleaned = cleaning.clean_text_columns(views.raw_sheet(spark, d), ["URL", "TITLE", "CONTENT"])
    return cleaning.rename_raw(cleaned).select("url", "title", "content")


@register("clean_labels", query(
    "SELECT BOOL AS raw, CAST(trunc(TRY_CAST(trim(BOOL) AS DOUBLE)) AS INT) AS label, count(*) AS n FROM raw_sheet "
    "WHERE TRY_CAST(trim(BOOL) AS DOUBLE) IS NOT NULL GROUP BY ALL", "raw_sheet"))
def _(spark, d):
    named = cleaning.rename_raw(views.raw_sheet(spark, d)).withColumn("raw", F.col("label"))
    return cleaning.coerce_label(named).groupBy("raw", "label").agg(F.count("*").alias("n"))


@register("clean_articles", query(f"SELECT {ARTICLES} FROM cleaned", "cleaned"))
def _(spark, d):
    return cleaning.clean_articles(views.raw_sheet(spark, d))


@register("clean_report", query(
    "SELECT 'rows' AS metric, count(*) AS value FROM cleaned UNION ALL "
    "SELECT concat('label_', CAST(label AS VARCHAR)), count(*) FROM cleaned GROUP BY label UNION ALL "
    + " UNION ALL ".join(f"SELECT 'missing_{c}', count(*) FILTER ({c} IS NULL) FROM cleaned" for c in ARTICLES.split(", ")),
    "cleaned"))
def _(spark, d):
    return cleaning.clean_report(cleaning.clean_articles(views.raw_sheet(spark, d)))


# --- profiling --------------------------------------------------------------------------


@register("profile_row_count", query("SELECT count(*) AS row_count FROM articles", "articles"))
def _(spark, d):
    return profiling.row_count(views.articles(spark, d))


@register("profile_label_distribution", query("SELECT coalesce(CAST(label AS VARCHAR), 'none') AS label, count(*) AS \"count\" FROM articles GROUP BY ALL", "articles"))
def _(spark, d):
    return label_text(profiling.label_distribution(views.articles(spark, d)))


@register("profile_data_quality", query(
    "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS missing_{c}" for c in ARTICLES.split(", ")) + " FROM articles", "articles"))
def _(spark, d):
    return profiling.data_quality(views.articles(spark, d))


@register("profile_lengths", query(
    "SELECT article_id, length(title) AS title_length, length(content) AS content_length FROM articles", "articles"))
def _(spark, d):
    return profiling.with_lengths(views.articles(spark, d)).select("article_id", big("title_length"), big("content_length"))


@register("profile_length_statistics", query(
    "SELECT round(avg(length(title)), 6) AS average_title_length, round(avg(length(content)), 6) AS average_content_length, "
    "round(avg(length(content)) FILTER (label = 0), 6) AS avg_content_length_label_0, "
    "round(avg(length(content)) FILTER (label = 1), 6) AS avg_content_length_label_1 FROM articles", "articles"))
def _(spark, d):
    stats = profiling.length_statistics(views.articles(spark, d))
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


@register("label_statistics", query(
    "SELECT coalesce(CAST(label AS VARCHAR), 'none') AS label, count(*) AS article_count, round(avg(length(title)), 6) AS avg_title_length, "
    "round(avg(length(content)), 6) AS avg_content_length FROM articles GROUP BY ALL", "articles"))
def _(spark, d):
    return label_text(profiling.label_statistics(views.articles(spark, d))).select(
        "label", "article_count", F.round("avg_title_length", 6).alias("avg_title_length"),
        F.round("avg_content_length", 6).alias("avg_content_length"),
    )


@register("profile_longest_articles", query(
    "SELECT article_id, title, length(content) AS content_length, coalesce(CAST(label AS VARCHAR), 'none') AS label FROM articles ORDER BY length(content) DESC, article_id LIMIT 10", "articles"))
def _(spark, d):
    top = profiling.longest_articles(views.articles(spark, d))
    return label_text(top).withColumn("content_length", big("content_length"))


@register("profile_sample_articles", query("SELECT article_id, title, coalesce(CAST(label AS VARCHAR), 'none') AS label FROM articles ORDER BY article_id LIMIT 10", "articles"))
def _(spark, d):
    return label_text(profiling.sample_articles(views.articles(spark, d)))


@register("profile_label_violations", query(
    "SELECT coalesce(CAST(label AS VARCHAR), 'none') AS label, count(*) AS n FROM articles WHERE label IS NULL OR label NOT IN (0, 1) GROUP BY ALL", "articles"))
def _(spark, d):
    bad = profiling.label_violations(views.articles(spark, d))
    return bad.groupBy(F.coalesce(F.col("label").cast("string"), F.lit("none")).alias("label")).agg(F.count("*").alias("n"))


@register("profile_label_names", "SELECT CASE label WHEN 0 THEN 'FAKE' WHEN 1 THEN 'REAL' ELSE 'UNKNOWN' END AS label_name, count(*) AS n FROM embeddings GROUP BY ALL")
def _(spark, d):
    named = views.table(spark, d, "embeddings").select(profiling.label_name(F.col("label")).alias("label_name"))
    return named.groupBy("label_name").agg(F.count("*").alias("n"))


@register("profile_required_columns", query("SELECT count(*) AS articles, 0::BIGINT AS missing FROM articles", "articles"))
def _(spark, d):
    df = require_columns(views.articles(spark, d))
    return df.agg(F.count("*").alias("articles")).withColumn("missing", F.lit(len(missing_columns(df))).cast("bigint"))


@register("profile_dataset_audit", query(
    "SELECT count(*) AS row_count, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in ARTICLES.split(", "))
    + ", concat('0=', count(*) FILTER (label = 0), ',1=', count(*) FILTER (label = 1)) AS label_distribution, CASE WHEN " + " AND ".join(f"count({c}) = count(*)" for c in ARTICLES.split(", ")) + " THEN 'PASS' ELSE 'FAIL' END AS status FROM articles", "articles"))
def _(spark, d):
    audit = profiling.dataset_audit(views.articles(spark, d))
    pairs = F.transform(F.map_entries("label_distribution"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return audit.withColumn("label_distribution", F.array_join(pairs, ","))


@register("profile_lookup_articles", query(
    "SELECT w.article_id, a.title, a.article_id IS NOT NULL AS found FROM (SELECT DISTINCT vec_id * 3 AS article_id FROM embeddings) w "
    "LEFT JOIN articles a USING (article_id)", "articles"))
def _(spark, d):
    wanted = views.article_vectors(spark, d).select((F.col("article_id") * 3).alias("article_id"))
    return profiling.lookup_articles(views.articles(spark, d), wanted).select("article_id", "title", "found")


# --- column functions -------------------------------------------------------------------


@register("text_normalize", query(f"SELECT article_id, {sql.fold('content')} AS normalized, {sql.collapse('content')} AS collapsed FROM articles", "articles"))
def _(spark, d):
    c = F.col("content")
    return views.articles(spark, d).select(
        "article_id", text.normalize_text(c).alias("normalized"), text.collapse_ws(c).alias("collapsed"))


_TOK = f"regexp_extract_all({sql.fold('content')}, '{sql.TOKEN}')"
_WRD = f"regexp_extract_all({sql.fold('content')}, '[\\p{{L}}\\p{{N}}]+')"


def _without(distinct_words: str, stop) -> str:
    return f"array_to_string(list_sort(list_filter({distinct_words}, lambda w: NOT list_contains({sql.words(stop)}, w))), ' ')"


@register("text_token_sets", query(
    f"SELECT article_id, array_to_string(list_sort(list_distinct({_TOK})), ' ') AS tokens, array_to_string(list_sort(list_distinct({_WRD})), ' ') AS words, "
    f"{_without(f'list_distinct({_TOK})', lexicons.RETRIEVAL_STOPWORDS)} AS kept_tokens, {_without(f'list_distinct({_WRD})', lexicons.RERANK_STOPWORDS)} AS kept_words FROM articles", "articles"))
def _(spark, d):
    normal = views.articles(spark, d).select("article_id", text.normalize_text(F.col("content")).alias("n"))
    sets = normal.select("article_id", text.token_set(F.col("n")).alias("t"), text.word_set(F.col("n")).alias("w"))
    show = lambda c: F.array_join(F.sort_array(c), " ")
    return sets.select(
        "article_id", show("t").alias("tokens"), show("w").alias("words"),
        show(text.drop_stopwords(F.col("t"), lexicons.RETRIEVAL_STOPWORDS)).alias("kept_tokens"),
        show(text.drop_stopwords(F.col("w"), lexicons.RERANK_STOPWORDS)).alias("kept_words"),
    )


@register("text_entities", query(
    f"SELECT article_id, name, array_to_string({sql.variants('name')}, '|') AS variants FROM (SELECT article_id, {sql.entity_name('title')} AS name FROM articles)", "articles"))
def _(spark, d):
    named = views.articles(spark, d).select("article_id", text.normalize_entity(text.nfkc(F.col("title"))).alias("name"))
    return named.withColumn("variants", joined(text.entity_variants(F.col("name"))))


_PW = f"list_filter(regexp_extract_all({sql.fold('content')}, '{sql.TOKEN}'), lambda w: NOT list_contains({sql.words(lexicons.RETRIEVAL_STOPWORDS)}, w) AND length(w) >= 3)"


@register("text_important_phrases", query(
    "SELECT article_id, array_to_string((" + sql.distinct(f"list_concat({sql.ngrams('w', 4, 12)}, {sql.ngrams('w', 3, 10)}, {sql.ngrams('w', 2, 8)}, {sql.ngrams('w', 1, 7)})")
    + f"), '|') AS phrases FROM (SELECT article_id, {_PW.replace('content', 'title')} AS w FROM articles)", "articles"))
def _(spark, d):
    normal = views.articles(spark, d).select("article_id", text.normalize_text(F.col("title")).alias("n"))
    return normal.select("article_id", joined(text.important_phrases(F.col("n"))).alias("phrases"))


@register("text_index_inputs", query(
    f"SELECT article_id, {sql.collapse('concat(title, chr(32), title, chr(32), content)')} AS search_text, "
    f"{sql.collapse('concat(title, chr(32), title, chr(32), substr(content, 1, 1500))')} AS embedding_text FROM articles", "articles"))
def _(spark, d):
    articles = views.articles(spark, d)
    searched = articles.select("article_id", text.search_text(F.col("title"), F.col("content")).alias("search_text"))
    return searched.join(vectors.embedding_inputs(articles), "article_id")


@register("text_truncation", query(
    f"SELECT article_id, CASE WHEN length(t) <= 3000 THEN t ELSE concat(substr(t, 1, 1500), chr(10), '...[TRUNCATED]...', chr(10), right(t, 1500)) END AS middle, "
    f"substr(content, 1, 350) AS short, substr(content, 1, 700) AS long FROM (SELECT *, {sql.strip('content')} AS t FROM articles)", "articles"))
def _(spark, d):
    c = F.col("content")
    return views.articles(spark, d).select(
        "article_id", text.truncate_middle(c, 3000).alias("middle"), text.snippet(c, 350).alias("short"), text.snippet(c, 700).alias("long"))


_POL = ["the", "nation", "que", "und", "12", "false", "true"]


@register("text_terms_and_digits", query(
    f"SELECT article_id, {sql.found(sql.words(_POL), 'n')} > 0 AS has_any, {sql.found(sql.words(_POL), 'n')}::BIGINT AS hits, "
    f"regexp_replace(n, '[^\\p{{Nd}}]', '', 'g') AS digits FROM (SELECT article_id, {sql.fold('content')} AS n FROM articles)", "articles"))
def _(spark, d):
    normal = views.articles(spark, d).select("article_id", text.normalize_text(F.col("content")).alias("n"))
    return normal.select(
        "article_id", text.contains_any(F.col("n"), _POL).alias("has_any"),
        big(text.count_terms(F.col("n"), _POL)).alias("hits"), text.digits(F.col("n")).alias("digits"))


@register("numeric_functions", query(
    "SELECT article_id, coalesce(TRY_CAST(BOOL AS DOUBLE), TRY_CAST(content_chars AS DOUBLE), 0.0) AS first_float, "
    "least(greatest(content_chars / 1000.0::DOUBLE - 0.5, 0.0), 1.0) AS clamped, round(content_chars / 7.0::DOUBLE, 4) AS rounded, "
    "CASE WHEN article_id % 4 = 0 THEN 0.0 ELSE content_chars::DOUBLE / (article_id % 4) END AS ratio, coalesce(TRY_CAST(BOOL AS BIGINT), -1) AS whole "
    "FROM (SELECT *, length(content) AS content_chars, CASE article_id % 3 WHEN 0 THEN 'x' WHEN 1 THEN '17' END AS BOOL FROM articles)", "articles"))
def _(spark, d):
    a = views.articles(spark, d).withColumns({
        "n": F.length("content"),
        "raw": F.when(F.col("article_id") % 3 == 0, "x").when(F.col("article_id") % 3 == 1, "17"),
    })
    n, i = F.col("n"), F.col("article_id")
    return a.select(
        "article_id", numeric.first_float(F.col("raw"), n).alias("first_float"),
        numeric.clamp01(n / 1000.0 - 0.5).alias("clamped"), numeric.round4(n / 7.0).alias("rounded"),
        numeric.safe_ratio(n, i % 4).alias("ratio"), F.coalesce(numeric.safe_int(F.col("raw")), F.lit(-1).cast("bigint")).alias("whole"))


@register("json_extraction", query("SELECT claim_id, json_extract_string(json, '$.verdict') AS verdict, json IS NOT NULL AS parsed FROM replies", "replies"))
def _(spark, d):
    found = views.responses(spark, d).select("claim_id", jsontext.extract_json(F.col("raw")).alias("json"))
    return found.select(
        "claim_id", F.get_json_object("json", "$.verdict").alias("verdict"), F.col("json").isNotNull().alias("parsed"))


@register("json_arrays", query("SELECT claim_id, to_json(entities)::VARCHAR AS entities, to_json(numbers_dates)::VARCHAR AS numbers FROM claims", "claims"))
def _(spark, d):
    return views.claims(spark, d).select(
        "claim_id", jsontext.to_json_array(F.col("entities")).alias("entities"), jsontext.to_json_array(F.col("numbers_dates")).alias("numbers"))


# --- lexical index ----------------------------------------------------------------------

_POST = "SELECT article_id, count(*) AS terms, sum(tf)::BIGINT AS tokens, max(tf)::BIGINT AS top_tf, min(term) AS first_term, max(term) AS last_term FROM {0} GROUP BY article_id"


def _posting_summary(lists):
    packed = lists.select(
        "article_id", F.size("terms").alias("n"), F.aggregate("tfs", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("tokens"),
        F.array_max("tfs").alias("top"), F.array_min("terms").alias("first"), F.array_max("terms").alias("last"))
    return packed.groupBy("article_id").agg(
        big(F.sum("n")).alias("terms"), big(F.sum("tokens")).alias("tokens"), big(F.max("top")).alias("top_tf"),
        F.min("first").alias("first_term"), F.max("last").alias("last_term"))


@register("index_word_postings", query(_POST.format("word_post_cnt"), "word_post_cnt"))
def _(spark, d):
    return _posting_summary(lexical.posting_lists(views.articles(spark, d), lexical.WORD))


@register("index_char_postings", query(_POST.format("char_post_cnt"), "char_post_cnt"))
def _(spark, d):
    return _posting_summary(lexical.posting_lists(views.articles(spark, d), lexical.CHAR))


for _channel in ("word", "char"):

    @register(f"index_{_channel}_vocabulary", query(f"SELECT term, df, total, round(idf, 8) AS idf FROM {_channel}_voc", f"{_channel}_voc"))
    def _(spark, d, channel=_channel):
        return _index(spark, d).vocabulary(channel).select("term", "df", "total", F.round("idf", 8).alias("idf"))

    @register(f"index_{_channel}_weights", query(
        f"SELECT article_id, count(*) AS terms, round(sum(w), 6) AS total_weight, round(max(w), 8) AS top_weight, round(sum(w * w), 8) AS norm FROM {_channel}_post GROUP BY article_id", f"{_channel}_post"))
    def _(spark, d, channel=_channel):
        def total(of):
            return F.aggregate("ws", F.lit(0.0), lambda a, w: a + of(w))

        return _index(spark, d).article_weights(channel).select(
            "article_id", big(F.size("ws")).alias("terms"), F.round(total(lambda w: w), 6).alias("total_weight"),
            F.round(F.array_max("ws"), 8).alias("top_weight"), F.round(total(lambda w: w * w), 8).alias("norm"))


@register("index_query_weights", query(
    "SELECT claim_id, term, round(max(o), 8) AS word_original, round(max(c), 8) AS word_claim FROM (SELECT claim_id, term, w AS o, NULL AS c FROM qwo "
    "UNION ALL SELECT claim_id, term, NULL, w FROM qwc) GROUP BY ALL", "qwo", "qwc"))
def _(spark, d):
    weights = candidates.claim_term_weights(
        _prepared(spark, d), _index(spark, d), "word", word_original="q_original", word_claim="q_claim")
    return weights.select("claim_id", "term", F.round("word_original", 8).alias("word_original"), F.round("word_claim", 8).alias("word_claim"))


@register("lexical_word_scores", query(
    "SELECT claim_id, article_id, round(sum(o), 6) AS word_original, round(sum(c), 6) AS word_claim FROM (SELECT claim_id, article_id, s AS o, 0.0 AS c FROM qwo_s "
    "UNION ALL SELECT claim_id, article_id, 0.0, s FROM qwc_s) GROUP BY ALL", "qwo_s", "qwc_s"))
def _(spark, d):
    scores = candidates.word_scores(_prepared(spark, d), _index(spark, d))
    return scores.select("claim_id", "article_id", F.round("word_original", 6).alias("word_original"), F.round("word_claim", 6).alias("word_claim"))


@register("lexical_char_scores", query("SELECT claim_id, article_id, round(s, 6) AS char_original FROM qch_s", "qch_s"))
def _(spark, d):
    scores = candidates.char_scores(_prepared(spark, d), _index(spark, d))
    return scores.select("claim_id", "article_id", F.round("char_original", 6).alias("char_original"))


@register("index_statistics", query(
    "SELECT 'articles' AS metric, count(*) AS value FROM articles UNION ALL SELECT 'word_features', count(*) FROM word_voc UNION ALL "
    "SELECT 'word_postings', count(*) FROM word_post UNION ALL SELECT 'char_features', count(*) FROM char_voc UNION ALL SELECT 'char_postings', count(*) FROM char_post",
    "articles", "word_voc", "word_post", "char_voc", "char_post"))
def _(spark, d):
    return _index(spark, d).stats()


@register("index_config", query(
    "SELECT 'document_count' AS name, CAST(count(*) AS VARCHAR) AS value FROM articles UNION ALL SELECT 'embedding_dimension', CAST(max(len(v)) AS VARCHAR) FROM vectors "
    "UNION ALL SELECT 'content_limit', '1500' UNION ALL SELECT 'normalized', 'True' UNION ALL SELECT 'buckets', '8' UNION ALL SELECT 'parts', '16'", "articles", "vectors"))
def _(spark, d):
    return _index(spark, d).config


# --- dense vectors ----------------------------------------------------------------------


@register("vector_validation", query(
    "SELECT (SELECT count(*) FROM vectors) AS vectors, (SELECT count(*) FROM vectors WHERE len(v) <> 64) AS wrong_dimension, "
    "(SELECT count(*) FROM (SELECT article_id FROM vectors GROUP BY 1 HAVING count(*) > 1)) AS repeated_ids, "
    "(SELECT count(*) FROM articles ANTI JOIN vectors USING (article_id)) AS articles_without_vector, "
    "(SELECT count(*) FROM vectors ANTI JOIN articles USING (article_id)) AS vectors_without_article", "articles", "vectors"))
def _(spark, d):
    return vectors.validate_vectors(views.article_vectors(spark, d), views.articles(spark, d), 64)


@register("vector_unit_length", query(
    "SELECT article_id, round(v[1] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS first_value, "
    "round(v[-1] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS last_value FROM vectors", "vectors"))
def _(spark, d):
    unit = views.article_vectors(spark, d).select("article_id", vectors.l2_normalize(F.col("embedding")).alias("u"))
    return unit.select("article_id", F.round(F.col("u")[0], 6).alias("first_value"), F.round(F.element_at("u", -1), 6).alias("last_value"))


def _vector_queries(spark, d):
    own = views.article_vectors(spark, d)
    return own.select(F.col("article_id").alias("query_id"), "embedding", F.col("article_id").alias("exclude_article_id"))


_ALL_PAIRS = ("SELECT q.article_id AS query_id, v.article_id, round(list_dot_product(q.v, v.v), 8) AS score, row_number() OVER (PARTITION BY q.article_id "
              "ORDER BY round(list_dot_product(q.v, v.v), 8) DESC, v.article_id) AS rank FROM vectors q JOIN vectors v ON q.article_id <> v.article_id")


@register("vector_best_scores", query(
    f"SELECT query_id, article_id, rank, round(score, 6) AS score FROM ({_ALL_PAIRS}) WHERE rank <= 20", "vectors"))
def _(spark, d):
    best = vectors.best_scores(_vector_queries(spark, d), views.article_vectors(spark, d), 20)
    return best.select("query_id", "article_id", big("rank"), F.round("score", 6).alias("score"))


@register("vector_semantic_topk", query(
    f"SELECT s.query_id, s.rank, s.article_id, a.title, a.url, CASE a.label WHEN 0 THEN 'FAKE' WHEN 1 THEN 'REAL' ELSE 'UNKNOWN' END AS label_name, "
    f"round(s.score, 4) AS relevance_score FROM (SELECT * FROM ({_ALL_PAIRS}) WHERE rank <= 10) s JOIN articles a USING (article_id)", "vectors", "articles"))
def _(spark, d):
    top = vectors.semantic_topk(_vector_queries(spark, d), views.article_vectors(spark, d), views.articles(spark, d))
    return top.select("query_id", big("rank"), "article_id", "title", "url", "label_name", "relevance_score")


# --- candidates -------------------------------------------------------------------------


@register("claim_queries", query("SELECT claim_id, q_semantic, q_original, q_claim FROM queries", "queries"))
def _(spark, d):
    return candidates.build_queries(views.claims(spark, d)).select("claim_id", "q_semantic", "q_original", "q_claim")


@register("claim_phrases", query("SELECT claim_id, array_to_string(phrases, '|') AS phrases FROM prepared", "prepared"))
def _(spark, d):
    return candidates.claim_phrases(views.claims(spark, d)).select("claim_id", joined("phrases").alias("phrases"))


@register("channel_semantic", query("SELECT claim_id, article_id, rank, round(s, 6) AS score FROM sem_s_top", "sem_s_top"))
def _(spark, d):
    asked = views.claim_vectors(spark, d).select(
        F.col("claim_id").alias("query_id"), "embedding", F.lit(None).cast("bigint").alias("exclude_article_id"))
    best = vectors.best_scores(asked, views.article_vectors(spark, d), 150)
    return best.select(F.col("query_id").alias("claim_id"), "article_id", big("rank"), F.round("score", 6).alias("score"))


for _name, _column, _depth, _source in (
    ("word_original", "word_original", 150, "qwo_s"), ("word_claim", "word_claim", 100, "qwc_s"), ("char_original", "char_original", 150, "qch_s")):

    @register(f"channel_{_name}", query(f"SELECT claim_id, article_id, rank, round(s, 6) AS score FROM {_source}_top", f"{_source}_top"))
    def _(spark, d, column=_column, depth=_depth):
        scored = candidates.term_scores(_prepared(spark, d), _index(spark, d))
        top = inverted.best_by_terms(scored, {column: depth})[column]
        return top.select("claim_id", "article_id", big("rank"), F.round(column, 6).alias("score"))


@register("channel_identity", query("SELECT claim_id, article_id, hits::BIGINT AS hits FROM identity", "identity"))
def _(spark, d):
    found = candidates.identity_candidates(_prepared(spark, d), _index(spark, d), 300)
    return found.select("claim_id", "article_id", big("hits"))


@register("candidate_pool", query("SELECT claim_id, article_id, identity_candidate, round(semantic_score, 6) AS semantic_score, "
    "round(lexical_score, 6) AS lexical_score, round(claim_lexical_score, 6) AS claim_lexical_score FROM scored", "scored"))
def _(spark, d):
    index, claim_vectors = _index(spark, d), views.claim_vectors(spark, d)
    pool = candidates.candidate_pool(_prepared(spark, d), claim_vectors, index)
    scored = candidates.score_pool(pool, claim_vectors, index)
    names = ("semantic_score", "lexical_score", "claim_lexical_score")
    return scored.select("claim_id", "article_id", "identity_candidate", *[F.round(c, 6).alias(c) for c in names])


@register("candidate_minmax", query("SELECT claim_id, article_id, round(semantic_norm, 5) AS semantic_norm, round(lexical_norm, 5) AS lexical_norm, "
    "round(claim_norm, 5) AS claim_norm FROM kept", "kept"))
def _(spark, d):
    names = ("semantic_norm", "lexical_norm", "claim_norm")
    return _scored(spark, d).select("claim_id", "article_id", *[F.round(c, 5).alias(c) for c in names])


# --- match signals over the identity pairs and over the pool -----------------------------

_SIG = ["entity_match", "entity_cooccurrence", "phrase_match", "event_specificity", "claim_event_overlap", "number_date_match", "fact_check_score"]


@register("match_signals", query(
    "SELECT claim_id, article_id, " + ", ".join(f"round({c}, 4) AS {c}" for c in _SIG)
    + ", specific_hits::BIGINT AS specific_hits, n_specific::BIGINT AS n_specific FROM id_signals", "id_signals"))
def _(spark, d):
    index, prepared = _index(spark, d), _prepared(spark, d)
    pairs = candidates.identity_candidates(prepared, index, 300)
    claims = prepared.select("claim_id", *signals.CLAIM_ARRAYS)
    found = signals.add_signals(term_search.with_found_terms(pairs, index.windows, claims))
    return found.select("claim_id", "article_id", *[F.round(c, 4).alias(c) for c in _SIG], big("specific_hits"), big("n_specific"))


@register("matched_entities", query(
    f"SELECT claim_id, article_id, array_to_string(list_filter(names, lambda n: {sql.found(sql.variants('n'), 'entity_w')} > 0), '|') AS matched FROM id_signals", "id_signals"))
def _(spark, d):
    index, prepared = _index(spark, d), _prepared(spark, d)
    pairs = candidates.identity_candidates(prepared, index, 300)
    found = term_search.find_terms(pairs, index.windows, prepared)
    return found.select("claim_id", "article_id", joined("matched_entities").alias("matched"))


@register("relevance_scores", query(
    "SELECT claim_id, article_id, relevance, evidence_type, strong_identity, strong_event, strong_claim, identity_candidate FROM rounded", "rounded"))
def _(spark, d):
    return _scored(spark, d).select(
        "claim_id", "article_id", "relevance", "evidence_type", "strong_identity", "strong_event", "strong_claim", "identity_candidate")


@register("retrieve_top12", query(
    "SELECT claim_id, retrieval_rank, article_id, " + ", ".join(sql._R4) + ", identity_candidate, relevance, evidence_type FROM retrieved", "retrieved"))
def _(spark, d):
    found = retrieval.retrieve(views.claims(spark, d), views.claim_vectors(spark, d), _index(spark, d))
    return found.withColumn("retrieval_rank", big("retrieval_rank"))


# --- reranking --------------------------------------------------------------------------

_EV = ("claim_id, rank, evidence_id, article_id, url, semantic_score, lexical_score, claim_match, phrase_match_score, entity_match, "
       "number_date_match, fact_check_score, directness_score, evidence_score, evidence_type, strong_evidence")


def _evidence_select(df):
    return df.withColumn("rank", F.col("rank").cast("bigint")).select(*_EV.split(", "))


@register("rerank_scores", query("SELECT claim_id, article_id, claim_match, directness_score, fact_check_score, evidence_score, evidence_type, strong_evidence FROM evidence_6", "evidence_6"))
def _(spark, d):
    scored = rerank.dedup_evidence(rerank.score_evidence(_with_text(spark, d), views.claims(spark, d)))
    return scored.select("claim_id", "article_id", "claim_match", "directness_score", "fact_check_score", "evidence_score", "evidence_type", "strong_evidence")


@register("rerank_top3", query(f"SELECT {_EV} FROM evidence", "evidence"))
def _(spark, d):
    return _evidence_select(rerank.rerank(_with_text(spark, d), views.claims(spark, d)))


@register("rerank_duplicates", query(
    "SELECT claim_id, evidence_id, first_rank AS retrieval_rank, evidence_score, claim_match FROM (SELECT *, "
    "min(retrieval_rank) OVER (PARTITION BY claim_id, evidence_id) AS first_rank, "
    "row_number() OVER (PARTITION BY claim_id, evidence_id ORDER BY evidence_score DESC, retrieval_rank) AS best FROM evidence_d_6) "
    "WHERE best = 1", "evidence_d_6"))
def _(spark, d):
    once = _with_text(spark, d)
    again = once.withColumns({
        "retrieval_rank": F.col("retrieval_rank") + 12,
        "claim_lexical_score": F.when(F.col("article_id") % 2 == 0, F.lit(1.0)).otherwise(F.lit(0.0))})
    scored = rerank.score_evidence(once.unionByName(again), views.claims(spark, d))
    return rerank.dedup_evidence(scored).select("claim_id", "evidence_id", big("retrieval_rank"), "evidence_score", "claim_match")


@register("rerank_top3_connected_phrase", query(f"SELECT {_EV} FROM evidence_p", "evidence_p"))
def _(spark, d):
    return _evidence_select(rerank.rerank(_with_text(spark, d), views.claims(spark, d), connect_phrase=True))


def _pol(terms):
    n = sql.found(sql.words(terms), "b")
    return f"CASE WHEN {n} = 0 THEN 0.0 ELSE least(0.5 + {n} * 0.1::DOUBLE, 1.0) END::DOUBLE"


_FACT = (f"CASE WHEN {sql.found(sql.words(lexicons.RERANK_FACT_CHECK_TERMS), 't')} > 0 THEN 1.0 WHEN "
         f"{sql.found(sql.words(lexicons.RERANK_FACT_CHECK_TERMS), 'c')} > 0 THEN 0.7 ELSE 0.0 END::DOUBLE")


@register("rerank_article_polarity", query(
    "SELECT article_id, f AS fact, n AS false_score, y AS true_score, CASE WHEN f >= 0.7 AND n >= y AND n >= 0.55 THEN 'FACT_CHECK_FALSE' "
    "WHEN f >= 0.7 AND y > n AND y >= 0.55 THEN 'FACT_CHECK_TRUE' WHEN f >= 0.7 THEN 'FACT_CHECK' ELSE 'NEWS' END AS type FROM ("
    f"SELECT article_id, {_FACT} AS f, round({_pol(lexicons.FALSE_TERMS)}, 6) AS n, round({_pol(lexicons.TRUE_TERMS)}, 6) AS y FROM ("
    f"SELECT article_id, {sql.fold('title')} AS t, {sql.fold('content')} AS c, {sql.fold('concat(title, chr(32), content)')} AS b FROM articles))", "articles"))
def _(spark, d):
    normal = views.articles(spark, d).select(
        "article_id", text.normalize_text(F.col("title")).alias("t"), text.normalize_text(F.col("content")).alias("c"),
        text.normalize_text(F.concat_ws(" ", "title", "content")).alias("b"))
    scored = normal.select(
        "article_id", rerank.fact_check_score(F.col("t"), F.col("c")).alias("fact"),
        F.round(rerank.polarity_score(F.col("b"), lexicons.FALSE_TERMS), 6).alias("false_score"),
        F.round(rerank.polarity_score(F.col("b"), lexicons.TRUE_TERMS), 6).alias("true_score"))
    return scored.withColumn("type", rerank.classify_evidence(
        F.lit(None).cast("string"), F.col("fact"), F.col("false_score"), F.col("true_score")))


# --- verdict tables ---------------------------------------------------------------------


@register("verdict_requests", query("SELECT request_id, title, content FROM request_norm WHERE title <> '' OR content <> ''", "request_norm"))
def _(spark, d):
    return verdict.normalize_requests(views.requests(spark, d))[0].select("request_id", "title", "content")


@register("verdict_rejected_requests", query(
    "SELECT request_id, 'provide at least one of question, title, content' AS reason FROM request_norm WHERE title = '' AND content = ''", "request_norm"))
def _(spark, d):
    return verdict.normalize_requests(views.requests(spark, d))[1]


_RAW = "concat('{\"main_claim\":', to_json(text)::VARCHAR, ',\"entities\":[', to_json(substr(text, 1, 12))::VARCHAR, ']}')"
_REPLY = (f"SELECT item_id AS claim_id, text, CASE item_id % 5 WHEN 4 THEN '  ' ELSE concat(' ', text) END AS news_text, CASE item_id % 5 WHEN 1 THEN "
          f"{quoted(json.dumps({'main_claim': ' ', 'claim_type': 'event', 'numbers_dates': ['2020']}))} WHEN 2 THEN 'not json' WHEN 3 THEN '[1]' ELSE {_RAW} END AS raw FROM benchmark")


@register("verdict_claim_records",
    f"SELECT claim_id, CASE WHEN error IS NULL THEN coalesce(nullif(trim(json_extract_string(raw, '$.main_claim')), ''), {sql.strip('news_text')}) END AS main_claim, "
    "CASE WHEN error IS NULL THEN array_to_string(coalesce(json_extract_string(raw, '$.entities[*]'), []), '|') END AS entities, "
    "CASE WHEN error IS NULL THEN array_to_string(coalesce(json_extract_string(raw, '$.numbers_dates[*]'), []), '|') END AS numbers_dates, "
    "CASE WHEN error IS NULL THEN coalesce(json_extract_string(raw, '$.claim_type'), '') END AS claim_type, error FROM (SELECT claim_id, news_text, "
    "CASE WHEN json_valid(raw) THEN raw END AS raw, CASE WHEN trim(news_text) = '' THEN 'news_text cannot be empty' "
    f"WHEN NOT json_valid(raw) OR json_type(CASE WHEN json_valid(raw) THEN raw END) <> 'OBJECT' THEN 'invalid JSON' END AS error FROM ({_REPLY}))")
def _(spark, d):
    records = verdict.parse_claims(views.claim_replies(spark, d))
    return records.select("claim_id", "main_claim", joined("entities").alias("entities"), joined("numbers_dates").alias("numbers_dates"), "claim_type", "error")


@register("verdict_extractor_inputs", query(
    "SELECT article_id, substr(concat(title, chr(10), chr(10), content), 1, 8000) AS extractor_input FROM articles", "articles"))
def _(spark, d):
    return verdict.extraction_inputs(views.articles(spark, d), "article_id").select("article_id", "extractor_input")


def _middle(e, n):
    return f"CASE WHEN length({e}) <= {n} THEN {e} ELSE concat(substr({e}, 1, {n // 2}), chr(10), '...[TRUNCATED]...', chr(10), right({e}, {n // 2})) END"


_SHOWN = ["semantic_score", "lexical_score", "entity_match", "number_date_match", "claim_match", "evidence_score"]
_BLOCK = (
    "concat('EVIDENCE ', rank, chr(10), 'Evidence ID: ', evidence_id, chr(10), 'Article ID: ', article_id, chr(10), 'Title: ', " + sql.strip("title")
    + ", chr(10), 'URL: ', " + sql.strip("url") + ", chr(10), 'Dataset label: ', CASE label WHEN 0 THEN 'FAKE' WHEN 1 THEN 'REAL' ELSE 'UNKNOWN' END, chr(10), 'Evidence type: ', evidence_type, "
    + ", ".join(f"chr(10), '{n}: ', printf('%.4f', {c})" for n, c in zip(
        ["Semantic score", "Lexical score", "Entity match", "Number/date match", "Claim match", "Evidence score"], _SHOWN))
    + ", chr(10), 'Strong evidence: ', CASE WHEN strong_evidence THEN 'True' ELSE 'False' END, chr(10), 'Article content:', chr(10), " + _middle(sql.strip("content"), 3000) + ")")
sql.cte("blocks", "claims evidence", f"""
SELECT c.claim_id, coalesce(b.block, {quoted(verdict.NO_EVIDENCE)}) AS evidence_block FROM claims c LEFT JOIN (
  SELECT claim_id, string_agg({_BLOCK}, chr(10) || chr(10) ORDER BY rank) AS block FROM evidence GROUP BY claim_id) b USING (claim_id)""")


@register("verdict_evidence_blocks", query("SELECT claim_id, evidence_block FROM blocks", "blocks"))
def _(spark, d):
    return verdict.evidence_blocks(views.claims(spark, d), _evidence(spark, d))


@register("verdict_prompts", query(
    f"SELECT claim_id, concat('CLAIM', chr(10), cl, chr(10), chr(10), 'ARTICLE', chr(10), {_middle('art', 5000)}, chr(10), chr(10), 'EVIDENCE', chr(10), evidence_block) AS prompt, "
    "concat('CLAIM', chr(10), cl, chr(10), chr(10), 'EVIDENCE', chr(10), evidence_block) AS retry_prompt FROM (SELECT c.claim_id, b.evidence_block, "
    f"{sql.strip('c.claim')} AS cl, {sql.strip('concat(c.source_title, chr(10), chr(10), c.source_content)')} AS art FROM claims c JOIN blocks b USING (claim_id))", "blocks", "claims"))
def _(spark, d):
    claims = views.claims(spark, d)
    return verdict.build_prompts(claims, verdict.evidence_blocks(claims, _evidence(spark, d)))


@register("article_windows_preset", query(
    "SELECT article_id, md5(content_w) AS content_w, md5(entity_w) AS entity_w, md5(event_w) AS event_w, md5(fact_w) AS fact_w, "
    "md5(identity_content) AS identity_content FROM fixed_windows", "fixed_windows"))
def _(spark, d):
    cut = index_store.article_windows(views.articles(spark, d), index_store.FIXED_WINDOWS)
    return cut.select("article_id", *[F.md5(c).alias(c) for c in ("content_w", "entity_w", "event_w", "fact_w", "identity_content")])


@register("claim_phrases_preset", query(
    "SELECT claim_id, array_to_string((" + sql.distinct("pp") + ")[1:30], '|') AS phrases FROM (SELECT claim_id, list_concat(("
    + sql.distinct("grams") + ")[1:15], all_vars) AS pp FROM prep3)", "prep3"))
def _(spark, d):
    limited = candidates.claim_phrases(views.claims(spark, d), own_phrases=15, phrases=30)
    return limited.select("claim_id", joined("phrases").alias("phrases"))


@register("verdict_validated", query(
    "SELECT claim_id, CASE WHEN error IS NULL THEN verdict END AS verdict, CASE WHEN error IS NULL THEN confidence END AS confidence, "
    "CASE WHEN error IS NULL THEN explanation END AS explanation, CASE WHEN error IS NULL THEN coalesce(own_summary, explanation) END AS summary, error FROM verdicts", "verdicts"))
def _(spark, d):
    return verdict.validate_responses(views.responses(spark, d)).drop("json")


@register("verdict_relations", query(
    "SELECT claim_id, json_extract_string(item, '$.evidence_id') AS evidence_id, CASE WHEN lower(trim(json_extract_string(item, '$.relationship'))) IN "
    "('supports', 'contradicts', 'unrelated', 'insufficient') THEN lower(trim(json_extract_string(item, '$.relationship'))) ELSE 'insufficient' END AS relationship "
    "FROM (SELECT claim_id, unnest(json_extract(json, '$.evidence_analysis[*]')) AS item FROM good) WHERE json_type(item) = 'OBJECT'", "good"))
def _(spark, d):
    validated = verdict.validate_responses(views.responses(spark, d))
    return verdict.explode_relations(validated).select("claim_id", "evidence_id", "relationship")


sql.cte("results", "claims evidence good verdicts", """
SELECT c.claim_id, g.verdict, g.confidence, c.claim, c.entities, g.explanation, g.summary,
  CASE WHEN g.claim_id IS NULL THEN coalesce(v.error, 'no reply') END AS error
FROM claims c LEFT JOIN good g USING (claim_id) LEFT JOIN verdicts v USING (claim_id)""")


def _results(spark, d):
    return verification.respond(views.claims(spark, d), _evidence(spark, d), views.responses(spark, d))


@register("verdict_responses", query(
    "SELECT r.claim_id, r.verdict, r.confidence, r.claim, array_to_string(r.entities, '|') AS entities, r.explanation, r.summary, r.error, "
    "coalesce(e.n, 0) AS evidence_count, coalesce(e.ids, '') AS evidence_ids, coalesce(e.snippets, '') AS snippets FROM results r LEFT JOIN ("
    "SELECT claim_id, count(*) AS n, string_agg(evidence_id, '|' ORDER BY rank) AS ids, string_agg(substr(content, 1, 350), '|' ORDER BY rank) AS snippets "
    "FROM evidence GROUP BY claim_id) e USING (claim_id)", "results", "evidence"))
def _(spark, d):
    return _results(spark, d).select(
        "claim_id", "verdict", "confidence", "claim", joined("entities").alias("entities"), "explanation", "summary", "error",
        big(F.size("evidence")).alias("evidence_count"), joined("evidence.evidence_id").alias("evidence_ids"), joined("evidence.content_snippet").alias("snippets"))


@register("verdict_report_view", query(
    "SELECT r.claim_id, CASE r.verdict WHEN 'FAKE' THEN 'FAKE NEWS' WHEN 'REAL' THEN 'AUTHENTIC NEWS' ELSE 'UNCERTAIN / UNVERIFIED' END AS verdict_title, "
    "floor(k * 100 + 0.5)::BIGINT AS confidence_percent, CASE WHEN k >= 0.85 THEN 'High Certainty' WHEN k >= 0.70 THEN 'Moderate Certainty' ELSE 'Safety Grounded' END AS certainty, "
    "array_to_string(r.entities[1:4], ', ') AS entity_tags, e.rank, coalesce(nullif(e.title, ''), 'Untitled Document') AS title, "
    "CASE WHEN e.evidence_type = 'FACT_CHECK' OR contains(e.title, 'सच') THEN 'Fact Check Report' ELSE 'News Evidence' END AS badge, "
    "least(floor(coalesce(nullif(e.evidence_score, 0), 0.5) * 100 + 0.5), 100)::BIGINT AS match_percent, "
    f"CASE WHEN e.content <> '' THEN {sql.collapse('substr(e.content, 1, 350)')} ELSE 'Snippet unavailable.' END AS snippet "
    "FROM (SELECT *, CASE WHEN confidence = 0 THEN 0.5 ELSE confidence END AS k FROM results WHERE error IS NULL) r LEFT JOIN evidence e USING (claim_id)", "results", "evidence"))
def _(spark, d):
    view = verdict.report_view(_results(spark, d))
    return view.select(*[F.col(c).cast("bigint").alias(c) if c in ("rank", "confidence_percent", "match_percent") else c for c in view.columns])


@register("verify_batch", query(
    "SELECT claim_id, rank, evidence_id, evidence_score, strong_evidence FROM evidence", "evidence"))
def _(spark, d):
    done = verification.verify(views.claims(spark, d), views.claim_vectors(spark, d), _index(spark, d))
    return done.evidence.select("claim_id", big("rank"), "evidence_id", "evidence_score", "strong_evidence")


# --- evaluation -------------------------------------------------------------------------


@register("evaluate_sample", query("SELECT article_id, title, label FROM sample", "sample"))
def _(spark, d):
    sample = evaluation.balanced_sample(views.articles(spark, d))
    parts = [sample.where(F.col("label") == label) for label, _ in evaluation.CLASSES]
    return evaluation.shuffle_rows(parts).select("article_id", "title", "label")


@register("evaluate_binary", query(
    "SELECT article_id, CASE predicted_verdict WHEN 'FAKE' THEN 0 WHEN 'REAL' THEN 1 ELSE -1 END::BIGINT AS predicted FROM predictions", "predictions"))
def _(spark, d):
    binary = evaluation.verdict_to_binary(F.col("predicted_verdict"))
    return views.predictions(spark, d).select("article_id", F.coalesce(binary, F.lit(-1)).cast("bigint").alias("predicted"))


@register("evaluate_rows", query(
    "SELECT s.article_id, s.label AS true_label, CASE s.label WHEN 0 THEN 'FAKE' ELSE 'REAL' END AS true_verdict, coalesce(v.verdict, 'ERROR') AS predicted_verdict, "
    "v.confidence, coalesce(v.verdict = CASE s.label WHEN 0 THEN 'FAKE' ELSE 'REAL' END, false) AS correct, CASE WHEN v.verdict IS NOT NULL THEN c.claim END AS claim, "
    "CASE WHEN v.verdict IS NOT NULL THEN to_json(c.entities)::VARCHAR END AS entities, CASE WHEN v.verdict IS NOT NULL THEN e.evidence_id END AS top_evidence_id, "
    "CASE WHEN v.verdict IS NOT NULL THEN e.evidence_score END AS top_evidence_score, CASE WHEN v.verdict IS NULL THEN coalesce(x.error, 'no verdict') END AS error "
    "FROM sample s LEFT JOIN claims c ON c.claim_id = s.article_id LEFT JOIN good v ON v.claim_id = s.article_id LEFT JOIN verdicts x ON x.claim_id = s.article_id "
    "LEFT JOIN (SELECT * FROM evidence WHERE rank = 1) e ON e.claim_id = s.article_id", "sample", "claims", "good", "verdicts", "evidence"))
def _(spark, d):
    verdicts = verdict.validate_responses(views.responses(spark, d)).drop("json")
    rows = evaluation.evaluation_rows(
        evaluation.balanced_sample(views.articles(spark, d)), views.claims(spark, d), _evidence(spark, d), verdicts)
    return rows.select("article_id", "true_label", "true_verdict", "predicted_verdict", "confidence", "correct", "claim", "entities",
                       "top_evidence_id", "top_evidence_score", "error")


@register("evaluate_counts", query("SELECT total, uncertain, errors, valid, c00 + c11 AS correct FROM counts", "counts"))
def _(spark, d):
    return evaluation.verdict_counts(views.predictions(spark, d))


@register("evaluate_class_metrics", query(
    "SELECT name, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM per_class", "per_class"))
def _(spark, d):
    m = evaluation.class_metrics(views.predictions(spark, d))
    return m.select("name", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("evaluate_average_f1", query(
    "SELECT round(avg(f1), 8) AS macro_f1, round(sum(f1 * support) / sum(support), 8) AS weighted_f1 FROM per_class", "per_class"))
def _(spark, d):
    f1 = evaluation.avg_f1(views.predictions(spark, d))
    return f1.select(*[F.round(c, 8).alias(c) for c in f1.columns])


@register("evaluate_confusion_matrix", query(
    "SELECT 'Actual_FAKE' AS actual, c00 AS \"Predicted_FAKE\", c01 AS \"Predicted_REAL\" FROM counts UNION ALL SELECT 'Actual_REAL', c10, c11 FROM counts", "counts"))
def _(spark, d):
    return evaluation.confusion_matrix(views.predictions(spark, d))


@register("evaluate_report", query(
    "SELECT name, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM per_class UNION ALL "
    "SELECT 'macro avg', round(avg(precision), 8), round(avg(recall), 8), round(avg(f1), 8), sum(support)::BIGINT FROM per_class UNION ALL "
    "SELECT 'weighted avg', round(sum(precision * support) / sum(support), 8), round(sum(recall * support) / sum(support), 8), "
    "round(sum(f1 * support) / sum(support), 8), sum(support)::BIGINT FROM per_class", "per_class"))
def _(spark, d):
    report = evaluation.classification_report(views.predictions(spark, d))
    return report.select("name", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("evaluate_rates", query(
    "SELECT round(uncertain::DOUBLE / total, 8) AS uncertain_rate, round(errors::DOUBLE / total, 8) AS error_rate, round(valid::DOUBLE / total, 8) AS coverage_rate, "
    "round((c00 + c11)::DOUBLE / total, 8) AS accuracy_all_cases, round((c00 + c11)::DOUBLE / valid, 8) AS accuracy_valid_cases FROM counts", "counts"))
def _(spark, d):
    r = evaluation.rates(views.predictions(spark, d))
    return r.select(*[F.round(c, 8).alias(c) for c in r.columns])


@register("evaluate_means", query("SELECT round(conf, 6) AS average_confidence, round(secs, 6) AS average_processing_time_seconds FROM counts", "counts"))
def _(spark, d):
    m = evaluation.means(views.predictions(spark, d))
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@register("evaluate_metrics", query(
    "SELECT (SELECT count(*) FROM labelled) AS total_dataset_rows, total AS evaluation_sample_size, valid AS valid_predictions, (c00 + c11) AS correct_predictions, "
    "round((c00 + c11)::DOUBLE / total, 4) AS accuracy_all_cases, (SELECT round(f1, 4) FROM per_class WHERE name = 'FAKE') AS fake_f1, "
    "(SELECT round(avg(f1), 4) FROM per_class) AS macro_f1, round(conf, 4) AS average_confidence, round(secs, 3) AS average_processing_time_seconds, "
    "(SELECT round(sum(recall * support) / sum(support), 8) FROM per_class) AS weighted_recall FROM counts", "counts", "per_class", "labelled"))
def _(spark, d):
    record = evaluation.metrics_record(views.predictions(spark, d), views.labelled_articles(spark, d), "articles", 5)
    names = ("total_dataset_rows", "evaluation_sample_size", "valid_predictions", "correct_predictions", "accuracy_all_cases", "fake_f1",
             "macro_f1", "average_confidence", "average_processing_time_seconds")
    nested = F.round(F.col("classification_report")["weighted avg"]["recall"], 8).alias("weighted_recall")
    return record.select(*names, nested)


@register("evaluate_without_valid", query(
    "SELECT count(*) AS evaluation_sample_size, 0::BIGINT AS valid_predictions, 0.0::DOUBLE AS accuracy_all_cases, 0.0::DOUBLE AS fake_f1, "
    "0.0::DOUBLE AS real_f1, 0.0::DOUBLE AS macro_f1, 0.0::DOUBLE AS weighted_f1, 1.0::DOUBLE AS error_rate, 0::BIGINT AS report_rows FROM predictions", "predictions"))
def _(spark, d):
    failed = views.predictions(spark, d).withColumn("predicted_verdict", F.lit("ERROR"))
    record = evaluation.metrics_record(failed, views.labelled_articles(spark, d), "articles", 5)
    return record.select("evaluation_sample_size", "valid_predictions", "accuracy_all_cases", "fake_f1", "real_f1", "macro_f1", "weighted_f1",
                         "error_rate", F.when(F.col("classification_report").isNull(), 0).otherwise(1).cast("bigint").alias("report_rows"))


# --- streaming --------------------------------------------------------------------------


def _request_vectors(spark, d):
    own = views.article_vectors(spark, d).withColumnRenamed("article_id", "claim_id")
    return lambda claims: own.join(claims.select("claim_id"), "claim_id", "left_semi")


def _streamed(spark, d):
    def build():
        base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
        views.requests(spark, d).write.json(f"{base}/in")
        stream_verify(
            spark, f"{base}/in", f"{base}/out", f"{base}/rejects", f"{base}/checkpoint", _index(spark, d), _request_vectors(spark, d),
            log=f"{base}/log",
        ).awaitTermination()
        return base

    return _once(spark, d, "streamed", build)


# Accepted requests in place of the claims, as a batch.
_REQUEST_TABLES = {
    "claims": ("request_norm", """
SELECT request_id AS claim_id, CASE WHEN title <> '' THEN title ELSE content END AS claim, title AS source_title, content AS source_content,
  CAST([] AS VARCHAR[]) AS entities, CAST([] AS VARCHAR[]) AS numbers_dates, NULL::BIGINT AS exclude_article_id
FROM request_norm WHERE title <> '' OR content <> ''"""),
    "claim_vectors": ("claims vectors", "SELECT c.claim_id, v.v FROM claims c JOIN vectors v ON v.article_id = c.claim_id"),
}


@register("stream_batches", query(
    "SELECT (SELECT count(*) FROM request_norm) AS requests, (SELECT count(*) FROM request_norm WHERE title = '' AND content = '') AS rejected, "
    "(SELECT count(*) FROM evidence) AS evidence", "request_norm", "evidence", **_REQUEST_TABLES))
def _(spark, d):
    log = read_log(spark, f"{_streamed(spark, d)}/log")
    return log.agg(*[F.sum(c).alias(c) for c in ("requests", "rejected", "evidence")])


@register("stream_verify", query(
    "SELECT claim_id, rank, evidence_id, evidence_score, strong_evidence FROM evidence", "evidence", **_REQUEST_TABLES))
def _(spark, d):
    found = spark.read.parquet(f"{_streamed(spark, d)}/out")
    return found.select("claim_id", big("rank"), "evidence_id", "evidence_score", "strong_evidence")


def batch_of_requests(spark, d):
    """The batch result the stream has to equal."""
    evidence, _ = verify_requests(views.requests(spark, d), _index(spark, d), _request_vectors(spark, d))
    return evidence.select("claim_id", big("rank"), "evidence_id", "evidence_score", "strong_evidence")
