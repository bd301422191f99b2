"""Corpus profile and data-quality checks. Every report is one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.scale import maybe_broadcast, measure
from claimweave.schema import ARTICLE_COLUMNS


class RowCountMismatch(ValueError):
    """The table does not have the expected number of rows."""


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def assert_row_count(df: DataFrame, expected: int) -> int:
    return check_rows(row_count(df).first()["row_count"], expected)


def check_rows(actual: int, expected: int) -> int:
    if actual != expected:
        raise RowCountMismatch(f"expected {expected} rows, found {actual}")
    return actual


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label").count().orderBy("label")


def data_quality(df: DataFrame, columns=ARTICLE_COLUMNS) -> DataFrame:
    """Null count per column in one row. Blank text counts as present."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def with_lengths(df: DataFrame) -> DataFrame:
    """Lengths in code points."""
    return df.withColumns(
        {"title_length": F.length("title"), "content_length": F.length("content")}
    )


def length_statistics(df: DataFrame) -> DataFrame:
    lengths = with_lengths(df)

    def mean_where(label):
        return F.avg(F.when(F.col("label") == label, F.col("content_length")))

    return lengths.agg(
        F.avg("title_length").alias("average_title_length"),
        F.avg("content_length").alias("average_content_length"),
        mean_where(0).alias("avg_content_length_label_0"),
        mean_where(1).alias("avg_content_length_label_1"),
    )


def label_statistics(df: DataFrame) -> DataFrame:
    return (
        with_lengths(df)
        .groupBy("label")
        .agg(
            F.count("*").alias("article_count"),
            F.avg("title_length").alias("avg_title_length"),
            F.avg("content_length").alias("avg_content_length"),
        )
        .orderBy("label")
    )


def label_record(df: DataFrame) -> DataFrame:
    """One mergeable row per label, null a group of its own: rows, nulls per column, texts and their characters.

    The four reports below derive from this record, so a corpus is read once for all of them. It has as many
    rows as there are labels.
    """
    lengths = with_lengths(df)
    return lengths.groupBy("label").agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in ARTICLE_COLUMNS if c != "label"],
        F.count_if(F.col("label").isNull()).alias("missing_label"),
        *[
            measure_.alias(f"{name}_{kind}")
            for name in ("title", "content")
            for kind, measure_ in (("texts", F.count(f"{name}_length")), ("chars", F.sum(f"{name}_length")))
        ],
    )


def _mean(name: str, condition: Column | None = None) -> Column:
    """Mean length over the rows of a label record that meet a condition."""
    chars, texts = F.col(f"{name}_chars"), F.col(f"{name}_texts")
    if condition is not None:
        chars, texts = F.when(condition, chars), F.when(condition, texts)
    return F.try_divide(F.sum(chars), F.sum(texts))


def reports_of(record: DataFrame) -> dict[str, DataFrame]:
    """Label distribution, label statistics, length statistics and null counts from a label record."""
    zero = F.lit(0).cast("bigint")
    return {
        "label_distribution": record.select("label", F.col("rows").alias("count")).orderBy("label"),
        "label_statistics": record.groupBy("label")
        .agg(
            F.sum("rows").alias("article_count"),
            _mean("title").alias("avg_title_length"),
            _mean("content").alias("avg_content_length"),
        )
        .orderBy("label"),
        "length_statistics": record.agg(
            _mean("title").alias("average_title_length"),
            _mean("content").alias("average_content_length"),
            _mean("content", F.col("label") == 0).alias("avg_content_length_label_0"),
            _mean("content", F.col("label") == 1).alias("avg_content_length_label_1"),
        ),
        "data_quality": record.agg(
            *[F.coalesce(F.sum(f"missing_{c}"), zero).alias(f"missing_{c}") for c in ARTICLE_COLUMNS]
        ),
    }


def longest_articles(df: DataFrame, k: int = 10) -> DataFrame:
    """Top-k by content length. The content itself is dropped before the sort."""
    return (
        with_lengths(df)
        .select("article_id", "title", "content_length", "label")
        .orderBy(F.desc("content_length"), "article_id")
        .limit(k)
    )


def sample_articles(df: DataFrame, k: int = 10) -> DataFrame:
    return df.select("article_id", "title", "label").orderBy("article_id").limit(k)


def label_violations(df: DataFrame) -> DataFrame:
    """Rows whose label is null or outside {0, 1}; empty on a valid table."""
    return df.where(F.col("label").isNull() | ~F.col("label").isin(0, 1)).select("article_id", "label")


def label_name(label: Column) -> Column:
    return F.when(label == 0, "FAKE").when(label == 1, "REAL").otherwise("UNKNOWN")


def dataset_audit(df: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """One row: rows, nulls per column, rows per label as a map, PASS or FAIL."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ARTICLE_COLUMNS]
    per_label = df.groupBy("label").agg(F.count("*").alias("rows"), *nulls)
    total = F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint")
    # one row per distinct label enters this second aggregation
    audit = per_label.agg(
        total.alias("row_count"),
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).cast("bigint").alias(f"null_{c}") for c in ARTICLE_COLUMNS],
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.when(
                        F.col("label").isNotNull(),
                        F.struct(F.col("label").cast("string").alias("key"), F.col("rows").alias("value")),
                    )
                )
            )
        ).alias("label_distribution"),
    )
    ok = F.lit(True)
    for c in ARTICLE_COLUMNS:
        ok = ok & (F.col(f"null_{c}") == 0)
    if expected_rows is not None:
        ok = ok & (F.col("row_count") == expected_rows)
    return audit.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def lookup_articles(articles: DataFrame, ids: DataFrame) -> DataFrame:
    """Articles of an id list with ``found``; ids without an article stay, with nulls."""
    wanted = ids.select("article_id").distinct()
    small = measure(wanted).fits()
    hits = articles.join(maybe_broadcast(wanted, small), "article_id", "left_semi")
    joined = wanted.join(hits.withColumn("found", F.lit(True)), "article_id", "left")
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))
