"""From a raw sheet to the canonical article table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.numeric import to_number
from claimweave.functions.text import strip_ws
from claimweave.operators.profiling import data_quality, label_distribution
from claimweave.scale import number_rows
from claimweave.schema import ARTICLE_COLUMNS

RAW_TO_CANONICAL = {"URL": "url", "TITLE": "title", "CONTENT": "content", "BOOL": "label"}


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Distinct rows.

    ``dropDuplicates`` combines on the map side first, so a row with very many copies
    leaves at most one per task. It runs before trimming: rows that differ only in outer
    white space are kept.
    """
    return df.dropDuplicates()


def duplicate_stats(df: DataFrame) -> DataFrame:
    """One row: rows before, rows after, copies removed; one pass, no wide sort."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count("*").alias("rows_after"),
    ).withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))


def clean_text_columns(df: DataFrame, columns) -> DataFrame:
    """Null text to blank, outer white space removed."""
    return df.withColumns({c: strip_ws(F.col(c)) for c in columns})


def rename_raw(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(RAW_TO_CANONICAL)


def coerce_label(df: DataFrame) -> DataFrame:
    """Numeric labels truncated to integers; rows whose label is no number are dropped."""
    return df.withColumn("label", to_number(F.col("label")).try_cast("int")).where(F.col("label").isNotNull())


def assign_ids(df: DataFrame, *order: str) -> DataFrame:
    """``article_id`` 1..n in ascending order of the given columns."""
    return number_rows(df, list(order), "article_id")


def canonical_columns(df: DataFrame) -> DataFrame:
    return df.select(*ARTICLE_COLUMNS)


def clean_articles(raw: DataFrame, *order: str) -> DataFrame:
    """Whole cleaning job. Spark tables have no input order, so ``order`` names one."""
    cleaned = clean_text_columns(drop_exact_duplicates(raw), ["TITLE", "CONTENT", "URL"])
    labelled = coerce_label(rename_raw(cleaned))
    return canonical_columns(assign_ids(labelled, *(order or ("url", "title", "content", "label"))))


def clean_report(df: DataFrame) -> DataFrame:
    """Post-clean report as (metric, value) rows: total, rows per label, nulls per column."""
    labels = label_distribution(df).select(
        F.concat(F.lit("label_"), F.col("label").cast("string")).alias("metric"),
        F.col("count").alias("value"),
    )
    quality = data_quality(df)
    missing = quality.unpivot([], quality.columns, "metric", "value")
    total = df.agg(F.count("*").alias("value")).select(F.lit("rows").alias("metric"), "value")
    return total.unionByName(labels).unionByName(missing)
