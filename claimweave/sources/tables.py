"""Reading and writing article tables, reports and evaluation results."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from claimweave.schema import ARTICLE_SCHEMA, RAW_SCHEMA


def read_articles_csv(spark: SparkSession, path: str, schema=ARTICLE_SCHEMA) -> DataFrame:
    """Article table from CSV with a declared schema and quoted multi-line fields.

    A multi-line CSV file cannot be split, so large inputs should arrive as many files or
    be converted to Parquet once. A leading byte-order mark is dropped by Spark's reader.
    """
    return (
        spark.read.option("header", "true")
        .option("multiLine", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .schema(schema)
        .csv(path)
    )


def read_first_available(
    spark: SparkSession,
    paths: Sequence[str],
    reader: Callable[[SparkSession, str], DataFrame] = read_articles_csv,
) -> DataFrame:
    """First path that answers a one-row probe; the last error if none does."""
    if not paths:
        raise ValueError("no path given")
    error = None
    for path in paths:
        try:
            df = reader(spark, path)
            df.take(1)
            return df
        except PySparkException as exc:
            error = exc
    raise error


def read_raw(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    """Raw four-column sheet from any Spark source, all columns as text."""
    reader = spark.read.format(fmt).schema(RAW_SCHEMA)
    if fmt == "csv":
        reader = reader.options(header="true", multiLine="true", quote='"', escape='"')
    return reader.options(**options).load(path)


def write_articles(df: DataFrame, path: str, parquet_path: str | None = None) -> None:
    """Clean table as CSV with every field quoted, and as Parquet for the jobs downstream."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("quoteAll", "true")
        # the writer trims by default
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    if parquet_path:
        df.write.mode("overwrite").parquet(parquet_path)


def write_reports(reports: Mapping[str, DataFrame], directory: str) -> None:
    """One single-file CSV per report; reports are aggregates of a few rows."""
    for name, report in reports.items():
        report.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{directory}/{name}")


def write_evaluation(
    rows: DataFrame, confusion: DataFrame, metrics: DataFrame, directory: str
) -> None:
    """Per-article rows and confusion matrix as CSV, the metrics record as JSON."""
    csv_rows = rows.write.mode("overwrite").options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    )
    csv_rows.csv(f"{directory}/evaluation_results")
    confusion.coalesce(1).write.mode("overwrite").option("header", "true").csv(
        f"{directory}/confusion_matrix"
    )
    metrics.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(
        f"{directory}/metrics"
    )
