"""Table schemas shared by every job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ARTICLE_COLUMNS = ["article_id", "url", "title", "content", "label"]

ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("article_id", T.LongType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("content", T.StringType(), True),
        T.StructField("label", T.IntegerType(), True),
    ]
)

RAW_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in ("URL", "TITLE", "CONTENT", "BOOL")]
)

CLAIM_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("main_claim", T.StringType(), True),
        T.StructField("sub_claims", T.ArrayType(T.StringType()), True),
        T.StructField("entities", T.ArrayType(T.StringType()), True),
        T.StructField("numbers_dates", T.ArrayType(T.StringType()), True),
        T.StructField("claim_type", T.StringType(), True),
        T.StructField("is_fact_check_article", T.StringType(), True),
        T.StructField("claim_status", T.StringType(), True),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType(), True),
        T.StructField("question", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("content", T.StringType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("article_id", T.LongType(), True),
    ]
)


class SchemaMismatch(ValueError):
    """A table lacks a required column."""


def missing_columns(df: DataFrame, columns=ARTICLE_COLUMNS) -> list[str]:
    """Sorted names from ``columns`` that ``df`` does not have."""
    return sorted(set(columns) - set(df.columns))


def require_columns(df: DataFrame, columns=ARTICLE_COLUMNS) -> DataFrame:
    """Return ``df``, or raise naming every missing column."""
    missing = missing_columns(df, columns)
    if missing:
        raise SchemaMismatch(f"missing required columns: {missing}")
    return df
