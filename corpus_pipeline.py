"""The corpus pipeline: stages that each take the documents left by the stage before.

1. quality classifier: documents that it rejects go,
2. n-gram Jaccard join: of each group of near-duplicates one row stays, of the smallest id, null last,
3. personal data: spans are replaced by their kind,
4. mixing: sources are repeated or cut to their targets,
5. packing: what remains is encoded and packed into sequences, one row per piece.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimweave.llm import jaccard_join, mixing, packing, personal_data, quality  # noqa: E402
from claimweave.llm.tables import materialize, read_table, unused  # noqa: E402
from claimweave.scale import maybe_broadcast, measure  # noqa: E402


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on their labels, does not reject."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: of smallest id, null after all others, then of smallest text hash.

    Of rows equal in both, any one stays. Texts without words, and null texts, link with nothing and all stay.
    """
    rows = jaccard_join.labelled_rows(docs).where("n > 0")
    keys = rows.groupBy("label", "doc_id", "mark").agg(F.count("*").alias("copies"))
    keys = materialize(keys, "join_keys")
    first = keys.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"))
    first = first.select(F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark"))
    gone = materialize(_keyed(keys.join(first, is_first, "left_anti")), "later_copies")
    out = _where_key(docs, gone, "left_anti")
    again = materialize(_keyed(keys.where("copies > 1").join(first, is_first, "left_semi")), "repeated_rows")
    if again.isEmpty():
        return out
    row, place, mark = unused([], "row", "place", "mark")
    repeated = _where_key(docs, again, "left_semi").select(
        F.struct(*docs.columns).alias(row), F.xxhash64(*docs.columns).alias(place), F.xxhash64("text").alias(mark)
    )
    one = repeated.groupBy(f"{row}.doc_id", mark).agg(F.min_by(row, place).alias(row)).select(f"{row}.*")
    return _where_key(out, again, "left_anti").unionByName(one)


def _keyed(keys: DataFrame) -> DataFrame:
    return keys.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))


def _where_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of documents with keys (_id, _mark)."""
    # The texts move only if the keys are too many to send to every task.
    small = measure(keys).fits(limit=32 << 20)
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_mark"))
    return docs.join(maybe_broadcast(keys, small), same, how)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced."""
    return personal_data.redact(docs, personal_data.fit(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row per time a document is taken, cut where only part of it is."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", keep_first_copies),
    ("personal_data", redact),
    ("mixing_sources", mix),
    ("packing", pack),
]
# Classifiers and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
