"""Proportional stratified interleaving: every shard holds the mixture of sources.

Rows of a source are put in a seeded order; the row of rank r among n stands at the fraction
(r - 1/2) / n. Sorted by that fraction the sources interleave in proportion, and any cut into
consecutive runs of equal length matches the mixture to within a row per source and cut.

Built on DataFrame functions only. Ranks come from counts per hash bucket, so neither a source
that holds most rows nor the global order is ever sorted by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.tables import add_running, bucket_count, group_key, hash_bucket, materialize, read_table

SEED = 17


def interleave(
    rows: DataFrame, source: str = "source", tie: list[str] | None = None, shards: int = 16, seed: int = SEED
) -> DataFrame:
    """``rows`` with ``position``, ``shard`` and ``slot``, counts of shards at most one apart.

    ``tie`` names the columns that the seeded order is drawn from (all by default). A null source
    is a source of its own. Rows equal in all of ``tie`` are interchangeable. An empty table
    stays empty. Columns of the input that clash with the three added ones are replaced.
    """
    added = ["position", "shard", "slot"]
    kept = [c for c in rows.columns if c.lower() not in added]
    tie = [c for c in tie or kept if c in kept]
    base = rows.select(
        F.struct(*kept).alias("row"),
        group_key(F.col(source)).alias("key"),
        F.xxhash64(F.lit(seed), *tie).alias("draw"),
        F.struct(*tie).alias("tie"),
    )
    total = rows.count()
    buckets = bucket_count(total)
    drawn = base.withColumn("bucket", hash_bucket(F.col("draw"), buckets))
    # The unsigned slice of the hash first, then the hash itself: within a slice both agree.
    ranked = add_running(drawn, ["key"], "bucket", [F.col("draw"), F.col("tie")], F.lit(1), "rank", "size")
    odd = F.col("rank") * 2 + 1
    placed = materialize(
        ranked.drop("bucket", "draw", "tie")
        .withColumn("slice", F.expr(f"(rank * 2 + 1) * {buckets}L div (size * 2)"))
        .withColumn("fraction", odd / (F.col("size") * 2)),
        "interleave",
    )
    spread = placed.withColumn("all", F.lit(0))
    done = add_running(
        spread, ["all"], "slice", [F.col("fraction"), F.col("key"), F.col("rank")], F.lit(1), "position"
    )
    return done.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        F.col("position").cast("bigint").alias("position"),
        F.expr(f"cast(position * {shards} div {max(total, 1)} as int)").alias("shard"),
    ).withColumn("slot", F.expr(f"position - (shard * {total}L + {shards - 1}) div {shards}"))


def write_shards(interleaved: DataFrame, path: str) -> None:
    """One folder per shard, its rows in slot order within ranges of slots."""
    interleaved.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 15 under the law ``rows``."""
    documents = read_table(spark, folder, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "source",
    )
    placed = interleave(rows, tie=["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
