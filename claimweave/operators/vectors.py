"""Dense vectors: validation, normalisation, exact cosine top-k.

Top-k scoring is a block product. Queries and articles are packed into blocks of bounded
size, the two sides meet in an equi-join on the query block, and NumPy multiplies one
pair of blocks at a time. Only the k best articles per query leave a pair of blocks, so
the full query-by-article product is never shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions.numeric import round4
from claimweave.functions.text import embedding_text
from claimweave.operators.profiling import label_name
from claimweave.scale import BROADCAST_BYTES, all_salts, maybe_broadcast, measure

QUERIES_PER_BLOCK = 2048
# scores that a pair of blocks holds at once
SCORES_AT_ONCE = 1 << 20
# scores are ordered on this many decimals, so that float noise never decides a tie
SCORE_DECIMALS = 8


def embedding_inputs(articles: DataFrame, content_chars: int = 1500) -> DataFrame:
    """Texts for an external encoder."""
    text = embedding_text(F.col("title"), F.col("content"), content_chars)
    return articles.select("article_id", text.alias("embedding_text"))


def validate_vectors(vectors: DataFrame, articles: DataFrame, dim: int) -> DataFrame:
    """One row of defects: wrong dimension, repeated id, article without vector, vector without article."""
    ids = vectors.groupBy("article_id").agg(
        F.count("*").alias("copies"), F.count_if(F.size("embedding") != dim).alias("wrong")
    )
    both = articles.select("article_id", F.lit(True).alias("has_article")).join(
        ids, "article_id", "full_outer"
    )
    return both.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("vectors"),
        F.coalesce(F.sum("wrong"), F.lit(0)).cast("bigint").alias("wrong_dimension"),
        F.count_if(F.col("copies") > 1).alias("repeated_ids"),
        F.count_if(F.col("copies").isNull()).alias("articles_without_vector"),
        F.count_if(F.col("has_article").isNull()).alias("vectors_without_article"),
    )


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Dot product inside the JVM, for single pairs."""
    return F.aggregate(
        F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x
    )


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    d = as_doubles(v)
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(d, lambda x: x / norm)).otherwise(d)


def _pack(batches):
    """Arrow batch of vectors -> one row holding the whole batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ids = batch.column("article_id")
        values = batch.column("embedding")
        yield pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.ListArray.from_arrays(pa.array([0, len(values.flatten())], pa.int32()), values.flatten()),
            ],
            names=["ids", "vectors"],
        )


def _matrix(vectors: pa.ListArray, rows: int) -> np.ndarray:
    """The flat buffer of a list of packed vectors as a matrix."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.float64)


def _best_of(line: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest finite scores, ties by id: only what reaches the k-th score is sorted."""
    some = np.flatnonzero(line > -np.inf)
    if len(some) > k:
        least = np.partition(line[some], len(some) - k)[len(some) - k]
        some = some[line[some] >= least]
    return some[np.lexsort((ids[some], -line[some]))[:k]]


def _block_topk(k: int):
    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c).slice(i, 1) for c in ("queries", "excluded", "asked", "ids", "vectors")}
                queries = row["queries"].flatten().to_numpy(zero_copy_only=False)
                ids = row["ids"].flatten().to_numpy(zero_copy_only=False)
                excluded = row["excluded"].flatten()
                never = excluded.is_null().to_numpy(zero_copy_only=False)
                excluded = excluded.fill_null(0).to_numpy(zero_copy_only=False)
                asked, articles = _matrix(row["asked"], len(queries)), _matrix(row["vectors"], len(ids)).T
                out, step = [], max(1, SCORES_AT_ONCE // max(len(ids), 1))
                for first in range(0, len(queries), step):
                    scores = asked[first : first + step] @ articles
                    np.round(scores, SCORE_DECIMALS, out=scores)
                    for j, line in enumerate(scores, first):
                        if not never[j]:
                            line[ids == excluded[j]] = -np.inf
                        best = _best_of(line, ids, k)
                        out.append((np.full(len(best), queries[j]), ids[best], line[best]))
                columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["query_id", "article_id", "score"])

    return score


def best_scores(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """Exact k best articles of every query: (query_id, article_id, score).

    ``queries`` has (query_id, embedding, exclude_article_id); an excluded article is never
    scored. Query blocks are broadcast when all of them together are small; otherwise they
    are replicated over salts and joined by a shuffle, because one block meets every
    article block.
    """
    asked = queries.select("query_id", "embedding", "exclude_article_id").where(
        F.col("embedding").isNotNull()
    )
    size = measure(asked)
    blocks = max(1, math.ceil(size.rows / QUERIES_PER_BLOCK))
    packed_queries = (
        asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        .groupBy("block")
        .agg(F.collect_list(F.struct("query_id", F.col("embedding").cast("array<double>").alias("embedding"), "exclude_article_id")).alias("q"))
        .select(
            "block", F.col("q.query_id").cast("array<bigint>").alias("queries"), F.col("q.exclude_article_id").cast("array<bigint>").alias("excluded"),
            F.flatten("q.embedding").alias("asked"),
        )
    )
    packed_articles = vectors.where(F.col("embedding").isNotNull()).select(
        F.col("article_id").cast("bigint").alias("article_id"),
        F.col("embedding").cast("array<float>").alias("embedding"),
    ).mapInArrow(_pack, "ids array<bigint>, vectors array<float>")
    pairs = packed_articles.withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    if size.fits():
        pairs = pairs.join(F.broadcast(packed_queries), "block")
    else:
        salts = F.lit(max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("ids"), salts).cast("int")).join(
            packed_queries.withColumn("salt", all_salts(salts)), ["block", "salt"]
        )
    local = pairs.select("queries", "excluded", "asked", "ids", "vectors").mapInArrow(
        _block_topk(k), "query_id bigint, article_id bigint, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "article_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def semantic_topk(queries: DataFrame, vectors: DataFrame, articles: DataFrame, k: int = 10) -> DataFrame:
    """Ranked nearest articles per query, the query's own article left out."""
    best = best_scores(queries, vectors, k)
    # at most k rows of three numbers per query
    small = queries.count() * k * 32 <= BROADCAST_BYTES
    picked = maybe_broadcast(best, small).join(
        articles.select("article_id", "title", "content", "url", "label"), "article_id"
    )
    return picked.select(
        "query_id",
        F.col("rank").cast("int").alias("rank"),
        "article_id",
        "title",
        "content",
        "url",
        "label",
        label_name(F.col("label")).alias("label_name"),
        round4(F.col("score")).alias("relevance_score"),
    )
