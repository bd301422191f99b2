"""Exact top-k inner-product search with a pivot-distance index.

Vectors get one more coordinate that lifts them all to the same norm, so that the highest inner
product is the nearest vector. Every vector is keyed by its nearest pivot (cell) and by its
distance from it, in rings of equal width. A query looks at rings around its own distance from
each pivot; with s the k-th best score so far, a ring is left out when the triangle inequality shows
that none of its vectors can reach s. Cells near the query are searched first, all others with
the sharper bound that this gives, so that nothing is missed.

Pivots are fitted on a bounded sample (``SAMPLE`` rows of smallest hash) and every row is indexed.
Rings with many rows are split; many queries of one ring are split as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.llm.tables import materialize, read_table

SAMPLE = 2048
PIVOTS = 64
RINGS = 24  # over the radius of the sphere
NEAR_CELLS = 4
BLOCK_ROWS = 8192
QUERY_ROWS = 16384
HIT = "query_key bigint, query_id bigint, vec_id bigint, score bigint"


def integers(embedding: Column, scale: int = 256) -> Column:
    """Components as floor(scale * x); null for a vector that is null or holds null or non-finite ones."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(embedding.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.transform(x, lambda v: F.floor(v * scale)))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)


def _lift(vectors: np.ndarray, radius2: float) -> np.ndarray:
    more = np.sqrt(np.maximum(radius2 - (vectors * vectors).sum(1), 0))
    return np.column_stack([vectors, more])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def _fit_pivots(points: np.ndarray, pivots: int) -> np.ndarray:
    """Means after a few rounds of k-means from a seeded start."""
    rng = np.random.default_rng(7)
    centres = points[rng.choice(len(points), min(pivots, len(points)), replace=False)]
    for _ in range(6):
        nearest = _distances(points, centres).argmin(1)
        centres = np.array([points[nearest == i].mean(0) if (nearest == i).any() else c for i, c in enumerate(centres)])
    return centres


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        few = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        few = np.arange(len(scores))
    return few[np.lexsort((ids[few], -scores[few]))[:k]]


def search(vectors: DataFrame, is_query: Column, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows of every query.

    ``vectors`` has ``vec_id`` and ``embedding``, whose scaled integer components count
    (``integers``); rows without usable vector or id take no part, shorter vectors are filled up with
    zeros. Equal rows count once each as candidates; a row never finds rows of its own id. Repeated
    equal queries answer once. An empty table, or one row, gives no rows.
    """
    spark = vectors.sparkSession
    whole = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), integers(F.col("embedding")).alias("ints"))
    whole = whole.where(F.col("ints").isNotNull() & F.col("vec_id").isNotNull())
    squares = F.aggregate("ints", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    n, dims, radius2, queries = whole.agg(
        F.count("*"), F.max(F.size("ints")), F.max(squares), F.count(F.when(is_query, 1))
    ).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not n or not dims:
        return empty
    filled = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.get("ints", i), F.lit(0)))
    whole = whole.withColumn("ints", filled)
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    sample_ids, sample_rows = sample["vec_id"].to_numpy(), _matrix(sample["ints"], dims)
    centres = _fit_pivots(_lift(sample_rows, radius2), pivots)
    width = max(np.sqrt(radius2) / RINGS, 1e-9)

    def index(batches):
        for batch in batches:
            far = _distances(_lift(_matrix(batch.column(1), dims), radius2), centres)
            cell = far.argmin(1)
            ring = (far[np.arange(len(cell)), cell] // width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(ring)],
                ["vec_id", "ints", "cell", "ring"],
            )

    indexed = materialize(whole.mapInArrow(index, "vec_id bigint, ints array<bigint>, cell int, ring int"), "pivot_index")
    rings = indexed.groupBy("cell", "ring").agg(F.count("*").alias("rows"))
    rings = rings.withColumn("parts", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int")).drop("rows")
    split = max(1, -(-queries // QUERY_ROWS))
    asked = (
        indexed.where(is_query)
        .select(F.xxhash64("vec_id", "ints").alias("query_key"), F.col("vec_id").alias("query_id"), "ints")
        .dropDuplicates(["query_key"])
    )
    rings_of_cell = {c: (0, int(2.1 * np.sqrt(radius2) / width) + 2) for c in range(len(centres))}
    found = rings.groupBy("cell").agg(F.min("ring"), F.max("ring")).collect()  # one row per pivot
    rings_of_cell = {r[0]: (r[1], r[2]) for r in found}

    def visits(near: bool):
        """Rings that each query has to look at, with the score to reach."""

        def run(batches):
            for batch in batches:
                names = batch.schema.names
                key, own, ints = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
                rows = _matrix(ints, dims)
                scores = rows @ sample_rows.T
                scores[own[:, None] == sample_ids] = -np.inf
                reach = np.full(len(own), -np.inf)
                if scores.shape[1] >= k:
                    reach = np.partition(scores, -k, axis=1)[:, -k]
                if "reach" in names:
                    better = batch.column(names.index("reach")).to_numpy(zero_copy_only=False).astype(float)
                    reach = np.fmax(reach, better)
                far = _distances(np.column_stack([rows, np.zeros(len(rows))]), centres)
                order = far.argsort(1, kind="stable").argsort(1, kind="stable")
                radius = np.sqrt(np.maximum((rows * rows).sum(1) + radius2 - 2 * reach, 0)) + 1e-6 * np.sqrt(radius2) + 1e-6
                q, cell, ring = [], [], []
                for i in range(len(own)):
                    for c, (lo, hi) in rings_of_cell.items():
                        if (order[i, c] < NEAR_CELLS) == near:
                            a = max(lo, int(max((far[i, c] - radius[i]) / width, lo)) if np.isfinite(radius[i]) else lo)
                            b = min(hi, int((far[i, c] + radius[i]) / width) if np.isfinite(radius[i]) else hi)
                            q += [i] * (b - a + 1)
                            cell += [c] * (b - a + 1)
                            ring += range(a, b + 1)
                for at in range(0, len(q), 20_000):
                    part = np.array(q[at : at + 20_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[part]), pa.array(own[part]), ints.take(pa.array(part)),
                         pa.array(reach[part]), pa.array(cell[at : at + 20_000], pa.int32()),
                         pa.array(ring[at : at + 20_000], pa.int32())],
                        ["query_key", "query_id", "ints", "reach", "cell", "ring"],
                    )

        return run

    visit_schema = "query_key bigint, query_id bigint, ints array<bigint>, reach double, cell int, ring int"

    def look(block: pa.Table, asking: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if block.num_rows and asking.num_rows:
            ids, rows = block["vec_id"].to_numpy(), _matrix(block["ints"], dims)
            keys, own, reach = (asking[c].to_numpy() for c in ("query_key", "query_id", "reach"))
            asked_rows = _matrix(asking["ints"], dims)
            for at in range(0, len(keys), 256):
                table = asked_rows[at : at + 256] @ rows.T
                for i, scores in enumerate(table, at):
                    good = np.flatnonzero((scores >= reach[i]) & (ids != own[i]))
                    best = good[_best(scores[good], ids[good], k)]
                    for column, x in zip(out, ([keys[i]] * len(best), [own[i]] * len(best), ids[best], scores[best])):
                        column.extend(x)
        return pa.table({c: pa.array(np.array(x, np.int64)) for c, x in zip(("query_key", "query_id", "vec_id", "score"), out)})

    salt = F.pmod(F.xxhash64("query_key"), F.lit(split)).cast("int")
    blocks = (
        indexed.join(rings, ["cell", "ring"])
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(split - 1))))
        .select("cell", "ring", "part", "salt", "vec_id", "ints")
    )
    place = ["cell", "ring", "part", "salt"]

    def hits(asked: DataFrame, near: bool) -> DataFrame:
        wanted = (
            asked.mapInArrow(visits(near), visit_schema)
            .join(rings, ["cell", "ring"])
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("salt", salt)
        )
        return blocks.groupBy(*place).cogroup(wanted.drop("parts").groupBy(*place)).applyInArrow(look, HIT)

    order = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    first = materialize(
        hits(asked, True).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "pivot_near"
    )
    reached = first.where(F.col("rank") == k).select("query_key", F.col("score").cast("double").alias("reach"))
    rest = hits(asked.join(reached, "query_key", "left"), False)
    both = first.drop("rank").unionByName(rest)
    return (
        both.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op5_pivot_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    return search(read_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
