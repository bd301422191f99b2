"""Ranked lexical search by presence masks.

Documents are cut into blocks of bounded size, and each block becomes an inverted file: for every term the
positions of its documents and their counts. A block answers an item with bit operations: every document gets
the mask of the item's terms that it holds, documents are grouped by mask, and a mask's best possible score is
the sum of its terms' largest contributions in the block. Masks are scored from the best one down until no
mask left can reach the k-th score, so the k best documents of a block are exact, and so are those of the table.

Blocks, and parts of at most ``ITEMS`` items, are dealt out as groups; neither documents nor items ever meet in
one task or the driver, and only terms that some item asks for leave the index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.llm.tables import materialize, read_table
from claimweave.scale import maybe_broadcast, measure

# Bytes of text in a block (a longer text is a block of its own), and items that a group answers.
BLOCK_BYTES = 8 << 20
ITEMS = 1024
# The vocabulary of the items is sent to the index only up to so many bytes.
TERM_BYTES = 32 << 20

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LETTERS = bytes(range(ord("A"), ord("Z") + 1))
# Byte by byte: signs and controls become spaces, A-Z small letters; all bytes beyond ASCII belong to terms.
_TERM_BYTES = bytes(
    b + 32 if b in _LETTERS else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)

INDEX = "block bigint, term string, n_docs bigint, n_terms bigint, docs binary, counts binary, ids array<bigint>"


def _block_rows(block: int, ids: list, lengths: list[int], vocabulary: dict, found: list[np.ndarray]):
    """The head row of a block (document ids and lengths) and a row for each of its terms."""
    n = np.array(lengths, "<i8")
    head = [[block], [None], [int((n > 0).sum())], [int(n.sum())], [None], [n.tobytes()], [ids]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(head, _TYPES)], schema=_SCHEMA
    )
    if not vocabulary:
        return
    term = np.concatenate(found).astype(np.int64)
    pair, tf = np.unique(term * len(ids) + np.repeat(np.arange(len(ids)), n), return_counts=True)
    term, doc = pair // len(ids), (pair % len(ids)).astype("<u4")
    cuts = np.searchsorted(term, np.arange(len(vocabulary) + 1))
    bounds = (cuts * 4).tolist()
    data, counts = doc.tobytes(), tf.astype("<u4").tobytes()
    spans = list(zip(bounds, bounds[1:]))
    size = len(vocabulary)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(size, block)), pa.array(list(vocabulary), pa.string()), pa.array(np.diff(cuts)),
            pa.nulls(size, pa.int64()), pa.array([data[a:z] for a, z in spans], pa.binary()),
            pa.array([counts[a:z] for a, z in spans], pa.binary()), pa.nulls(size, pa.list_(pa.int64())),
        ],
        schema=_SCHEMA,
    )


_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
_SCHEMA = pa.schema(list(zip(["block", "term", "n_docs", "n_terms", "docs", "counts", "ids"], _TYPES)))


def index_documents(documents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Inverted blocks of (doc_id, text): a row per block and term, and one without term for the block itself.

    Null and empty texts are documents without terms. Rows are indexed one by one: repeated or null ids stay.
    """

    def build(batches):
        from collections import defaultdict
        from itertools import count

        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32

        def fresh():
            return [], [], defaultdict(count().__next__), []

        ids, lengths, vocabulary, found = fresh()
        held = 0
        for batch in batches:
            own = batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, 256):
                for i, text in enumerate(batch.column(1).slice(at, 256).cast(pa.binary()).to_pylist(), at):
                    terms = (text or b"").translate(_TERM_BYTES).split()
                    ids.append(own[i])
                    lengths.append(len(terms))
                    found.append(np.fromiter(map(vocabulary.__getitem__, terms), np.int32, len(terms)))
                    held += len(text or b"") + 8
                    if held >= block_bytes:
                        yield from _block_rows(first, ids, lengths, vocabulary, found)
                        first, held = first + 1, 0
                        ids, lengths, vocabulary, found = fresh()
        if ids:
            yield from _block_rows(first, ids, lengths, vocabulary, found)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(build, INDEX)


def _masks(size: int, terms: list[np.ndarray]) -> np.ndarray:
    """For every document a row of 64-bit words: bit j says that it holds term j."""
    masks = np.zeros((size, (len(terms) + 63) // 64), np.uint64)
    for j, docs in enumerate(terms):
        masks[docs, j // 64] |= np.uint64(1 << (j % 64))
    return masks


def _grouped(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents with a mask, sorted by mask; where each distinct mask starts (and the end); the distinct masks."""
    docs = np.flatnonzero(masks.any(axis=1))
    own = masks[docs]
    order = np.lexsort(own.T)
    docs, own = docs[order], own[order]
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]).any(axis=1)]) if len(docs) else np.zeros(0, np.int64)
    return docs, np.r_[new, len(docs)], own[new]


def best_documents(
    docs: list[np.ndarray], shares: list[np.ndarray], weights: np.ndarray, keys: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the k best of a block for one item.

    For each term of the item: its documents, their contributions and the term's weight. ``keys`` holds the rank
    of every document's id, which settles equal scores.
    """
    rows, starts, masks = _grouped(_masks(len(keys), docs))
    most = weights * np.array([x.max() for x in shares])
    bits = (masks[:, np.arange(len(docs)) // 64] >> (np.arange(len(docs)) % 64).astype(np.uint64)) & np.uint64(1)
    bound = bits.astype(np.int64) @ most
    order = np.argsort(-bound, kind="stable")
    best, scores, done, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 16
    while done < len(order) and (len(best) < k or bound[order[done]] >= scores[-1]):
        some = order[done : done + step]
        sizes = starts[some + 1] - starts[some]
        at = np.repeat(starts[some] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        own = np.sort(rows[at])
        score = np.zeros(len(own), np.int64)
        for have, share, weight in zip(docs, shares, weights):
            i = np.searchsorted(have, own)
            i[i == len(have)] = 0
            score += np.where(have[i] == own, weight * share[i], 0)
        best, scores = np.r_[best, own], np.r_[scores, score]
        top = np.lexsort((keys[best], -scores))[:k]
        best, scores = best[top], scores[top]
        done, step = done + step, step * 2
    return best, scores


def _lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The length measure m of documents with n terms."""
    if 90 * n_docs * int(n.max(initial=0)) < 1 << 63:
        return 10 + 90 * n_docs * n // n_terms
    return np.array([10 + 90 * n_docs * x // n_terms for x in n.tolist()], np.int64)


FOUND = "item_key bigint, doc_id bigint, score bigint"


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents with a score above 0 of every item row: (item_key, item_id, rank, doc_id, score).

    ``index`` comes from ``index_documents`` and has been written; ``items`` has (item_id, text). Null or empty
    items, and items without a known term, have no rows; repeated items are answered each; equal scores go by
    ascending doc_id, null last. ``item_key`` tells item rows apart.
    """
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = materialize(
        items.select(
            F.monotonically_increasing_id().alias("item_key"), F.col("item_id").cast("bigint").alias("item_id"),
            F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("terms"),
        ),
        "items",
    )
    total = index.where("term IS NULL").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = total["n"] or 0, total["l"] or 0
    parts = -(-asked.count() // ITEMS) or 1
    pairs = asked.select(
        "item_key", F.pmod(F.xxhash64("item_key"), F.lit(parts)).cast("int").alias("part"), F.explode("terms").alias("term")
    )
    words = materialize(pairs.select("term").distinct(), "item_terms")
    small = measure(words).fits(limit=TERM_BYTES)
    postings = materialize(
        index.where("term IS NOT NULL").select("block", "term", "n_docs", "docs", "counts").join(maybe_broadcast(words, small), "term"),
        "postings",
    )
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.sum("n_docs") + 1))).cast("bigint")
    weights = postings.groupBy("term").agg(weight.alias("weight")).where("weight > 0")
    # at most ITEMS item keys a row
    wanted = pairs.groupBy("term", "part").agg(F.sort_array(F.collect_list("item_key")).alias("keys")).join(weights, "term")
    hits = postings.join(maybe_broadcast(wanted, small), "term").select(
        "block", "part", "docs", "counts", "weight", "keys", F.lit(None).cast("array<bigint>").alias("ids")
    )
    heads = index.where("term IS NULL").select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(None).cast("binary").alias("docs"), "counts",
        F.lit(None).cast("bigint").alias("weight"), F.lit(None).cast("array<bigint>").alias("keys"), "ids",
    )

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(x for x in rows if x["ids"] is not None)
        terms = [x for x in rows if x["ids"] is None]
        ids = head["ids"]
        m = _lengths(np.frombuffer(head["counts"], "<i8"), n_docs, max(n_terms, 1))
        keys = np.empty(len(ids), np.int64)
        keys[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))] = np.arange(len(ids))
        docs = [np.frombuffer(x["docs"], "<u4").astype(np.int64) for x in terms]
        tfs = [np.frombuffer(x["counts"], "<u4").astype(np.int64) for x in terms]
        shares = [1_000_000_000 * tf // (1000 * tf + 8 * m[doc]) for doc, tf in zip(docs, tfs)]
        weights = np.array([x["weight"] for x in terms], np.int64)
        own: dict[int, list[int]] = {}
        for j, x in enumerate(terms):
            for key in x["keys"]:
                own.setdefault(key, []).append(j)
        out: list[list] = [[], [], []]
        for key, js in own.items():
            best, scores = best_documents([docs[j] for j in js], [shares[j] for j in js], weights[js], keys, k)
            for column, values in zip(out, ([key] * len(best), [ids[doc] for doc in best.tolist()], scores.tolist())):
                column += values
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["item_key", "doc_id", "score"])

    # an explicit number of tasks: the rows are few bytes, but much work
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = hits.unionByName(heads).repartition(tasks, "block", "part").groupBy("block", "part")
    found = groups.applyInArrow(answer, FOUND).where("score > 0")
    order = Window.partitionBy("item_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item_key", "item_id"), "item_key").select("item_key", "item_id", "rank", "doc_id", "score")


def rank_documents(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item; further columns are ignored."""
    index = materialize(index_documents(documents), "inverted")
    return search(index, items, k).drop("item_key")


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 best documents for every benchmark item."""
    return rank_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


_SQL_TERMS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
OP13_SQL = f"""
WITH d AS (SELECT doc_id, unnest({_SQL_TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, tot),
m AS (SELECT doc_id, 100 - 90 + ((90 * n * nn) // ll) AS m FROM len, tot),
q AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10"""
