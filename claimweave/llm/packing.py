"""Packing documents into sequences by shortest-pack-first over the length histogram.

Documents are encoded and cut into pieces of ``size`` ids and one shorter rest. The
histogram of piece lengths, at most ``size`` numbers, is packed on the driver: lengths are placed
longest first, each into the packs with the most room, as counts of packing patterns. Pieces are
then ranked within their length and take the places of their length in the patterns by rank.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import tokens
from claimweave.llm.tables import add_running, bucket_count, hash_bucket, lean, materialize, read_table

SIZE = 2048
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def cut_documents(documents: DataFrame, tokenizer: str, end_id: int, size: int = SIZE) -> DataFrame:
    """Pieces of all documents: whole ones of ``size`` ids, and what is left.

    Every document ends with ``end_id``; null text is the empty text, with that id alone.
    """

    def cut(batches):
        coder = tokens.encoder(tokenizer)
        end = np.array([end_id], coder.dtype).tobytes()
        for batch in batches:
            own = batch.column(0).to_pylist()
            for first, group in tokens.text_batches(batch.column(1)):
                rows: list[list] = [[], [], [], [], []]
                for i, found in enumerate(coder.encode(group), first):
                    ids = np.frombuffer(found + end, coder.dtype).astype("<u4")
                    for at in range(0, len(ids), size):
                        piece = ids[at : at + size]
                        for column, x in zip(rows, (own[i], at, len(piece), zlib.crc32(piece.tobytes()), len(ids))):
                            column.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in rows], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(lean(cut), PIECE)


def pack_histogram(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of packing patterns that hold every length as often as the histogram says.

    Where no pack has room for a length, new packs take as many of it as fit.
    """
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)  # patterns by free ids
    order: list[int] = []  # negative free ids, a heap

    def put(free: int, count: int, lengths: tuple[int, ...]) -> None:
        if count:
            if not room[free]:
                heapq.heappush(order, -free)
            room[free].append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while order and not room[-order[0]]:
                heapq.heappop(order)
            if order and -order[0] >= length:
                free = -order[0]
                count, lengths = room[free].pop()
                used = min(count, left)
                put(free, count - used, lengths)
                put(free - length, used, (*lengths, length))
                left -= used
            else:
                most = size // length
                put(size - most * length, left // most, (length,) * most)
                put(size - left % most * length, int(left % most > 0), (length,) * (left % most))
                left = 0
    return [pattern for free in sorted(room) for pattern in room[free]]


def pattern_places(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For every length: first rank, first sequence and offset of its places, in order of rank."""
    places: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    base = 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            places[length].append((taken[length], base, offset))
            taken[length] += count
            offset += length
        base += count
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in places.items()}


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with (doc_id, start, length, ids_crc32, doc_tokens).

    Pieces of equal length are dealt out in a seeded order, so reruns agree. Empty stays empty.
    """
    counts = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``size`` rows
    histogram = {r["length"]: r["n"] for r in counts}
    places = pattern_places(pack_histogram(histogram, size))
    keys = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    drawn = pieces.withColumn("draw", F.xxhash64(*keys))
    drawn = drawn.withColumn("bucket", hash_bucket(F.col("draw"), bucket_count(sum(histogram.values()))))
    ranked = add_running(drawn, ["length"], "bucket", [F.col("draw"), *map(F.col, keys)], F.lit(1), "rank")

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros((2, batch.num_rows), np.int64)
            for x in np.unique(length):
                first, base, at = places[int(x)]
                own = np.flatnonzero(length == x)
                i = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own], offset[own] = base[i] + rank[own] - first[i], at[i]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    columns = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("rank").cast("bigint"))
    return columns.mapInArrow(place, PIECE + ", sequence_id bigint, offset bigint")


def pack_documents(
    documents: DataFrame, tokenizer: str | None = None, end_id: int = 1, size: int = SIZE
) -> DataFrame:
    """All documents of a table packed: one row per piece."""
    pieces = cut_documents(documents, tokenizer or tokens.default_path(), end_id, size)
    return pack(materialize(pieces, "pieces"), size)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return pack_documents(read_table(spark, folder, "documents"))
