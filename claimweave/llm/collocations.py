"""Phrase collocations from FM-indexes over word ids.

Documents are cut into shards of bounded size. A shard is a sequence of word ids, with a separator between
pieces, so that no phrase crosses one. Its two-way FM-index keeps the word before every sorted suffix and the word
after every sorted prefix; a phrase is an interval in both orders, extended by a word on either side. Words are
extended to the left, pairs to the right, all intervals of a depth at once, with their counts.

Counts are summed over shards after each depth, and a depth extends only what is frequent in the whole language:
no phrase can be more frequent than a part of it. Counts travel packed, sorted by phrase, one row per shard
and bucket of phrases, and so do the frequent ones back to the shards that hold them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.llm.tables import materialize, read_table
from claimweave.scale import maybe_broadcast, measure, with_row_index

SHARD_BYTES = 8 << 20
# Phrase occurrences that a bucket of packed counts receives on average, and bytes of words sent to all tasks.
BUCKET_ROWS = 1 << 21
WORD_BYTES = 32 << 20
# A phrase drops out where a longer one holds at least this share of its occurrences, in percent.
COVERED = 50

_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
# 0xFF never occurs in UTF-8, so it can stand for the end of a piece.
_END = b"\xff"
_PIECE_BYTES = bytes(
    0x0A if b in _SEPARATORS else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)

SHARD = "shard bigint, symbols binary, size bigint, lang string, word string, id bigint, n bigint"
_SHARD_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
_SHARD_SCHEMA = pa.schema(list(zip(["shard", "symbols", "size", "lang", "word", "id", "n"], _SHARD_TYPES)))


def pack(ids: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane, which compresses well: most upper bytes are zero."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as byte planes of their differences."""
    return np.diff(keys, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel())


# --- shards ---------------------------------------------------------------------------


def cut_shards(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per shard one row with its word ids, 0 between pieces, and one row per word with its id and count.

    Words of different languages are different. Null lang is ``und``, null text is empty.
    """

    def build(batches):
        from collections import defaultdict
        from itertools import count

        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 24

        def rows():
            symbols = np.concatenate(found)
            ended = np.flatnonzero((symbols[1:] == 0) & (symbols[:-1] == 0)) + 1
            symbols = np.delete(symbols, ended)
            n = np.bincount(symbols, minlength=1)
            yield [[shard], [pack(symbols)], [len(symbols)], [None], [None], [None], [None]]
            for lang, words in words_of.items():
                own = np.fromiter(words.values(), np.int64, len(words))
                keep = own > 0
                names = [w for w in words if w != _END]
                size = len(names)
                yield [np.full(size, shard), [None] * size, [None] * size, [lang] * size, names, own[keep], n[own[keep]]]

        def batches_of():
            for columns in rows():
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _SHARD_TYPES)], schema=_SHARD_SCHEMA)

        next_id, words_of, found, held = count(1), {}, [], 0
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, 256):
                for i, text in enumerate(batch.column(1).slice(at, 256).cast(pa.binary()).to_pylist(), at):
                    words = words_of.get(langs[i])
                    if words is None:
                        words = words_of[langs[i]] = defaultdict(next_id.__next__)
                        words[_END] = 0
                    tokens = (text or b"").translate(_PIECE_BYTES).replace(b"\n", b" \xff ").split()
                    tokens.append(_END)
                    found.append(np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)))
                    held += len(text or b"") + 1
                    if held >= shard_bytes:
                        yield from batches_of()
                        shard += 1
                        next_id, words_of, found, held = count(1), {}, [], 0
        if found:
            yield from batches_of()

    return documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(build, SHARD)


class PhraseIndex:
    """Two-way FM-index of a shard whose suffixes are sorted by their first ``depth`` symbols.

    Row i of the forward order is a suffix, ``before[i]`` the symbol in front of it; the backward order is the
    same for the reversed sequence. An interval of the forward order stands for a phrase, and its twin in the
    backward order for the reversed phrase. Intervals of phrases up to ``depth`` symbols are exact.
    """

    def __init__(self, symbols: np.ndarray, alphabet: int, depth: int = 2):
        self.starts = np.r_[0, np.cumsum(np.bincount(symbols, minlength=alphabet))]
        self.alphabet = alphabet
        self.before, self.steps = self._order(symbols, depth)
        self.after, self.steps_back = self._order(symbols[::-1], depth)

    def _order(self, symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The transformed sequence, and for each row the row of the suffix one symbol longer."""
        rank, known = symbols.astype(np.int64), 1
        while known < depth:  # ranks by twice as many symbols; beyond the end is a separator
            ahead = np.r_[rank[known:], np.zeros(min(known, len(rank)), np.int64)]
            rank = np.unique(rank * (int(ahead.max(initial=0)) + 1) + ahead, return_inverse=True)[1]
            known *= 2
        order = np.argsort(rank, kind="stable")
        before = symbols[order - 1].astype(np.int32)
        steps = np.empty(len(order), np.int32)
        steps[np.argsort(before, kind="stable")] = np.arange(len(order), dtype=np.int32)
        return before, steps

    def _extend(self, before, steps, low, high, twin):
        size = high - low
        parent = np.repeat(np.arange(len(low)), size)
        rows = np.arange(size.sum()) + np.repeat(low - np.r_[0, np.cumsum(size)[:-1]], size)
        order = np.argsort(parent * self.alphabet + before[rows], kind="stable")
        rows, symbol = rows[order], before[rows][order]
        new = np.flatnonzero(np.r_[True, (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])]) if len(rows) else np.zeros(0, np.int64)
        count = np.diff(np.r_[new, len(rows)])
        own = parent[new]
        inside = new - np.r_[0, np.cumsum(size)[:-1]][own]
        return own, symbol[new].astype(np.int64), count, steps[rows[new]].astype(np.int64), twin[own] + inside

    def words(self, ids: np.ndarray):
        """(low, high, twin) of one-word phrases."""
        return self.starts[ids], self.starts[ids + 1], self.starts[ids]

    def left(self, low, high, twin):
        """Extensions by the word before: (number of the phrase, word, count, low, twin)."""
        return self._extend(self.before, self.steps, low, high, twin)

    def right(self, twin, size, low):
        """Extensions by the word after, from the twin interval: (number of the phrase, word, count, twin, low)."""
        return self._extend(self.after, self.steps_back, twin, twin + size, low)


def _shard_index(row: dict, ids: np.ndarray) -> PhraseIndex:
    """Index of a shard where only the words ``ids`` count, as 1, 2, ...; others end a piece."""
    symbols = unpack(row["symbols"])
    new = np.zeros(max(int(symbols.max(initial=0)), int(ids.max(initial=0))) + 1, np.int64)
    new[ids] = np.arange(1, len(ids) + 1)
    symbols = new[symbols]
    symbols = np.delete(symbols, np.flatnonzero((symbols[1:] == 0) & (symbols[:-1] == 0)) + 1)
    return PhraseIndex(symbols, len(ids) + 1)


# --- counts ---------------------------------------------------------------------------

COUNTS = "bucket int, shard bigint, keys binary, extra binary, n binary"


def _packed(shard: int, buckets: int, keys: np.ndarray, n: np.ndarray, extra: np.ndarray | None = None):
    """Rows of counts, one per bucket, each sorted by its keys."""
    bucket = ((keys if extra is None else keys * 31 + extra) * -7046029254386353131 >> 40) % buckets
    order = np.lexsort((keys, bucket) if extra is None else (extra, keys, bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[b] : cuts[b + 1]]
        yield b, shard, pack_sorted(keys[own]), b"" if extra is None else pack(extra[own]), pack(n[own])


def _count_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * 5
    return pa.table([pa.array(list(x), t) for x, t in zip(columns, kinds)], names=["bucket", "shard", "keys", "extra", "n"])


def _own_words(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids in the shard, numbers in the corpus) of the frequent words of a shard, by corpus number."""
    ids, numbers = (table.column(c).to_numpy().astype(np.int64) for c in ("id", "number"))
    order = np.argsort(numbers)
    return ids[order], numbers[order]


def _pair_intervals(index: PhraseIndex, numbers: np.ndarray):
    """All two-word phrases of a shard: keys of corpus numbers, counts, forward and backward interval starts."""
    low, high, twin = index.words(np.arange(1, index.alphabet))
    second, first, count, at, back = index.left(low, high, twin)
    real = first > 0
    keys = (numbers[first[real] - 1] << 32) | numbers[second[real]]
    return keys, count[real], at[real], back[real]


def count_pairs(shards: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    """Packed counts of the two-word phrases of frequent words, per shard and bucket."""

    def pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if right.num_rows:
            ids, numbers = _own_words(right)
            for row in left.to_pylist():
                keys, n, _, _ = _pair_intervals(_shard_index(row, ids), numbers)
                out += _packed(row["shard"], buckets, keys, n)
        return _count_table(out)

    return shards.groupBy("shard").cogroup(words.groupBy("shard")).applyInArrow(pairs, COUNTS)


def frequent_pairs(counts: DataFrame, least: int) -> DataFrame:
    """Rows (shard, keys, n) of the frequent pairs that a shard holds, and one row without shard with their totals."""

    def merge(table: pa.Table) -> pa.Table:
        rows = [(x["shard"], unpack_sorted(x["keys"]), unpack(x["n"])) for x in table.select(["shard", "keys", "n"]).to_pylist()]
        every, inverse = np.unique(np.concatenate([k for _, k, _ in rows]), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, inverse, np.concatenate([n for _, _, n in rows]))
        keep = total >= least
        out = [(None, every[keep].tobytes(), total[keep].tobytes())]
        for shard, keys, _ in rows:
            own = keys[keep[np.searchsorted(every, keys)]]
            if len(own):
                out.append((shard, own.tobytes(), b""))
        kinds = [pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(list(x), t) for x, t in zip(zip(*out), kinds)], names=["shard", "keys", "n"])

    return counts.groupBy("bucket").applyInArrow(merge, "shard bigint, keys binary, n binary")


def count_triples(shards: DataFrame, words: DataFrame, kept: DataFrame, buckets: int) -> DataFrame:
    """Packed counts of the three-word phrases whose two pairs are frequent, per shard and bucket."""
    own = words.select("shard", "id", "number", F.lit(None).cast("binary").alias("keys")).unionByName(
        kept.where("shard IS NOT NULL").select(
            "shard", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("number"), "keys"
        )
    )

    def triples(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, "<i8") for x in right.column("keys").to_pylist() if x is not None]
        out = []
        if parts:
            frequent = np.sort(np.concatenate(parts))
            ids, numbers = _own_words(right.filter(right.column("id").is_valid()))
            for row in left.to_pylist():
                index = _shard_index(row, ids)
                keys, n, low, back = _pair_intervals(index, numbers)
                good = np.flatnonzero(np.isin(keys, frequent))
                parent, third, count, _, _ = index.right(back[good], n[good], low[good])
                real = third > 0
                first, third, count = keys[good][parent[real]], numbers[third[real] - 1], count[real]
                both = np.isin(((first & 0xFFFFFFFF) << 32) | third, frequent)
                out += _packed(row["shard"], buckets, first[both], count[both], third[both])
        return _count_table(out)

    return shards.groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(triples, COUNTS)


def frequent_triples(counts: DataFrame, least: int) -> DataFrame:
    """(w1, w2, w3, a) of the frequent three-word phrases."""

    def merge(table: pa.Table) -> pa.Table:
        keys, extra, n = (
            np.concatenate([f(x) for x in table.column(c).to_pylist()])
            for c, f in (("keys", unpack_sorted), ("extra", unpack), ("n", unpack))
        )
        order = np.lexsort((extra, keys))
        keys, extra, n = keys[order], extra[order], n[order]
        new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (extra[1:] != extra[:-1])])
        total = np.add.reduceat(n, new)
        keep = total >= least
        keys, extra = keys[new][keep], extra[new][keep]
        return pa.table({"w1": keys >> 32, "w2": keys & 0xFFFFFFFF, "w3": extra, "a": total[keep]})

    return counts.groupBy("bucket").applyInArrow(merge, "w1 bigint, w2 bigint, w3 bigint, a bigint")


def _unpacked(totals: DataFrame) -> DataFrame:
    """(w1, w2, a) of the rows of totals."""

    def rows(batches):
        for batch in batches:
            for keys, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = np.frombuffer(keys, "<i8")
                yield pa.RecordBatch.from_pydict({"w1": keys >> 32, "w2": keys & 0xFFFFFFFF, "a": np.frombuffer(n, "<i8")})

    return totals.where("shard IS NULL").select("keys", "n").mapInArrow(rows, "w1 bigint, w2 bigint, a bigint")


# --- phrases --------------------------------------------------------------------------


def _score(l: str, r: str) -> F.Column:
    """floor(1000000 * a * a / (l * r)) with 38 digits; counts have at most 15."""
    whole = "CAST({} AS DECIMAL(15, 0))".format
    return F.expr(f"({whole('a')} * {whole('a')} * CAST(1000000 AS DECIMAL(7, 0))) DIV ({whole(l)} * {whole(r)})")


def mine_phrases(documents: DataFrame, least: int = 10, best: int = 2000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of two or three words of each language.

    ``documents`` has (lang, text); further columns are ignored, repeated rows count each time, an empty table
    gives no rows. Up to 2**31 frequent words are told apart.
    """
    spark = documents.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = materialize(cut_shards(documents, shard_bytes), "shards")
    vocabulary = cut.where("word IS NOT NULL").select("shard", "lang", "word", "id", "n")
    counts = vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    counts = materialize(counts, "word_counts")
    sizes = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = materialize(
        with_row_index(counts.where(F.col("f") >= least), [F.col("lang"), F.col("word")], "number"), "frequent_words"
    )
    measured = measure(frequent)
    names = maybe_broadcast(frequent.select("lang", "word", "number"), measured.fits(limit=WORD_BYTES))
    words = materialize(vocabulary.join(names, ["lang", "word"]).select("shard", "id", "number"), "words")
    shards = cut.where("symbols IS NOT NULL").select("shard", "symbols")

    total = cut.agg(F.sum("size").alias("s")).first()["s"] or 0
    buckets = max(tasks, -(-total // BUCKET_ROWS))
    by_shard = words.repartition(tasks, "shard")
    counted = count_pairs(shards.repartition(tasks, "shard"), by_shard, buckets)
    kept = materialize(frequent_pairs(counted.repartition(tasks, "bucket"), least), "pairs")
    counted = count_triples(shards.repartition(tasks, "shard"), by_shard, kept, buckets)
    triples = materialize(frequent_triples(counted.repartition(tasks, "bucket"), least), "triples")
    pairs = materialize(_unpacked(kept), "pair_totals")

    def word(number: str, count: str) -> DataFrame:
        return frequent.select(F.col("number").alias(number), F.col("f").alias(count))

    def pair(first: str, second: str, count: str) -> DataFrame:
        return pairs.select(F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(count))

    # the largest extension of a pair to either side
    longer = (
        triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
        .groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    )
    two = (
        pairs.join(longer, ["w1", "w2"], "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("a")))
        .join(word("w1", "l"), "w1").join(word("w2", "r"), "w2")
        .select("w1", "w2", F.lit(None).cast("bigint").alias("w3"), "a", "l", "r", _score("l", "r").alias("score"))
    )
    cuts = (
        triples.join(pair("w1", "w2", "l2"), ["w1", "w2"]).join(pair("w2", "w3", "r1"), ["w2", "w3"])
        .join(word("w1", "l1"), "w1").join(word("w3", "r2"), "w3")
        .withColumns({"s1": _score("l1", "r1"), "s2": _score("l2", "r2")})
    )
    first = F.col("s1") <= F.col("s2")
    three = cuts.select(
        "w1", "w2", "w3", "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )

    def named(number: str, text: str, lang: bool = False) -> DataFrame:
        return frequent.select(F.col("number").alias(number), F.col("word").alias(text), *(["lang"] if lang else []))

    scored = two.unionByName(three).join(frequent.select(F.col("number").alias("w1"), "lang"), "w1")
    # texts are only fetched for phrases that can be among the best; ties of the last place stay
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = scored.withColumn("place", F.rank().over(place)).where(F.col("place") <= best)
    texts = (
        near.join(named("w1", "t1"), "w1").join(named("w2", "t2"), "w2").join(named("w3", "t3"), "w3", "left")
        .withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        texts.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= best)
        .join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 best phrases of two or three words of each language."""
    return mine_phrases(read_table(spark, folder, "documents"))


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12_SQL = rf"""
WITH p AS (SELECT row_number() OVER () AS piece, lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOW}, '[.,;:!?\x0A-\x0D]')) AS x FROM documents)),
t AS (SELECT piece, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM p),
g AS (SELECT lang, w1, lead(w1, 1) OVER (PARTITION BY piece ORDER BY i) AS w2, lead(w1, 2) OVER (PARTITION BY piece ORDER BY i) AS w3 FROM t),
f1 AS (SELECT lang, w1, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
f2 AS (SELECT lang, w1, w2, count(*)::HUGEINT AS a FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*)::HUGEINT AS a FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
x AS (SELECT lang, w1, w2, max(a) AS longer FROM (SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL),
two AS (SELECT f2.lang, concat(f2.w1, ' ', f2.w2) AS phrase, f2.a, u.f AS l, v.f AS r, (1000000 * f2.a * f2.a) // (u.f * v.f) AS score
  FROM f2 LEFT JOIN x ON x.lang = f2.lang AND x.w1 = f2.w1 AND x.w2 = f2.w2
  JOIN f1 u ON u.lang = f2.lang AND u.w1 = f2.w1 JOIN f1 v ON v.lang = f2.lang AND v.w1 = f2.w2
  WHERE longer IS NULL OR 100 * longer < 50 * f2.a),
c AS (SELECT f3.lang, concat(f3.w1, ' ', f3.w2, ' ', f3.w3) AS phrase, f3.a, u.f AS l1, q.a AS r1, p2.a AS l2, v.f AS r2,
  (1000000 * f3.a * f3.a) // (u.f * q.a) AS s1, (1000000 * f3.a * f3.a) // (p2.a * v.f) AS s2
  FROM f3 JOIN f1 u ON u.lang = f3.lang AND u.w1 = f3.w1 JOIN f1 v ON v.lang = f3.lang AND v.w1 = f3.w3
  JOIN f2 p2 ON p2.lang = f3.lang AND p2.w1 = f3.w1 AND p2.w2 = f3.w2 JOIN f2 q ON q.lang = f3.lang AND q.w1 = f3.w2 AND q.w2 = f3.w3),
s AS (SELECT * FROM two UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM k JOIN n USING (lang) WHERE rank <= 2000"""
