"""TF-IDF over words and characters, term by term: the plain form of the index.

Terms are counted text by text in NumPy and stay in lists, one or a few rows per article; single postings become
rows (``term_counts``) only where they are joined with a vocabulary.

Weight of a term in an article: (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), then every
article is scaled to unit length. Terms outside the fitted vocabulary are ignored.

The stored index is built and scored in packed lists (``inverted``); claims are weighed here.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions.text import INDEX_TOKEN, search_text, tokens
from claimweave.scale import (
    all_salts,
    materialize,
    measure,
    salt_of,
    salts_for,
    with_row_index,
)

WORD, CHAR = "word", "char"
SCORE_DECIMALS = 8


@dataclass(frozen=True)
class Analyzer:
    """How one channel cuts text and which terms it keeps."""

    min_df: int
    max_df: float | None


ANALYZERS = {
    WORD: Analyzer(min_df=2, max_df=0.98),
    CHAR: Analyzer(min_df=3, max_df=None),
}
# The preset of most terms per channel.
FIXED_TERMS = {WORD: 300_000, CHAR: 200_000}


# Characters whose runs are counted at once, terms in one list, and keys that fit one number.
CHUNK_CHARS, LIST_TERMS, KEY_LIMIT = 1 << 16, 1 << 16, 1 << 62
RUN_LENGTHS = (3, 4, 5)


def index_words(text: Column) -> Column:
    """The words of the lower-cased text, joined by a space; a word is a run of two or more word characters."""
    return F.array_join(tokens(F.lower(text), INDEX_TOKEN), " ")


def squeezed(text: Column) -> Column:
    """The lower-cased text with one space for runs of white space."""
    return F.regexp_replace(F.lower(text), r"(?U)[\s\x1c-\x1f]{2,}", " ")


CUT_TEXTS = {WORD: index_words, CHAR: squeezed}


def _tally(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys ascending, and how often each occurs."""
    key = np.sort(key)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.diff(np.r_[first, len(key)]).astype(np.int32)


def _strings(points: np.ndarray) -> pa.Array:
    """Rows of code points as an Arrow column of strings."""
    if points.max(initial=0) < 128:
        size, data = np.full(len(points), points.shape[1]), points.astype(np.uint8).tobytes()
    else:
        size = (1 + (points >= 1 << 7) + (points >= 1 << 11) + (points >= 1 << 16)).sum(axis=1)
        data = np.ascontiguousarray(points.astype("<u4")).tobytes().decode("utf-32-le").encode()
    bounds = np.r_[0, np.cumsum(size)].astype(np.int32)
    return pa.StringArray.from_buffers(len(points), pa.py_buffer(bounds), pa.py_buffer(data))


def char_counts(texts: list[str], owners: np.ndarray):
    """(owners, terms, counts) of the runs of three, four and five characters, owners ascending."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
    size = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(owners, size)
    room = np.repeat(np.cumsum(size), size) - np.arange(len(codes))
    present = np.zeros(int(codes.max(initial=0)) + 1, bool)
    present[codes] = True
    alphabet, codes = np.flatnonzero(present), (np.cumsum(present) - 1)[codes]
    base, bits = max(len(alphabet), 1), max(len(alphabet) - 1, 1).bit_length()
    for n in RUN_LENGTHS:
        start = np.flatnonzero(room >= n)
        if not len(start):
            continue
        if int(owners[-1] + 1) << bits * n < KEY_LIMIT:
            key = owner[start]
            for j in range(n):
                key = (key << bits) | codes[start + j]
            key, tf = _tally(key)
            digits = np.stack([key >> bits * (n - 1 - j) & (1 << bits) - 1 for j in range(n)], axis=1)
            of = key >> bits * n
        else:  # a large alphabet: number the runs first
            key = codes[start]
            for j in range(1, n):
                key = np.unique(key * base + codes[start + j], return_inverse=True)[1]
            at, runs = np.unique(key, return_index=True)[1], int(key.max()) + 1
            key, tf = _tally(owner[start] * runs + key)
            digits, of = np.stack([codes[start[at] + j] for j in range(n)], axis=1)[key % runs], key // runs
        yield of, _strings(alphabet[digits]), tf


def word_counts(texts: list[str], owners: np.ndarray):
    """(owners, terms, counts) of words, then of two neighbouring words of a text, owners ascending."""
    split = pc.split_pattern(pa.array(texts, pa.string()), " ")
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    words = split.flatten().dictionary_encode()
    names, word = words.dictionary, words.indices.to_numpy().astype(np.int64)
    base = len(names)
    key, tf = _tally(owners[row] * base + word)
    yield key // base, names.take(pa.array(key % base)), tf
    pair = np.flatnonzero(row[1:] == row[:-1])
    if not len(pair):
        return
    both, two = np.unique(word[pair] * base + word[pair + 1], return_inverse=True)
    key, tf = _tally(owners[row[pair]] * len(both) + two)
    both, of = both[key % len(both)], key // len(both)
    yield of, pc.binary_join_element_wise(names.take(pa.array(both // base)), names.take(pa.array(both % base)), " "), tf


COUNTERS = {WORD: word_counts, CHAR: char_counts}


def _lists(keys: pa.Array, of: np.ndarray, terms: pa.Array, tf: np.ndarray) -> pa.RecordBatch:
    """Rows (key, terms, tfs): the terms of each owner, in lists of at most ``LIST_TERMS``."""
    cuts = np.union1d(np.flatnonzero(np.r_[True, of[1:] != of[:-1]]), np.arange(0, len(of), LIST_TERMS))
    bounds = pa.array(np.r_[cuts, len(of)].astype(np.int32))
    columns = [keys.take(pa.array(of[cuts])), pa.ListArray.from_arrays(bounds, terms), pa.ListArray.from_arrays(bounds, pa.array(tf))]
    return pa.RecordBatch.from_arrays(columns, ["key", "terms", "tfs"])


def term_lists(texts: DataFrame, channel: str, key: str = "article_id", text: str = "search_text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(key, terms, tfs) of ``dealt`` texts: the distinct terms of a key and their counts.

    They lie in one or more rows, each term in one of them only. Keys without terms have no row. Neighbouring texts
    are counted together, up to ``chunk_chars`` characters; a key whose texts are longer is summed from chunks.
    """
    kind = texts.schema[key].dataType

    def count(batches):
        counter, keys, rows, owners, held, rest = COUNTERS[channel], [], [], [], 0, Counter()

        def done(last: int):
            """Lists of the first ``last`` keys; counts of a further one are kept for its next texts."""
            whole = pa.array(keys, key_type)
            for of, terms, tf in counter(rows, np.array(owners, np.int64)) if rows else ():
                upto = int(np.searchsorted(of, last))
                if upto:
                    yield _lists(whole, of[:upto], terms.slice(0, upto), tf[:upto])
                for term, n in zip(terms.slice(upto).to_pylist(), tf[upto:].tolist()):
                    rest[term] += n

        def summed():
            terms, tf = list(rest), np.fromiter(rest.values(), np.int32, len(rest))
            for at in range(0, len(terms), LIST_TERMS):
                some = tf[at : at + LIST_TERMS]
                yield _lists(pa.array(keys[-1:], key_type), np.zeros(len(some), np.int64), pa.array(terms[at : at + LIST_TERMS], pa.string()), some)
            rest.clear()

        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 256):
                for k, t in zip(*(column.to_pylist() for column in batch.slice(at, 256).columns)):
                    if not t:
                        continue
                    new = not keys or k != keys[-1]
                    if rest and new:  # the last key is complete
                        yield from done(0)
                        yield from summed()
                        keys, rows, owners, held = [], [], [], 0
                    elif rows and held + len(t) > chunk_chars:
                        yield from done(len(keys) if new else len(keys) - 1)
                        keys, rows, owners, held = ([] if new else keys[-1:]), [], [], 0
                    if new:
                        keys.append(k)
                    rows.append(t)
                    owners.append(len(keys) - 1)
                    held += len(t)
        if rest:
            yield from done(0)
            yield from summed()
        else:
            yield from done(len(keys))

    cut = texts.select(key, CUT_TEXTS[channel](F.col(text)).alias("text"))
    found = cut.mapInArrow(count, f"key {kind.simpleString()}, terms array<string>, tfs array<int>")
    return found.withColumnRenamed("key", key)


def term_counts(texts: DataFrame, channel: str, key: str = "article_id", text: str = "search_text") -> DataFrame:
    """(key, term, tf) of every text, see :func:`term_lists`."""
    lists = term_lists(texts, channel, key, text)
    return lists.select(key, F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf"))))


def search_texts(articles: DataFrame) -> DataFrame:
    text = search_text(F.col("title"), F.col("content"))
    return articles.select("article_id", text.alias("search_text"))


def dealt(rows: DataFrame, key: str = "article_id") -> DataFrame:
    """Rows hashed on their id, those of one id side by side.

    The number of partitions is explicit: taken apart, texts grow a hundredfold, so runtime
    coalescing by the size of the texts would leave far too few tasks.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, key).sortWithinPartitions(key)


def posting_lists(articles: DataFrame, channel: str) -> DataFrame:
    """(article_id, terms, tfs): the postings of a channel, packed by article."""
    return term_lists(search_texts(dealt(articles)), channel)


def word_postings(articles: DataFrame) -> DataFrame:
    return term_counts(search_texts(dealt(articles)), WORD)


def char_postings(articles: DataFrame) -> DataFrame:
    return term_counts(search_texts(dealt(articles)), CHAR)


def document_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").cast("bigint").alias("total")
    )


def prune_df(terms: DataFrame, n_articles: int, analyzer: Analyzer) -> DataFrame:
    """Drop rare terms and, where the analyzer says so, near-universal ones."""
    keep = F.col("df") >= analyzer.min_df
    if analyzer.max_df is not None:
        keep = keep & (F.col("df") <= F.lit(analyzer.max_df * n_articles))
    return terms.where(keep)


def cap_vocabulary(terms: DataFrame, max_terms: int) -> DataFrame:
    """Most frequent terms, ties by the term. Ranked over all tasks, not in one."""
    order = [F.desc("total"), F.col("term")]
    return with_row_index(terms, order, "_rank").where(F.col("_rank") <= max_terms).drop("_rank")


def weigh_terms(terms: DataFrame, n_articles: int) -> DataFrame:
    """idf, and the number of salts a term with very many articles is split over."""
    idf = F.log((F.lit(1.0) + n_articles) / (F.lit(1.0) + F.col("df"))) + 1.0
    return terms.select(
        "term", "df", "total", idf.alias("idf"), salts_for(F.col("df")).alias("salts")
    )


def fit_vocabulary(
    postings: DataFrame, n_articles: int, channel: str, max_terms: int | None = None
) -> DataFrame:
    """The vocabulary of (key, term, tf) rows, see :func:`fit_terms`."""
    return fit_terms(document_frequency(postings), n_articles, channel, max_terms)


def fit_terms(
    frequencies: DataFrame, n_articles: int, channel: str, max_terms: int | None = None
) -> DataFrame:
    """(term, df, total, idf, salts) of (term, df, total): pruned, weighed, and capped only if ``max_terms`` is given."""
    kept = materialize(prune_df(frequencies, n_articles, ANALYZERS[channel]), f"terms_{channel}")
    # the count comes from file metadata; ranking is needed only beyond the cap
    if max_terms is not None and kept.count() > max_terms:
        kept = cap_vocabulary(kept, max_terms)
    return weigh_terms(kept, n_articles)


def tfidf(counts: DataFrame, vocabulary: DataFrame, key: str = "article_id") -> DataFrame:
    """Unit-length weighted postings (key, term, w, salts).

    A vocabulary is broadcast only if it is measured small. Otherwise both sides shuffle on the term, and
    a term found in very many articles is spread over its salts. The norm is a window over the key.
    """
    terms = vocabulary.select("term", "idf", "salts")
    if measure(terms).fits():
        joined = counts.join(F.broadcast(terms), "term")
    else:
        # A hot term has over a million articles, so these are few.
        hot = terms.where("salts > 1").select("term", F.col("salts").alias("_salts"))
        salt = salt_of(F.col(key), F.coalesce(F.col("_salts"), F.lit(1)))
        dealt = counts.join(F.broadcast(hot), "term", "left").withColumn("_salt", salt).drop("_salts")
        joined = dealt.join(terms.withColumn("_salt", all_salts(F.col("salts"))), ["term", "_salt"]).drop("_salt")
    raw = joined.withColumn("raw", (1.0 + F.log(F.col("tf").cast("double"))) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / norm).alias("w"), "salts")


def query_weights(
    claims: DataFrame, text: str, vocabulary: DataFrame, channel: str
) -> DataFrame:
    """Claim texts through the fitted vocabulary: (claim_id, term, w, salts)."""
    counts = term_counts(dealt(claims.select("claim_id", text), "claim_id"), channel, key="claim_id", text=text)
    return tfidf(counts, vocabulary, key="claim_id")


def lexical_scores(
    weights: DataFrame, postings: DataFrame, names: list[str], small: bool
) -> DataFrame:
    """Cosine of every claim with every article it shares a term with.

    ``weights`` has (claim_id, term, salts) and one weight column per name in ``names``;
    the result has (article_id, claim_id) and one score per name. Where both sides have a
    ``channel``, terms meet within their channel. A small claim side is broadcast, so
    postings stay where they are and, read from a table bucketed by article, are summed
    without a shuffle. Otherwise both sides shuffle on the term, and a term found in very
    many articles is spread over as many salts as its frequency asks for.
    """
    key = ["channel", "term"] if "channel" in postings.columns else ["term"]
    if small:
        joined = postings.join(F.broadcast(weights.drop("salts")), key)
    else:
        salted = postings.withColumn("salt", salt_of(F.col("article_id"), F.col("salts")))
        asked = weights.withColumn("salt", all_salts(F.col("salts"))).drop("salts")
        joined = salted.join(asked, [*key, "salt"])
    sums = [
        F.round(F.coalesce(F.sum(F.col("w") * F.col(n)), F.lit(0.0)), SCORE_DECIMALS).alias(n)
        for n in names
    ]
    return joined.groupBy("article_id", "claim_id").agg(*sums)
