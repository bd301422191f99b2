"""The inverted file: packed lists of articles per term, and the lookups on it.

Articles are cut into chunks of bounded size. A chunk has one row for itself (its article ids, ascending), one row
with the words of its identity texts, and per channel one packed row for each part of the terms: the terms, in how
many articles each is, these articles as differences of positions, and how often each has the term (nothing if all
have it once). Weights are not stored: a row has the frequencies of its terms in all articles, a chunk the lengths of
its articles, and a lookup makes the weights of the lists it needs. Rows are made, merged and scored in NumPy; single
postings and the terms of a chunk never become rows.

On disk the file is bucketed by chunk: a batch of claims is packed by channel and part of the term and joined to the
rows where they lie, so that no list crosses the network.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions.text import INDEX_TOKEN, digits, fold, nfkc, normalize_text, search_text, text_or_blank, tokens
from claimweave.operators.lexical import ANALYZERS, CHAR, SCORE_DECIMALS, WORD
from claimweave.scale import BROADCAST_BYTES, ROWS_PER_SALT, give_back, materialize, maybe_broadcast

TOKEN, HEAD = "token", "head"
# A chunk ends beyond so many characters or articles.
CHUNK_CHARS, CHUNK_ARTICLES = 4 << 20, 8192
# Claims that are looked up in a chunk at once.
CLAIMS = 256
# Pairs of a claim and an article that are summed in one step, and frequent terms in one product.
PAIRS, SLAB = 1 << 22, 1024
# Keys of runs, with the article, below this fit one number.
KEY_LIMIT = 1 << 62
# Sums of weights are equal up to this.
SLACK = 1e-7

# Texts of up to so many characters have terms of one part only; beyond, a part has the terms of so many.
SMALL_VOCABULARY, PART_CHARS = 16 << 20, 16 << 20
# Postings whose squares are summed in one step.
HELD_SUMS = 8 << 20
# Shares of the numbers or of the phrases of a claim that support an article with a single entity.
NUMBERS_FOUND, PHRASES_FOUND = 0.20, 0.15

# Of a chunk itself ``at`` and ``tf`` hold the lengths of its articles by words and by characters, ``df`` the number
# of all articles and ``part`` the number of parts; of its words ``tf`` and ``width`` hold the texts and their sizes,
# ``df`` and ``total`` the digits of the texts and their sizes.
_LIST = "chunk bigint, channel string, part int, terms binary, sizes binary, n binary, {} binary, width binary, at binary, tf binary, ids array<bigint>"
COUNTS, LISTS = _LIST.format("total binary, df"), _LIST.format("total binary, df")
MERGED = "chunk bigint, channel string, part int, terms binary, sizes binary, df binary, total binary"


# --- building -------------------------------------------------------------------------


def index_inputs(articles: DataFrame, identity_chars: int | None = None) -> DataFrame:
    """What the channels see, made by the JVM's text functions: words, characters, and the identity text.

    The identity text is the normalised title, as long as ``title`` says, and the normalised content or its first
    ``identity_chars`` characters; ``digits`` are those of the text.
    """
    text = search_text(F.col("title"), F.col("content"))
    content = fold(nfkc(text_or_blank(F.col("content"))))
    own = articles.select(
        F.col("article_id").cast("bigint").alias("article_id"), text.alias("text"),
        normalize_text(text_or_blank(F.col("title"))).alias("title"),
        (F.substring(content, 1, identity_chars) if identity_chars else content).alias("content"),
    ).withColumn("identity", F.concat_ws(" ", "title", "content"))
    # the text has single spaces already, so lower case is all that ``lexical.squeezed`` would change
    return own.withColumn("chars", F.lower("text")).select(
        "article_id", F.array_join(tokens(F.col("chars"), INDEX_TOKEN), " ").alias("words"), "chars",
        F.length("title").alias("title"), "identity", digits(F.col("identity")).alias("digits"),
    )


def _tally(pair: np.ndarray, size: int):
    """Distinct keys ascending, cuts of their lists, positions, counts of ``key * size + position``; sorts in place."""
    pair.sort()
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    tf = np.diff(np.r_[first, len(pair)]).astype("<u4")
    key, at = np.divmod(pair[first], size)
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[new], np.r_[new, len(key)], at.astype("<u4"), tf


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, the number of the text, and how many remain in it from each on."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<i4")
    size = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    return codes, owner, (np.repeat(np.cumsum(size), size) - np.arange(len(codes))).astype(np.int32)


def _strings(digits: np.ndarray) -> list[str]:
    """Rows of code points as strings."""
    n = digits.shape[1]
    if (digits == 0).any():  # NumPy strings end before a zero
        return ["".join(map(chr, row)) for row in digits.tolist()]
    return np.ascontiguousarray(digits.astype("<u4")).view(f"<U{n}").ravel().tolist()


def char_lists(texts: list[str], lengths: tuple[int, ...]):
    """(terms, cuts, positions, counts) of the runs of each length; positions are numbers of texts."""
    codes, owner, room = _code_points(texts)
    # numbered by a table of all code points up to the largest, not by sorting
    present = np.zeros(int(codes.max(initial=0)) + 1, bool)
    present[codes] = True
    alphabet, codes = np.flatnonzero(present), (np.cumsum(present, dtype=np.int32) - 1)[codes]
    base, size = max(len(alphabet), 1), max(len(texts), 1)
    for n in lengths:
        m = max(len(codes) - n + 1, 0)
        if base**n * size < KEY_LIMIT:
            key = codes[:m].astype(np.int64)
            for j in range(1, n):
                key *= base
                key += codes[j : m + j]
            key *= size
            key += owner[:m]
            key, cuts, at, tf = _tally(key[room[:m] >= n], size)
            digits = np.stack([key // base ** (n - 1 - j) % base for j in range(n)], axis=1)
        else:  # a large alphabet: number the runs first
            start = np.flatnonzero(room >= n)
            key = codes[start].astype(np.int64)
            for j in range(1, n):
                key = np.unique(key * base + codes[start + j], return_inverse=True)[1]
            first = np.unique(key, return_index=True)[1]
            digits = np.stack([codes[start[first] + j] for j in range(n)], axis=1)
            _, cuts, at, tf = _tally(key * size + owner[start], size)
        yield _strings(alphabet[digits]) if len(digits) else [], cuts, at, tf


def word_lists(texts: list[str]):
    """(terms, cuts, positions, counts) of the words of texts, then of two neighbouring words; spaces divide words."""
    split = pc.split_pattern(pa.array(texts, pa.string()), " ")
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    words = split.flatten()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    owner, words = owner[real], words.filter(pa.array(real)).dictionary_encode()
    names, words = words.dictionary, words.indices.to_numpy().astype(np.int64)
    size, base = max(len(texts), 1), max(len(names), 1)
    key, cuts, at, tf = _tally(words * size + owner, size)
    yield names.take(pa.array(key)), cuts, at, tf
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    # numbered first: two words and a text may not fit one number
    both, two = np.unique(words[pair] * base + words[pair + 1], return_inverse=True)
    key, cuts, at, tf = _tally(two * size + owner[pair], size)
    first, second = names.take(pa.array(both[key] // base)), names.take(pa.array(both[key] % base))
    yield pc.binary_join_element_wise(first, second, " "), cuts, at, tf


def _slices(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary column of the slices of an array."""
    bounds = pa.array((cuts * data.itemsize).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, bounds.buffers()[1], pa.py_buffer(np.ascontiguousarray(data))])


def _pack(at: np.ndarray, tf: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of ascending positions below 2^16 as differences, their counts in 0, 1 or 4 bytes each, these widths."""
    first = np.cumsum(n) - n
    steps = np.diff(at.astype(np.int64), prepend=0)
    steps[first] = at[first]
    most = np.maximum.reduceat(tf, first)
    width = np.where(most > 255, 4, np.where(most > 1, 1, 0)).astype(np.uint8)
    if not width.any():
        return steps.astype("<u2"), np.zeros(0, np.uint8), width
    each = np.repeat(width, n).astype(np.int64)
    to, data = np.cumsum(each) - each, np.zeros(int(each.sum()), np.uint8)
    narrow, wide = each == 1, each == 4
    data[to[narrow]] = tf[narrow]
    for byte in range(4):
        data[to[wide] + byte] = tf[wide] >> (8 * byte) & 255
    return steps.astype("<u2"), data, width


def _packed(at: np.ndarray, tf: np.ndarray, cuts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The differences and the counts of ``_pack`` as columns, one row per list."""
    n = np.diff(cuts)
    steps, data, width = _pack(at, tf, n)
    return _slices(steps, cuts), _slices(data, np.r_[0, np.cumsum(width * n)])


def _upto(steps: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Positions of lists from their differences, one list after the other."""
    upto = np.cumsum(steps, dtype=np.int64)
    first = np.cumsum(n) - n
    return upto - np.repeat(upto[first] - steps[first], n)


def _unpack(data: np.ndarray, width: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Counts of lists from their bytes, one list after the other."""
    out = np.ones(int(n.sum()), np.int64)
    if width.any():
        each, of = np.repeat(width, n), np.repeat(width, width * n)
        for size in (1, 4):
            out[each == size] = data[of == size].view(f"<u{size}")
    return out


def _positions(column: pa.ChunkedArray, n: np.ndarray) -> np.ndarray:
    """Positions of all lists of a column, one list after the other."""
    return _upto(np.frombuffer(b"".join(column.to_pylist()), "<u2"), n)


def _counts(column: pa.ChunkedArray, n: np.ndarray) -> np.ndarray:
    """Counts of all lists of a column, one list after the other."""
    lists = column.to_pylist()
    width = np.fromiter(map(len, lists), np.int64, len(lists)) // np.maximum(n, 1)
    return _unpack(np.frombuffer(b"".join(lists), np.uint8), width, n)


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``n[i]`` consecutive places from ``first[i]`` on, for each i."""
    return np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)


def _numbers(data: bytes, kind: str) -> np.ndarray:
    """Numbers of a binary value, wide enough to calculate with."""
    some = np.frombuffer(data, kind)
    return some if kind == "<f8" else some.astype(np.int64)


def _lists(row: dict, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, positions and counts of the lists of a row, or of those numbered ``some``."""
    n, width = _numbers(row["n"], "<u4"), _numbers(row["width"], "u1")
    steps, data = np.frombuffer(row["at"], "<u2"), np.frombuffer(row["tf"], "u1")
    if some is not None:
        held = n * width
        steps, data = steps[_spread((np.cumsum(n) - n)[some], n[some])], data[_spread((np.cumsum(held) - held)[some], held[some])]
        n, width = n[some], width[some]
    return n, _upto(steps, n), _unpack(data, width, n)


def _terms(row: dict, terms: str = "terms", sizes: str = "sizes") -> pa.StringArray:
    """Texts of a row from their bytes and sizes."""
    size = _numbers(row[sizes], "<u4")
    bounds = pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int32))
    return pa.StringArray.from_buffers(len(size), bounds, pa.py_buffer(row[terms]))


def _blobs(terms: pa.StringArray) -> tuple[bytes, bytes]:
    """Bytes of all texts, and their sizes."""
    if not len(terms):
        return b"", b""
    bounds = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset : terms.offset + len(terms) + 1]
    first, last = int(bounds[0]), int(bounds[-1])
    return terms.buffers()[2].slice(first, last - first).to_pybytes() if last > first else b"", np.diff(bounds).astype("<u4").tobytes()


# Multipliers of the bytes of a term, by their places.
_MIXERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def part_of(terms: pa.StringArray, parts: int) -> np.ndarray:
    """Part that each term lies in, from its bytes."""
    if parts == 1 or not len(terms):
        return np.zeros(len(terms), np.int64)
    data, sizes = _blobs(terms)
    size = _numbers(sizes, "<u4")
    first = np.cumsum(size) - size
    place = np.arange(len(data)) - np.repeat(first, size)
    mixed = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * _MIXERS[place & 63]
    sums = np.add.reduceat(np.r_[mixed, np.uint64(0)], first)
    sums[size == 0] = 0
    sums ^= sums >> np.uint64(29)
    return ((sums * _MIXERS[1] >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def parts_for(chars: int, parts: int) -> int:
    """Parts of the terms of each channel: one for few texts, else a multiple of ``parts`` that grows with them."""
    return 1 if chars <= SMALL_VOCABULARY else parts * -(-chars // (parts * PART_CHARS))


def _row(**values) -> dict:
    return dict.fromkeys(("terms", "sizes", "n", "total", "df", "width", "at", "tf"), b"") | {"ids": None} | values


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _schema(ddl: str) -> pa.Schema:
    """The Arrow form of the columns above."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split(" ") for column in ddl.split(", "))])


def count_terms(inputs: DataFrame, parts: int, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Packed rows of the terms of ``index_inputs``, chunk by chunk."""

    def build(batches):
        from pyspark import TaskContext

        chunk, schema = TaskContext.get().partitionId() << 32, _schema(COUNTS)

        def rows(channel, lists):
            """One row per part; ``lists`` are terms, cuts, positions and counts of kinds of terms."""
            lists = list(lists)
            terms = pa.concat_arrays([x[0] if isinstance(x[0], pa.Array) else pa.array(x[0], pa.string()) for x in lists])
            n, at, tf = np.concatenate([np.diff(x[1]) for x in lists]), np.concatenate([x[2] for x in lists]), np.concatenate([x[3] for x in lists])
            part, first = part_of(terms, parts), np.cumsum(n) - n
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            for p in range(parts):
                own = order[ends[p] : ends[p + 1]]
                if not len(own):
                    continue
                text, sizes = _blobs(terms.take(pa.array(own)))
                take = _spread(first[own], n[own])
                steps, data, width = _pack(at[take], tf[take], n[own])
                total = np.add.reduceat(tf[take], np.cumsum(n[own]) - n[own], dtype=np.int64)
                yield _row(
                    chunk=chunk, channel=channel, part=p, terms=text, sizes=sizes, n=n[own].astype("<u4").tobytes(), total=total.astype("<i8").tobytes(),
                    width=width.tobytes(), at=steps.tobytes(), tf=data.tobytes())

        def words_of_identity(texts, titles, found):
            terms, cuts, at, _ = next(word_lists(texts))
            text, sizes = _blobs(terms)
            whole, of_digits = _blobs(pa.array(texts, pa.string())), _blobs(pa.array(found, pa.string()))
            steps = _pack(at, np.ones_like(at), np.diff(cuts))[0] if len(at) else at.astype("<u2")
            yield _row(
                chunk=chunk, channel=TOKEN, part=0, terms=text, sizes=sizes, n=np.diff(cuts).astype("<u4").tobytes(), at=steps.tobytes(),
                tf=whole[0], width=whole[1], df=of_digits[0], total=of_digits[1] + np.array(titles, "<u4").tobytes(), ids=[held_ids[i] for i in order])

        def whole():
            nonlocal order
            order = np.argsort(np.array(held_ids, np.int64), kind="stable").tolist()
            words, chars, titles, identity, found = ([held[i][j] for i in order] for j in range(5))
            yield _batch([_row(chunk=chunk, channel=HEAD, part=parts, ids=[held_ids[i] for i in order])], schema)
            yield _batch(list(rows(WORD, word_lists(words))), schema)
            yield _batch(list(rows(CHAR, char_lists(chars, (3, 4, 5)))), schema)
            yield _batch(list(words_of_identity(identity, titles, found)), schema)

        held_ids, held, size, order = [], [], 0, []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for i, *own in zip(*(column.to_pylist() for column in batch.slice(at, 256).columns)):
                    held_ids.append(i)
                    held.append(own)
                    size += len(own[1])
                    if size >= chunk_chars or len(held) >= CHUNK_ARTICLES:
                        yield from whole()
                        chunk += 1
                        held_ids, held, size = [], [], 0
        if held:
            yield from whole()
        give_back()

    return inputs.mapInArrow(build, COUNTS)


def merge_terms(counts: DataFrame, capped: bool = False) -> DataFrame:
    """Frequencies of the terms over all chunks, part by part.

    A row without a chunk has the terms of a part that are in enough articles to be in a vocabulary, and their
    frequencies; the others have, for a chunk and part, the frequencies of its terms in their order there.
    """

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        channel, part = rows[0]["channel"], rows[0]["part"]
        each = [_terms(x) for x in rows]
        coded = pa.concat_arrays(each).dictionary_encode()
        of, size = coded.indices.to_numpy(), len(coded.dictionary)
        df = np.bincount(of, np.concatenate([_numbers(x["n"], "<u4") for x in rows]), size).astype("<i8")
        total = np.bincount(of, np.concatenate([_numbers(x["total"], "<i8") for x in rows]), size).astype("<i8")
        keep = df >= ANALYZERS[channel].min_df
        text, sizes = _blobs(coded.dictionary.filter(pa.array(keep)))
        out = [dict(chunk=None, channel=channel, part=part, terms=text, sizes=sizes, df=df[keep].tobytes(), total=total[keep].tobytes())]
        ends = np.cumsum([len(x) for x in each])
        for x, own in zip(rows, np.split(of, ends[:-1])):
            out.append(dict(chunk=x["chunk"], channel=channel, part=part, terms=b"", sizes=b"", df=df[own].astype("<u4").tobytes(), total=total[own].tobytes() if capped else b""))
        return pa.Table.from_pylist(out, _schema(MERGED))

    own = counts.where(F.col("channel").isin(WORD, CHAR)).select("chunk", "channel", "part", "terms", "sizes", "n", "total")
    return own.groupBy("channel", "part").applyInArrow(merge, MERGED)


def frequencies(merged: DataFrame, channel: str) -> DataFrame:
    """(term, df, total) of the terms of a channel that are in enough articles."""

    def apart(batches):
        for batch in batches:
            for x in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([_terms(x), pa.array(_numbers(x["df"], "<i8")), pa.array(_numbers(x["total"], "<i8"))], ["term", "df", "total"])

    own = merged.where(F.col("chunk").isNull() & (F.col("channel") == channel)).select("terms", "sizes", "df", "total")
    return own.mapInArrow(apart, "term string, df bigint, total bigint")


def last_kept(vocabulary: DataFrame) -> tuple[int, str]:
    """The least total of a capped vocabulary, and the last of its terms with that."""
    least = vocabulary.agg(F.min("total")).first()[0]
    return least, vocabulary.where(F.col("total") == least).agg(F.max("term")).first()[0]


def finished(counts: DataFrame, merged: DataFrame, n_articles: int, caps: dict[str, tuple[int, str]]) -> DataFrame:
    """The rows of the file: the terms of the vocabularies with their frequencies, and the lengths of the articles.

    ``caps`` has ``last_kept`` of the vocabularies that are capped.
    """

    def known(x: dict, found: dict) -> np.ndarray:
        df, analyzer = _numbers(found["df"], "<u4"), ANALYZERS[x["channel"]]
        keep = df >= analyzer.min_df
        if analyzer.max_df is not None:
            keep &= df <= analyzer.max_df * n_articles
        if x["channel"] in caps:
            least, last = caps[x["channel"]]
            total = _numbers(found["total"], "<i8")
            keep &= total >= least
            for i in np.flatnonzero(keep & (total == least)).tolist():
                keep[i] = _terms(x)[i].as_py().encode() <= last.encode()
        return keep

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {(x["channel"], x["part"]): x for x in right.to_pylist()}
        rows = left.to_pylist()
        head = next(x for x in rows if x["channel"] == HEAD)
        squares = {c: np.zeros(len(head["ids"])) for c in (WORD, CHAR)}
        out = [head]
        for x in rows:
            channel = x["channel"]
            if channel == TOKEN:
                out.append(x)
            if channel not in squares:
                continue
            keep = known(x, found[channel, x["part"]])
            some = np.flatnonzero(keep)
            if not len(some):
                continue
            df = _numbers(found[channel, x["part"]]["df"], "<u4")[some]
            n, at, tf = _lists(x, some)
            raw = _raw(n, tf, df, n_articles)
            for a in range(0, len(at), HELD_SUMS):
                squares[channel] += np.bincount(at[a : a + HELD_SUMS], raw[a : a + HELD_SUMS] ** 2, len(head["ids"]))
            text, sizes = _blobs(_terms(x).take(pa.array(some)))
            steps, data, width = _pack(at, tf, n)
            out.append(x | dict(
                terms=text, sizes=sizes, n=n.astype("<u4").tobytes(), total=b"", df=df.astype("<u4").tobytes(), width=width.tobytes(), at=steps.tobytes(), tf=data.tobytes()))
        head |= {"at": np.sqrt(squares[WORD]).tobytes(), "tf": np.sqrt(squares[CHAR]).tobytes(), "df": np.array([n_articles], "<i8").tobytes()}
        return pa.Table.from_pylist(out, _schema(LISTS))

    own = merged.where(F.col("chunk").isNotNull()).select("chunk", "channel", "part", "df", "total")
    return counts.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInArrow(finish, LISTS)


def _raw(n: np.ndarray, tf: np.ndarray, df: np.ndarray, n_articles: int) -> np.ndarray:
    """Weights before scaling of the articles of lists."""
    idf = np.log((1.0 + n_articles) / (1.0 + df)) + 1.0
    return np.where(tf == 1, 1.0, 1.0 + np.log(tf)) * np.repeat(idf, n)


def members(lists: DataFrame) -> DataFrame:
    """(article_id, chunk, position) of every article."""
    return lists.where(F.col("channel") == HEAD).select("chunk", F.posexplode("ids").alias("position", "article_id"))


def _articles(rows: list[dict]) -> tuple[np.ndarray, dict[str, np.ndarray], int]:
    """Ids and lengths per channel of the articles of a chunk, and the number of all articles."""
    own = next(x for x in rows if x["channel"] == HEAD)
    lengths = {WORD: np.frombuffer(own["at"], "<f8"), CHAR: np.frombuffer(own["tf"], "<f8")}
    return np.array(own["ids"], np.int64), lengths, int(_numbers(own["df"], "<i8")[0])


def _weighed(rows: list[dict], channel: str):
    """(row, articles, lengths, positions, weights, df) of the rows of a channel of a chunk."""
    own, lengths, total = _articles(rows)
    for x in rows:
        if x["channel"] == channel:
            df = _numbers(x["df"], "<u4")
            n, at, tf = _lists(x)
            yield x, own, n, at, _raw(n, tf, df, total) / lengths[channel][at], df


def postings(lists: DataFrame, channel: str) -> DataFrame:
    """(article_id, term, w, salts): the lists of a channel taken apart."""

    def apart(table: pa.Table) -> pa.Table:
        kinds = pa.schema([("article_id", pa.int64()), ("term", pa.string()), ("w", pa.float64()), ("salts", pa.int32())])
        some = []
        for x, own, n, at, w, df in _weighed(table.to_pylist(), channel):
            each = np.repeat(np.arange(len(n)), n)
            salts = -(-df // ROWS_PER_SALT)
            some.append(pa.table([pa.array(own[at]), _terms(x).take(pa.array(each)), pa.array(w), pa.array(salts[each].astype(np.int32))], schema=kinds))
        return pa.concat_tables(some) if some else kinds.empty_table()

    some = lists.where(F.col("channel").isin(channel, HEAD))
    return some.groupBy("chunk").applyInArrow(apart, "article_id bigint, term string, w double, salts int")


def article_weights(lists: DataFrame, channel: str) -> DataFrame:
    """(article_id, ws): all weights of an article in one list; articles without terms have no row."""

    def gathered(table: pa.Table) -> pa.Table:
        found = [(own, at, w) for _, own, _, at, w, _ in _weighed(table.to_pylist(), channel)]
        if not found:
            return pa.table({"article_id": pa.array([], pa.int64()), "ws": pa.array([], pa.list_(pa.float64()))})
        own, at, w = found[0][0], np.concatenate([x[1] for x in found]), np.concatenate([x[2] for x in found])
        order, n = np.argsort(at, kind="stable"), np.bincount(at, minlength=len(own))
        have = np.flatnonzero(n)
        bounds = pa.array(np.r_[0, np.cumsum(n[have])].astype(np.int32))
        return pa.table({"article_id": own[have], "ws": pa.ListArray.from_arrays(bounds, pa.array(w[order]))})

    some = lists.where(F.col("channel").isin(channel, HEAD))
    return some.groupBy("chunk").applyInArrow(gathered, "article_id bigint, ws array<double>")


# --- scores of claims -----------------------------------------------------------------

KINDS = {"word_original": WORD, "word_claim": WORD, "char_original": CHAR}
SCORED = "claim_id bigint, article_id bigint, " + ", ".join(f"{k} double, in_{k} boolean" for k in KINDS) + ", forced boolean"
# The terms that a block of claims asks of a part: how many claims have each, which ones, their weights per kind.
ASKED = "channel string, part int, block int, asked_terms binary, asked_sizes binary, asked_n binary, asked_claims binary, asked_weights binary"


class _Scores:
    """Sums of one kind of weights for the claims of a part against the articles of a chunk."""

    def __init__(self, claims: int, size: int, rows: list[tuple]):
        """``rows``: (positions, weights, claims, their weights) of every term that a claim of the part has."""
        self.size, self.rows = size, rows
        self.sums = np.zeros((claims, size))
        frequent = [4 * len(r[0]) > size for r in rows]
        self.rare = [r for r, f in zip(rows, frequent) if not f]
        self.frequent = [r for r, f in zip(rows, frequent) if f]
        self.kept = np.ones(size, bool)

    def add_rare(self) -> None:
        flat = self.sums.ravel()
        some: list[tuple] = []
        held = 0
        for row in self.rare:
            work = len(row[0]) * len(row[2])
            if work >= 256:
                self.sums[np.ix_(row[2], row[0])] += np.outer(row[3], row[1])
                continue
            some.append(row)
            held += work
            if held >= PAIRS:
                self._scatter(flat, some)
                some, held = [], 0
        if some:
            self._scatter(flat, some)

    def _scatter(self, flat: np.ndarray, rows: list[tuple]) -> None:
        """Many short lists at once: every claim of a row meets every article of it."""
        n = np.array([len(r[0]) for r in rows])
        m = np.array([len(r[2]) for r in rows])
        at, w = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        claim, q = np.concatenate([r[2] for r in rows]), np.concatenate([r[3] for r in rows])
        size = np.repeat(n, m)  # list length of every (row, claim)
        first = np.repeat(np.r_[0, np.cumsum(n)[:-1]], m)
        take = np.arange(size.sum()) + np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size)
        flat += np.bincount(np.repeat(claim, size) * self.size + at[take], np.repeat(q, size) * w[take], len(flat))

    def drop_hopeless(self, depth: int, keep: np.ndarray) -> None:
        """Forget articles whose sum, with the largest weights still to come, stays below the depth-th sum of every claim."""
        if self.size <= depth or not self.frequent:
            return
        rest = np.zeros(len(self.sums))
        for _, w, claim, q in self.frequent:
            rest[claim] += q * w.max()
        least = np.partition(self.sums, self.size - depth, axis=1)[:, self.size - depth]
        asks = (rest > 0) | (self.sums > 0).any(axis=1)
        self.kept = keep | ((self.sums + (rest + SLACK)[:, None] >= least[:, None]) & asks[:, None]).any(axis=0)

    def add_frequent(self, kept: np.ndarray) -> None:
        """The frequent terms, for the articles that are left, as products of matrices."""
        columns = np.flatnonzero(kept)
        place = np.full(self.size, -1, np.int64)
        place[columns] = np.arange(len(columns))
        for first in range(0, len(self.frequent), SLAB):
            slab = self.frequent[first : first + SLAB]
            articles, claims = np.zeros((len(slab), len(columns))), np.zeros((len(self.sums), len(slab)))
            for i, (at, w, claim, q) in enumerate(slab):
                own = place[at]
                articles[i, own[own >= 0]] = w[own >= 0]
                claims[claim, i] = q
            self.sums[:, columns] += claims @ articles

    def best(self, claim: int, depth: int) -> np.ndarray:
        """The best articles of a claim with a positive sum, ties by article."""
        line = np.where(self.kept, self.sums[claim], -1.0)
        some = np.flatnonzero(line > 0)
        if len(some) > depth:
            least = np.partition(line[some], len(some) - depth)[len(some) - depth]
            some = some[line[some] >= least]
        return some[np.argsort(-line[some], kind="stable")[:depth]]


def _asked(weights: DataFrame, block: Column, parts: int) -> DataFrame:
    """The terms of all claims, packed by channel, part and block."""

    def dealt(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            part = part_of(table.column("term").combine_chunks(), parts).astype(np.int32)
            yield from table.append_column("part", pa.array(part)).to_batches()

    def pack(table: pa.Table) -> pa.Table:
        coded = table.column("term").combine_chunks().dictionary_encode()
        of = coded.indices.to_numpy()
        order = np.argsort(of, kind="stable")
        text, sizes = _blobs(coded.dictionary)
        weight = np.concatenate([table.column(k).fill_null(0.0).to_numpy()[order] for k in KINDS])
        one = {c: table.column(c)[0].as_py() for c in ("channel", "part", "block")}
        return pa.Table.from_pylist([one | dict(
            asked_terms=text, asked_sizes=sizes, asked_n=np.bincount(of).astype("<u4").tobytes(),
            asked_claims=table.column("claim_id").to_numpy()[order].astype("<i8").tobytes(), asked_weights=weight.astype("<f8").tobytes())], _schema(ASKED))

    rows = weights.withColumn("block", block).select("claim_id", "channel", "term", *KINDS, "block")
    placed = rows.mapInArrow(dealt, "claim_id bigint, channel string, term string, " + ", ".join(f"{k} double" for k in KINDS) + ", block int, part int")
    return placed.groupBy("channel", "part", "block").applyInArrow(pack, ASKED)


def _parts(lists: DataFrame) -> int:
    return lists.where(F.col("channel") == HEAD).agg(F.max("part")).first()[0] or 1


def _groups(weights: DataFrame, forced: DataFrame | None, lists: DataFrame, claims: DataFrame) -> DataFrame:
    """Rows of every chunk and block of claims: the lists with what the block asks of them, the chunk itself with the claims of the block and the forced pairs.

    ``weights`` has (claim_id, channel, term) and a weight per kind of ``KINDS``, ``claims`` has claim_id. A group has at
    most about ``CLAIMS`` claims and one chunk, so its sums are bounded whatever the batch.
    """
    parts, names = _parts(lists), claims.select("claim_id").distinct()
    blocks = -(-names.count() // CLAIMS) or 1
    block = F.pmod(F.xxhash64("claim_id"), F.lit(blocks)).cast("int")
    heads = names.withColumn("block", block).groupBy("block").agg(F.sort_array(F.collect_list("claim_id")).alias("asked_names")).select(
        F.lit(HEAD).alias("channel"), F.lit(parts).alias("part"), "block", "asked_names")
    asked = materialize(_asked(weights, block, parts).unionByName(heads, allowMissingColumns=True), "asked_terms")
    size = asked.agg(F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in asked.columns if asked.schema[c].dataType.typeName() == "binary"))).first()[0]
    wanted = lists.where(F.col("channel").isin(WORD, CHAR, HEAD)).select("chunk", "channel", "part", "terms", "sizes", "n", "df", "width", "at", "tf", "ids")
    every = wanted.join(maybe_broadcast(asked, (size or 0) <= BROADCAST_BYTES), ["channel", "part"])
    if forced is None:
        return every.withColumn("forced", F.lit(None).cast("array<struct<claim_id:bigint,position:int>>"))
    pairs = materialize(
        forced.select("claim_id", "article_id").distinct().join(members(lists), "article_id").withColumn("block", block)
        .groupBy("chunk", "block").agg(F.collect_list(F.struct("claim_id", "position")).alias("forced"), F.count("*").alias("pairs")),
        "forced_pairs",
    )
    small = (pairs.agg(F.sum("pairs")).first()[0] or 0) * 16 <= BROADCAST_BYTES
    side = pairs.select("chunk", "block", F.lit(HEAD).alias("channel"), "forced")
    return every.join(maybe_broadcast(side, small), ["chunk", "block", "channel"], "left")


def _asked_lists(rows: list[dict], names: np.ndarray, lengths: dict[str, np.ndarray], total: int) -> dict[str, list[tuple]]:
    """Per kind (positions, weights, claims, their weights) of every term that a claim of the block has."""
    out: dict[str, list[tuple]] = {k: [] for k in KINDS}
    for x in rows:
        if x["channel"] not in lengths:
            continue
        asked = _terms(x, "asked_terms", "asked_sizes")
        place = pc.index_in(asked, value_set=_terms(x))
        have = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
        if not len(have):
            continue
        some = place.drop_null().to_numpy().astype(np.int64)
        n, at, tf = _lists(x, some)
        w = _raw(n, tf, _numbers(x["df"], "<u4")[some], total) / lengths[x["channel"]][at]
        claim = np.searchsorted(names, _numbers(x["asked_claims"], "<i8"))
        entries = _numbers(x["asked_n"], "<u4")
        ends, cuts = np.cumsum(entries).tolist(), np.r_[0, np.cumsum(n)].tolist()
        weights = np.frombuffer(x["asked_weights"], "<f8").reshape(len(KINDS), -1)
        for kind, q in zip(KINDS, weights):
            if KINDS[kind] != x["channel"]:
                continue
            positive = q > 0
            whole = positive.all()
            for i, k in enumerate(have.tolist()):
                a, z = (ends[k - 1] if k else 0), ends[k]
                c, v = claim[a:z], q[a:z]
                if not whole:
                    own = positive[a:z]
                    c, v = c[own], v[own]
                    if not len(c):
                        continue
                out[kind].append((at[cuts[i] : cuts[i + 1]], w[cuts[i] : cuts[i + 1]], c, v))
    return out


def score_claims(weights: DataFrame, forced: DataFrame, lists: DataFrame, depths: dict[str, int], claims: DataFrame) -> DataFrame:
    """Best articles of every claim by each kind of weight, and all scores of the pairs in ``forced``.

    ``weights`` and ``claims`` are as in ``_groups``, ``forced`` has (claim_id, article_id). The result has one row per
    pair that is among the best ``depths`` of its chunk in some kind (``in_<kind>``) or forced, with all three cosines;
    the best of the table are among them.
    """

    def score(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own, lengths, total = _articles(rows)
        head = next(x for x in rows if x["channel"] == HEAD)
        names = np.array(head["asked_names"], np.int64)
        keep = np.zeros(len(own), bool)
        must = head["forced"] or []
        claim_of = {name: i for i, name in enumerate(names.tolist())}
        pairs = np.array([(claim_of[x["claim_id"]], x["position"]) for x in must], np.int64).reshape(-1, 2)
        keep[pairs[:, 1]] = True
        asked = _asked_lists(rows, names, lengths, total)
        scores = {}
        for kind in KINDS:
            scores[kind] = _Scores(len(names), len(own), asked.pop(kind))
            scores[kind].add_rare()
            scores[kind].drop_hopeless(depths[kind], keep)
        # an article that any kind still needs gets all of its sums
        kept = np.zeros(len(own), bool)
        for x in scores.values():
            kept |= x.kept
        best: list[dict[str, np.ndarray]] = [{} for _ in names]
        for kind, x in scores.items():
            x.add_frequent(kept)
            np.round(x.sums, SCORE_DECIMALS, out=x.sums)
            for i in range(len(names)):
                best[i][kind] = x.best(i, depths[kind])
        out: dict[str, list] = {c: [] for c in ["claim_id", "article_id", *(f for k in KINDS for f in (k, f"in_{k}")), "forced"]}
        also = [pairs[pairs[:, 0] == i, 1] for i in range(len(names))]
        for i, name in enumerate(names.tolist()):
            some = np.unique(np.concatenate([*best[i].values(), also[i]]))
            out["claim_id"].append(np.full(len(some), name))
            out["article_id"].append(own[some])
            for kind, x in scores.items():
                out[kind].append(x.sums[i, some])
                out[f"in_{kind}"].append(np.isin(some, best[i][kind]))
            out["forced"].append(np.isin(some, also[i]))
        kinds = {"claim_id": np.int64, "article_id": np.int64, "forced": bool} | {f"in_{k}": bool for k in KINDS}
        return pa.table({c: np.concatenate(x) if x else np.zeros(0, kinds.get(c, np.float64)) for c, x in out.items()})

    return _groups(weights, forced, lists, claims).groupBy("chunk", "block").applyInArrow(score, SCORED)


def score_all(weights: DataFrame, lists: DataFrame, kinds: list[str], claims: DataFrame) -> DataFrame:
    """(article_id, claim_id, a cosine per kind) of every claim with every article it shares a term with: a report."""

    def score(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own, lengths, total = _articles(rows)
        names = np.array(next(x for x in rows if x["channel"] == HEAD)["asked_names"], np.int64)
        asked = _asked_lists(rows, names, lengths, total)
        sums = []
        for kind in kinds:
            scores = _Scores(len(names), len(own), asked.pop(kind))
            scores.add_rare()
            scores.add_frequent(scores.kept)
            sums.append(scores.sums)
        claim, at = np.nonzero(np.any([x > 0 for x in sums], axis=0))
        return pa.table({"article_id": own[at], "claim_id": names[claim]} | {k: np.round(x[claim, at], SCORE_DECIMALS) for k, x in zip(kinds, sums)})

    schema = "article_id bigint, claim_id bigint, " + ", ".join(f"{k} double" for k in kinds)
    return _groups(weights, None, lists, claims).groupBy("chunk", "block").applyInArrow(score, schema)


def best_by_terms(scored: DataFrame, depths: dict[str, int]) -> dict[str, DataFrame]:
    """Per kind the best articles of every claim, from ``score_claims``: its columns and ``rank``."""
    out = {}
    for kind, depth in depths.items():
        order = Window.partitionBy("claim_id").orderBy(F.desc(kind), "article_id")
        ranked = scored.where(F.col(f"in_{kind}")).withColumn("rank", F.row_number().over(order))
        out[kind] = ranked.where(F.col("rank") <= depth)
    return out


# --- articles that name the entities of claims -------------------------------------------


class _Words:
    """The words of the identity texts of a chunk: which articles hold a piece of text without a space."""

    def __init__(self, row: dict):
        self.words, self.size = [t.encode() for t in _terms(row).to_pylist()], len(row["ids"])
        n = _numbers(row["n"], "<u4")
        self.at, self.cuts = _upto(np.frombuffer(row["at"], "<u2"), n), np.r_[0, np.cumsum(n)]
        self.data = np.frombuffer(row["terms"], np.uint8).astype(np.int64)
        self.owner = np.repeat(np.arange(len(self.words)), _numbers(row["sizes"], "<u4"))
        # a run of a few bytes and the number of a word fit one number
        self.bits = max(len(self.words).bit_length(), 1)
        self.longest = min(5, (63 - self.bits) // 8)
        self.runs: dict[int, np.ndarray] = {}
        self.held: dict[str, np.ndarray] = {}

    def _with_runs(self, piece: bytes, n: int) -> np.ndarray:
        """Numbers of the words that have the rarest run of ``n`` bytes of ``piece``."""
        if n not in self.runs:
            start = np.flatnonzero(self.owner[n - 1 :] == self.owner[: len(self.owner) - n + 1])
            keys = np.zeros(len(start), np.int64)
            for j in range(n):
                keys = keys << 8 | self.data[start + j]
            keys = np.sort(keys << self.bits | self.owner[start])
            self.runs[n] = keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
        runs = self.runs[n]
        keys = np.array([int.from_bytes(piece[i : i + n], "big") for i in range(len(piece) - n + 1)], np.int64)
        first, last = np.searchsorted(runs, keys << self.bits), np.searchsorted(runs, (keys + 1) << self.bits)
        rarest = int(np.argmin(last - first))
        return runs[first[rarest] : last[rarest]] & ((1 << self.bits) - 1)

    def holding(self, piece: str) -> np.ndarray:
        """Whether each article has a word that contains ``piece``."""
        if piece not in self.held:
            out, own = np.zeros(self.size, bool), piece.encode()
            words = self._with_runs(own, min(len(own), self.longest))
            if len(own) > self.longest:
                words = np.array([i for i in words.tolist() if own in self.words[i]], np.int64)
            if len(words):
                first = self.cuts[words]
                out[self.at[_spread(first, self.cuts[words + 1] - first)]] = True
            self.held[piece] = out
        return self.held[piece]

    def maybe(self, text: str) -> np.ndarray:
        """Whether each article has all pieces of a text that spaces divide."""
        pieces = [p for p in text.split(" ") if p]
        if not pieces:
            return np.ones(self.size, bool)
        out = self.holding(pieces[0])
        for p in pieces[1:]:
            out = out & self.holding(p)
        return out


def _in_title_or_content(text: str, title: int, phrase: str) -> bool:
    """Whether the first ``title`` characters or those behind the space after them contain a phrase."""
    at = text.find(phrase)
    return at >= 0 and (at + len(phrase) <= title or text.find(phrase, title + 1) >= 0)


NAMED = "claim_id bigint, article_id bigint, hits int"


def named_entities(claims: DataFrame, lists: DataFrame, limit: int | None = None) -> DataFrame:
    """(claim_id, article_id, hits): how many variants of the entities of a claim the identity text of an article has.

    ``claims`` has (claim_id, exclude_article_id, identity_variants, phrases, numbers_s). Without a limit these are all
    articles with a variant. With one the excluded article is left out, an article with a single variant counts only if
    a fifth of the numbers or 15 % of the phrases are there as well, and of each chunk only the ``limit`` best of a claim
    leave it, ties by id; the best of the table are among them.

    A text without a space lies in a word, so it is searched among the distinct words of a chunk. Longer ones are searched in
    the texts of articles that have all their pieces.
    """
    blocks = -(-claims.count() // CLAIMS) or 1
    asked = materialize(
        claims.withColumn("block", F.pmod(F.xxhash64("claim_id"), F.lit(blocks)).cast("int"))
        .groupBy("block").agg(F.collect_list(F.struct("claim_id", "exclude_article_id", "identity_variants", "phrases", "numbers_s")).alias("asked"))
        .withColumn("channel", F.lit(TOKEN)),
        "asked_entities",
    )
    size = asked.agg(F.sum(F.octet_length(F.to_json("asked")))).first()[0] or 0
    rows = lists.where(F.col("channel") == TOKEN).join(maybe_broadcast(asked, size <= BROADCAST_BYTES), "channel")

    def supported(claim: dict, at: list[int], words: _Words, texts: list[str], titles: np.ndarray, found: list[str]):
        """Which of the articles ``at``, ascending, have enough numbers or phrases; no more than the limit."""
        phrases, numbers = claim["phrases"], claim["numbers_s"]
        most = np.zeros(len(at), np.int64)
        had = []
        for p in phrases:
            had.append(words.maybe(p)[at])
            most += had[-1]
        plain, spaced = [" " not in p for p in phrases], []
        sure = np.zeros(len(at), np.int64)
        for p, one, alone in zip(phrases, had, plain):
            if alone:
                sure += one
            else:
                spaced.append((p, one))
        out = []
        for i, a in enumerate(at):
            if len(out) == limit:
                break
            n, text = len(phrases), texts[a]
            enough = n and most[i] / n >= PHRASES_FOUND
            if enough and sure[i] / n < PHRASES_FOUND:
                hits = int(sure[i])
                for p, one in spaced:
                    if one[i] and _in_title_or_content(text, titles[a], p):
                        hits += 1
                        if hits / n >= PHRASES_FOUND:
                            break
                enough = hits / n >= PHRASES_FOUND
            if not enough and numbers:
                hits = sum(x["value"] != "" and (x["value"] in text or (len(x["digits"]) >= 2 and x["digits"] in found[a])) for x in numbers)
                enough = hits / len(numbers) >= NUMBERS_FOUND
            if enough:
                out.append(a)
        return out

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                own, words = np.array(row["ids"], np.int64), _Words(row)
                texts = _terms(row, "tf", "width").to_pylist()
                of_digits = _numbers(row["total"], "<u4")
                titles = of_digits[len(own) :]
                found = _terms({"df": row["df"], "sizes": row["total"][: 4 * len(own)]}, "df", "sizes").to_pylist()
                out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
                present: dict[str, np.ndarray] = {}
                for claim in row["asked"]:
                    hits = np.zeros(len(own), np.int32)
                    for v in claim["identity_variants"]:
                        if v not in present:
                            present[v] = words.maybe(v)
                            if " " in v:
                                present[v] = present[v].copy()
                                for a in np.flatnonzero(present[v]).tolist():
                                    present[v][a] = v in texts[a]
                        hits += present[v]
                    if limit is None:
                        some = np.flatnonzero(hits)
                    else:
                        if claim["exclude_article_id"] is not None:
                            hits[own == claim["exclude_article_id"]] = 0
                        some = np.flatnonzero(hits >= 2)
                        some = some[np.argsort(-hits[some], kind="stable")[:limit]]
                        single = np.flatnonzero(hits == 1).tolist() if len(some) < limit else []
                        some = np.r_[some, np.array(supported(claim, single, words, texts, titles, found), np.int64)]
                    out.append((np.full(len(some), claim["claim_id"]), own[some], hits[some]))
                columns = [np.concatenate(x) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["claim_id", "article_id", "hits"])

    return rows.select("terms", "sizes", "n", "df", "total", "width", "at", "tf", "ids", "asked").mapInArrow(search, NAMED)
