"""Jaccard join of documents on word shingles with token-combination prefixes.

A token is the 56-bit hash of a shingle. Two sets of sizes m <= n link when they share at least 80 % of
their union, so m >= 0.8 n and they share at least 0.8 n tokens. All sets are put in one global order:
tokens of one set only, rare tokens, frequent tokens. With c tokens of a prefix in a class whose
signatures are combinations of k tokens, max(0, c - k + 1) of them count; a prefix long enough to
count n - 0.8 n + 1 has a signature in common with that of every set that it links with.

1. Every task sends its tokens, packed and sorted, to token buckets, which find those of two sets
   or more and their class; tokens frequent within one task are sent only once for it.
2. The shared tokens go back to the sets. Where fewer than 80 % of a set are shared nothing can
   link. All others get prefixes: single rare tokens, pairs of frequent tokens. Frequent tokens are
   divided into subclasses, as many as suit the size band of the set, so that pairs stay linear in
   the prefix; bands of sets that can link are equal or adjacent, so pairs are made for both.
3. Sets of one signature are compared with the one of them that has the fewest tokens of its own;
   links join them into components. A set that shares a signature with sets of other components is
   then compared with all sets of the largest of these and with the other such sets there, in
   blocks that report links only. No pair within a component is ever listed, and no link
   between components is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.components import components
from claimweave.llm.shingles import column_sets, mix
from claimweave.llm.tables import lean, materialize, read_table

# A token of so many sets is frequent.
FREQUENT = 32
# Tokens that a task packs at once, and that a bucket holds on average.
PIECE_TOKENS = 1_000_000
BUCKET_TOKENS = 1_500_000
# Sets of a component held in one block, and sets compared with a block at once.
BLOCK_SETS = 256
ASKING_SETS = 1024

_SENT = "key int, tokens binary, docs binary, digests binary, sizes binary, frequent binary"
_BACK = "part int, digests binary, sizes binary, tokens binary, frequent binary"
_EMPTY = np.zeros(0, np.uint64)


def _digest(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def set_sizes(documents: DataFrame) -> DataFrame:
    """(doc_id, mark, digest, n): hash of every text, size of its shingle set, and a number equal for equal sets."""

    def sizes(batches):
        for batch in batches:
            sets = column_sets(batch.column(1))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "mark": batch.column(2),
                "digest": pa.array([_digest(s) for s in sets], pa.int64()),
                "n": pa.array([len(s) for s in sets], pa.int64()),
            })

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    return rows.mapInArrow(lean(sizes), "doc_id bigint, mark bigint, digest bigint, n bigint")


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal significance side by side, which compress well for sorted numbers."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal sorted values."""
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, int)
    return starts, np.diff(np.append(starts, len(values)))


def _send(buckets: int, parts: int):
    """Task function of step 1. Keys below 0 are rows for the sets themselves, by part."""
    shift = np.uint64(56 - (buckets.bit_length() - 1))

    def flush(sets: dict[int, np.ndarray]):
        digests = np.array(list(sets), np.int64)
        sizes = np.array([len(s) for s in sets.values()], np.uint32)
        tokens = np.concatenate(list(sets.values())) >> np.uint64(8)
        docs = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, docs = tokens[order], docs[order]
        starts, counts = _runs(tokens)
        often = np.repeat(counts >= FREQUENT, counts)
        part = digests.view(np.uint64) % np.uint64(parts)
        own, own_part = tokens[often], part[docs[often]]
        for p in range(parts):
            here, mine = part == p, own_part == p
            if here.any():
                # The sets of this part with their sizes, then frequent tokens of theirs.
                some = docs[often][mine]
                yield (-1 - p, _planes(np.concatenate([np.full(here.sum(), 2**64 - 1, np.uint64), own[mine]])), b"",
                       np.concatenate([digests[here], digests[some]]).tobytes(),
                       np.concatenate([sizes[here], sizes[some]]).tobytes(), b"")
        hot = tokens[starts[counts >= FREQUENT]]
        tokens, docs = tokens[~often], docs[~often]
        edges = np.searchsorted(tokens >> shift, np.arange(buckets + 1, dtype=np.uint64))
        hot_edges = np.searchsorted(hot >> shift, np.arange(buckets + 1, dtype=np.uint64))
        for b in range(buckets):
            a, z, c, d = edges[b], edges[b + 1], hot_edges[b], hot_edges[b + 1]
            if z > a or d > c:
                some, place = np.unique(docs[a:z], return_inverse=True)
                kind = np.uint16 if len(some) <= 1 << 16 else np.uint32
                yield (b, _planes(tokens[a:z]), place.astype(kind).tobytes(), digests[some].tobytes(), b"", _planes(hot[c:d]))

    def rows(found):
        columns = list(zip(*found))
        if columns:
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                ["key", "tokens", "docs", "digests", "sizes", "frequent"],
            )

    def send(batches):
        sets: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for s in column_sets(batch.column(1).slice(at, 256)):
                    if len(s) and (d := _digest(s)) not in sets:
                        sets[d] = s
                        held += len(s)
                if held >= PIECE_TOKENS:
                    yield from rows(flush(sets))
                    sets, held = {}, 0
        if sets:
            yield from rows(flush(sets))

    return send


def _shared(parts: int):
    """Bucket function of step 1: the tokens of two sets or more go back, by part of their set."""

    def shared(table: pa.Table) -> pa.Table:
        out = []
        rows = table.to_pylist()
        if rows and rows[0]["key"] < 0:
            out = [(-1 - r["key"], r["digests"], r["sizes"], r["tokens"], b"") for r in rows]
        elif rows:
            tokens, owners, hot = [], [], []
            for r in rows:
                t, d = _unplanes(r["tokens"]), np.frombuffer(r["digests"], np.int64)
                place = np.frombuffer(r["docs"], np.uint16 if len(d) <= 1 << 16 else np.uint32)
                tokens.append(t)
                owners.append(d[place])
                hot.append(_unplanes(r["frequent"]))
            token, owner = np.concatenate(tokens), np.concatenate(owners)
            hot = np.unique(np.concatenate(hot))
            order = np.lexsort((owner, token))
            token, owner = token[order], owner[order]
            if len(token):
                new = np.concatenate(([True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])))
                token, owner = token[new], owner[new]
            _, counts = _runs(token)
            df = np.repeat(counts, counts)
            frequent = (df >= FREQUENT) | np.isin(token, hot)
            keep = (df >= 2) | frequent
            token, owner, frequent = token[keep], owner[keep], frequent[keep]
            part = owner.view(np.uint64) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
            for p in range(parts):
                mine = order[edges[p] : edges[p + 1]]
                if len(mine):
                    out.append((p, owner[mine].tobytes(), b"", _planes(token[mine]), frequent[mine].tobytes()))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.int32(), *[pa.binary()] * 4]
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "digests", "sizes", "tokens", "frequent"]
        )

    return shared


def _signatures(n: int, rare: np.ndarray, frequent: np.ndarray, need: int) -> np.ndarray:
    """Signatures of a set whose prefix still has to count ``need`` tokens."""
    single = mix(rare[:need] ^ np.uint64(0x5BD1E995))
    need -= len(single)
    if need <= 0:
        return single
    out = [single]
    band = int(np.log(n) / np.log(1.25))
    for b in (band, band + 1):
        subclasses = max(1, int(0.1 * 1.25**b))
        sub = frequent % np.uint64(subclasses)
        # Position within the subclass: all but its first token count.
        order = np.argsort(sub, kind="stable")
        starts, counts = _runs(sub[order])
        later = np.ones(len(sub), bool)
        later[order[starts]] = False
        stop = int(np.searchsorted(np.cumsum(later), need)) + 1
        sub, tokens = sub[:stop], frequent[:stop]
        order = np.argsort(sub, kind="stable")
        starts, counts = _runs(sub[order])
        tag = np.uint64(b + 1)
        for s, c in zip(starts, counts):
            t = np.sort(tokens[order[s : s + c]])
            i, j = np.triu_indices(c, 1)
            out.append(mix(mix(t[i] + tag) * np.uint64(3) + mix(t[j])))
    return np.unique(np.concatenate(out))


_CANDIDATE = "digest bigint, n bigint, own bigint, tokens binary, signatures array<bigint>"


def _candidates(table: pa.Table) -> pa.Table:
    """Part function of step 2: sets that may link, with shared tokens and signatures."""
    digests, tokens, frequent, known = [], [], [], {}
    for r in table.to_pylist():
        d, t = np.frombuffer(r["digests"], np.int64), _unplanes(r["tokens"])
        f = np.frombuffer(r["frequent"], bool) if r["frequent"] else np.ones(len(t), bool)
        if r["sizes"]:
            whole = t == np.uint64(2**64 - 1)
            known.update(zip(d[whole].tolist(), np.frombuffer(r["sizes"], np.uint32)[whole].tolist()))
            d, t, f = d[~whole], t[~whole], f[~whole]
        digests.append(d), tokens.append(t), frequent.append(f)
    out = [[], [], [], [], []]
    if digests:
        d, t, f = np.concatenate(digests), np.concatenate(tokens), np.concatenate(frequent)
        order = np.lexsort((t, d))
        d, t, f = d[order], t[order], f[order]
        if len(d):
            new = np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])))
            d, t, f = d[new], t[new], f[new]
        for a, c in zip(*_runs(d)):
            n = known[int(d[a])]
            if n >= 4 and 5 * c >= 4 * n:
                own, mine, often = n - int(c), t[a : a + c], f[a : a + c]
                need = n - -(-4 * n // 5) + 1 - own
                signatures = _signatures(n, mine[~often], mine[often], need)
                for column, x in zip(out, (int(d[a]), n, own, mine.tobytes(), signatures.view(np.int64))):
                    column.append(x)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(out, kinds)], ["digest", "n", "own", "tokens", "signatures"]
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) of digests that link."""
    left = sets.select(F.col("digest").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("digest").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))

    def check(batches):
        for batch in batches:
            a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
            ta, tb = batch.column(4), batch.column(5)
            good = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(t[i].as_buffer(), np.uint64) for t in (ta, tb))
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= 80 * (int(na[i]) + int(nb[i]) - common))
            good = np.array(good, bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], ["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ta", "tb")
    return joined.mapInArrow(check, "a bigint, b bigint")


def links(documents: DataFrame, total: int) -> DataFrame:
    """(node, root): component of every set that links with another set; both are digests."""
    spark = documents.sparkSession
    buckets = 1 << max(3, (max(total, 1) // BUCKET_TOKENS).bit_length())
    parts = max(8, total // BUCKET_TOKENS)
    sent = documents.select(F.lit(0), "text").mapInArrow(lean(_send(buckets, parts)), _SENT)
    back = sent.groupBy("key").applyInArrow(_shared(parts), _BACK)
    sets = materialize(back.groupBy("part").applyInArrow(_candidates, _CANDIDATE), "join_sets")

    posts = sets.select(F.explode("signatures").alias("sig"), "digest", "n", "own")
    pivot = F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "digest", "n", "own")).alias("pivot")
    many = posts.groupBy("sig").agg(pivot, F.count("*").alias("sets")).where("sets > 1").drop("sets")
    posts = materialize(posts.join(many, "sig"), "join_posts")

    def allowed(n1, own1, n2, own2):
        """Whether the tokens that are not a set's own suffice for a link."""
        shared = F.least(F.col(n1) - F.col(own1), F.col(n2) - F.col(own2))
        return shared * 9 >= (F.col(n1) + F.col(n2)) * 4

    stars = (
        posts.where("digest <> pivot.digest").where(allowed("n", "own", "pivot.n", "pivot.own"))
        .select(F.least("digest", "pivot.digest").alias("a"), F.greatest("digest", "pivot.digest").alias("b"))
        .distinct()
    )
    stars = materialize(stars, "join_stars")
    found = materialize(_verified(stars, sets), "join_links")
    roots = components(found)

    labelled = (
        posts.drop("pivot").join(roots, posts["digest"] == roots["node"], "left")
        .withColumn("label", F.coalesce("root", "digest")).drop("node", "root")
    )
    per = labelled.groupBy("sig", "label").agg(F.count("*").alias("sets"))
    split = (
        per.groupBy("sig")
        .agg(F.max_by("label", F.struct("sets", "label")).alias("major"), F.count("*").alias("labels"))
        .where("labels > 1").drop("labels")
    )
    minor = (
        labelled.join(split, "sig").where("label <> major")
        .select("major", "digest").distinct()
    )
    minor = materialize(minor, "join_minor")
    more = materialize(_crossing(minor, sets, roots), "join_links")
    return roots if more.isEmpty() else components(found.union(more))


def _crossing(minor: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a, b) between components, from every set in ``minor`` (major, digest).

    Such a set is compared with all sets of the component ``major`` and all others that ``minor`` lists
    with it, block by block; a block reports one link per component that it finds.
    """
    own = sets.join(roots, sets["digest"] == roots["node"], "left").select(
        "digest", "n", "tokens", F.coalesce("root", "digest").alias("label")
    )
    of_major = own.join(minor.select(F.col("major").alias("label")).distinct(), "label").select(
        F.col("label").alias("major"), "digest"
    )
    members = of_major.union(minor)
    sizes = members.groupBy("major").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"))
    askers = minor.groupBy("major").agg(F.ceil(F.count("*") / ASKING_SETS).cast("int").alias("salts"))
    facts = sizes.join(askers, "major")

    def salt(n: str):
        return F.pmod(F.xxhash64("digest"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    columns = ["major", "block", "salt", "digest"]
    held = members.join(facts, "major").withColumn("block", salt("blocks")).withColumn("salt", every("salts"))
    asking = minor.join(facts, "major").withColumn("salt", salt("salts")).withColumn("block", every("blocks"))
    place = columns[:3]
    left = held.select(*columns).join(own, "digest").groupBy(*place)
    return left.cogroup(asking.select(*columns).join(own, "digest").groupBy(*place)).applyInArrow(_compare, "a bigint, b bigint")


def _compare(held: pa.Table, asking: pa.Table) -> pa.Table:
    """One link (a, b) from every asking set to every other component held in the block."""
    found: list[tuple[int, int]] = []
    if held.num_rows and asking.num_rows:
        tokens = [np.frombuffer(x, np.uint64) for x in held["tokens"].to_pylist()]
        owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        every = np.concatenate(tokens)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        digest, n, label = (held[c].to_numpy() for c in ("digest", "n", "label"))
        for row in asking.to_pylist():
            mine = np.frombuffer(row["tokens"], np.uint64)
            lo, hi = np.searchsorted(every, mine, "left"), np.searchsorted(every, mine, "right")
            count = hi - lo
            place = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
            common = np.bincount(owner[place], minlength=len(tokens))
            good = (100 * common >= 80 * (n + row["n"] - common)) & (label != row["label"])
            _, first = np.unique(label[good], return_index=True)
            found += [(row["digest"], int(y)) for y in digest[good][first]]
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def labelled_rows(documents: DataFrame) -> DataFrame:
    """(doc_id, mark, n, label, component_id) of every row.

    ``mark`` is ``xxhash64`` of the text. ``label`` is a number equal within a component and
    independent of ids; it and ``component_id`` are null for texts without words.
    """
    sizes = materialize(set_sizes(documents), "join_sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    least = sizes.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("first"))
    linked = links(documents, total)
    grouped = least.join(linked, least["digest"] == linked["node"], "left").withColumn("label", F.coalesce("root", "digest"))
    ids = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    of_digest = grouped.join(ids, "label").select("digest", "label", "component_id")
    return sizes.join(of_digest, "digest", "left").select("doc_id", "mark", "n", "label", "component_id")


def join_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    ``component_id`` is the smallest doc_id reachable by links, the document's own included.
    Texts without words, and null texts, have no shingles, link with nothing and are their own component.
    Repeated rows and equal texts link; null ids keep their rows and never name a component unless
    it has no other id. Other columns play no part.
    """
    return labelled_rows(documents).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return join_documents(read_table(spark, folder, "documents"))
