"""Near-duplicate embeddings by NN-descent.

Equal vectors are one node. Every node keeps a list of its nearest nodes found so far. The lists start from
random hyperplane leaves and are refined in rounds: the neighbours of a node, in both directions, are compared
with each other, and every pair that improves a list of either side enters it. Comparisons use 8-bit copies of
the unit vectors; pairs within their error of the threshold are compared again in double precision.

A list that is full of links may miss more of them, so it is enlarged to its whole connected group: the group is
cut into blocks by the angle to its first node, block pairs are linked or apart by the triangle inequality where
that decides, and compared in full otherwise. Groups with full lists are themselves linked by a graph over a few
nodes of each. The recall of a sample against all rows is measured, and lists double until it suffices.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.llm.components import components
from claimweave.llm.tables import materialize, read_table
from claimweave.scale import maybe_broadcast

THRESHOLD = 0.9
NEIGHBOURS = 8
# Trees of hyperplane leaves, most hyperplanes of a tree, nodes in a leaf (a larger one is dealt out).
TREES, BITS, LEAF = 4, 48, 1024
# Neighbours of a node that are compared in a round, and the share of new links that ends the rounds.
MEMBERS = 12
QUIET = 0.001
# Nodes that stand for a group with full lists, and nodes in a block of a group.
ENVOYS, BLOCK = 3, 512
# Cells of the angle to a group's first node, per angle of the threshold.
CELLS = 64
# Sampled nodes that are compared with all others, and the recall they have to reach.
AUDIT, RECALL = 1024, 0.98
# Bytes of a table that is sent to all tasks.
SMALL_BYTES = 32 << 20
SEED = 20_011

EDGES = "array<struct<s:float,v:bigint,fresh:boolean>>"


def _rows(vectors: DataFrame, kind: str) -> DataFrame:
    """(vec_id, key, vector): the bytes of every usable vector and their digest, null for all others."""

    def read(batches):
        for batch in batches:
            lists = batch.column(1)
            at = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(kind)
            whole = lists.is_valid().to_numpy(zero_copy_only=False)
            data: list[bytes | None] = []
            for i in range(len(lists)):
                own = values[at[i] : at[i + 1]] if whole[i] else values[:0]
                data.append(own.tobytes() if len(own) and np.isfinite(own).all() and own.any() else None)
            keys = [x and hashlib.blake2b(x, digest_size=16).digest() for x in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(data, pa.binary())], ["vec_id", "key", "vector"]
            )

    element = "float" if kind == "<f4" else "double"
    columns = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(f"array<{element}>"))
    return columns.mapInArrow(read, "vec_id bigint, key binary, vector binary")


def _units(data: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one dimension, scaled to length 1 in double precision."""
    x = np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_size(data: list[bytes]):
    """Row numbers of the byte strings of every length."""
    sizes = np.array([len(x) for x in data])
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def _nodes(rows: DataFrame, kind: str) -> DataFrame:
    """One row per distinct vector: node, key, copies, first_id, vector, 8-bit code and its error."""

    def encode(batches):
        for batch in batches:
            columns = {c: batch.column(c) for c in ("node", "key", "copies", "first_id", "vector")}
            data = columns["vector"].to_pylist()
            codes: list[bytes] = [b""] * len(data)
            errors = np.zeros(len(data))
            for own in _by_size(data):
                x = _units([data[i] for i in own], kind)
                scale = np.abs(x).max(axis=1, keepdims=True).astype("<f4") / np.float32(127)
                q = np.rint(x / scale)
                errors[own] = np.sqrt(((q * scale - x) ** 2).sum(axis=1))
                code = np.concatenate([scale.view(np.int8).reshape(len(own), 4), q.astype(np.int8)], axis=1)
                for i, c in zip(own, code):
                    codes[i] = c.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(codes, pa.binary()), pa.array(errors)], [*columns, "code", "error"]
            )

    distinct = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first_id"), F.first("vector").alias("vector")
    )
    named = distinct.select(F.monotonically_increasing_id().alias("node"), "key", "copies", "first_id", "vector")
    kinds = "node bigint, key binary, copies bigint, first_id bigint, vector binary, code binary, error double"
    return named.mapInArrow(encode, kinds)


def _decoded(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(8-bit components, scales) of codes of one dimension."""
    raw = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1)
    return raw[:, 4:].astype(np.float32), np.ascontiguousarray(raw[:, :4]).view("<f4").ravel()


def _leaf_edges(nodes: DataFrame, n: int, k: int, leaf: int, salt: int) -> DataFrame:
    """(node, s, v, fresh): the k nearest nodes within every leaf of every tree.

    A leaf is the set of nodes on the same sides of as many seeded hyperplanes as give about ``leaf`` nodes.
    """
    bits = min(BITS, max(0, math.ceil(math.log2(max(n, 1) / leaf))))
    trees = TREES if bits else 1

    def place(batches):
        for batch in batches:
            node, codes = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for own in _by_size(codes):
                x, _ = _decoded([codes[i] for i in own])
                for tree in range(trees):
                    planes = np.random.default_rng([SEED, salt, tree, x.shape[1]]).standard_normal((x.shape[1], bits))
                    sides = (x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.RecordBatch.from_pydict({
                        "node": node[own], "code": pa.array([codes[i] for i in own], pa.binary()),
                        "dim": np.full(len(own), x.shape[1]), "tree": np.full(len(own), tree), "leaf": sides,
                    })

    placed = nodes.select("node", "code").mapInArrow(place, "node bigint, code binary, dim bigint, tree bigint, leaf bigint")
    sizes = placed.groupBy("dim", "tree", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > 2 * leaf)
    large = sizes.withColumn("parts", F.ceil(F.col("n") / leaf)).drop("n")
    few = trees * n // (2 * leaf) * 32 <= SMALL_BYTES  # there are no more large leaves than that
    dealt = placed.join(maybe_broadcast(large, few), ["dim", "tree", "leaf"], "left").withColumn(
        "part", F.pmod(F.xxhash64("node", "tree"), F.coalesce("parts", F.lit(1)))
    )

    def nearest(table: pa.Table) -> pa.Table:
        own = table.column("node").to_numpy()
        x, scale = _decoded(table.column("code").to_pylist())
        some = min(k, len(own) - 1)
        if not some:
            return pa.table({"node": own[:0], "s": pa.array([], pa.float32()), "v": own[:0], "fresh": pa.array([], pa.bool_())})
        s = (x @ x.T).astype(np.float64) * np.outer(scale, scale)
        np.fill_diagonal(s, -2.0)
        at = np.argpartition(-s, some - 1, axis=1)[:, :some]
        found = np.take_along_axis(s, at, axis=1).astype(np.float32).ravel()
        return pa.table({"node": np.repeat(own, some), "s": found, "v": own[at].ravel(), "fresh": np.ones(len(found), bool)})

    groups = dealt.select("node", "code", "dim", "tree", "leaf", "part").groupBy("dim", "tree", "leaf", "part")
    return groups.applyInArrow(nearest, "node bigint, s float, v bigint, fresh boolean")


def _lists(edges: DataFrame, k: int) -> DataFrame:
    """(node, edges): the k best different entries of every node, best first; an entry known before is not fresh."""
    best = Window.partitionBy("node").orderBy(F.desc("s"), F.desc("v"))
    kept = edges.withColumn("place", F.dense_rank().over(best)).where(F.col("place") <= k)
    single = kept.groupBy("node", "s", "v").agg(F.min("fresh").alias("fresh"))
    entry = F.struct("s", "v", "fresh")
    return single.groupBy("node").agg(F.sort_array(F.collect_list(entry), False).cast(EDGES).alias("edges"))


def _neighbours_of_neighbours(graph: DataFrame, nodes: DataFrame, k: int, members: int, turn: int) -> DataFrame:
    """(node, s, v, fresh): better entries found by comparing the neighbours of every node with each other.

    A node's members are its listed nodes and those that list it, the fresh ones first, the others in a seeded
    order; pairs without a fresh member were compared before.
    """
    worst = F.when(F.size("edges") >= k, F.element_at("edges", -1)["s"]).otherwise(F.lit(-2.0)).cast("float")
    known = graph.select("node", "edges", worst.alias("worst")).join(nodes.select("node", "code"), "node")
    listed = (
        graph.select(F.col("node").alias("z"), F.inline("edges"))
        .join(known.select(F.col("node").alias("v"), "code", "worst"), "v")
        .select("z", F.col("v").alias("m"), "code", "worst", "fresh")
    )
    listing = known.select(F.col("node").alias("m"), "code", "worst", F.inline("edges")).select(
        F.col("v").alias("z"), "m", "code", "worst", "fresh"
    )
    order = Window.partitionBy("z").orderBy(F.desc("fresh"), F.xxhash64("z", "m", F.lit(turn)))
    chosen = listed.unionByName(listing).withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= members)

    def compare(batches):
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            z = table.column("z").to_numpy()
            cut = int(np.flatnonzero(np.r_[True, z[1:] != z[:-1]])[-1])
            rest = table.slice(cut)  # the last node may go on in the next batch
            yield from found(table.slice(0, cut))
        if rest is not None:
            yield from found(rest)

    def found(table: pa.Table):
        codes = table.column("code").to_pylist()
        z, m, worst, fresh = (table.column(c).to_numpy() for c in ("z", "m", "worst", "fresh"))
        for own in _by_size(codes):
            first = np.flatnonzero(np.r_[True, z[own][1:] != z[own][:-1]])
            size = np.diff(np.r_[first, len(own)])
            group = np.repeat(np.arange(len(first)), size)
            slot = np.arange(len(own)) - np.repeat(first, size)
            x, scale = _decoded([codes[i] for i in own])
            shape = (len(first), int(size.max()))
            cube = np.zeros((*shape, x.shape[1]), np.float32)
            cube[group, slot] = x
            name, least, new, scales = (np.zeros(shape, t) for t in (np.int64, np.float32, bool, np.float64))
            used = np.zeros(shape, bool)
            name[group, slot], least[group, slot], new[group, slot], scales[group, slot], used[group, slot] = m[own], worst[own], fresh[own], scale, True
            s = ((cube @ cube.transpose(0, 2, 1)).astype(np.float64) * scales[:, :, None] * scales[:, None, :]).astype(np.float32)
            good = used[:, :, None] & used[:, None, :] & (name[:, :, None] != name[:, None, :])
            good &= (new[:, :, None] | new[:, None, :]) & (s > least[:, :, None])
            g, i, j = np.nonzero(good)
            a, b, s = name[g, i], name[g, j], s[g, i, j]
            order = np.lexsort((-b, -s, a))  # best first, equal ones side by side
            a, b, s = a[order], b[order], s[order]
            keep = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
            a, b, s = a[keep], b[keep], s[keep]
            start = np.searchsorted(a, a)
            keep = np.arange(len(a)) - start < k
            yield pa.RecordBatch.from_pydict({"node": a[keep], "s": s[keep], "v": b[keep], "fresh": np.ones(int(keep.sum()), bool)})

    return chosen.select("z", "m", "code", "worst", "fresh").mapInArrow(compare, "node bigint, s float, v bigint, fresh boolean")


def neighbour_graph(nodes: DataFrame, k: int, near: float, leaf: int = LEAF, salt: int = 0, members: int = MEMBERS) -> DataFrame:
    """(node, edges) after as many rounds as add links, that is entries of at least ``near``."""
    n = nodes.count()
    graph = materialize(_lists(_leaf_edges(nodes, n, k, leaf, salt), k), "graph")
    if n <= leaf:  # one leaf held all pairs
        return graph
    turn = 0
    while True:
        turn += 1
        old = graph.select("node", F.inline("edges")).withColumn("fresh", F.lit(False))
        better = _neighbours_of_neighbours(graph, nodes, k, members, turn)
        graph = materialize(_lists(old.unionByName(better), k), "graph")
        links = F.filter("edges", lambda e: e["s"] >= near)
        seen = graph.agg(F.sum(F.size(links)).alias("all"), F.sum(F.size(F.filter(links, lambda e: e["fresh"]))).alias("new")).first()
        if (seen["new"] or 0) <= QUIET * (seen["all"] or 0):
            return graph


def verified_links(graph: DataFrame, nodes: DataFrame, kind: str, threshold: float, margin: float) -> DataFrame:
    """(a, b), a < b, of the graph's entries with a cosine of at least the threshold in double precision."""
    entry = graph.select("node", F.inline("edges")).where(F.col("s") >= threshold - margin)
    pairs = entry.select(F.least("node", "v").alias("a"), F.greatest("node", "v").alias("b"), "s").groupBy("a", "b").agg(F.max("s").alias("s"))
    pairs = materialize(pairs, "near_pairs")
    sure, open_ = pairs.where(F.col("s") >= threshold + margin), pairs.where(F.col("s") < threshold + margin)
    vector = nodes.select("node", "vector")
    both = (
        open_.join(vector.select(F.col("node").alias("a"), F.col("vector").alias("va")), "a")
        .join(vector.select(F.col("node").alias("b"), F.col("vector").alias("vb")), "b")
    )

    def test(batches):
        for batch in batches:
            left, right = batch.column("va").to_pylist(), batch.column("vb").to_pylist()
            good = np.zeros(len(left), bool)
            for own in _by_size(left):
                x, y = _units([left[i] for i in own], kind), _units([right[i] for i in own], kind)
                good[own] = (x * y).sum(axis=1) >= threshold
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return sure.select("a", "b").unionByName(both.select("a", "b", "va", "vb").mapInArrow(test, "a bigint, b bigint"))


def _bridges(full: DataFrame, groups: DataFrame, nodes: DataFrame, kind: str, k: int, threshold: float, margin: float) -> DataFrame | None:
    """Links between groups with full lists, found over a few nodes of each; None if there are none.

    ``full`` holds the nodes whose list is full of links, ``groups`` (node, root).
    """
    roots = groups.join(full, "node", "left_semi").select("root").distinct()
    members = groups.join(roots, "root", "left_semi")
    drawn = Window.partitionBy("root").orderBy(F.xxhash64("node"))
    envoys = materialize(
        members.withColumn("place", F.row_number().over(drawn)).where(F.col("place") <= ENVOYS).select("node", "root"), "envoys"
    )
    if envoys.select("root").distinct().count() < 2:
        return None
    chosen = materialize(nodes.join(envoys.select("node"), "node", "left_semi"), "envoy_nodes")
    links = verified_links(neighbour_graph(chosen, k, threshold - margin), chosen, kind, threshold, margin)
    root = envoys.select(F.col("node").alias("a"), F.col("root").alias("ra")), envoys.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    crossing = materialize(links.join(root[0], "a").join(root[1], "b").where("ra <> rb").select("a", "b"), "bridges")
    return crossing if crossing.limit(1).count() else None


def _vector_bytes(members: DataFrame) -> int:
    """The longest vector of a table, in bytes."""
    return members.agg(F.max(F.octet_length("vector")).alias("b")).first()["b"] or 0


def _group_sums(members: DataFrame, n: int, kind: str, threshold: float) -> DataFrame:
    """(node, total): copies of all members of the node's group with a cosine of at least the threshold, its own included.

    ``members`` has (root, node, copies, vector), ``n`` rows at most; groups may be of any size.
    """
    limit = math.acos(threshold)
    width = limit / CELLS
    sizes = members.groupBy("root").agg(F.count("*").alias("size"))
    large = materialize(
        sizes.where(F.col("size") > BLOCK).join(members.where("root = node").select("root", F.col("vector").alias("head")), "root"), "large_groups"
    )

    def cells(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int64)
            heads_, vectors = batch.column("head").to_pylist(), batch.column("vector").to_pylist()
            for own in _by_size([h or b"" for h in heads_]):
                if heads_[own[0]]:
                    x, y = _units([vectors[i] for i in own], kind), _units([heads_[i] for i in own], kind)
                    out[own] = np.arccos(np.clip((x * y).sum(axis=1), -1.0, 1.0)) // width
            names = ["root", "node", "copies", "vector"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out)], [*names, "cell"])

    with_heads = members.join(maybe_broadcast(large.drop("size"), _vector_bytes(members) * n // BLOCK <= SMALL_BYTES), "root", "left")
    placed = materialize(
        with_heads.select("root", "node", "copies", "vector", "head").mapInArrow(
            cells, "root bigint, node bigint, copies bigint, vector binary, cell bigint"
        ),
        "placed",
    )
    # a group has at most pi / width cells, so its list of cells is bounded
    cell = placed.groupBy("root", "cell").agg(F.count("*").alias("n"), F.sum("copies").alias("copies"))
    cell = cell.withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int"))
    is_large = F.col("size").isNotNull()
    lists = cell.groupBy("root").agg(F.collect_list(F.struct("cell", "copies", "parts")).alias("cells"))
    around = cell.join(lists, "root").join(large.drop("head"), "root", "left")
    # two members are linked if their angles to the head, rounded up, sum to less than the threshold's
    sure_sum = math.floor((limit - 1e-6) / width) - 2
    sure = F.aggregate(
        F.filter("cells", lambda c: is_large & (c["cell"] + F.col("cell") <= sure_sum)), F.lit(0).cast("bigint"), lambda a, c: a + c["copies"]
    )
    cell = materialize(
        around.select(
            "root", "cell", "parts", sure.alias("sure"),
            F.filter("cells", lambda c: (c["cell"] >= F.col("cell")) & (~is_large | (c["cell"] + F.col("cell") > sure_sum))
                     & (c["cell"] - F.col("cell") <= CELLS + 1)).alias("open"),
        ),
        "cells",
    )
    opened = cell.select("root", F.col("cell").alias("c1"), F.col("parts").alias("n1"), F.inline("open")).select(
        "root", "c1", "n1", F.col("cell").alias("c2"), F.col("parts").alias("n2")
    )
    pairs = (
        opened.withColumn("p1", F.explode(F.sequence(F.lit(0), F.col("n1") - 1)))
        .withColumn("p2", F.explode(F.sequence(F.lit(0), F.col("n2") - 1)))
        .where((F.col("c1") < F.col("c2")) | (F.col("p1") <= F.col("p2")))
    )
    blocks = placed.join(cell.select("root", "cell", "parts"), ["root", "cell"]).select(
        "root", "cell", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node", "copies", "vector"
    )
    pair = ["root", "c1", "p1", "c2", "p2"]
    alone = (F.col("c1") == F.col("c2")) & (F.col("p1") == F.col("p2"))
    one = pairs.join(blocks.select("root", F.col("cell").alias("c1"), F.col("part").alias("p1"), "node", "copies", "vector"), ["root", "c1", "p1"])
    two = pairs.where(~alone).join(
        blocks.select("root", F.col("cell").alias("c2"), F.col("part").alias("p2"), "node", "copies", "vector"), ["root", "c2", "p2"]
    )
    sides = one.select(*pair, F.lit(1).alias("side"), "node", "copies", "vector").unionByName(
        two.select(*pair, F.lit(2).alias("side"), "node", "copies", "vector")
    )

    def compare(batches):
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            cuts = starts(table)
            rest = table.slice(cuts[-1])
            for a, z in zip(cuts, cuts[1:]):
                yield counts(table.slice(a, z - a))
        if rest is not None:
            yield counts(rest)

    def starts(table: pa.Table) -> list[int]:
        keys = np.stack([table.column(c).to_numpy() for c in pair])
        return np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]).tolist()

    def counts(table: pa.Table) -> pa.RecordBatch:
        side, node, copies = (table.column(c).to_numpy() for c in ("side", "node", "copies"))
        x = _units(table.column("vector").to_pylist(), kind)
        a, b = side == 1, side == 2
        if b.any():
            near = x[a] @ x[b].T >= threshold
            node, total = np.r_[node[a], node[b]], np.r_[near @ copies[b], near.T @ copies[a]]
        else:
            total = (x @ x.T >= threshold) @ copies
        return pa.RecordBatch.from_pydict({"node": node, "total": total})

    # sorted by pair, a task holds one pair of blocks at a time
    dealt = sides.repartition(*pair).sortWithinPartitions(*pair)
    compared = dealt.mapInArrow(compare, "node bigint, total bigint")
    decided = placed.join(cell.select("root", "cell", "sure"), ["root", "cell"]).select("node", F.col("sure").alias("total"))
    return compared.unionByName(decided).groupBy("node").agg(F.sum("total").alias("total"))


def audit(nodes: DataFrame, totals: DataFrame, kind: str, threshold: float, sample: int = AUDIT) -> float:
    """Share of the links of ``sample`` nodes, counted against all nodes, that ``totals`` (node, total) has."""
    drawn = nodes.orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(sample).select("node", "vector", "copies").collect()
    data = {
        len(drawn[own[0]]["vector"]): (_units([drawn[i]["vector"] for i in own], kind), np.array([drawn[i]["node"] for i in own]))
        for own in _by_size([r["vector"] for r in drawn])
    }

    def compare(batches):
        for batch in batches:
            vectors, copies = batch.column("vector").to_pylist(), batch.column("copies").to_numpy()
            for own in _by_size(vectors):
                if len(vectors[own[0]]) not in data:
                    continue
                queries, names = data[len(vectors[own[0]])]
                total = np.zeros(len(names), np.int64)
                for at in range(0, len(own), 1024):
                    some = own[at : at + 1024]
                    total += copies[some] @ (_units([vectors[i] for i in some], kind) @ queries.T >= threshold)
                yield pa.RecordBatch.from_pydict({"node": names, "true": total})

    true = nodes.select("vector", "copies").mapInArrow(compare, "node bigint, true bigint").groupBy("node").agg(F.sum("true").alias("true"))
    own = nodes.select("node", "copies")
    both = true.join(own, "node").join(totals, "node", "left").select(
        (F.col("true") - F.col("copies")).alias("true"), (F.coalesce("total", "copies") - F.col("copies")).alias("found")
    )
    seen = both.agg(F.sum("true").alias("true"), F.sum("found").alias("found")).first()
    return seen["found"] / seen["true"] if seen["true"] else 1.0


def link_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS, recall: float = RECALL, leaf: int = LEAF
) -> tuple[DataFrame, float]:
    """((vec_id, n_links, component_id, kept) of every row, measured recall).

    Rows count one by one: equal vectors are linked with each other, repeated ids stay repeated. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing, as do vectors of different
    length. ``component_id`` is the smallest id of the component, null only if it has no other.
    """
    kind = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    rows = _rows(vectors, kind)
    nodes = materialize(_nodes(rows, kind), "nodes")
    error = nodes.agg(F.max("error").alias("e")).first()["e"] or 0.0
    margin = 2 * error + error * error + 1e-5  # no cosine of two codes is further off
    links: DataFrame | None = None
    total_nodes, salt = nodes.count(), 0
    while True:
        graph = neighbour_graph(nodes, k, threshold - margin, leaf, salt)
        found = verified_links(graph, nodes, kind, threshold, margin)
        links = materialize(found if links is None else found.unionByName(links).distinct(), "links")
        full = graph.where((F.size("edges") >= k) & (F.element_at("edges", -1)["s"] >= threshold - margin)).select("node")
        groups = components(links)
        while (more := _bridges(full, groups, nodes, kind, k, threshold, margin)) is not None:
            links = materialize(links.unionByName(more), "links")
            groups = components(links)
        groups = materialize(groups, "groups")
        members = groups.join(nodes.select("node", "copies", "vector"), "node").select("root", "node", "copies", "vector")
        totals = materialize(_group_sums(materialize(members, "members"), total_nodes, kind, threshold), "totals")
        measured = audit(nodes, totals, kind, threshold)
        if measured >= recall or k >= total_nodes:
            break
        k, salt = 2 * k, salt + 1
    first = groups.join(nodes.select("node", "first_id"), "node").groupBy("root").agg(F.min("first_id").alias("component_id"))
    facts = (
        nodes.select("node", "key", "copies", "first_id").join(groups, "node", "left").join(first, "root", "left").join(totals, "node", "left")
        .select(
            "key", (F.coalesce("total", "copies") - 1).alias("n_links"),
            F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )
    out = rows.select("vec_id", "key").join(facts, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), measured


def op11_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links, component and its first id for every row of ``embeddings`` at a cosine of 0.9."""
    return link_vectors(read_table(spark, folder, "embeddings"))[0]
