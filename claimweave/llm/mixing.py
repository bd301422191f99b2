"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: sources share a budget by weight, no source above a multiple of its own size, the
excess going to the others by weight. Seats: blocks of equal word count go to the source with the
highest quotient target / (2 k - 1) for its k-th block, shard by shard, which gives integer quotas
per source and shard. Selection: the documents of a source are laid end to end in a seeded order as a
ring of words; its blocks are the consecutive ones from a seeded start, going round as often as
the quota asks. So all but the two documents at the ends are taken whole, no document is taken
more often than the ring goes round, and no table of blocks is needed.

Built on DataFrame functions only. The driver sees sums over the sources, never the sources.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.tables import (
    WORD, add_running, bucket_count, group_key, hash_bucket, materialize, read_table,
)
from claimweave.scale import with_row_index

# Most words in a block; targets are met to within about half a block. A block is at most half the smallest
# target, so that every source with a target gets seats.
BLOCK_WORDS = 64
SEED = 29


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in code point order; ``share`` is the budget over all sizes."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    block: int = BLOCK_WORDS
    shards: int = 4
    seed: int = SEED


def _targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Adds ``target``: share by weight, held at ``most`` times the size, the excess shared anew."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level = mix.share * total, 0.0
    top = F.col("source_size") * mix.most
    while True:
        above = F.lit(level) * F.col("weight") > top
        held, free = sources.agg(F.sum(F.when(above, top)), F.sum(F.when(~above, F.col("weight")))).first()
        new = (budget - (held or 0)) / free if free else level
        if new <= level:
            break
        level = new
    target = F.least(F.lit(level) * F.col("weight"), top.cast("double"))
    return sources.withColumn("target", target.cast("double"))


def _seats(level: Column) -> Column:
    """How many of a source's quotients target / (2 k - 1) reach ``level``."""
    return F.floor((F.col("target") / level + 1) / 2)


def apportion(sources: DataFrame, house: int, name: str, passes: int = 12, width: int = 24) -> DataFrame:
    """Adds ``name``: how many of ``house`` seats go to each source by highest quotients.

    Every pass counts the seats at ``width`` levels at once and keeps the narrowest bracket; what
    then lies between its two levels is ordered by quotient and ``rank``.
    """
    least, most, n = sources.agg(F.min("target"), F.sum("target"), F.count("*")).first()
    if house <= 0 or not most:
        return sources.withColumn(name, F.lit(0).cast("bigint"))
    high, low = 2 * most, most / (2 * house + n + 1)  # no seats at all; at least as many as asked
    over = None
    for _ in range(passes):
        levels = [low * (high / low) ** (i / width) for i in range(1, width)]
        counts = sources.agg(*[F.sum(_seats(F.lit(x))) for x in levels]).first()
        ends = [(low, None), *zip(levels, counts), (high, 0)]
        i = max(j for j, (_, c) in enumerate(ends) if c is None or c >= house)
        (low, over), (high, under) = ends[i], ends[i + 1]
        if over == house or (over is not None and over - under <= 1000):
            break
        if not low < levels[0] < high and high / low < 1 + 1e-15:
            break
    if over == house:
        return sources.withColumn(name, _seats(F.lit(low)).cast("bigint"))
    sure, reach = _seats(F.lit(high)), _seats(F.lit(low))
    have = sources.agg(F.sum(sure)).first()[0] or 0
    between = (
        sources.where(reach > sure)
        .select("rank", "target", F.explode(F.sequence(sure + 1, reach)).alias("k"))
        .orderBy((F.col("target") / (F.col("k") * 2 - 1)).desc(), "rank")
        .limit(max(0, int(house - have)))
        .groupBy("rank")
        .agg(F.count("*").alias("extra"))
    )
    return (
        sources.join(between, "rank", "left")
        .withColumn(name, (sure + F.coalesce(F.col("extra"), F.lit(0))).cast("bigint"))
        .drop("extra")
    )


def source_quotas(rows: DataFrame, source: str, size: str, mix: Mix) -> DataFrame:
    """(key, rank, source_size, weight, target, block, quotas, quota): words of a block, blocks per shard and in all.

    Null is a source of its own, after all others.
    """
    sizes = rows.groupBy(group_key(F.col(source)).alias("key")).agg(F.sum(size).cast("bigint").alias("source_size"))
    ranked = with_row_index(sizes, [F.col("key")], "rank", start=0)
    weight = F.lit(mix.weights[-1])
    for i, w in enumerate(mix.weights[:-1]):
        weight = F.when(F.col("rank") % len(mix.weights) == i, w).otherwise(weight)
    out = materialize(_targets(materialize(ranked.withColumn("weight", weight), "mix"), mix), "mix")
    total, least = out.agg(F.sum("target"), F.min(F.when(F.col("target") > 0, F.col("target")))).first()
    block = int(max(1, min(mix.block, (least or 0) / 2)))
    house = round((total or 0.0) / block)
    names = [f"_seats_{j}" for j in range(1, mix.shards + 1)]
    base = out
    for j, name in enumerate(names, 1):
        seats = apportion(base, house * j // mix.shards, name)
        out = seats if j == 1 else out.join(seats.select("rank", name), "rank")
    out = materialize(out, "mix")
    steps = [F.col(b) - (F.col(a) if a else 0) for a, b in zip([None, *names], names)]
    return out.select(
        "key", "rank", "source_size", "weight", "target", F.lit(block).alias("block"),
        F.array(*steps).alias("quotas"), F.col(names[-1]).alias("quota"),
    )


def mix_sources(rows: DataFrame, source: str, size: str, tie: list[str], mix: Mix = Mix()) -> DataFrame:
    """Every row of ``rows`` with what the mix takes of it.

    Adds ``source_size``, ``target`` (its source's) and ``taken`` (words, repeats counted),
    of the words taken one time more than the rest ``head`` (the first ones) and ``tail`` (the last ones), and
    ``shard``, the shard whose blocks take the row's first words (null where nothing is taken): a shard has the
    next blocks of the ring, as many as its quota of the source.
    ``size`` counts a row's words; null counts as 0. Nothing is taken of a row of size 0, an
    empty table stays empty. Rows equal in ``tie`` and size are interchangeable.
    Clashing columns of the input are replaced.
    """
    added = ["source_size", "target", "taken", "head", "tail", "shard"]
    kept = [c for c in rows.columns if c.lower() not in added]
    base = rows.select(
        F.struct(*kept).alias("row"),
        group_key(F.col(source)).alias("key"),
        F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("size"),
        F.xxhash64(F.lit(mix.seed), *tie).alias("draw"),
        F.struct(*tie).alias("tie"),
    )
    base = materialize(base.withColumn("bucket", hash_bucket(F.col("draw"), bucket_count(rows.count()))), "mix_rows")
    quotas = source_quotas(base, "key", "size", mix).withColumn("key", F.substring("key", 2, 2_000_000_000))
    facts = quotas.select("key", "source_size", "target", "quota", "block", "quotas")
    order = [F.col("draw"), F.col("tie"), F.col("size")]
    at = add_running(base, ["key"], "bucket", order, F.col("size"), "at", facts=facts)
    words = F.least(F.col("quota") * F.col("block"), F.col("source_size") * mix.most)
    blocks = F.greatest(F.ceil(F.col("source_size") / F.col("block")), F.lit(1))
    ring = (
        at.withColumn("words", words)
        .withColumn("start", F.pmod(F.xxhash64(F.lit(mix.seed), "key"), blocks) * F.col("block"))
        .withColumn("rounds", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0))
        .withColumn("stop", F.col("start") + F.col("words") - F.col("rounds") * F.col("source_size"))
        .withColumn("end", F.col("at") + F.col("size"))
    )

    def overlap(lo: Column, hi: Column) -> Column:
        return F.greatest(F.least(F.col("end"), hi) - F.greatest(F.col("at"), lo), F.lit(0))

    # The last, partial round is [start, stop) on the ring: what passes its end begins again at 0.
    straight = overlap(F.col("start"), F.col("stop"))
    wrapped = overlap(F.lit(0), F.col("stop") - F.col("source_size"))
    first = F.when(F.col("at") >= F.col("start"), straight).otherwise(0)
    taken = F.col("rounds") * F.col("size") + straight + wrapped
    # the block of the first word taken, and the shards whose blocks all lie before it
    ahead = F.when((F.col("at") < F.col("start")) & (F.col("end") > F.col("start")), 0).otherwise(
        F.pmod(F.col("at") - F.col("start"), F.col("source_size"))
    )
    upto = F.transform("quotas", lambda q, i: F.aggregate(F.slice("quotas", 1, i + 1), F.lit(0).cast("bigint"), lambda a, x: a + x))
    shard = F.least(F.size(F.filter(upto, lambda q: q * F.col("block") <= ahead)), F.lit(mix.shards - 1))
    return ring.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        "source_size", "target",
        taken.cast("bigint").alias("taken"),
        (first + wrapped).cast("bigint").alias("head"),
        (straight - first).cast("bigint").alias("tail"),
        F.when(taken > 0, shard).alias("shard"),
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mixed_documents(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: a row per time a document is taken, cut where only part of it is.

    Columns are those of the input; ``n_chars`` follows the text. Documents without words are
    never taken.
    """
    columns = documents.columns
    # The documents travel as one column, so no column of theirs can clash. A hash of the text draws the order,
    # so that the text itself moves only once.
    sized = documents.select(
        F.struct(*columns).alias("doc"), F.col("source").alias("of"), F.col("doc_id").alias("id"),
        word_count(F.col("text")).alias("words"), F.xxhash64("text").alias("mark"),
    )
    mixed = mix_sources(sized, "of", "words", ["id", "mark"], mix)
    text = F.col("doc").getField("text")
    words = F.regexp_extract_all(text, F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    part = lambda a, n: F.array_join(F.slice(words, a, n), "")
    none = F.array().cast("array<string>")
    whole, n = F.expr("taken - head - tail"), F.col("words")
    pieces = F.concat(
        F.when(n > 0, F.array_repeat(text, (whole / n).cast("int"))).otherwise(none),
        F.when((n > 0) & (F.col("head") == n), F.array(text))
        .when(F.col("head") > 0, F.array(part(F.lit(1), F.col("head").cast("int"))))
        .otherwise(none),
        F.when(
            F.col("tail") > 0, F.array(part((n - F.col("tail") + 1).cast("int"), F.col("tail").cast("int")))
        ).otherwise(none),
    )
    out = mixed.select("doc", F.explode(pieces).alias("piece"))
    new = {"text": F.col("piece"), "n_chars": F.char_length("piece").cast("bigint")}
    return out.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in columns])


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    documents = read_table(spark, folder, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mix_sources(documents, "source", "size", ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "shard")
