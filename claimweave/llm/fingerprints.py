"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the sorted array of the ``K`` smallest distinct 64-bit hashes of a text's word
shingles (all of them, if there are fewer). Sketches of parts merge into the sketch of the whole, and
estimate resemblance, containment and the number of distinct shingles. Shingles are five
words; a text of one to four words is one shingle, a text without words has none.

Built on DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.llm.tables import read_table, unused

K = 128
SHINGLE = 5


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    plain = F.translate(F.coalesce(text, F.lit("")), upper + "\t\n\x0b\x0c\r", lower + " " * 5)
    return F.array_remove(F.split(plain, " "), "")


def shingle_hashes(tokens: Column, size: int = SHINGLE) -> Column:
    """Hashes of all runs of ``size`` words, repeats included."""

    def hashes(t: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(t) - (size - 1)), lambda i: F.xxhash64(F.slice(t, i, size)))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(t) >= size, runs).when(F.size(t) > 0, F.array(F.xxhash64(t))).otherwise(none)

    return _let(tokens, hashes)


def bottom(hashes: Column, k: int = K) -> Column:
    """Sketch of an array of hashes."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    return bottom(shingle_hashes(words(text), size), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two texts' shingles."""
    return bottom(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness; exact while the union fits ``k``. Two empty sketches are equal (1)."""

    def share(union: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(union, a), b))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))

    return _let(merge(a, b, k), share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 if a is empty."""

    def share(of_a: Column) -> Column:
        both = F.size(F.array_intersect(of_a, b))
        return F.when(F.size(of_a) == 0, F.lit(0.0)).otherwise(both / F.size(of_a))

    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(_let(F.array_intersect(merge(a, b, k), a), share))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    largest = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / largest)


def as_text(a: Column) -> Column:
    """Fixed-width hex of a sketch."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merged_sketch(rows: DataFrame, keys: list[str], name: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from sketches of its parts, merged in steps so that no key is gathered whole.

    Only the ``k`` smallest hashes of a key matter, and they are picked among hash slices first.
    """
    part, = unused(keys, "_hash")
    spread = rows.select(*keys, F.explode(name).alias(part)).distinct()
    slice_, rank = unused([*keys, part], "_slice", "_rank")
    first = Window.partitionBy(*keys, slice_).orderBy(part)
    then = Window.partitionBy(*keys).orderBy(part)
    few = (
        spread.withColumn(slice_, F.shiftrightunsigned(F.xxhash64(part), 54))
        .withColumn(rank, F.row_number().over(first)).where(F.col(rank) <= k)
        .withColumn(rank, F.row_number().over(then)).where(F.col(rank) <= k)
    )
    return few.groupBy(*keys).agg(F.sort_array(F.collect_list(part)).alias(name))


def _range_ends(ids: DataFrame, ranges: int) -> list[int]:
    """Ids that cut the table into about equal ranges; each is in the table, the last is the largest."""
    shares = [i / ranges for i in range(1, ranges)]
    cuts, top = ids.agg(
        F.percentile_approx("doc_id", F.array(*map(F.lit, shares or [0.5])), 20 * ranges).alias("cuts"), F.max("doc_id")
    ).first()
    return sorted({*(cuts or []), top} - {None})


def in_ranges(rows: DataFrame, ranges: int) -> DataFrame:
    """Rows dealt out by ``range``, a slice of the ids, so that every row finds its next one there.

    Rows of the largest id of a range are also sent, as ``guest``, to the range above it, where
    they follow the last row; those of the largest id of all follow the last row of the lowest
    range, and null ids stand at its end before them.
    """
    ends = _range_ends(rows.select("doc_id"), ranges)
    table = F.array(*map(F.lit, ends)) if ends else None
    at = F.lit(0)
    if ends:  # how many ends are below the id, by halving
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(ends).bit_length()))])
        at = F.aggregate(
            steps, F.lit(0),
            lambda at, step: F.when(
                (at + step <= len(ends)) & (F.get(table, at + step - 1) < F.col("doc_id")), at + step
            ).otherwise(at),
        )
    known = F.when(F.col("doc_id").isNull(), 0).otherwise(at)
    top = F.lit(ends[-1] if ends else None).cast("bigint")
    guest_in = (
        F.when(F.col("doc_id").eqNullSafe(top), 0)
        .when(F.get(table, F.col("range")) == F.col("doc_id"), F.col("range") + 1)
        if ends else F.lit(0)
    )
    places = F.array_compact(F.array(
        F.struct(F.col("range").alias("range"), F.lit(False).alias("guest")),
        F.when(F.col("guest_in").isNotNull(), F.struct(F.col("guest_in").alias("range"), F.lit(True).alias("guest"))),
    ))
    return (
        rows.withColumn("range", known.cast("int")).withColumn("guest_in", guest_in)
        .withColumn("place", F.explode(places))
        .select(*rows.columns, F.col("place.range").alias("range"), F.col("place.guest").alias("guest"))
        .repartition("range")
    )


def fingerprint_documents(documents: DataFrame, k: int = K, ranges: int | None = None) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, one row per document.

    The edited text of n code points has its last n // 3 replaced by as many of the first ones of the next
    document by descending ``doc_id`` (all of them, if it has fewer; the last document is
    followed by the first). Null text is the empty text. Repeated and null ids keep their rows.
    Other columns of the input play no part.
    """
    spark = documents.sparkSession
    ranges = ranges or 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = in_ranges(rows, ranges).withColumn("sketch", sketch(F.col("text"), k))
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    n = F.char_length("text")
    third = F.expr("char_length(text) div 3").cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    return (
        placed.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_sketch", F.lead("sketch").over(order))
        .where(~F.col("guest"))
        .select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
        .withColumn("edited_sketch", sketch(F.col("edited"), k))
        .select(
            "doc_id", "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            as_text(F.col("sketch")).alias("fingerprint"),
            as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
            resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
            resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
            distinct_shingles(F.col("sketch"), k).alias("distinct_estimate"),
        )
    )


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint_documents(read_table(spark, folder, "documents"))
