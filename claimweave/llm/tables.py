"""Small helpers shared by the operators: tables, column names, distributed positions."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.scale import materialize, shared_dir

# Words of the corpus: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def local_path(uri: str) -> str | None:
    """The plain path of a file: URI, None for any other store."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return None if "://" in uri else os.path.abspath(uri)


def lean(function: Callable) -> Callable:
    """A function of Arrow batches that hands free memory back to the system when its task ends.

    Python workers serve one task after the other, so what one of them keeps is missing to the next stage.
    """

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not with this C library
            pass

    return run


def each_text(column: pa.Array, rows: int = 256) -> Iterator[str | None]:
    """The texts of an Arrow column, a few at a time as Python objects."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def unused(taken: list[str], *names: str) -> list[str]:
    """Column names near ``names`` that do not clash with ``taken`` (compared without case)."""
    low, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in low:
            name += "_"
        low.add(name.lower())
        out.append(name)
    return out


def group_key(column: Column) -> Column:
    """A non-null text key that keeps null apart from every value and sorts it last."""
    return F.coalesce(F.concat(F.lit("0"), column.cast("string")), F.lit("1"))


def hash_bucket(h: Column, buckets: int) -> Column:
    """Number of the equal slice of the 64-bit range that ``h`` lies in; ``buckets`` is a power of two."""
    bits = buckets.bit_length() - 1
    return F.shiftrightunsigned(h, 64 - bits).cast("int") if bits else F.lit(0)


def bucket_count(rows: int, per_bucket: int = 20_000, least: int = 512) -> int:
    """Power of two that leaves about ``per_bucket`` rows in a bucket."""
    return 1 << max(least.bit_length() - 1, (max(rows, 1) // per_bucket).bit_length())


def add_running(
    df: DataFrame, group: list[str], bucket: str, order: list[Column], amount: Column, name: str,
    total: str | None = None, facts: DataFrame | None = None,
) -> DataFrame:
    """Sum of ``amount`` over the rows of ``group`` before this one, by ``bucket``, then ``order``.

    Buckets are slices of the order, so their totals give the offset of every bucket and a window
    never holds more than one bucket of one group. ``total`` names a column for the group's sum,
    ``facts`` holds more columns per group; both travel with the small table of bucket offsets,
    so that no join brings a whole group together. ``df`` is read twice: cut its lineage first
    if it is costly.
    """
    own, before = unused(df.columns, "_own", "_before")
    keyed = df.withColumn(own, amount)
    group_rows = Window.partitionBy(*group)
    earlier = group_rows.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*group, bucket)
        .agg(F.sum(own).alias(own))
        .select(
            *group, bucket, F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias(before),
            *([F.sum(own).over(group_rows).alias(total)] if total else []),
        )
    )
    if facts is not None:
        offsets = offsets.join(facts, group)
    within = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.join(offsets, [*group, bucket])
        .withColumn(name, F.col(before) + F.coalesce(F.sum(own).over(within), F.lit(0)))
        .drop(own, before)
    )


__all__ = [
    "WORD", "add_running", "bucket_count", "each_text", "group_key", "hash_bucket", "lean", "local_path", "materialize",
    "new_folder", "read_table", "shared_dir", "unused",
]
