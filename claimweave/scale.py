"""Size gates, shared-folder tables, hot-key salting and global row numbers.

Everything here exists so that the operators can be written once and stay
correct whatever the size of either side: a side is broadcast only after it has
been measured, a hot key is split by a number of salts derived from its exact
frequency, and lineage is cut only through tables in the shared checkpoint
folder, which outlive lost executors.
"""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import tempfile
import urllib.parse
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The largest claim batch, in bytes of claim-side data, that is ever broadcast.
BROADCAST_BYTES = 128 * 1024 * 1024
# A key with more rows than this is split over several tasks.
ROWS_PER_SALT = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local session may fall back to a folder of its own; a cluster without a
    shared folder is an error rather than a silent machine-local path.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="claimweave-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def remove_folder(path: str) -> bool:
    """Remove a folder of the shared store if it is there; False for stores that only Spark can reach."""
    parts = urllib.parse.urlsplit(path)
    try:
        if parts.scheme in ("", "file"):
            fs, root = pyarrow.fs.LocalFileSystem(), parts.path
        else:
            fs, root = pyarrow.fs.FileSystem.from_uri(path)
    except pa.ArrowInvalid:
        return False
    if fs.get_file_info(root).type != pyarrow.fs.FileType.NotFound:
        fs.delete_dir(root)
    return True


# Folder of intermediate tables within a ``scratch`` block.
_scratch: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch(folder: str) -> Iterator[None]:
    """Intermediate tables made inside go to ``folder``, which is removed at the end.

    What an attempt that was lost has left there is removed first, so the name should be the same for every
    attempt. Results must be written before the block ends.
    """
    remove_folder(folder)
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        remove_folder(folder)


def work_folder(spark: SparkSession) -> str:
    """Where intermediate tables go."""
    return _scratch.get() or shared_dir(spark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows with texts that go to a Python worker at once.
TEXTS_AT_ONCE = 512


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside hand few rows at once to Python workers, for rows with whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before) if int(before) > 0 else TEXTS_AT_ONCE, TEXTS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Hand free memory of a Python worker back to the system; it serves one task after the other."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not with this C library
        ctypes.CDLL(None).malloc_trim(0)


def _byte_size(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(field.dataType, T.ArrayType):
        if isinstance(field.dataType.elementType, T.StringType):
            return F.coalesce(F.octet_length(F.array_join(column, " ")), F.lit(0))
        return F.coalesce(F.size(column) * 8, F.lit(0))
    return F.lit(8)


@dataclass(frozen=True)
class Measured:
    """A table together with its exact row and byte count."""

    df: DataFrame
    rows: int
    bytes: int

    def fits(self, growth: float = 1.0, limit: int = BROADCAST_BYTES) -> bool:
        """Whether a table derived from this one, ``growth`` times its size, may be broadcast."""
        return self.bytes * growth <= limit


def measure(df: DataFrame) -> Measured:
    """Count rows and bytes in one aggregation (nothing but two numbers reaches the driver)."""
    size = F.lit(0)
    for field in df.schema.fields:
        size = size + _byte_size(field)
    row = df.agg(F.count("*").alias("n"), F.sum(size.cast("bigint")).alias("b")).first()
    return Measured(df, row["n"], row["b"] or 0)


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    """Hint a broadcast only where the caller has checked the size."""
    return F.broadcast(df) if small else df


def salts_for(rows: Column, rows_per_salt: int = ROWS_PER_SALT) -> Column:
    """Number of tasks a key with ``rows`` rows is split over (1 for ordinary keys)."""
    return F.ceil(rows / F.lit(rows_per_salt)).cast("int")


def salt_of(row_key: Column, salts: Column) -> Column:
    """Salt of one row of the big side: spreads equal keys by another column."""
    return F.pmod(F.xxhash64(row_key), salts.cast("bigint")).cast("int")


def all_salts(salts: Column) -> Column:
    """Every salt of a key, to replicate the small side."""
    return F.explode(F.sequence(F.lit(0), salts - 1))


def with_row_index(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in the order of ``order``, without a single-task sort.

    A range partitioning sorts the rows over all tasks; the row count of each range
    (one small row per task) gives the offset of the next one. ``order`` should be
    unique, otherwise equal rows share one range and get an arbitrary order.
    """
    ranged = materialize(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "row_index"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_offset") + F.row_number().over(within) + (start - 1)).cast("bigint"))
        .drop("_range", "_offset")
    )


def _range_keys(df: DataFrame, columns: list[str], width: int) -> list[Column]:
    """Keys of bounded width that never contradict the order of ``columns``.

    A text counts up to ``width`` characters, then whether it goes on; behind a text that goes on, the
    keys of later columns are null. Rows with equal keys are equal in all columns, or their first long
    text has the same beginning.
    """
    keys, whole = [], F.lit(True)
    for name in columns:
        if isinstance(df.schema[name].dataType, T.StringType):
            longer = F.coalesce(F.length(name) > width, F.lit(False))
            keys += [F.when(whole, F.substring(name, 1, width)), F.when(whole, longer)]
            whole = whole & ~longer
        else:
            keys.append(F.when(whole, F.col(name)))
    return keys


def number_rows(df: DataFrame, columns: list[str], name: str, start: int = 1, width: int = 64) -> DataFrame:
    """Consecutive numbers in ascending order of ``columns``, nulls first, texts of any length among them.

    The range exchange is keyed by the first ``width`` characters and a digest, so the sample of keys that
    the driver takes stays small, and rows that share a long beginning spread over many ranges. Sorted ranges
    are written once; a row's number is its place there plus the rows of earlier ranges (one small row per
    task). Only groups of equal keys that lie in several ranges, at most one per range border, are
    numbered again, among themselves, by eight times as many characters. Rows equal in all columns
    share a digest and are never split; their order is arbitrary.
    """
    low_bits = (1 << 33) - 1  # monotonically_increasing_id: partition above, place within it below
    rest, done = df.withColumn("_base", F.lit(start).cast("bigint")), None
    while True:
        keys = _range_keys(df, columns, width)
        ranged = materialize(
            rest.repartitionByRange("_base", *keys, F.xxhash64(*columns))
            .sortWithinPartitions("_base", *columns)
            .withColumn("_at", F.monotonically_increasing_id()),
            "row_numbers",
        ).withColumns({"_group": F.struct("_base", *keys), "_range": F.shiftright("_at", 33)})
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        ranges = materialize(
            ranged.groupBy("_range")
            .agg(F.count("*").alias("_n"), F.min_by("_group", "_at").alias("_first"), F.max_by("_group", "_at").alias("_last"))
            .select("_range", "_first", "_last", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")),
            "ranges",
        )
        placed = ranged.join(F.broadcast(ranges.select("_range", "_offset")), "_range").withColumn(
            "_place", F.col("_offset") + F.col("_at").bitwiseAND(F.lit(low_bits))
        )
        if done is None:
            numbered = placed.withColumn(name, F.col("_base") + F.col("_place"))
        else:
            # The rows of one base are consecutive; there are no more bases than ranges of the round before.
            first = placed.groupBy("_base").agg(F.min("_place").alias("_start"))
            numbered = placed.join(F.broadcast(first), "_base").withColumn(
                name, F.col("_base") + F.col("_place") - F.col("_start")
            )
        split = (
            ranges.select("_range", F.explode(F.array("_first", "_last")).alias("_group"))
            .groupBy("_group").agg(F.count_distinct("_range").alias("_n")).where("_n > 1").select("_group")
        )
        if split.isEmpty():
            last = numbered.select(*df.columns, name)
            return last if done is None else done.unionByName(last)
        settled = numbered.join(F.broadcast(split), "_group", "left_anti").select(*df.columns, name)
        done = settled if done is None else done.unionByName(settled)
        again = numbered.join(F.broadcast(split), "_group")
        bases = again.groupBy("_group").agg(F.min(name).alias("_next"))
        rest = again.join(F.broadcast(bases), "_group").select(*df.columns, F.col("_next").alias("_base"))
        width *= 8
