"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned by id; every partition writes three flat files in id order:
``.bin`` (the ids, 16 bits if the vocabulary fits, else 32), ``.idx`` (64-bit offsets of its
documents within the file, one more than documents) and ``.ids`` (64-bit document ids). A small
table lists one row per file with its base, the number of ids in all files before it. A task
writes under a name of its own and the table names the files of tasks that ended well, so a
retried or doubled task leaves no trace in the result.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.llm import tokens
from claimweave.llm.tables import lean, local_path, materialize, new_folder, read_table

# Ids below this get the flag for a null document id, which has no 64-bit value of its own.
NULL_ID = np.iinfo(np.int64).min
_ROWS = 2000


def _store(folder: str):
    """(file system, path) of a folder that driver and executors share."""
    path = local_path(folder)
    if path is not None:
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(folder)


def read_flat(folder: str, name: str, dtype) -> np.ndarray:
    """A flat file as an array: memory-mapped from a file system, read from any other store."""
    path = local_path(folder)
    if path is not None:
        file = f"{path}/{name}"
        return np.memmap(file, dtype, "r") if pyarrow.fs.LocalFileSystem().get_file_info(file).size else np.zeros(0, dtype)
    fs, root = _store(folder)
    with fs.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read_buffer(), dtype)


def write_tokens(documents: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the files of all documents and returns their table.

    The table has (part, file, dtype, documents, tokens, first_document, base), one row per file.
    Null text is the empty text, so its only id is ``end_id``. Null ids come first; documents
    of equal id stand in the order of their texts. No file is written for an empty table.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows of one id, or without, spread by their texts
    ordered = rows.withColumn("mark", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(n, "doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text").drop("mark")
    schema = "part int, file string, dtype string, documents bigint, tokens bigint"

    def write(batches):
        coder = tokens.encoder(tokenizer)
        end = np.array([end_id], coder.dtype).tobytes()
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, root = _store(folder)
        count, total, files = 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if files is None:
                fs.create_dir(root, recursive=True)
                files = [fs.open_output_stream(f"{root}/{name}.{x}") for x in ("bin", "idx", "ids")]
                files[1].write(np.zeros(1, "<i8").tobytes())
            files[2].write(np.ascontiguousarray(batch.column(0).fill_null(NULL_ID).to_numpy(), "<i8").tobytes())
            for _, group in tokens.text_batches(batch.column(1)):
                found = [x + end for x in coder.encode(group)]
                files[0].write(b"".join(found))
                ends = total + np.cumsum([len(x) // coder.dtype.itemsize for x in found])
                files[1].write(ends.astype("<i8").tobytes())
                count, total = count + len(found), int(ends[-1])
        if files is not None:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [name], "dtype": [coder.dtype.str],
                "documents": [count], "tokens": [total],
            })

    table = materialize(ordered.mapInArrow(lean(write), schema), "token_files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return table.select(
        "*",
        F.coalesce(F.sum("documents").over(before), F.lit(0)).alias("first_document"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"),
    )


def read_documents(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = read_flat(folder, row["file"] + ".bin", np.dtype(row["dtype"]))
                offsets = read_flat(folder, row["file"] + ".idx", "<i8")
                docs = read_flat(folder, row["file"] + ".ids", "<i8")
                for at in range(0, len(docs), _ROWS):
                    to = min(at + _ROWS, len(docs))
                    crc = [
                        zlib.crc32(ids[offsets[i] : offsets[i + 1]].astype("<u4").tobytes()) for i in range(at, to)
                    ]
                    own = np.array(docs[at:to])
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(own, pa.int64(), mask=own == NULL_ID),
                        "start": pa.array(offsets[at:to] + row["base"], pa.int64()),
                        "n_tokens": pa.array(np.diff(offsets[at : to + 1]), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    })

    return files.repartition(n, "part").mapInArrow(read, schema)


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as token files and read back."""
    target = new_folder(spark, "tokens")
    files = write_tokens(read_table(spark, folder, "documents"), target, tokens.default_path(), 2)
    return read_documents(files, target)
