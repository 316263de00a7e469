"""Scratch tables on the shared folder, Arrow plumbing and file access for the
operators of this subpackage.

Lineage is cut by tables written under the folder that the cluster names in
``spark.checkpoint.dir``; only a plain local session without that setting (as
in tests) gets a private folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: list[str] = []

#: Bytes of text that a task handles at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20


def shared_root(spark: SparkSession) -> str:
    """The shared folder as a full URI."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL_DIR:
            _LOCAL_DIR.append(tempfile.mkdtemp(prefix="textlab-llm-"))
        base = _LOCAL_DIR[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub(r"^file:/+", "file:///", fs.makeQualified(path).toString())


def fresh_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


#: Rows that pass between Spark and a Python worker at a time while a table is written.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Whole texts pass to Python workers in batches of ``BATCH_ROWS`` rows at most."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    if 0 < int(old) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def written(df: DataFrame, what: str) -> DataFrame:
    """The frame, written once to the shared folder and read back."""
    spark, path = df.sparkSession, fresh_folder(df.sparkSession, what)
    with small_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_written(df: DataFrame) -> None:
    """Delete a scratch table of ``written`` that nothing reads any more."""
    path = getattr(df, "_scratch", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release_memory() -> None:
    """At the end of a task: give freed memory back to the system, as the worker
    process lives on and works for other stages."""
    import ctypes
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def filesystem(uri: str):
    """(pyarrow file system, path in it) of a full URI; runs in tasks."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, row offsets) of a string or binary column; null is empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        off_type = np.int64
    else:
        off_type = np.int32
    if col.null_count:
        col = col.fill_null(b"" if "binary" in str(col.type) else "")
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], off_type, len(col) + col.offset + 1)[col.offset:].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs


def row_chunks(offs: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; every row is in exactly one."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the concatenation of [s, s + l) over all rows."""
    lens = np.asarray(lens, np.int64)
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lens) - lens
    return np.repeat(np.asarray(starts, np.int64) - before, lens) + np.arange(total)


def offsets_of(lens: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=out[1:])
    return out


def list_array(flat: np.ndarray, offs: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat, kind))
