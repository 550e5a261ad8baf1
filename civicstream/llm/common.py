"""Shared folder tables and Arrow helpers for the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstream.session import ensure_checkpoint_dir

#: Text bytes handled at once by the array code in a task; its scratch arrays take up to
#: about 60 bytes for each. A longer document is handled alone.
SLICE_BYTES = 1 << 20

#: Rows of an Arrow batch between the JVM and Python (whole texts, so far below the default).
ARROW_ROWS = "512"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on: a shared folder, small Arrow batches."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, visible to driver and executors."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds at most ``limit`` bytes (one row at
    least)."""
    n = batch.num_rows
    if not n:
        return
    offsets = text_buffer(batch.column(column))[1]
    start = 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end
    release()


@functools.cache
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def release() -> None:
    """Give memory that is free back to the system: workers wait for their next task with what
    they hold, beside other workers and the JVM."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type)
                                  or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offs = offs[column.offset:column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def binary_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column of the byte ranges between ``offsets`` of ``data``."""
    data = np.ascontiguousarray(data).view(np.uint8)
    if len(data) < 2**31:
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
            None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    return pa.array([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... (count of them) of each range, one range after another."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def schema_of(df: DataFrame, columns: list[str], extra: str) -> str:
    """DDL of ``columns`` of ``df`` followed by ``extra``."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in columns]
    return ", ".join([*kept, extra])


def utf8_text(column: str) -> F.Column:
    return F.col(column).cast("string")
