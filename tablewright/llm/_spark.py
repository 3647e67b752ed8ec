"""Helpers shared by the operators: checkpoints, Arrow batches, reading of tables."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a Python worker.
SLICE_BYTES = (1 << 20) - 1


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; one of our own only where none is set and all runs on this machine (tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        named = tempfile.mkdtemp(prefix="tablewright-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def release() -> None:
    """Give memory that a worker has freed back to the system; workers live on after a task and share their executor's limit."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(spark: SparkSession, most: int = 1000) -> None:
    """Let at most ``most`` rows, which may be long texts, go to a Python worker at once.

    Frames run later than they are made, so the session's setting stays changed; a smaller one is left as it is.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= most:
        spark.conf.set(name, str(most))


def two_columns(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``text`` alone, so that columns of other names cannot clash; null text stays null."""
    small_batches(df.sparkSession)
    return df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))


def bytes_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    kind, width = (np.int64, 8) if large else (np.int32, 4)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * width).astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])), at - at[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes of text; a longer text is a part of its own."""
    _, at = bytes_of(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last
    release()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and read it again: much narrower there than ``cut``.

    The tables of a session go when its Python process ends.
    """
    spark = df.sparkSession
    top = f"{checkpoint_dir(spark)}/tables-{_RUN}"
    if top not in _made:
        _made.add(top)
        atexit.register(_drop, spark, top)
    path = f"{top}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote for these frames; nothing may read them again."""
    for df in frames:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if any(top.split(":")[-1].lstrip("/") in path for top in _made):
                _drop(df.sparkSession, path)


_RUN = uuid.uuid4().hex
_made: set[str] = set()


def _drop(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the session may be gone
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting that holds for the actions run inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
