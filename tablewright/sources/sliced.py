"""A table store in encoded column slices: what a column-slice file holds, kept in Parquet rows so that any file system will do.

Each row of ``slices`` is a slice of the table: for each column its values in one encoding, and a mask of the
missing ones where there are any.  Values have the layout of the twelve types: temporal ones are milliseconds (since 0001-01-01,
of the day, or of the span), decimals 16 bytes, text UTF-8.  Encodings are run lengths, bit arrays (Boolean) and
plain (Binary, or all if run lengths are off).  Under a mask a value is zero or empty.

Every task cuts its own rows into slices as they come, so writing and reading are one narrow pass; a task's last
slice is shorter.  ``meta`` has the schema and the typed metadata and is written last, as in ``store``.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import convert
from ..operators.adapt import to_table
from ..operators.metadata import Table
from ..operators.slices import encoding, rows_per_slice
from ..types import column, of_field
from .store import path_text, prepared, read_note, replaced, write_note

_WIDTH = {"Integer": "<i4", "LongInteger": "<i8", "SingleReal": "<f4", "Real": "<f8", "DateTime": "<i8", "Date": "<i8", "Time": "<i8", "TimeSpan": "<i8"}
_SPARK: dict[str, T.DataType] = {"Boolean": T.BooleanType(), "Integer": T.IntegerType(), "SingleReal": T.FloatType(), "Real": T.DoubleType(), "String": T.StringType(), "Binary": T.BinaryType(), "Currency": T.BinaryType()}
SLICE = "task int, slice long, n_rows long, columns array<struct<encoding: string, values: binary, mask: binary>>"
_COLUMN = pa.list_(pa.struct([("encoding", pa.string()), ("values", pa.binary()), ("mask", pa.binary())]))


# ---- values of a slice


def _plain(values: pa.Array, kind: str) -> bytes:
    if kind in _WIDTH:
        return values.to_numpy(zero_copy_only=False).astype(_WIDTH[kind]).tobytes()
    pieces = values.cast(pa.binary()).to_pylist()
    return np.array([len(p) for p in pieces], "<u4").tobytes() + b"".join(pieces)


def _unplain(data: bytes, n: int, kind: str) -> pa.Array:
    if kind in _WIDTH:
        return pa.array(np.frombuffer(data, _WIDTH[kind], n))
    at = np.concatenate(([0], np.cumsum(np.frombuffer(data, "<u4", n)))).astype(np.int64) + 4 * n
    found = pa.array([data[at[k] : at[k + 1]] for k in range(n)], pa.binary())
    return found.cast(pa.string()) if kind == "String" else found


def encode(values: pa.Array, kind: str, run_lengths: bool = True) -> dict:
    """A column slice: its encoding, its values, and the mask of the missing ones if there are any."""
    how = encoding(kind, run_lengths)
    mask = np.packbits(values.is_null().to_numpy(zero_copy_only=False)).tobytes() if values.null_count else None
    if values.null_count:
        values = values.fill_null(False if kind == "Boolean" else 0 if kind in _WIDTH else "" if kind == "String" else b"")
    if how == "bit array":
        data = np.packbits(values.to_numpy(zero_copy_only=False)).tobytes()
    elif how == "run length":
        runs = pa.compute.run_end_encode(values, run_end_type=pa.int32()) if len(values) else None
        ends = runs.run_ends.to_numpy() if runs is not None else np.zeros(0, np.int32)
        data = struct.pack("<I", len(ends)) + np.diff(ends, prepend=0).astype("<u4").tobytes() + (_plain(runs.values, kind) if runs is not None else b"")
    else:
        data = _plain(values, kind)
    return {"encoding": how, "values": data, "mask": mask}


def decode(part: Mapping, n: int, kind: str) -> pa.Array:
    data = part["values"]
    match part["encoding"]:
        case "bit array":
            out = pa.array(np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool))
        case "run length":
            (runs,) = struct.unpack_from("<I", data)
            times = np.frombuffer(data, "<u4", runs, 4)
            out = _unplain(data[4 + 4 * runs :], runs, kind).take(pa.array(np.repeat(np.arange(runs), times)))
        case _:
            out = _unplain(data, n, kind)
    if part["mask"] is None:
        return out
    missing = np.unpackbits(np.frombuffer(part["mask"], np.uint8), count=n).astype(bool)
    return pa.compute.if_else(pa.array(~missing), out, pa.scalar(None, out.type))


# ---- tables


def _physical(frame: DataFrame, kinds: list[str]) -> DataFrame:
    """Columns as they are encoded, by number."""
    out = []
    for k, (f, kind) in enumerate(zip(frame.schema.fields, kinds, strict=True)):
        c = column(f.name)
        match kind:
            case "DateTime":
                c = convert.datetime_ms(c)
            case "Date":
                c = convert.date_ms(c)
            case "TimeSpan":
                c = convert.timespan_ms(c)
            case "Currency":
                c = convert.decimal_binary(c)
        out.append(c.cast(_SPARK.get(kind, T.LongType())).alias(f"c{k}"))
    return frame.select(*out)


def write_slices(obj, path: str | os.PathLike, types: Mapping[str, str] | None = None, default_column: str = "x", per_slice: int = 0, run_lengths: bool = True, mode: str = "error", spark: SparkSession | None = None) -> None:
    """Write any object a table can be made of, in slices of ``per_slice`` rows (0: about 100,000 cells)."""
    table = to_table(obj, default_column, spark)
    frame = prepared(table, types)
    kinds, size, path = [of_field(f) for f in frame.schema.fields], rows_per_slice(len(frame.columns), per_slice), path_text(path)
    session = frame.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def made(t: pa.Table) -> pa.RecordBatch:
            parts = [encode(c.combine_chunks() if not isinstance(c.combine_chunks(), pa.ChunkedArray) else pa.concat_arrays(c.chunks), kind, run_lengths) for c, kind in zip(t.columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([number]), pa.array([t.num_rows]), pa.array([parts], _COLUMN)], ["task", "slice", "n_rows", "columns"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= size:
                t = pa.Table.from_batches(held)
                yield made(t.slice(0, size))
                held, rows, number = t.slice(size).to_batches(), rows - size, number + 1
        if rows:
            yield made(pa.Table.from_batches(held))

    replaced(session, path, mode)
    sliced = _physical(frame, kinds).mapInArrow(cut, SLICE) if kinds else session.createDataFrame([], SLICE)
    sliced.write.mode(mode).parquet(f"{path}/slices")
    write_note(frame, path, table.metadata, mode)


def slices_of(spark: SparkSession, path: str | os.PathLike) -> DataFrame:
    """The slices as they are stored."""
    return spark.read.schema(SLICE).parquet(f"{path_text(path)}/slices")


def read_slices(spark: SparkSession, path: str | os.PathLike) -> Table:
    """The table of such a store."""
    schema, metadata = read_note(spark, path)
    if not schema.fields:
        return Table(spark.createDataFrame([], schema), metadata)
    kinds = [of_field(f) for f in schema.fields]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([decode(p, row["n_rows"], kind) for p, kind in zip(row["columns"], kinds, strict=True)], [f"c{k}" for k in range(len(kinds))])

    physical = T.StructType([T.StructField(f"c{k}", _SPARK.get(kind, T.LongType())) for k, kind in enumerate(kinds)])
    rows = slices_of(spark, path).select("n_rows", "columns").mapInArrow(join, physical)
    out = []
    for k, (f, kind) in enumerate(zip(schema.fields, kinds, strict=True)):
        c = F.col(f"c{k}")
        match kind:
            case "DateTime":
                c = convert.ms_datetime(c)
            case "Date":
                c = convert.ms_date(c)
            case "TimeSpan":
                c = convert.ms_timespan(c)
            case "Currency":
                c = convert.binary_decimal(c, f.dataType)
        out.append(c.alias(f.name, metadata=f.metadata or {}))
    return Table(rows.select(*out), metadata)
