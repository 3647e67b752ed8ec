"""Tables from Python objects.  The order of the cases matters: a text is iterable but is a scalar here."""

from __future__ import annotations

import datetime as dt
import decimal
import io
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import types as kinds
from ..errors import TableError
from ..types import CURRENCY, INTEGER, LONG, REAL, SINGLE, SPARK, TIME, TIMESPAN, TYPE_KEY
from .metadata import COLUMN_ROLE, CONTENT, CRS, GEOMETRY, IS_GEOCODING, META_KEY, WKB, Table, encode

_ARROW = {
    "Boolean": pa.bool_(),
    "Integer": pa.int32(),
    "LongInteger": pa.int64(),
    "SingleReal": pa.float32(),
    "Real": pa.float64(),
    "DateTime": pa.timestamp("us"),
    "Date": pa.date32(),
    "Time": pa.int64(),
    "TimeSpan": pa.duration("us"),
    "String": pa.string(),
    "Binary": pa.binary(),
}


def to_table(obj, default_column: str = "x", spark: SparkSession | None = None) -> Table:
    """A table of a Spark or pandas frame, column, array, dict of lists, text, iterable, figure, image or any other scalar."""
    if isinstance(obj, Table):
        return obj
    if isinstance(obj, DataFrame):
        return Table(obj)
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        raise TableError("no Spark session to make a table in")
    if isinstance(obj, pd.DataFrame):
        return _frame(obj, spark)
    if isinstance(obj, pd.Series):
        return _columns(spark, {str(obj.name) if obj.name is not None else default_column: _series(obj)})
    if isinstance(obj, np.ndarray):
        return _columns(spark, {default_column: _array(obj)})
    if isinstance(obj, dict):
        if not all(isinstance(v, list) for v in obj.values()):
            raise TableError("a dict of columns must hold lists")
        if len({len(v) for v in obj.values()}) > 1:
            raise TableError("columns are not of one length")
        return _columns(spark, {str(k): _values(v, f"column '{k}'") for k, v in obj.items()})
    if isinstance(obj, (str, bytes, bytearray)):
        return _columns(spark, {default_column: _values([bytes(obj) if isinstance(obj, bytearray) else obj], "value")})
    if isinstance(obj, Iterable):
        return _columns(spark, {default_column: _values(list(obj), f"column '{default_column}'")})
    image = _image(obj)
    return _columns(spark, {default_column: _values([obj if image is None else image], "value")})


def _image(obj) -> bytes | None:
    """PNG bytes of a figure (``savefig``) or an image (``save`` with a format), by their library's module."""
    library = type(obj).__module__.split(".")[0]
    held = io.BytesIO()
    if library in ("matplotlib", "seaborn") and hasattr(obj, "savefig"):
        obj.savefig(held, format="png")
    elif any(c.__module__.startswith("PIL.") for c in type(obj).__mro__) and hasattr(obj, "save"):
        obj.save(held, "PNG")
    else:
        return None
    return held.getvalue()


Column = tuple[str, Sequence]


def _values(values: list, what: str) -> Column:
    return kinds.of_values(values, what), values


def _array(a: np.ndarray) -> Column:
    if a.dtype == object:
        return _values(a.tolist(), "array")
    return _series(pd.Series(a))


def _series(s: pd.Series) -> Column:
    declared = s.attrs.get("type")
    try:
        have = kinds.of_dtype(s, f"column '{s.name}'")
    except TableError:
        if not kinds.is_type(declared) or s.notna().any():
            raise
        have = declared
    return have, s.astype(object).where(s.notna(), None).tolist()


def _shapes(frame: pd.DataFrame) -> tuple[pd.DataFrame, dict[str, list]]:
    """A frame whose geometry column (values with ``wkb``) is a binary column named Geometry, and the table metadata that goes with it."""
    at = next((k for k in range(frame.shape[1]) if str(frame.dtypes.iloc[k]) == "geometry"), None)
    if at is None:
        return frame, {}
    column = frame.iloc[:, at]
    wkb = pd.Series([None if v is None else bytes(v.wkb) for v in column], index=frame.index, dtype=object)
    wkb.attrs = {"type": "Binary", "metadata": {COLUMN_ROLE: GEOMETRY, CONTENT: WKB}}
    parts = [frame.iloc[:, k] for k in range(frame.shape[1])]
    names = [str(c) for c in frame.columns]
    parts[at], names[at] = wkb, GEOMETRY
    out = pd.DataFrame(dict(enumerate(parts)))
    out.columns, out.attrs = names, frame.attrs
    crs = getattr(column, "crs", None)
    meta = {IS_GEOCODING: [True]} | ({CRS: [str(crs)]} if crs is not None else {})
    return out, meta | {"geometry attrs": [wkb.attrs]}


def _frame(frame: pd.DataFrame, spark: SparkSession) -> Table:
    frame, shaped = _shapes(frame)
    geometry = shaped.pop("geometry attrs", [{}])[0]
    names = [str(c) for c in frame.columns]
    if len(set(names)) < len(names):
        raise TableError("column names are not unique")
    columns = {n: _series(frame.iloc[:, k]) for k, n in enumerate(names)}
    df, out = _columns(spark, columns).df, []
    for k, n in enumerate(names):
        attrs = geometry if geometry and n == GEOMETRY else frame.iloc[:, k].attrs
        extra = {}
        if kinds.is_type(attrs.get("type")):
            extra["tablewright.declared"] = attrs["type"]
        if attrs.get("metadata"):
            extra[META_KEY] = encode(attrs["metadata"])
        out.append(kinds.column(n).alias(n, metadata={**(df.schema[n].metadata or {}), **extra}))
    return Table(df.select(*out) if out else df, {k: v if isinstance(v, list) else [v] for k, v in frame.attrs.get("metadata", {}).items()} | shaped)


def _plain(value, kind: str):
    """The value Arrow takes; None where it is missing."""
    if kinds.missing(value):
        return None
    if kind == TIME:
        return (value.hour * 3600 + value.minute * 60 + value.second) * 1000 + value.microsecond // 1000
    if kind == "DateTime":
        value = value.to_pydatetime(warn=False) if isinstance(value, pd.Timestamp) else value
        value = pd.Timestamp(value).to_pydatetime(warn=False) if isinstance(value, np.datetime64) else value
        return value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value
    if kind == "Date":
        return value.date() if isinstance(value, dt.datetime) else value
    if kind == TIMESPAN:
        return value.to_pytimedelta() if isinstance(value, pd.Timedelta) else value
    if kind in (INTEGER, LONG):
        return int(value)
    if kind in (SINGLE, REAL):
        return float(value)
    return value


def _columns(spark: SparkSession, columns: dict[str, Column]) -> Table:
    fields, arrays = [], []
    for name, (kind, values) in columns.items():
        plain = [_plain(v, kind) for v in values]
        spark_type: T.DataType = SPARK[kind]
        arrow = _ARROW.get(kind)
        if kind == CURRENCY:
            scale = max([0, *(-v.as_tuple().exponent for v in plain if isinstance(v, decimal.Decimal) and isinstance(v.as_tuple().exponent, int))])
            whole = max([1, *(v.adjusted() + 1 for v in plain if isinstance(v, decimal.Decimal) and v.is_finite())])
            if scale + whole > 38:
                raise TableError(f"decimals of column '{name}' need more than 38 digits")
            spark_type, arrow = T.DecimalType(38, max(scale, 0)), pa.decimal128(38, max(scale, 0))
        fields.append(T.StructField(name, spark_type, True, {TYPE_KEY: kind}))
        arrays.append(pa.array(plain, arrow))
    schema = T.StructType(fields)
    if not fields:
        return Table(spark.createDataFrame([], schema))
    df = spark.createDataFrame(pa.table(arrays, names=list(columns)), T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
    return Table(df.select(*(kinds.column(f.name).alias(f.name, metadata=f.metadata) for f in fields)))
