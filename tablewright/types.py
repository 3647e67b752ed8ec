"""The closed set of twelve column types: names, Spark types, inference, and which conversions exist."""

from __future__ import annotations

import datetime as dt
import decimal
import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import TableError, TableWarning

#: Key of the type's name in a field's metadata.
TYPE_KEY = "tablewright.type"

# The names of the types.
BOOLEAN, INTEGER, LONG, SINGLE, REAL = "Boolean", "Integer", "LongInteger", "SingleReal", "Real"
DATETIME, DATE, TIME, TIMESPAN = "DateTime", "Date", "Time", "TimeSpan"
STRING, BINARY, CURRENCY = "String", "Binary", "Currency"

#: Times are kept as milliseconds of the day: Parquet takes no TIME column.
SPARK: dict[str, T.DataType] = {
    BOOLEAN: T.BooleanType(),
    INTEGER: T.IntegerType(),
    LONG: T.LongType(),
    SINGLE: T.FloatType(),
    REAL: T.DoubleType(),
    DATETIME: T.TimestampNTZType(),
    DATE: T.DateType(),
    TIME: T.LongType(),
    TIMESPAN: T.DayTimeIntervalType(),
    STRING: T.StringType(),
    BINARY: T.BinaryType(),
    CURRENCY: T.DecimalType(38, 10),
}
NAMES = tuple(SPARK)
_NUMBERS = frozenset((BOOLEAN, INTEGER, LONG, SINGLE, REAL))
_ALWAYS = frozenset((BOOLEAN, STRING))


def column(name: str) -> Column:
    """The column of that very name, dots and ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_type(name: str | None) -> bool:
    return name in SPARK


def number(name: str | None) -> int | None:
    """A type's place in the closed list; None for what isn't one.  Numbers are this package's own."""
    return NAMES.index(name) if name in SPARK else None


def of_number(place: int) -> str | None:
    return NAMES[place] if 0 <= place < len(NAMES) else None


def of_spark(kind: T.DataType, name: str = "") -> str:
    """The type of a Spark column that says nothing about itself."""
    match kind:
        case T.BooleanType():
            return BOOLEAN
        case T.IntegerType() | T.ShortType() | T.ByteType():
            return INTEGER
        case T.LongType():
            return LONG
        case T.FloatType():
            return SINGLE
        case T.DoubleType():
            return REAL
        case T.TimestampNTZType() | T.TimestampType():
            return DATETIME
        case T.DateType():
            return DATE
        case T.DayTimeIntervalType():
            return TIMESPAN
        case T.DecimalType():
            return CURRENCY
        case T.BinaryType():
            return BINARY
        case T.StringType():
            return STRING
    if kind.typeName() == "time" or kind.simpleString().startswith("time("):
        return TIME
    raise TableError(f"unknown type '{kind.simpleString()}' of column '{name}'")


def of_field(field: T.StructField) -> str:
    """The type a field names in its metadata, else the type of its Spark type."""
    named = (field.metadata or {}).get(TYPE_KEY)
    return named if is_type(named) else of_spark(field.dataType, field.name)


def convertible(have: str, want: str) -> bool:
    """Anything becomes Boolean or String, numbers become each other, a type becomes itself."""
    return want in _ALWAYS or have == want and have != STRING or have in _NUMBERS and want in _NUMBERS


def checked(have: str | None, want: str | None, what: str = "column") -> str:
    """The type to write: ``want`` if it is one of the twelve, else ``have``."""
    if not is_type(want):
        if have is None:
            raise TableError(f"the type of {what} is unknown: all values are missing")
        return have
    if have is not None and not convertible(have, want):
        raise TableError(f"{have} does not become {want}")
    return want


# ---- inference from Python values


def missing(value) -> bool:
    """None, NaN, NaT and NA are missing; containers never are."""
    if value is None or value is pd.NaT or value is pd.NA:
        return True
    if isinstance(value, (float, np.floating)):
        return bool(np.isnan(value))
    if isinstance(value, decimal.Decimal):
        return value.is_nan()
    if isinstance(value, (np.datetime64, np.timedelta64)):
        return bool(np.isnat(value))
    return False


_EXACT: dict[type, str] = {
    bool: BOOLEAN,
    np.int32: INTEGER,
    int: LONG,
    np.int64: LONG,
    np.float32: SINGLE,
    float: REAL,
    np.float64: REAL,
    dt.datetime: DATETIME,
    pd.Timestamp: DATETIME,
    dt.date: DATE,
    dt.time: TIME,
    dt.timedelta: TIMESPAN,
    pd.Timedelta: TIMESPAN,
    str: STRING,
    bytes: BINARY,
    decimal.Decimal: CURRENCY,
}


def of_values(values: Iterable, what: str = "column") -> str:
    """The type of the first value that isn't missing; all others must be instances of that value's class."""
    found = [v for v in values if not missing(v)]
    if not found:
        raise TableError(f"the type of {what} is unknown: all values are missing")
    kind = type(found[0])
    if not all(isinstance(v, kind) for v in found):
        raise TableError(f"{what} has values of several types")
    if kind not in _EXACT:
        raise TableError(f"unknown type '{kind.__name__}' of {what}")
    return _EXACT[kind]


def of_dtype(series: pd.Series, what: str = "column") -> str:
    """The type of a pandas column by its dtype; object columns by their values, categories by theirs."""
    dtype = series.dtype
    if isinstance(dtype, pd.CategoricalDtype):
        return of_dtype(pd.Series(dtype.categories), what)
    name = str(dtype)
    if name == "object":
        return of_values(series.tolist(), what)
    for start, kind in (("datetime64[", DATETIME), ("timedelta64[", TIMESPAN), ("string", STRING)):
        if name.startswith(start):
            return kind
    plain = {"bool": BOOLEAN, "int32": INTEGER, "int64": LONG, "float32": SINGLE, "float64": REAL, "str": STRING}
    if name.lower().replace("boolean", "bool") in plain:
        return plain[name.lower().replace("boolean", "bool")]
    raise TableError(f"unknown dtype '{name}' of {what}")


# ---- whole numbers declared too narrow


@dataclass(frozen=True)
class Policy:
    """The type each column is written with."""

    types: Mapping[str, str]
    promoted: tuple[str, ...] = ()


def policy(df: DataFrame, declared: Mapping[str, str] | None = None) -> Policy:
    """Decide every column's type.  One aggregate over ``df`` runs only if a wider number is declared Integer.

    A number declared Integer that isn't strictly between the two limits of 32 bits makes its column
    LongInteger, with a warning; a Real beyond 64 bits is an error when it is converted.
    """
    seen: set[str] = set()
    for f in df.schema.fields:
        if f.name in seen:
            raise TableError(f"column name '{f.name}' is not unique")
        seen.add(f.name)
    declared = declared or {}
    have = {f.name: of_field(f) for f in df.schema.fields}
    physical = {f.name: of_spark(f.dataType, f.name) for f in df.schema.fields}
    want = {n: checked(h, declared.get(n), f"column '{n}'") for n, h in have.items()}
    narrow = [n for n, w in want.items() if w == INTEGER and physical[n] in (LONG, SINGLE, REAL)]
    promoted: list[str] = []
    if narrow:
        outside = [F.coalesce(F.bool_or(~((column(n) > -2147483648) & (column(n) < 2147483647))), F.lit(False)).alias(str(k)) for k, n in enumerate(narrow)]
        row = df.agg(*outside).first()
        promoted = [n for k, n in enumerate(narrow) if row[k]]
    for n in promoted:
        if physical[n] != LONG:
            raise TableError(f"values of column '{n}' do not fit Integer")
        warnings.warn(f"column '{n}' has values beyond Integer; LongInteger is used", TableWarning, stacklevel=2)
        want[n] = LONG
    return Policy(want, tuple(promoted))
