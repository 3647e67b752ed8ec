"""Expressions for every legal conversion between the twelve types, and the encodings of temporal values.

Everything but the text of floats and bytes is a built-in expression; those two, whose text is Python's,
are Arrow functions.
"""

from __future__ import annotations

import decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TableError
from ..types import BINARY, BOOLEAN, CURRENCY, DATE, DATETIME, INTEGER, LONG, REAL, SINGLE, SPARK, STRING, TIME, TIMESPAN, TYPE_KEY, Policy, convertible, of_field
from ..types import column as named

#: Milliseconds from 0001-01-01 to 1970-01-01, and of a day.
EPOCH_MS, DAY_MS = 62_135_596_800_000, 86_400_000


def valid(column: Column, kind: T.DataType) -> Column:
    """NaN is a missing value."""
    return F.when(~F.isnan(column), column) if isinstance(kind, (T.FloatType, T.DoubleType)) else column


# ---- milliseconds


def _div(a: Column, b: int) -> Column:
    """Whole-number division, cut off towards zero."""
    return F.call_function("div", a, F.lit(b).cast("long"))


def datetime_ms(column: Column) -> Column:
    """Milliseconds since 0001-01-01, microseconds cut off.  The session's zone should be UTC."""
    micros = F.unix_micros(column.cast("timestamp"))
    return _div(micros - F.pmod(micros, F.lit(1000)), 1000) + F.lit(EPOCH_MS)


def ms_datetime(column: Column) -> Column:
    return F.timestamp_millis(column - F.lit(EPOCH_MS)).cast("timestamp_ntz")


def date_ms(column: Column) -> Column:
    return F.datediff(column.cast("date"), F.expr("date'0001-01-01'")).cast("long") * F.lit(DAY_MS)


def ms_date(column: Column) -> Column:
    return F.date_add(F.expr("date'0001-01-01'"), _div(column, DAY_MS).cast("int"))


def timespan_ms(column: Column) -> Column:
    """Whole milliseconds, cut off towards zero."""
    return _div(timespan_micros(column), 1000)


def ms_timespan(column: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), column.cast("decimal(18,6)") / F.lit(1000))


# ---- decimals of 16 bytes: a 96-bit coefficient, two unused bytes, a biased exponent and the sign


# The exponent's bias and the end of the coefficient's range.
_BIAS, _MOST = 6176, 2**96


def decimal_bytes(value: decimal.Decimal) -> bytes:
    sign, digits, exponent = value.as_tuple()
    if not isinstance(exponent, int):
        raise TableError("a decimal without a finite value cannot be encoded")
    coefficient = int("".join(map(str, digits)))
    if coefficient >= _MOST:
        raise ValueError("the coefficient of a decimal has more than 96 bits")
    return coefficient.to_bytes(12, "little") + bytes(2) + (exponent + _BIAS << 1 | sign << 15).to_bytes(2, "little")


def bytes_decimal(data: bytes) -> decimal.Decimal:
    if len(data) != 16:
        raise TableError("an encoded decimal has 16 bytes")
    last = int.from_bytes(data[14:], "little")
    digits = tuple(map(int, str(int.from_bytes(data[:12], "little"))))
    return decimal.Decimal((last >> 15, digits, (last >> 1 & 0x3FFF) - _BIAS))


@F.pandas_udf(T.BinaryType())
def _decimal_binary(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else decimal_bytes(v))


def decimal_binary(column: Column) -> Column:
    """A decimal column as 16 bytes each; a coefficient of more than 96 bits is an error."""
    return _decimal_binary(column)


def binary_decimal(column: Column, kind: T.DecimalType) -> Column:
    """16 bytes each as a decimal column of type ``kind``."""

    @F.pandas_udf(kind)
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else bytes_decimal(bytes(v)))

    return run(column)


# ---- text


@F.pandas_udf(T.StringType())
def _float_text(values: pd.Series) -> pd.Series:
    return values.map(repr, na_action="ignore").astype(object).where(values.notna(), None)


@F.pandas_udf(T.StringType())
def _single_text(values: pd.Series) -> pd.Series:
    return pd.Series([None if x != x else str(x) for x in values.to_numpy("float32")], dtype=object)


@F.pandas_udf(T.StringType())
def _bytes_text(values: pd.Series) -> pd.Series:
    return values.map(lambda b: None if b is None else str(bytes(b)))


def _fixed(column: Column, seconds: Column, micros: Column) -> Column:
    """A time's text: no fraction if there is none, else six digits."""
    return F.concat(seconds, F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))))


def single_text(column: Column) -> Column:
    """The shortest text that reads back as the same 32-bit number."""
    return _single_text(column.cast("float"))


def real_text(column: Column) -> Column:
    """As Python writes a float: its shortest form differs from Java's, so this is an Arrow function."""
    return _float_text(column.cast("double"))


def datetime_text(column: Column) -> Column:
    micros = F.pmod(F.unix_micros(column.cast("timestamp")), F.lit(1_000_000))
    return _fixed(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"), micros)


def time_text(ms: Column) -> Column:
    part = lambda by, most: F.lpad(F.pmod(_div(ms, by), F.lit(most)).cast("string"), 2, "0")
    return _fixed(ms, F.concat_ws(":", part(3_600_000, 24), part(60_000, 60), part(1000, 60)), F.pmod(ms, F.lit(1000)) * 1000)


def timespan_text(column: Column) -> Column:
    """As Python writes a time span: floor days, then hours without a leading zero."""
    ms = timespan_ms(column)
    day = _div(ms - F.pmod(ms, F.lit(DAY_MS)), DAY_MS)
    rest = F.pmod(ms, F.lit(DAY_MS))
    hours = _div(rest, 3_600_000).cast("string")
    part = lambda by: F.lpad(F.pmod(_div(rest, by), F.lit(60)).cast("string"), 2, "0")
    days = F.when(day == 0, "").otherwise(F.concat(day.cast("string"), F.when(F.abs(day) == 1, " day, ").otherwise(" days, ")))
    return _fixed(column, F.concat(days, F.concat_ws(":", hours, part(60_000), part(1000))), F.pmod(rest, F.lit(1000)) * 1000)


def text(column: Column, have: str) -> Column:
    match have:
        case "Boolean":
            out = F.when(column, "True").otherwise("False")
        case "SingleReal":
            return single_text(column)
        case "Real":
            return real_text(column)
        case "Binary":
            return _bytes_text(column)
        case "DateTime":
            out = datetime_text(column)
        case "Time":
            out = time_text(column)
        case "TimeSpan":
            out = timespan_text(column)
        case _:
            return column.cast("string")
    return F.when(column.isNotNull(), out)


def truth(column: Column, have: str) -> Column:
    """Python's truth: empty and zero are false, every date and time is true; the text 'False' is true."""
    if have == BOOLEAN:
        return column
    if have in (STRING, BINARY):
        out = F.length(column) > 0
    elif have == TIMESPAN:
        out = timespan_micros(column) != 0
    elif have in (DATETIME, DATE, TIME):
        out = F.lit(True)
    else:
        out = column != 0
    return F.when(column.isNotNull(), out)


def timespan_micros(column: Column) -> Column:
    seconds = F.extract(F.lit("SECOND"), column).cast("decimal(18,6)")
    whole = F.extract(F.lit("DAY"), column).cast("long") * F.lit(DAY_MS) + F.extract(F.lit("HOUR"), column).cast("long") * F.lit(3_600_000) + F.extract(F.lit("MINUTE"), column).cast("long") * F.lit(60_000)
    return whole * F.lit(1000) + (seconds * F.lit(1_000_000)).cast("long")


def convert(column: Column, have: str, want: str, kind: T.DataType | None = None) -> Column:
    """``column`` of type ``have`` (Spark type ``kind``) as type ``want``; NaN becomes null, times are whole milliseconds."""
    if not (convertible(have, want) or have == want):
        raise TableError(f"{have} does not become {want}")
    column = valid(column, kind if kind is not None else SPARK[have])
    if want == BOOLEAN:
        return truth(column, have)
    if want == STRING and have != STRING:
        return text(column, have)
    if want == DATETIME:
        return F.date_trunc("millisecond", column.cast("timestamp_ntz"))
    if want == TIME:
        return column if kind is None or isinstance(kind, T.LongType) else _div(F.call_function("time_to_micros", column), 1000)
    if want == TIMESPAN:
        return ms_timespan(timespan_ms(column))
    if want in (INTEGER, LONG, SINGLE, REAL):
        return column.cast(SPARK[want])
    if want == CURRENCY:
        return column if isinstance(kind, T.DecimalType) else column.cast(SPARK[want])
    return column.cast(SPARK[want]) if want in (DATE, BINARY, STRING) else column


def apply(df: DataFrame, decided: Policy) -> DataFrame:
    """``df`` with each column converted to its decided type and marked with it; other metadata is kept."""
    out = []
    for f in df.schema.fields:
        want = decided.types[f.name]
        c = convert(named(f.name), of_field(f), want, f.dataType)
        out.append(c.alias(f.name, metadata={**(f.metadata or {}), TYPE_KEY: want}))
    return df.select(*out)

