import datetime as dt
import decimal
import warnings

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright import types
from tablewright.errors import TableError, TableWarning
from tablewright.functions import convert
from tablewright.operators.adapt import to_table
from tablewright.sources.store import prepared

NUMBERS = {"Boolean", "Integer", "LongInteger", "SingleReal", "Real"}
SOURCES = {
    "String": ["apple", "banana", ""],
    "Binary": [b"apple", b"", b"\xff"],
    "Boolean": [True, False, True],
    "LongInteger": [1, 2, 0],
    "Real": [1.0, 2.0, 3.5],
    "DateTime": [dt.datetime(2020, 1, 2, 3, 4, 5, 678_901), dt.datetime(1979, 10, 23, 5, 32), dt.datetime(1583, 1, 1)],
    "Date": [dt.date(2020, 1, 2), dt.date(1979, 10, 23), dt.date(1583, 1, 1)],
    "Time": [dt.time(5, 32), dt.time(23, 59, 59, 999_999), dt.time(0)],
    "TimeSpan": [dt.timedelta(milliseconds=12345678900), dt.timedelta(milliseconds=-1500), dt.timedelta(0)],
    "Currency": [decimal.Decimal("123.45"), decimal.Decimal("67.890"), decimal.Decimal(0)],
}


@pytest.mark.parametrize("source", SOURCES)
@pytest.mark.parametrize("target", types.NAMES)
def test_matrix(source, target):
    legal = target in ("Boolean", "String") or source == target != "String" or source in NUMBERS and target in NUMBERS
    assert types.convertible(source, target) == legal


@pytest.mark.parametrize("source", SOURCES)
def test_conversions(spark, source):
    values = SOURCES[source] + [None]
    table = to_table(values, "x", spark)
    assert types.of_field(table.df.schema["x"]) == source
    for target in types.NAMES:
        if not types.convertible(source, target):
            with pytest.raises(TableError, match="does not become"):
                prepared(table, {"x": target})
            continue
        got = [r.x for r in prepared(table, {"x": target}).collect()]
        assert got[-1] is None
        if target == "Boolean":
            always = source in ("DateTime", "Date", "Time")
            assert got[:-1] == [True if always else bool(v) for v in values[:-1]]
        if target == "String" and source not in ("Currency", "DateTime", "Time", "TimeSpan"):
            assert got[:-1] == [str(v) for v in values[:-1]]
        if target == "Integer" and source == "Real":
            assert got == [1, 2, 3, None]


def test_temporal_text(spark):
    df = spark.range(1).select(
        F.expr("timestamp_ntz'2020-01-02 03:04:05.7785'").alias("a"), F.expr("timestamp_ntz'2020-01-02 03:04:05'").alias("b"), F.expr("interval '-1 00:00:01.5' day to second").alias("c"), F.expr("45296789L").alias("d")
    )
    row = df.select(convert.text(F.col("a"), "DateTime"), convert.text(F.col("b"), "DateTime"), convert.text(F.col("c"), "TimeSpan"), convert.text(F.col("d"), "Time")).first()
    assert tuple(row) == ("2020-01-02 03:04:05.778500", "2020-01-02 03:04:05", str(-dt.timedelta(days=1, seconds=1.5)), "12:34:56.789000")


def test_real_text(spark):
    df = spark.createDataFrame([(203.789, 1e10), (0.1, 0.1), (None, None), (float("nan"), float("nan")), (1e20, 1e22)], "s float, r double")
    got = [tuple(r) for r in df.select(convert.convert(F.col("s"), "SingleReal", "String"), convert.convert(F.col("r"), "Real", "String")).collect()]
    assert got == [("203.789", "10000000000.0"), ("0.1", "0.1"), (None, None), (None, None), ("1e+20", "1e+22")]


def test_milliseconds(spark):
    df = spark.sql("select timestamp_ntz'0001-01-01 00:00:00.0019' a, timestamp_ntz'1969-12-31 23:59:59.9999' b, date'0001-01-02' c, interval '-0 00:00:00.0019' day to second d")
    got = df.select(convert.datetime_ms(F.col("a")), convert.datetime_ms(F.col("b")), convert.date_ms(F.col("c")), convert.timespan_ms(F.col("d"))).first()
    assert tuple(got) == (1, 62_135_596_799_999, 86_400_000, -1)


@pytest.mark.parametrize("text", ["0", "33.4455", "-0.01", "79228162514264337593543950335", "1E+5", "-12345678901234567890.123"])
def test_decimal_codec(text):
    d = decimal.Decimal(text)
    assert len(convert.decimal_bytes(d)) == 16
    assert convert.bytes_decimal(convert.decimal_bytes(d)).as_tuple() == d.as_tuple()


def test_decimal_too_long():
    with pytest.raises(ValueError, match="96 bits"):
        convert.decimal_bytes(decimal.Decimal(2**96))


@pytest.mark.parametrize(
    ("values", "kind"),
    [([1, True], "LongInteger"), ([dt.date(2020, 1, 1), dt.datetime(2020, 1, 1)], "Date"), ([None, 1.5, float("nan")], "Real"), ([np.int32(1)], "Integer"), ([np.float32(1)], "SingleReal"), ([pd.Timedelta(1)], "TimeSpan")],
)
def test_inference(values, kind):
    assert types.of_values(values) == kind


@pytest.mark.parametrize(("values", "says"), [([True, 1], "several types"), ([dt.datetime(2020, 1, 1), dt.date(2020, 1, 1)], "several types"), ([None, float("nan")], "all values are missing"), ([bytearray(b"x")], "unknown type"), ([np.int8(1)], "unknown type")])
def test_inference_errors(values, says):
    with pytest.raises(TableError, match=says):
        types.of_values(values)


def test_promotion(spark):
    df = spark.createDataFrame([(500400300200, 0, 2147483647), (500400300201, 1, 0), (None, None, None)], "large long, small long, edge long")
    with pytest.warns(TableWarning):
        decided = types.policy(df, {"large": "Integer", "small": "Integer", "edge": "Integer"})
    assert decided.types == {"large": "LongInteger", "small": "Integer", "edge": "LongInteger"}


def test_real_beyond_integer(spark):
    with warnings.catch_warnings(), pytest.raises(TableError, match="do not fit"):
        warnings.simplefilter("ignore")
        types.policy(spark.createDataFrame([(3e10,)], "x double"), {"x": "Integer"})


def test_unknown_declared_type_is_ignored(spark):
    assert types.policy(spark.createDataFrame([(1,)], "x int"), {"x": "Nothing"}).types == {"x": "Integer"}


def test_all_missing(spark):
    with pytest.raises(TableError, match="all values are missing"):
        to_table([None, None], "x", spark)
    frame = pd.DataFrame({"x": [None, None]})
    frame["x"].attrs["type"] = "Date"
    for kind in types.NAMES:
        s = pd.Series([None, None], name="x")
        s.attrs["type"] = kind
        assert [r.x for r in to_table(s, "x", spark).df.collect()] == [None, None]


def test_arrays_are_refused(spark, data):
    with pytest.raises(TableError, match="unknown type"):
        prepared(spark.read.parquet(f"{data}/embeddings.parquet"))
