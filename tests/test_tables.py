import datetime as dt
import decimal
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.errors import TableError, TableWarning
from tablewright.functions import geo
from tablewright.functions.convert import decimal_bytes
from tablewright.operators import metadata as meta
from tablewright.operators import packages, slices
from tablewright.operators.adapt import to_table
from tablewright.operators.metadata import Table
from tablewright.operators.slices import encoding
from tablewright.sources import sliced
from tablewright.sources.store import read_table, read_table_stream, write_table
from tablewright.streaming import tables as streams

EVERY = {
    "TMDBinary": b"\x00\x01\x02\x03",
    "TMDBoolean": True,
    "TMDDate": dt.date(2004, 8, 5),
    "TMDDateTime": dt.datetime(2005, 9, 1, 13, 31, 42),
    "TMDDecimal": decimal.Decimal("101.45"),
    "TMDDouble": 102.36,
    "TMDFloat": np.float32(103.27),
    "TMDInteger": np.int32(104),
    "TMDLong": 105,
    "TMDString": "Tmd01",
    "TMDTime": dt.time(15, 12, 34),
    "TMDTimeSpan": dt.timedelta(hours=1, minutes=2, seconds=3.456),
}
FIRST = (b"c\x01\x02\x03", True, dt.date(2001, 2, 3), dt.datetime(2004, 5, 6, 7, 8, 9), decimal.Decimal("201.23"), 202.456, np.float32(203.789), np.int32(204), 205, "Data01", dt.time(1, 2, 3), dt.timedelta(hours=4, minutes=5, seconds=6.789))
COLUMNS = ["Binary", "Boolean", "Date", "DateTime", "Decimal", "Double", "Float", "Integer", "Long", "String", "Time", "TimeSpan"]


def alltypes(spark):
    """13 rows: the first is whole, row k + 1 lacks column k."""
    columns = {c: [None if row == k + 1 else FIRST[k] for row in range(13)] for k, c in enumerate(COLUMNS)}
    columns["CMTNA"] = [np.int32(9001 + k) for k in range(13)]
    table = to_table(columns, spark=spark)
    return Table(meta.with_column_metadata(table.df, "Binary", EVERY), {k: [v] for k, v in EVERY.items()})


def test_roundtrip(spark, tmp_path):
    table = alltypes(spark)
    path = tmp_path / "日本語ファイル"
    write_table(table, path)
    back = read_table(spark, path)
    assert meta.get_types(back) == meta.get_types(table) == dict(zip([*COLUMNS, "CMTNA"], ["Binary", "Boolean", "Date", "DateTime", "Currency", "Real", "SingleReal", "Integer", "LongInteger", "String", "Time", "TimeSpan", "Integer"], strict=True))
    assert sorted(back.df.collect(), key=lambda r: r.CMTNA) == sorted(table.df.collect(), key=lambda r: r.CMTNA)
    assert back.metadata == meta.decode(meta.encode(EVERY))
    assert meta.column_metadata(back, "Binary")["TMDTimeSpan"] == [EVERY["TMDTimeSpan"]]
    with pytest.raises(Exception, match="exist"):
        write_table(table, path)


def test_empty_tables(spark, tmp_path):
    table = alltypes(spark)
    write_table(Table(table.df.where("false"), table.metadata), tmp_path / "none")
    assert len(read_table(spark, tmp_path / "none").df.columns) == 13
    write_table(Table(spark.range(0).select()), tmp_path / "bare")
    assert read_table(spark, tmp_path / "bare").df.columns == []


def test_slices_of_files(spark, tmp_path):
    write_table(spark.range(95).coalesce(1), tmp_path / "t", per_slice=10)
    assert len(list((tmp_path / "t" / "data").glob("*.parquet"))) == 10
    write_table(spark.range(3), tmp_path / "t", mode="overwrite")
    assert read_table(spark, tmp_path / "t").df.count() == 3


def test_versions(spark, tmp_path):
    write_table(spark.range(3), tmp_path / "t")
    note = next((tmp_path / "t" / "meta").glob("part-*"))
    for crc in (tmp_path / "t" / "meta").glob(".*.crc"):
        crc.unlink()
    note.write_text(note.read_text().replace('"version": "1.0"', '"version": "1.1"'))
    with pytest.raises(TableError, match="unsupported version"):
        read_table(spark, tmp_path / "t")


def test_errors_leave_nothing(spark, tmp_path):
    with pytest.raises(TableError):
        write_table({"x": [1, "a"]}, tmp_path / "t", spark=spark)
    with pytest.raises(TableError):
        write_table(spark.range(3), tmp_path / "t", types={"id": "Date"})
    assert not (tmp_path / "t").exists()


def test_nan_is_missing(spark, tmp_path):
    write_table(spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double"), tmp_path / "t")
    assert sorted(str(r.x) for r in read_table(spark, tmp_path / "t").df.collect()) == ["1.0", "None", "None"]


def test_stream(spark, tmp_path, data):
    write_table(spark.read.parquet(f"{data}/events.parquet"), tmp_path / "t")
    stream = read_table_stream(spark, tmp_path / "t")
    q = streams.write_stream(streams.typed(stream.df, {"value": "String"}).select("event_id", "value"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(f"{data}/events.parquet").count()
    counted = streams.windowed_counts(stream.df, "ts", "1 day", "1 hour", "event_type")
    q = counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("counted").agg(F.sum("n")).first()[0] == spark.read.parquet(f"{data}/events.parquet").count()


def test_objects(spark):
    one = lambda x, **k: [tuple(r) for r in to_table(x, spark=spark, **k).df.collect()]
    assert one("text") == [("text",)]
    assert one(b"b") == one(bytearray(b"b")) == [(b"b",)]
    assert one(range(2)) == [(0,), (1,)]
    assert sorted(one({42, 100})) == [(42,), (100,)]
    assert one(x for x in (1, None)) == [(1,), (None,)]
    assert one(3.5) == [(3.5,)]
    assert one({"a": [1, 2], "b": ["x", None]}) == [(1, "x"), (2, None)]
    assert one(np.array([1.5, np.nan])) == [(1.5,), (None,)]
    assert to_table(pd.Series([1.0], name="b"), spark=spark).df.columns == ["b"]
    assert to_table(pd.DataFrame({3.14159: [1]}), spark=spark).df.columns == ["3.14159"]
    nullable = pd.DataFrame({"b": pd.array([True, None], "boolean"), "i": pd.array([1, None], "Int32"), "f": pd.array([None, 8.0], "Float32"), "c": pd.Categorical(["x", None])})
    table = to_table(nullable, spark=spark)
    assert list(meta.get_types(table).values()) == ["Boolean", "Integer", "SingleReal", "String"]
    assert [tuple(r) for r in table.df.collect()] == [(True, 1, None, "x"), (None, None, 8.0, None)]
    for bad in ({"a": 1}, {"a": [1], "b": [1, 2]}, [{}], [1, "a"]):
        with pytest.raises(TableError):
            to_table(bad, spark=spark)


class FakeFigure:
    __module__ = "matplotlib.figure"

    def savefig(self, held, format):
        held.write(b"\x89PNG\r\n\x1a\n")


def test_figure(spark):
    assert to_table(FakeFigure(), spark=spark).df.first()[0] == b"\x89PNG\r\n\x1a\n"


@pytest.mark.parametrize("unit", ["s", "ms", "us", "ns"])
def test_resolutions(spark, unit):
    table = to_table(pd.DataFrame({"t": pd.Series(["2020-01-01"]).astype(f"datetime64[{unit}]"), "d": pd.Series([pd.Timedelta(38400, "s")]).astype(f"timedelta64[{unit}]")}), spark=spark)
    assert tuple(table.df.first()) == (dt.datetime(2020, 1, 1), dt.timedelta(seconds=38400))


def test_metadata_operators(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    with pytest.warns(TableWarning, match="there is no column"):
        meta.set_types(df, {"z": "Integer"})
    with pytest.warns(TableWarning, match="is no type"):
        named = meta.set_types(df, {"x": "Nothing", "y": "Boolean"})
    assert meta.declared(named) == {"y": "Boolean"}
    with pytest.raises(TypeError):
        meta.get_types([1])
    with pytest.raises(TypeError):
        meta.copy_metadata(df, [1])
    with pytest.raises(KeyError):
        meta.copy_metadata(df.select("x"), df)
    with pytest.raises(TableError, match="length 1"):
        meta.encode({"a": [1, 2]})
    with pytest.raises(TableError, match="missing"):
        meta.encode({"a": []})
    report = meta.metadata_report(Table(meta.with_column_metadata(df, "x", {"m": 1}), {"t": [1]}))
    assert "x: {'m': [1]}" in report and "left out" in report


def wkb(kind, *pts):
    body = b"".join(struct.pack("<2d", *p) for p in pts)
    if kind == 1:
        return struct.pack("<BI", 1, 1) + body
    if kind == 3:
        return struct.pack("<BIII", 1, 3, 1, len(pts)) + body
    return struct.pack("<BII", 1, kind, len(pts)) + body


def test_geometry(spark):
    square = wkb(3, (0, 0), (4, 0), (4, 2), (0, 2), (0, 0))
    assert geo.box_of(square) == (0, 0, 4, 2) and geo.kind_of(square) == "Polygon"
    several = struct.pack("<BII", 1, 5, 2) + wkb(2, (1, 1), (2, 2)) + wkb(2, (5, -1), (0, 0))
    assert geo.box_of(several) == (0, -1, 5, 2)
    table = meta.set_geocoding_table(spark.createDataFrame([(bytearray(square),), (None,)], "Geometry binary"), crs="EPSG:4326")
    assert table.metadata["MapChart.GeometryType"] == ["Polygon"] and table.metadata["MapChart.GeographicCrs"] == ["EPSG:4326"]
    row = table.df.where("Geometry is not null").first()
    assert (row.XMin, row.YMax, row.XCenter, row.YCenter) == (0, 2, 2, 1)
    mixed = spark.createDataFrame([(bytearray(square),), (bytearray(wkb(1, (1, 1))),)], "Geometry binary")
    with pytest.raises(TableError, match="more than one kind"):
        meta.set_geocoding_table(mixed)


def test_slices(spark):
    assert slices.rows_per_slice(11) == 9090 and slices.rows_per_slice(10**6) == 10 and slices.rows_per_slice(3, 5) == 5
    assert [tuple(r) for r in slices.slice_plan(spark.range(23), 10).orderBy("slice").collect()] == [(0, 0, 10), (1, 10, 10), (2, 20, 3)]
    assert slices.slice_plan(spark.range(0)).count() == 0
    assert {r.column: r.encoding for r in slices.encoding_plan(spark.createDataFrame([], "a boolean, b binary, c int")).collect()} == {"a": "bit array", "b": "plain", "c": "run length"}


def test_packages(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "name string, needs string")
    assert {r.name for r in packages.closure(edges, spark.createDataFrame([("a",)], "name string")).collect()} == {"a", "b", "c"}
    old = spark.createDataFrame([("p", "1.9"), ("q", "2.0"), ("r", "1")], "name string, version string")
    new = spark.createDataFrame([("p", "1.10"), ("q", "1.9.9"), ("s", "1")], "name string, version string")
    assert {r.name: r.change for r in packages.compare(old, new).collect()} == {"p": "upgraded", "q": "downgraded", "r": "removed", "s": "added"}
    assert packages.needs_major(old, new) and packages.next_version("1.2.3", True) == "2.0.0.0" and packages.next_version("1.2", False) == "1.3.0.0"


class Shape:
    def __init__(self, wkb):
        self.wkb = wkb


class GeometryDtype(pd.api.extensions.ExtensionDtype):
    name, type, kind = "geometry", Shape, "O"

    @classmethod
    def construct_array_type(cls):
        return GeometryArray


class GeometryArray(pd.api.extensions.ExtensionArray):
    """As much of a geometry column as the adapter sees."""

    dtype = GeometryDtype()
    crs = "EPSG:4326"

    def __init__(self, values):
        self.values = list(values)

    @classmethod
    def _from_sequence(cls, values, dtype=None, copy=False):
        return cls(values)

    def __len__(self):
        return len(self.values)

    def __getitem__(self, k):
        return self.values[k] if isinstance(k, int) else GeometryArray(np.array(self.values, object)[k].tolist())

    def isna(self):
        return np.array([v is None for v in self.values])

    def copy(self):
        return GeometryArray(self.values)

    def take(self, indices, allow_fill=False, fill_value=None):
        return GeometryArray([self.values[i] for i in indices])


def test_geometry_frame(spark, tmp_path):
    point = wkb(1, (3, 4))
    frame = pd.DataFrame({"name": ["a", "b"], "where": GeometryArray([Shape(point), None])})
    write_table(frame, tmp_path / "g", spark=spark)
    back = meta.geo_table(read_table(spark, tmp_path / "g"))
    assert [tuple(r) for r in back.df.orderBy("name").collect()] == [("a", point), ("b", None)]
    assert meta.column_metadata(back, "Geometry")["ContentType"] == ["application/x-wkb"]
    with pytest.raises(TableError):
        meta.geo_table(Table(spark.range(1)))


def test_bundle():
    from tablewright import support

    assert "pyspark" in support.bundle()


def test_sliced_store(spark, tmp_path):
    table = alltypes(spark)
    for name, more in (("a", {}), ("b", {"per_slice": 2, "run_lengths": False}), ("c", {"per_slice": 5})):
        sliced.write_slices(table, tmp_path / name, **more)
        back = sliced.read_slices(spark, tmp_path / name)
        assert meta.get_types(back) == meta.get_types(table) and back.metadata == meta.decode(meta.encode(EVERY))
        assert sorted(back.df.collect(), key=lambda r: r.CMTNA) == sorted(table.df.collect(), key=lambda r: r.CMTNA)
        assert meta.column_metadata(back, "Binary")["TMDTimeSpan"] == [EVERY["TMDTimeSpan"]]
    assert sliced.slices_of(spark, tmp_path / "b").agg(F.max("n_rows")).first()[0] == 2
    sliced.write_slices(Table(table.df.where("false"), table.metadata), tmp_path / "none")
    assert len(sliced.read_slices(spark, tmp_path / "none").df.columns) == 13 and sliced.read_slices(spark, tmp_path / "none").df.count() == 0
    sliced.write_slices(Table(spark.range(0).select()), tmp_path / "bare")
    assert sliced.read_slices(spark, tmp_path / "bare").df.columns == []
    sliced.write_slices(spark.range(3), tmp_path / "a", mode="overwrite")
    assert sorted(r.id for r in sliced.read_slices(spark, tmp_path / "a").df.collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="96 bits"):
        decimal_bytes(decimal.Decimal(2**96))


@pytest.mark.parametrize("run_lengths", [True, False])
@pytest.mark.parametrize(("kind", "values"), [("Boolean", pa.array([True, None, False, True, True, None, False, False, True])), ("Integer", pa.array([1, 1, None, 1, 2, 2], pa.int32())), ("Real", pa.array([0.5, None, -0.0], pa.float64())), ("String", pa.array(["", "é", "é", None])), ("Binary", pa.array([b"", None, b"\x00"], pa.binary())), ("LongInteger", pa.array([], pa.int64())), ("String", pa.array([None, None], pa.string()))])
def test_column_slices(kind, values, run_lengths):
    part = sliced.encode(values, kind, run_lengths)
    assert part["encoding"] == encoding(kind, run_lengths) and (part["mask"] is None) == (values.null_count == 0)
    assert sliced.decode(part, len(values), kind).to_pylist() == values.to_pylist()


def test_append(spark, tmp_path):
    write_table(spark.range(3), tmp_path / "t")
    write_table(Table(spark.range(3, 5), {"note": ["later"]}), tmp_path / "t", mode="append")
    back = read_table(spark, tmp_path / "t")
    assert sorted(r.id for r in back.df.collect()) == [0, 1, 2, 3, 4] and back.metadata == {"note": ["later"]}
    with pytest.raises(TableError, match="cannot be appended"):
        write_table(spark.range(3).selectExpr("cast(id as int) id"), tmp_path / "t", mode="append")
    write_table(spark.range(2), tmp_path / "new", mode="append")
    assert read_table(spark, tmp_path / "new").df.count() == 2


def test_descriptor_as_path(spark, tmp_path):
    import os

    write_table(spark.range(3), tmp_path / "t")
    at = os.open(tmp_path / "t", os.O_RDONLY)
    assert read_table(spark, at).df.count() == 3
    os.close(at)
    with pytest.raises(TypeError):
        read_table(spark, True)


def test_versions_of_four_numbers():
    of = packages.Version.of
    assert of("1.2") < of("1.2.0.1") < of("1.10") and str(of("1.2").raised(2)) == "1.2.1.0"
    for bad in ("1.x", "1.2.3.4.5", ""):
        with pytest.raises(ValueError, match="no version"):
            of(bad)


def test_closure_of_a_long_chain_and_a_cycle(spark):
    edges = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(11)] + [("n5", "n2"), ("n3", "n3"), ("x", "y"), ("n1", None)], "name string, needs string")
    found = packages.closure(edges, spark.createDataFrame([("n1",), (None,)], "name string"))
    assert sorted(r.name for r in found.collect()) == sorted(f"n{k}" for k in range(1, 12))
