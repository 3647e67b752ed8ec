"""Registered queries of sources, adapters, metadata, geometry and scripts, and the same in SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import struct
import uuid
import warnings

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import support, types
from .errors import ScriptError, TableError, TableWarning
from .functions import convert
from .operators import metadata as meta
from .operators import packages
from .operators.adapt import to_table
from .operators.metadata import Table
from .plans.datafn import DataFunction, Input, Output
from .plans.steps import folder
from .queries import _converted, _read, query
from .sources import sliced, store
from .types import BOOLEAN, CURRENCY, INTEGER, LONG, NAMES, STRING, TYPE_KEY


def _fresh(spark: SparkSession) -> str:
    return f"{folder(spark)}/stores/{uuid.uuid4().hex}"


def _rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A few rows that the driver made."""
    return spark.createDataFrame(rows, schema)


def _values(names: str, rows: list[tuple]) -> str:
    """The same in SQL."""
    text = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else f"CAST({v} AS BIGINT)" if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) v({names})"


def _cents(column: str) -> Column:
    """Whole cents as a decimal of two places."""
    return (F.round(F.col(column) * 100).cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(22,2)")


def _time(column: Column, name: str) -> Column:
    return column.cast("long").alias(name, metadata={TYPE_KEY: "Time"})


# ---- all twelve types through both stores

_START = "timestamp_ntz'1995-01-01 00:00:00'"


def _twelve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of all twelve types, with missing values in most."""
    line = _read(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") != 2, F.col("l_returnflag") == "R").alias("flag"),
        F.col("l_tax").cast("float").alias("tax"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linenumber") != 1, F.col("l_shipdate")).alias("shipped"),
        F.col("l_shipdate").cast("date").alias("day"),
        _time(F.when(F.col("l_linenumber") != 4, (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 31) % 86_400_000), "at"),
        (F.col("l_shipdate") - F.expr(_START)).alias("since"),
        F.when(F.col("l_linenumber") != 5, F.col("l_linestatus")).alias("status"),
        F.when(F.col("l_linenumber") != 6, F.concat(F.col("l_returnflag"), F.col("l_linestatus")).cast("binary")).alias("raw"),
        F.when(F.col("l_linenumber") != 7, _cents("l_extendedprice")).alias("price"),
    )


def _shown(df: DataFrame) -> DataFrame:
    """Intervals, bytes and decimals as numbers and text that any engine writes alike."""
    return df.withColumns({"since": convert.timespan_ms(F.col("since")), "raw": F.hex("raw"), "price": (F.col("price") * 100).cast("long")})


_TWELVE_SQL = """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 2 THEN l_returnflag = 'R' END AS flag, CAST(l_tax AS FLOAT) AS tax, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity,
CASE WHEN l_linenumber <> 1 THEN make_timestamp((epoch_us(l_shipdate) // 1000) * 1000) END AS shipped, CAST(l_shipdate AS DATE) AS day, CASE WHEN l_linenumber <> 4 THEN (l_orderkey * 7919 + l_linenumber * 31) % 86400000 END AS at,
CAST(trunc((epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1995-01-01')) / 1000.0) AS BIGINT) AS since, CASE WHEN l_linenumber <> 5 THEN l_linestatus END AS status,
CASE WHEN l_linenumber <> 6 THEN hex(encode(l_returnflag || l_linestatus)) END AS raw, CASE WHEN l_linenumber <> 7 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END AS price FROM lineitem"""


@query(_TWELVE_SQL)
def stored_twelve_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark)
    store.write_table(_twelve(spark, sf_dir), path)
    return _shown(store.read_table(spark, path).df)


@query(_TWELVE_SQL)
def sliced_twelve_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through encoded slices: run lengths, bit arrays, masks, milliseconds, 16-byte decimals."""
    path = _fresh(spark)
    sliced.write_slices(_twelve(spark, sf_dir), path)
    return _shown(sliced.read_slices(spark, path).df)


@query("""SELECT c."column" AS "column", c.encoding AS encoding, c.masked AS masked, count(*) AS n_rows, true AS within FROM lineitem,
(VALUES ('l_orderkey', 'run length', false), ('l_linenumber', 'run length', false), ('flag', 'bit array', true), ('tax', 'run length', false), ('quantity', 'run length', true), ('shipped', 'run length', true),
('day', 'run length', false), ('at', 'run length', true), ('since', 'run length', false), ('status', 'run length', true), ('raw', 'plain', true), ('price', 'run length', true)) c("column", encoding, masked) GROUP BY ALL""")
def slice_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each column's slices are stored, and whether every slice has at most the default number of rows."""
    path = _fresh(spark)
    sliced.write_slices(_twelve(spark, sf_dir), path)
    names = sliced.read_slices(spark, path).df.columns
    each = sliced.slices_of(spark, path).select("n_rows", F.posexplode("columns").alias("k", "c"))
    of_column = each.groupBy("k").agg(F.max("c.encoding").alias("encoding"), F.bool_or(F.col("c.mask").isNotNull()).alias("masked"), F.sum("n_rows").alias("n_rows"), (F.max("n_rows") <= 100_000 // len(names)).alias("within"))
    return of_column.select(F.element_at(F.array(*map(F.lit, names)), F.col("k") + 1).alias("column"), "encoding", "masked", "n_rows", "within")


@query("SELECT 'plain' AS encoding, count(*) AS n_rows, (count(*) + 499) // 500 AS slices FROM orders")
def plain_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lengths off, slices of 500 rows, one task: the last slice is shorter."""
    path = _fresh(spark)
    sliced.write_slices(_read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").coalesce(1), path, per_slice=500, run_lengths=False)
    of_slice = sliced.slices_of(spark, path)
    return of_slice.groupBy(F.col("columns")[1]["encoding"].alias("encoding")).agg(F.sum("n_rows").alias("n_rows"), F.count("*").alias("slices"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT n_nationkey + 100, n_name, n_regionkey FROM nation")
def appended_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, nation = _fresh(spark), _read(spark, sf_dir, "nation")
    store.write_table(nation, path)
    store.write_table(nation.withColumn("n_nationkey", F.col("n_nationkey") + 100), path, mode="append")
    return store.read_table(spark, path).df


class _Path(os.PathLike):
    def __init__(self, text: str) -> None:
        self.text = text

    def __fspath__(self) -> str:
        return self.text


@query("SELECT kind, r_regionkey FROM region, (VALUES ('text'), ('bytes'), ('path')) v(kind)")
def store_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths as text with signs beyond ASCII, bytes and path objects (descriptors have a test: they are local)."""
    out = None
    for kind, of in (("text", str), ("bytes", os.fsencode), ("path", _Path)):
        path = of(_fresh(spark) + "-表")
        store.write_table(_read(spark, sf_dir, "region").select("r_regionkey"), path)
        part = store.read_table(spark, path).df.select(F.lit(kind).alias("kind"), "r_regionkey")
        out = part if out is None else out.union(part)
    return out


# ---- encodings and conversions


_REVERSED = " || ".join(f"substr(h, {k}, 2)" for k in range(15, 0, -2))


@query(f"SELECT o_orderkey, {_REVERSED} || '00000000' || '0000' || '3C' || CASE WHEN negative THEN 'B0' ELSE '30' END AS coded FROM (SELECT o_orderkey, o_orderkey % 2 = 0 AS negative, printf('%016X', CAST(round(o_totalprice * 100) AS BIGINT)) AS h FROM orders)")
def decimal_to_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 bytes: the coefficient, little end first, and the exponent of hundredths with the sign."""
    price = F.when(F.col("o_orderkey") % 2 == 0, -_cents("o_totalprice")).otherwise(_cents("o_totalprice"))
    return _read(spark, sf_dir, "orders").select("o_orderkey", F.hex(convert.decimal_binary(price)).alias("coded"))


@query("SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders")
def bytes_to_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", _cents("o_totalprice").alias("price"))
    back = convert.binary_decimal(convert.decimal_binary(F.col("price")), orders.schema["price"].dataType)
    return orders.select("o_orderkey", (back * 100).cast("long").alias("cents"))


@query("SELECT o_orderkey, CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 100 AS VARCHAR) || '.' || lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS price, round(o_totalprice * 100) <> 0 AS some FROM orders")
def currency_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", _cents("o_totalprice").alias("price"), _cents("o_totalprice").alias("some"))
    return _converted(orders, price=STRING, some=BOOLEAN)


@query("""SELECT event_id, ms, CASE WHEN ms IS NOT NULL THEN lpad(CAST(ms // 3600000 AS VARCHAR), 2, '0') || ':' || lpad(CAST(ms // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(ms // 1000 % 60 AS VARCHAR), 2, '0')
|| CASE WHEN ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(ms % 1000 * 1000 AS VARCHAR), 6, '0') END END AS shown, CASE WHEN ms IS NOT NULL THEN true END AS truth
FROM (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN event_id * 86413 % 86400000 END AS ms FROM events)""")
def time_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Time column: its milliseconds, its text, its truth."""
    ms = F.when(F.col("event_id") % 9 != 0, F.col("event_id") * 86413 % 86_400_000)
    events = _read(spark, sf_dir, "events").select("event_id", *(_time(ms, c) for c in ("ms", "shown", "truth")))
    return _converted(events, ms="Time", shown=STRING, truth=BOOLEAN)


@query("""SELECT event_id, ms, CASE WHEN ms // 86400000 = 0 THEN '' ELSE CAST(ms // 86400000 AS VARCHAR) || CASE WHEN abs(ms // 86400000) = 1 THEN ' day, ' ELSE ' days, ' END END
|| CAST(rest // 3600000 AS VARCHAR) || ':' || lpad(CAST(rest // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(rest // 1000 % 60 AS VARCHAR), 2, '0') || CASE WHEN rest % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(rest % 1000 * 1000 AS VARCHAR), 6, '0') END AS shown, ms <> 0 AS truth
FROM (SELECT event_id, ms, ms - 86400000 * (CASE WHEN ms < 0 AND ms % 86400000 <> 0 THEN ms // 86400000 - 1 ELSE ms // 86400000 END) AS rest FROM (SELECT event_id, event_id % 500 * 7654321 AS ms FROM events))""")
def timespan_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans from milliseconds: back to them, as text, as truth."""
    span = convert.ms_timespan(F.col("event_id") % 500 * 7_654_321)
    events = _read(spark, sf_dir, "events").select("event_id", *(span.alias(c) for c in ("ms", "shown", "truth")))
    return _converted(events, ms="TimeSpan", shown=STRING, truth=BOOLEAN).withColumn("ms", convert.timespan_ms(F.col("ms")))


@query("SELECT n_nationkey, 'b''' || n_name || '''' AS shown, n_nationkey % 3 <> 0 AS truth FROM nation")
def binary_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    some = F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).otherwise("").cast("binary")
    return _converted(nation.select("n_nationkey", F.col("n_name").cast("binary").alias("shown"), some.alias("truth")), shown=STRING, truth=BOOLEAN)


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CASE WHEN o_orderkey % 4 <> 0 THEN true END AS has_day, true AS has_time, CAST(o_custkey AS VARCHAR) AS customer FROM orders")
def date_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"), F.when(F.col("o_orderkey") % 4 != 0, day).alias("has_day"), F.col("o_orderdate").alias("has_time"), F.col("o_custkey").alias("customer"))
    return _converted(orders, day=STRING, has_day=BOOLEAN, has_time=BOOLEAN, customer=STRING)


@query("SELECT event_id, CAST(value AS FLOAT) AS single, CAST(CAST(value AS FLOAT) AS DOUBLE) AS back, CAST(trunc(value) AS BIGINT) AS whole, value <> 0 AS truth FROM events")
def number_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    single = _converted(events.select("event_id", F.col("value").alias("single"), F.col("value").cast("float").alias("back"), F.col("value").alias("whole"), F.col("value").alias("truth")), single="SingleReal", back="Real", whole=LONG, truth=BOOLEAN)
    return single


# ---- inference


_SEEN: list[tuple[str, list]] = [
    ("bool", [True, None]), ("int32", [np.int32(1)]), ("int", [1, None]), ("int64", [np.int64(2)]), ("float32", [np.float32(1)]), ("float", [None, 1.5]), ("datetime", [dt.datetime(2020, 1, 1)]), ("timestamp", [pd.Timestamp("2020-01-01")]),
    ("date", [dt.date(2020, 1, 1)]), ("time", [dt.time(1)]), ("timedelta", [dt.timedelta(1)]), ("text", ["x"]), ("bytes", [b"x"]), ("decimal", [decimal.Decimal("1.5")]), ("int then bool", [1, True]), ("date then datetime", [dt.date(2020, 1, 1), dt.datetime(2020, 1, 1)]),
    ("bool then int", [True, 1]), ("datetime then date", [dt.datetime(2020, 1, 1), dt.date(2020, 1, 1)]), ("nothing", [None, float("nan")]), ("bytearray", [bytearray(b"x")]), ("int8", [np.int8(1)]),
]
_FOUND = ["Boolean", "Integer", "LongInteger", "LongInteger", "SingleReal", "Real", "DateTime", "DateTime", "Date", "Time", "TimeSpan", "String", "Binary", "Currency", "LongInteger", "Date", *["an error"] * 5]


def _or_error(of, x) -> str:
    try:
        return of(x)
    except TableError:
        return "an error"


@query(_values("seen, type", [(n, t) for (n, _), t in zip(_SEEN, _FOUND, strict=True)]))
def inferred_from_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, "seen string, type string", [(n, _or_error(types.of_values, v)) for n, v in _SEEN])


_DTYPES = [("bool", "Boolean"), ("boolean", "Boolean"), ("int32", "Integer"), ("Int32", "Integer"), ("int64", "LongInteger"), ("Int64", "LongInteger"), ("float32", "SingleReal"), ("Float32", "SingleReal"), ("float64", "Real"), ("Float64", "Real"),
           ("datetime64[ns]", "DateTime"), ("datetime64[ms]", "DateTime"), ("timedelta64[ns]", "TimeSpan"), ("string", "String"), ("category", "String"), ("int8", "an error"), ("uint32", "an error"), ("complex128", "an error")]


@query(_values("dtype, type", _DTYPES))
def inferred_from_dtypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, "dtype string, type string", [(d, _or_error(types.of_dtype, pd.Series(["a"] if d == "category" else [], dtype=d))) for d, _ in _DTYPES])


# ---- objects that become tables


class _Figure:
    """Stands for the figures and images of libraries that need not be installed."""

    def savefig(self, held, format: str | None = None) -> None:
        held.write(b"\x89PNG\r\n\x1a\n")

    save = savefig


def _of_library(module: str) -> object:
    return type("Picture", (_Figure,), {"__module__": module})()


_POINT = struct.pack("<BIdd", 1, 1, 2.0, 3.0)
_PNG = "89504E470D0A1A0A"
_ADAPTED = [
    ("frame", "a", "LongInteger", 2, "1"), ("series", "b", "Real", 2, "1.5"), ("unnamed series", "x", "String", 1, "s"), ("array", "x", "Real", 2, "0.5"), ("dict", "k", "LongInteger", 2, "1"), ("text", "x", "String", 1, "text"), ("bytes", "x", "Binary", 1, "62"),
    ("bytearray", "x", "Binary", 1, "62"), ("list", "x", "LongInteger", 2, "1"), ("range", "x", "LongInteger", 3, "4"), ("set", "x", "LongInteger", 1, "42"), ("generator", "x", "LongInteger", 2, "0"), ("scalar", "x", "Real", 1, "3.5"), ("time", "x", "Time", 1, "3723004"), ("span", "x", "TimeSpan", 1, "90000"),
    ("figure", "x", "Binary", 1, _PNG), ("grid", "x", "Binary", 1, _PNG), ("image", "x", "Binary", 1, _PNG), ("dict of scalars", "an error", "an error", 0, "an error"),
]


@query(_values("object, \"column\", type, n_rows, first", _ADAPTED))
def adapted_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of object as a table: its column's name and type, its rows, its least value as text."""
    objects = [
        pd.DataFrame({"a": [1, 2]}), pd.Series([1.5, None], name="b"), pd.Series(["s"]), np.array([0.5, 1.5]), {"k": [1, 2]}, "text", b"b", bytearray(b"b"), [1, 2], range(4, 7), {42}, (k for k in (0, 1)), 3.5, dt.time(1, 2, 3, 4000), dt.timedelta(seconds=90),
        _of_library("matplotlib.figure"), _of_library("seaborn.axisgrid"), _of_library("PIL.Image"), {"k": 1},
    ]
    rows = []
    for (name, *_), obj in zip(_ADAPTED, objects, strict=True):
        try:
            df = to_table(obj, spark=spark).df
        except TableError:
            rows.append((name, "an error", "an error", 0, "an error"))
            continue
        kind, c = meta.get_types(df)[df.columns[0]], F.col(df.columns[0])
        shown = F.hex(c) if kind == "Binary" else convert.timespan_ms(c).cast("string") if kind == "TimeSpan" else c.cast("string")
        r = df.agg(F.count("*").alias("n"), F.min(shown).alias("first")).first()
        rows.append((name, df.columns[0], kind, r.n, r.first))
    return _rows(spark, "object string, `column` string, type string, n_rows long, first string", rows)


# ---- metadata


_EVERY: list[tuple[str, object, str]] = [
    ("Boolean", True, "True"), ("LongInteger", 3, "3"), ("Real", 3.25, "3.25"), ("DateTime", dt.datetime(1583, 1, 1, 2, 3, 4), "1583-01-01 02:03:04"), ("Date", dt.date(1583, 1, 1), "1583-01-01"), ("Time", dt.time(0, 0, 33), "00:00:33"),
    ("TimeSpan", dt.timedelta(seconds=12, milliseconds=300), "0:00:12.300000"), ("String", "The", "The"), ("Currency", decimal.Decimal("33.4455"), "33.4455"), ("Binary", b"\x01", "b'\\x01'"), ("Integer", np.int32(2), "2"), ("SingleReal", np.float32(0.25), "0.25"),
]


@query(_values("place, type, shown", [(p, t, s) for p in ("table", "column") for t, _, s in _EVERY]))
def stored_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of all twelve types, of a table and of a column, through a store."""
    path, every = _fresh(spark), {t: v for t, v, _ in _EVERY}
    region = meta.with_column_metadata(_read(spark, sf_dir, "region"), "r_name", every)
    store.write_table(Table(region, {t: [v] for t, v in every.items()}), path)
    back = store.read_table(spark, path)
    coded = {"table": meta.encode(back.metadata), "column": meta.encode(meta.column_metadata(back, "r_name"))}
    # whole and real numbers come back as Python's own, so the stored type is the one that was written
    raw = {"table": meta.encode(every), "column": back.df.schema["r_name"].metadata[meta.META_KEY]}
    return _rows(spark, "place string, type string, shown string", [(p, raw[p][t]["type"], str(meta.decode_value(coded[p][t]))) for p in coded for t in coded[p]])


@query(_values("name, id", [(n, k) for k, n in enumerate(NAMES)]))
def type_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed list of types in its order, by name and by number."""
    return _rows(spark, "name string, id long", [(types.of_number(k), types.number(n)) for k, n in enumerate(NAMES)])


@query(_values("said", [("there is no column 'nowhere'",), ("'Text' is no type for column 'r_name'",), ("r_name: String",), ("r_regionkey: Real",)]))
def declared_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown columns and types are warned of; the others are declared."""
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always", TableWarning)
        df = meta.set_types(_read(spark, sf_dir, "region"), {"nowhere": "Real", "r_name": "Text", "r_regionkey": "Real"})
    decided = types.policy(df, meta.declared(df)).types
    return _rows(spark, "said string", [(str(w.message),) for w in seen if issubclass(w.category, TableWarning)] + [(f"{c}: {t}",) for c, t in decided.items()])


# ---- geometry


def _box(k: int) -> bytes:
    """A rectangle from (k, -k) to (k + 2, 5 - k)."""
    x, y = float(k), float(-k)
    ring = [(x, y), (x + 2, y), (x + 2, y + 5), (x, y + 5), (x, y)]
    return struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 5) + b"".join(struct.pack("<dd", *p) for p in ring)


def _places(spark: SparkSession, sf_dir: str) -> Table:
    shapes = F.create_map(*(x for k in range(25) for x in (F.lit(k), F.lit(_box(k)))))
    return Table(_read(spark, sf_dir, "nation").select("n_nationkey", F.element_at(shapes, F.col("n_nationkey")).alias("Geometry")))


@query("SELECT n_nationkey, CAST(n_nationkey AS DOUBLE) AS XMin, CAST(-n_nationkey AS DOUBLE) AS YMin, n_nationkey + CAST(2 AS DOUBLE) AS XMax, CAST(5 AS DOUBLE) - n_nationkey AS YMax, n_nationkey + CAST(1 AS DOUBLE) AS XCenter, CAST(2.5 AS DOUBLE) - n_nationkey AS YCenter, 'Polygon' AS kind, 'EPSG:4326' AS crs FROM nation")
def geocoding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes and centres of polygons, through a store, with the kind and reference system that the table's metadata has."""
    path = _fresh(spark)
    store.write_table(meta.set_geocoding_table(_places(spark, sf_dir), crs="EPSG:4326"), path)
    back = meta.geo_table(store.read_table(spark, path))
    return back.df.select("n_nationkey", *meta.BOXES, F.lit(back.metadata[meta.GEOMETRY_KIND][0]).alias("kind"), F.lit(back.metadata[meta.CRS][0]).alias("crs"))


@query(_values("\"case\", said", [("no flag", "the table is not marked as one that maps places"), ("no shapes", "cannot read geometries: there is no Binary column 'Geometry'"), ("kinds", "geometry column has more than one kind of geometry")]))
def geometry_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    def said(f) -> str:
        try:
            return f()
        except TableError as error:
            return str(error)

    region = _read(spark, sf_dir, "region")
    mixed = spark.range(2).select(F.when(F.col("id") == 0, F.lit(_POINT)).otherwise(F.lit(_box(0))).alias("Geometry"))
    cases = [("no flag", lambda: meta.geo_table(Table(region))), ("no shapes", lambda: meta.geo_table(Table(region, {meta.IS_GEOCODING: [True]}))), ("kinds", lambda: meta.set_geocoding_table(mixed))]
    return _rows(spark, "`case` string, said string", [(n, str(said(f))) for n, f in cases])


# ---- scripts


_SCRIPTS = [
    ("value", "out1 = in2 + 1", True, "", ""), ("null", "print(in3)", True, "", "None\n"), ("names", "print(__inputs__, __outputs__)", True, "", "('in1', 'in2', 'in3', 'gone', '') ('out1',)\n"), ("skipped", "print('gone' in globals())", True, "", "False\n"),
    ("raised", "raise TypeError('from test')", False, "TypeError", ""), ("syntax", "rais x", False, "SyntaxError", ""), ("indent", "if True:\nx = 1", False, "IndentationError", ""), ("cause", "try:\n    1 / 0\nexcept ZeroDivisionError as e:\n    raise ValueError('no') from e", False, "ValueError", ""),
    ("exit", "import sys\nsys.exit(3)", False, "SystemExit", ""), ("undefined", "out2 = 1", False, "ScriptError", ""), ("unwritable", "out1 = [object()]", False, "TableError", ""),
]


def _hosted(spark: SparkSession, sf_dir: str, name: str, script: str, **more) -> object:
    region = _read(spark, sf_dir, "region")
    inputs = [Input("in1", "table", region), Input("in2", "value", region.select("r_regionkey"), order=("r_regionkey",)), Input("in3", "NULL"), Input("gone", "table", f"{folder(spark)}/nowhere"), Input("", "table", region)]
    wanted = [Output("out1")] if name not in ("null", "skipped") else []
    return DataFunction(inputs, wanted if name != "names" else [Output("out1")], script + ("\nout1 = 1" if name == "names" else ""), **more).run(spark)


@query(_values("\"case\", success, error, printed, traced", [(n, ok, e, p, not ok) for n, _, ok, e, p in _SCRIPTS]))
def script_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of scripts that work and of those that don't: the outcome, what was printed, whether the report has a trace."""
    rows = []
    for name, script, *_ in _SCRIPTS:
        r = _hosted(spark, sf_dir, name, script)
        rows.append((name, r.success, type(r.error).__name__ if r.error else "", r.stdout, "Traceback, the last call last:" in r.summary))
    return _rows(spark, "`case` string, success boolean, error string, printed string, traced boolean", rows)


@query(_values("kind, success, ran", [("script", True, True), ("aggregationScript", False, False), ("other", False, False)]))
def script_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only scripts run; those that aggregate for the host are refused, and what is not run defines no output."""
    rows = []
    for kind in ("script", "aggregationScript", "other"):
        r = _hosted(spark, sf_dir, "kind", "print('ran')\nout1 = 1", kind=kind)
        rows.append((kind, r.success, r.stdout == "ran\n"))
    return _rows(spark, "kind string, success boolean, ran boolean", rows)


@query(_values("line, found", [("input 'in1': table", True), ("has 2 columns", True), ("input 'gone'", True), ("input 4: bad name", True), ("script of kind 'script'", True), ("outputs are written", True), ("Printed as errors:", True), ("Log:", True), ("my_script.py", True)]))
def script_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log and the report of a run that fails after its outputs are written."""
    r = _hosted(spark, sf_dir, "log", "import sys\nprint('e', file=sys.stderr)\nout1 = 1", debugging=True)
    failed = _hosted(spark, sf_dir, "log", "raise ValueError('x')", filename="some/folder/my_script.py")
    lines = ["input 'in1': table", "has 2 columns", "input 'gone'", "input 4: bad name", "script of kind 'script'", "outputs are written", "Printed as errors:", "Log:", "my_script.py"]
    return _rows(spark, "line string, found boolean", [(x, x in (failed if x == "my_script.py" else r).summary and "some/folder" not in failed.summary) for x in lines])


@query("SELECT c_custkey, c_name, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_acctbal > 0")
def script_output_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An output that is written to a store and read again; its input is a store too."""
    before, after = _fresh(spark), _fresh(spark)
    store.write_table(_read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), before)
    script = "from pyspark.sql import functions as F\nout1 = in1.where('c_acctbal > 0').withColumn('c_acctbal', F.col('c_acctbal') * 2)"
    result = DataFunction([Input("in1", "table", before)], [Output("out1", after)], script).run(spark)
    if not result.success:
        raise RuntimeError(result.summary)
    return store.read_table(spark, after).df


@query(_values("\"case\", class, said", [("declared", "TableError", "Binary does not become Date"), ("values", "TableError", "column 'x' has values of several types"), ("nested", "TableError", "unknown type 'array<float>' of column 'embedding'"), ("kind", "ScriptError", "input 'a' is of unknown kind 'row'"), ("promoted", "TableWarning", "column 'o_orderkey' has values beyond Integer; LongInteger is used")]))
def errors_and_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    region = _read(spark, sf_dir, "region")
    binary = region.select(F.col("r_name").cast("binary").alias("b"))
    for case, wanted, f in (
        ("declared", TableError, lambda: store.prepared(binary, {"b": "Date"})),
        ("values", TableError, lambda: to_table([True, 1], spark=spark)),
        ("nested", TableError, lambda: store.prepared(_read(spark, sf_dir, "embeddings"))),
        ("kind", ScriptError, lambda: Input("a", "row", region).read(spark, lambda x: None)),
    ):
        try:
            f()
        except wanted as error:
            rows.append((case, type(error).__name__, str(error)))
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always", TableWarning)
        types.policy(_read(spark, sf_dir, "orders").select((F.col("o_orderkey") * 10_000_000_000).alias("o_orderkey")), {"o_orderkey": INTEGER})
    rows += [("promoted", w.category.__name__, str(w.message)) for w in seen if issubclass(w.category, TableWarning)]
    return _rows(spark, "`case` string, class string, said string", rows)


# ---- packages


@query(_values("version, place, raised, below", [("1.2.3.4", 0, "2.0.0.0", True), ("1.2.3.4", 1, "1.3.0.0", True), ("1.2.3.4", 2, "1.2.4.0", True), ("1.2.3.4", 3, "1.2.3.5", True), ("1.9", 1, "1.10.0.0", True), ("7", 0, "8.0.0.0", True)]))
def raised_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of four numbers: the next at each place, and that it is above."""
    rows = [(v, k) for v, places in (("1.2.3.4", (0, 1, 2, 3)), ("1.9", (1,)), ("7", (0,))) for k in places]
    of = packages.Version.of
    return _rows(spark, "version string, place long, raised string, below boolean", [(v, k, str(of(v).raised(k)), of(v) < of(v).raised(k)) for v, k in rows])


@query("SELECT bool_or(o.minor > n.minor OR n.minor IS NULL) AS major FROM (SELECT s_suppkey, s_suppkey % 11 AS minor FROM supplier WHERE s_suppkey % 3 <> 0) o LEFT JOIN (SELECT s_suppkey, s_suppkey % 13 AS minor FROM supplier WHERE s_suppkey % 4 <> 0) n USING (s_suppkey)")
def major_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is a package gone or older in the new list?"""
    k = F.col("s_suppkey")
    supplier = _read(spark, sf_dir, "supplier")
    listed = lambda by, of: supplier.where(k % by != 0).select(F.concat(F.lit("s"), k.cast("string")).alias("name"), F.concat(F.lit("1."), (k % of).cast("string")).alias("version"))
    return _rows(spark, "major boolean", [(packages.needs_major(listed(3, 11), listed(4, 13)),)])


@query(_values("key, filled", [("packages", True), ("python", True), ("system", True)]))
def support_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    import json

    return _rows(spark, "key string, filled boolean", [(k, bool(v)) for k, v in json.loads(support.bundle()).items()])
