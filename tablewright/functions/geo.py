"""Bounding boxes and kinds of WKB geometries, in plain Python behind Arrow functions."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of the kinds of geometry in well-known binary, by code.
KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
#: What a map calls them; other kinds have no name.
NAMES = {"Point": "Point", "LineString": "Line", "LinearRing": "Line", "MultiLineString": "PolyLine", "Polygon": "Polygon"}


def _head(data: bytes, at: int) -> tuple[str, int, int, int]:
    """Byte order, kind, dimensions of a point and place after the head of a geometry (ISO and extended codes)."""
    order = "<" if data[at] else ">"
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    dims = 2
    if code & 0xE0000000:
        dims += bool(code & 0x80000000) + bool(code & 0x40000000)
        at += 4 * bool(code & 0x20000000)
        code &= 0x0FFFFFFF
    if code >= 1000:
        dims += {1: 1, 2: 1, 3: 2}.get(code // 1000, 0)
        code %= 1000
    return order, code, dims, at


def points(data: bytes, at: int = 0) -> tuple[list[tuple[float, float]], int]:
    """The x and y of all points of a geometry, and where it ends."""
    order, code, dims, at = _head(data, at)

    def run(at: int, n: int) -> tuple[list[tuple[float, float]], int]:
        flat = struct.unpack_from(f"{order}{n * dims}d", data, at)
        return list(zip(flat[::dims], flat[1::dims], strict=True)), at + 8 * n * dims

    def count(at: int) -> tuple[int, int]:
        return struct.unpack_from(order + "I", data, at)[0], at + 4

    if code == 1:
        return run(at, 1)
    n, at = count(at)
    if code == 2:
        return run(at, n)
    out: list[tuple[float, float]] = []
    for _ in range(n):
        if code == 3:
            m, at = count(at)
            more, at = run(at, m)
        else:
            more, at = points(data, at)
        out += more
    return out, at


def kind_of(data: bytes | None) -> str | None:
    return None if data is None else KINDS.get(_head(data, 0)[1])


def box_of(data: bytes | None) -> tuple[float, float, float, float] | None:
    if data is None:
        return None
    found = [p for p in points(data)[0] if p[0] == p[0] and p[1] == p[1]]
    if not found:
        return None
    x, y = zip(*found, strict=True)
    return min(x), min(y), max(x), max(y)


def kind(wkb: Column) -> Column:
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: kind_of(None if v is None else bytes(v)))

    return run(wkb)


def envelope(wkb: Column) -> Column:
    @F.pandas_udf("struct<XMin: double, YMin: double, XMax: double, YMax: double>")
    def run(values: pd.Series) -> pd.DataFrame:
        boxes = [box_of(None if v is None else bytes(v)) or (None,) * 4 for v in values]
        return pd.DataFrame(boxes, columns=["XMin", "YMin", "XMax", "YMax"], dtype="float64")

    return run(wkb)
