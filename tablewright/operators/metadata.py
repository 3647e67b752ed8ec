"""Tables with metadata.  Column metadata lives in the schema; table metadata in a wrapper, as Spark has no place for it."""

from __future__ import annotations

import base64
import datetime as dt
import decimal
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import types as kinds
from ..errors import TableError, TableWarning
from ..functions import geo

#: Key of a column's own metadata among a field's.
META_KEY = "tablewright.metadata"

# Names that programs which draw maps look for.
GEOMETRY = "Geometry"
IS_GEOCODING, IS_ENABLED = "MapChart.IsGeocodingTable", "MapChart.IsGeocodingEnabled"
GEOMETRY_KIND, CRS, COLUMN_ROLE, CONTENT = "MapChart.GeometryType", "MapChart.GeographicCrs", "MapChart.ColumnTypeId", "ContentType"
WKB = "application/x-wkb"
BOXES = ("XMin", "YMin", "XMax", "YMax", "XCenter", "YCenter")
#: Fixed value: characters of column metadata after which a report stops.
REPORT_CHARS = 80_000


@dataclass
class Table:
    """A DataFrame and the metadata of the table it holds: name -> list of values."""

    df: DataFrame
    metadata: dict[str, list] = field(default_factory=dict)

    def __getattr__(self, name: str):
        return getattr(self.df, name)


# ---- metadata values as JSON


def encode_value(value) -> dict[str, str]:
    """A value of one of the twelve types as its type's name and text."""
    kind = kinds.of_values([value], "metadata")
    match kind:
        case "Binary":
            text = base64.b64encode(value).decode()
        case "Date" | "DateTime" | "Time":
            text = value.isoformat()
        case "TimeSpan":
            text = str((value.days * 86400 + value.seconds) * 1_000_000 + value.microseconds)
        case "SingleReal" | "Real":
            text = repr(float(value))
        case _:
            text = str(value)
    return {"type": kind, "value": text}


def decode_value(coded: Mapping[str, str]):
    text = coded["value"]
    match coded["type"]:
        case "Boolean":
            return text == "True"
        case "Integer" | "LongInteger":
            return int(text)
        case "SingleReal" | "Real":
            return float(text)
        case "Binary":
            return base64.b64decode(text)
        case "Date":
            return dt.date.fromisoformat(text)
        case "DateTime":
            return dt.datetime.fromisoformat(text)
        case "Time":
            return dt.time.fromisoformat(text)
        case "TimeSpan":
            return dt.timedelta(microseconds=int(text))
        case "Currency":
            return decimal.Decimal(text)
    return text


def encode(metadata: Mapping[str, object]) -> dict[str, dict[str, str]]:
    """Values may be scalars or lists of length 1."""
    out = {}
    for name, value in metadata.items():
        values = value if isinstance(value, list) else [value]
        if len(values) > 1:
            raise TableError(f"metadata '{name}' is not length 1")
        if not values:
            raise TableError(f"the type of metadata '{name}' is unknown: all values are missing")
        out[str(name)] = encode_value(values[0])
    return out


def decode(coded: Mapping[str, Mapping[str, str]]) -> dict[str, list]:
    return {name: [decode_value(v)] for name, v in coded.items()}


def column_metadata(df: DataFrame | Table, column: str) -> dict[str, list]:
    return decode((_df(df).schema[column].metadata or {}).get(META_KEY, {}))


def with_column_metadata(df: DataFrame, column: str, metadata: Mapping[str, object]) -> DataFrame:
    old = dict(df.schema[column].metadata or {})
    return df.withMetadata(column, {**old, META_KEY: encode(metadata)})


def _df(x: DataFrame | Table) -> DataFrame:
    return x.df if isinstance(x, Table) else x


# ---- public operators


def copy_metadata(source, destination):
    """``destination`` with the metadata of ``source``: tables to tables by column name, single columns (tables of one) to single columns.

    A column that the source lacks is a ``KeyError``; two kinds of objects are a ``TypeError``.
    """
    if not all(isinstance(x, (DataFrame, Table)) for x in (source, destination)):
        raise TypeError("metadata is copied from a table to a table")
    s, d = _df(source), _df(destination)
    fields = {f.name: f for f in s.schema.fields}
    out = d
    for f in d.schema.fields:
        if f.name not in fields:
            raise KeyError(f.name)
        if fields[f.name].metadata:
            out = out.withMetadata(f.name, {**(f.metadata or {}), **fields[f.name].metadata})
    if isinstance(destination, Table) or isinstance(source, Table):
        mine = dict(destination.metadata) if isinstance(destination, Table) else {}
        return Table(out, {**mine, **(source.metadata if isinstance(source, Table) else {})})
    return out


def get_types(df: DataFrame | Table) -> dict[str, str | None]:
    """Column -> type name; None for columns outside the twelve types."""
    if not isinstance(df, (DataFrame, Table)):
        raise TypeError("df is not a table")
    out: dict[str, str | None] = {}
    for f in _df(df).schema.fields:
        try:
            out[f.name] = kinds.of_field(f)
        except TableError:
            out[f.name] = None
    return out


def set_types(df: DataFrame | Table, types: Mapping[str, str]) -> DataFrame | Table:
    """Declare the types columns are to be written with.  Unknown columns and types are warned of and left out."""
    if not isinstance(df, (DataFrame, Table)):
        raise TypeError("df is not a table")
    out = _df(df)
    known = set(out.columns)
    for column, kind in types.items():
        if column not in known:
            warnings.warn(f"there is no column '{column}'", TableWarning, stacklevel=2)
        elif not kinds.is_type(kind):
            warnings.warn(f"'{kind}' is no type for column '{column}'", TableWarning, stacklevel=2)
        else:
            out = out.withMetadata(column, {**(out.schema[column].metadata or {}), "tablewright.declared": kind})
    return Table(out, dict(df.metadata)) if isinstance(df, Table) else out


def declared(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["tablewright.declared"] for f in df.schema.fields if (f.metadata or {}).get("tablewright.declared")}


def set_geocoding_table(table: DataFrame | Table, geometry: str = GEOMETRY, crs: str | None = None) -> Table:
    """Add the bounding box and centre of a WKB column and mark the table as one that maps places.

    One aggregate finds the kinds of geometry; more than one kind, or a kind without a name here, is an error.
    """
    df, meta = _df(table), dict(table.metadata) if isinstance(table, Table) else {}
    if geometry not in df.columns:
        raise TableError(f"no geometry column '{geometry}'")
    boxes = BOXES
    df = df.drop(*(b for b in boxes if b in df.columns))
    found = [r[0] for r in df.select(geo.kind(F.col(geometry)).alias("k")).where("k is not null").distinct().limit(len(geo.KINDS) + 1).collect()]
    if len(found) > 1:
        raise TableError("geometry column has more than one kind of geometry")
    named = geo.NAMES.get(found[0]) if found else None
    if found and named is None:
        raise TableError(f"geometry of kind '{found[0]}' cannot be mapped")
    box: Column = geo.envelope(F.col(geometry))
    df = df.withColumn("__box", box)
    for b in boxes[:4]:
        df = df.withColumn(b, F.col(f"__box.{b}"))
    df = df.withColumns({"XCenter": (F.col("XMin") + F.col("XMax")) / 2, "YCenter": (F.col("YMin") + F.col("YMax")) / 2}).drop("__box")
    for b in boxes:
        df = with_column_metadata(df, b, {COLUMN_ROLE: b})
    df = with_column_metadata(df, geometry, {COLUMN_ROLE: GEOMETRY, CONTENT: WKB})
    meta |= {IS_GEOCODING: [True], IS_ENABLED: [True]}
    if named:
        meta[GEOMETRY_KIND] = [named]
    if crs:
        meta[CRS] = [crs]
    return Table(df, meta)


def geo_table(table: Table) -> Table:
    """A stored table that maps places: its geometry must be a Binary column; everything stays WKB."""
    if not (table.metadata.get(IS_GEOCODING) or [False])[0]:
        raise TableError("the table is not marked as one that maps places")
    if get_types(table).get(GEOMETRY) != "Binary":
        raise TableError(f"cannot read geometries: there is no Binary column '{GEOMETRY}'")
    return table


def metadata_report(table: DataFrame | Table, most: int = REPORT_CHARS) -> str:
    """Table and column metadata as text, from the schema alone; columns stop after ``most`` characters."""
    from pprint import pformat

    meta = table.metadata if isinstance(table, Table) else {}
    out = "table metadata:" + (f"\n {pformat(meta)}" if meta else " none")
    columns, blank = "", False
    for c in _df(table).columns:
        if len(columns) > most:
            columns += "\n (too long, cut off here)"
            break
        of_column = column_metadata(table, c)
        if of_column:
            columns += f"\n {c}: {pformat(of_column)}"
        else:
            blank = True
    if not columns:
        return out + "\ncolumn metadata: none"
    return out + "\ncolumn metadata:" + columns + ("\n (columns without metadata are left out)" if blank else "")


