"""How a table is cut into slices, how each column is encoded, and how many values each lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import column, of_field


# Cells of a slice, and the least rows.
CELLS, LEAST = 100_000, 10


def rows_per_slice(columns: int, asked: int = 0) -> int:
    """``asked`` if positive, else about 100,000 cells, 10 rows at least."""
    return asked if asked > 0 else max(LEAST, CELLS // max(1, columns))


def slice_plan(df: DataFrame, asked: int = 0) -> DataFrame:
    """``slice``, ``first_row``, ``n_rows`` of each slice; the last is shorter."""
    size = rows_per_slice(len(df.columns), asked)
    total = df.agg(F.count("*").alias("total"))
    slices = total.where("total > 0").select("total", F.explode(F.expr(f"sequence(0L, (total - 1) div {size})")).alias("slice"))
    first = F.col("slice") * F.lit(size)
    return slices.select("slice", first.alias("first_row"), F.least(F.lit(size).cast("long"), F.col("total") - first).alias("n_rows"))


def encoding(kind: str, run_lengths: bool = True) -> str:
    if kind == "Boolean":
        return "bit array"
    return "run length" if run_lengths and kind != "Binary" else "plain"


def encoding_plan(df: DataFrame, run_lengths: bool = True) -> DataFrame:
    """``column``, ``type``, ``encoding`` of each column, from the schema."""
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(of_field(f)).alias("type"), F.lit(encoding(of_field(f), run_lengths)).alias("encoding")) for f in df.schema.fields]
    return df.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def invalid(field: T.StructField):
    """Is the value missing?  NaN is."""
    c = column(field.name)
    return c.isNull() | F.isnan(c) if isinstance(field.dataType, (T.FloatType, T.DoubleType)) else c.isNull()


def invalid_counts(df: DataFrame) -> DataFrame:
    """``column``, ``n_invalid``, ``has_mask``: one aggregate over the table, unpivoted."""
    fields = df.schema.fields
    one = df.agg(*(F.count_if(invalid(f)).alias(f"c{k}") for k, f in enumerate(fields)))
    rows = F.array(*(F.struct(F.lit(f.name).alias("column"), F.col(f"c{k}").alias("n_invalid")) for k, f in enumerate(fields)))
    return one.select(F.explode(rows).alias("r")).select("r.column", "r.n_invalid", (F.col("r.n_invalid") > 0).alias("has_mask"))
