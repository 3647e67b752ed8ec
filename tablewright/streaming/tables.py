"""The type policy over streams, and windowed counts with late data.

A stream's types are declared or known from its schema: there is no pass over the data first, so a whole
number declared Integer that doesn't fit fails the query instead of widening the column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import convert
from ..types import Policy, checked, of_field


def typed(stream: DataFrame, declared: Mapping[str, str] | None = None) -> DataFrame:
    """``stream`` with its columns converted to the declared types."""
    declared = declared or {}
    return convert.apply(stream, Policy({f.name: checked(of_field(f), declared.get(f.name), f"column '{f.name}'") for f in stream.schema.fields}))


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Rows for each window of ``width`` and key; rows later than ``late`` are dropped.  ``time`` may have no zone."""
    at = stream.withColumn("__at", F.col(time).cast("timestamp")).withWatermark("__at", late)
    out = at.groupBy(F.window("__at", width), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), F.col("window.end").cast("timestamp_ntz").alias("window_end"), *keys, "n")


def write_stream(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Append the stream to the Parquet files below ``path``; all input that is there now, then stop."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()


def write_latest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the whole present result of an aggregated stream in the Parquet files at ``path``."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start()
