"""A session with the settings the engine is planned for."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Adaptive plans, skewed joins split, UTC, Arrow batches small enough for long texts.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(master: str | None = None, name: str = "tablewright", **settings: str) -> SparkSession:
    """The running session, or one with ``SETTINGS``; ``settings`` use ``__`` for a dot."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    for k, v in settings.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once for each application; Spark's own file server hands them out."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    _sent.add(sc.applicationId)
    top = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="tablewright-")) / "tablewright.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(path))
