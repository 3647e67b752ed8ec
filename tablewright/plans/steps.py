"""Cutting of lineage by a reliable checkpoint."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; one of our own where none is set and all runs on this machine."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        named = tempfile.mkdtemp(prefix="tablewright-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there."""
    folder(df.sparkSession)
    return df.checkpoint()
