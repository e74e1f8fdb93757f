"""Cutting the lineage of iterative operators, and broadcasts of a checked size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession) -> SparkContext:
    """The context with a checkpoint folder: that of spark.checkpoint.dir, which all executors share. Where it is unset, a local session (tests) gets one of its own; a cluster must set it."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="countloom-")
        context.setCheckpointDir(folder)
    return context


def kept(d: DataFrame) -> DataFrame:
    """d as a checkpoint in the shared folder."""
    _folder(d.sparkSession)
    return d.checkpoint()


def written(d: DataFrame) -> DataFrame:
    """d as Parquet in the shared folder: for tables with a row for each row of the input or more, as columns are packed and read one by one, and their rows counted from the footers."""
    path = f"{_folder(d.sparkSession).getCheckpointDir()}/{uuid.uuid4().hex}"
    schema = d.schema
    d.write.parquet(path)
    return d.sparkSession.read.schema(schema).parquet(path)


def small_or_not(d: DataFrame, most: int = 500_000) -> DataFrame:
    """d marked for broadcast if it has no more rows than that, which a bounded count tells; else as it is, and Spark shuffles."""
    return F.broadcast(d) if d.limit(most + 1).count() <= most else d
