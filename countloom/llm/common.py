"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of characters other than space and the controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a local session (tests) gets one of its own; a cluster must set it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="countloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int = 1000, size: int = 1 << 23):
    """Jobs started inside hand so many rows and bytes at most at once to Python (a longer row by itself), so that batches of whole texts stay small on both sides."""
    asked = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {key: spark.conf.get(key) for key in asked}
    try:
        for key, value in asked.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def small_or_not(df: DataFrame, rows: int, most: int) -> DataFrame:
    """df marked for broadcast if its counted rows are within the bound; beyond it Spark shuffles."""
    return F.broadcast(df) if rows <= most else df


def small_bytes_or_not(df: DataFrame, most: int) -> DataFrame:
    """df, a written table, marked for broadcast if its texts and binaries, and 16 bytes for each column, come to no more bytes than the bound."""
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) if t in ("string", "binary") else F.lit(0)) + 16 for c, t in df.dtypes)
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= most else df


def let(value: Column | str, body: str, name: str) -> str:
    """SQL that evaluates value once and binds it to name in body (which may stand in a lambda)."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"
