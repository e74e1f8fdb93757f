"""Molecule counts over a stream of reads: beyond the batch operators, with event time and a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_molecules(reads: DataFrame, keys: list[str], umi: str, time: str = "ts", late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """The first reads of each molecule, counted by key and window; reads later than the watermark are dropped. Works on streams and on tables."""
    first = reads.withWatermark(time, late).dropDuplicates([*keys, umi, time]) if not reads.isStreaming else reads.withWatermark(time, late).dropDuplicatesWithinWatermark([*keys, umi])
    return first.groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n_molecules"))
