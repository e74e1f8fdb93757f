"""Running totals and ranks over a whole order, dealt to ranges of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import kept


def running_totals(d: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """d with the sum of value over all rows before each one; rows differ in order, and value is a long.

    The rows are range-sorted once and held in the shared folder, so that ranges stay as they are; a window adds up inside a range, and what lies before a range comes
    from the totals of the ranges, one row each. No task holds more than its range.
    """
    ranges = kept(d.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    own = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("_range").agg(F.sum(value).alias("_total"))
    before = totals.select("_range", F.coalesce(F.sum("_total").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))  # a row for each range
    return ranges.join(F.broadcast(before), "_range").withColumn(name, (F.col("_earlier") + F.coalesce(F.sum(value).over(own), F.lit(0))).cast("long")).drop("_range", "_earlier")


def ranked(d: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """d with the number of rows that come before it in order; rows equal in order share it. Equal rows are counted before they are sorted, so a frequent value is one row."""
    counts = d.groupBy(*order).agg(F.count("*").alias("_n"))
    return d.join(running_totals(counts, order, "_n", name).drop("_n"), order)
