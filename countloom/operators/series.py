"""Ordered values: derivatives, peaks, spaced tops, histograms of other widths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranks import running_totals


def derivative(d: DataFrame, keys: list[str], order: str, x: str) -> DataFrame:
    """Adds slope, the next value less this one; the last row of a key has none and is left out."""
    return d.withColumn("slope", F.lead(x).over(Window.partitionBy(*keys).orderBy(order)) - F.col(x)).filter("slope is not null")


def peaks(d: DataFrame, keys: list[str], order: str, x: str, width: int) -> DataFrame:
    """Rows at which a rise of at least width steps turns into a fall of at least width steps.

    A rise ends where two steps in a row go down, and a fall where two in a row don't, so a single step the other way doesn't part a slope. Values begin
    with a rise; the peak lies before the first falling step.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    s = derivative(d, keys, order, x)
    s = s.withColumn("_next", F.lead("slope").over(w)).withColumn("_before", F.lag("slope").over(w)).withColumn("_last", F.lag(F.struct(order, x)).over(w)).filter("_next is not null")
    turn = F.when((F.col("slope") < 0) & (F.col("_next") < 0), -1).when((F.col("slope") >= 0) & (F.col("_next") >= 0), 1)
    s = s.withColumn("_sign", F.coalesce(F.last(turn, ignorenulls=True).over(w), F.lit(1)))
    s = s.withColumn("_run", F.sum(F.coalesce((F.lag("_sign").over(w) != F.col("_sign")).cast("int"), F.lit(0))).over(w))
    at = F.when(F.col("_before") < 0, F.col("_last")).otherwise(F.struct(order, x))
    runs = s.groupBy(*keys, "_run").agg(F.first("_sign").alias("_sign"), F.count("*").alias("_steps"), F.min_by(at, order).alias("_at"))
    runs = runs.withColumn("_rise", F.lag("_steps").over(Window.partitionBy(*keys).orderBy("_run")))
    return runs.filter((F.col("_sign") == -1) & (F.col("_rise") >= width) & (F.col("_steps") >= width)).select(*keys, f"_at.{order}", f"_at.{x}")


def inflections(d: DataFrame, keys: list[str], order: str, x: str, width: int) -> DataFrame:
    """Where the slope has a peak of that width: rows of the place and its slope, see ``peaks``."""
    slopes = derivative(d, keys, order, x).select(*keys, order, F.col("slope").alias("_bend"))
    return peaks(slopes, keys, order, "_bend", width).withColumnRenamed("_bend", "slope")


def run_peaks(d: DataFrame, keys: list[str], order: str, x: str, width: int) -> DataFrame:
    """Rows between a run of at least width steps that don't go down and a run of at least width steps that do. Here every single step the other way ends a run, as suits whole numbers."""
    w = Window.partitionBy(*keys).orderBy(order)
    s = derivative(d, keys, order, x).withColumn("_down", F.col("slope") < 0)
    s = s.withColumn("_run", F.sum(F.coalesce((F.lag("_down").over(w) != F.col("_down")).cast("int"), F.lit(0))).over(w))
    runs = s.groupBy(*keys, "_run", "_down").agg(F.count("*").alias("_steps"), F.min(F.struct(order, x)).alias("_at"))
    runs = runs.withColumn("_rise", F.lag("_steps").over(Window.partitionBy(*keys).orderBy("_run")))
    return runs.filter(F.col("_down") & (F.col("_rise") >= width) & (F.col("_steps") >= width)).select(*keys, f"_at.{order}", f"_at.{x}")


def spaced(d: DataFrame, keys: list[str], pos: str, apart: int) -> DataFrame:
    """The rows that count when places are taken in order and each must lie at least so far behind the last one that counts. Places are whole numbers, one row for each of a key.

    Behind a gap of that size the first place always counts, so stretches between such gaps are walked by themselves; a task holds the places of one stretch.
    """
    w = Window.partitionBy(*keys).orderBy(pos)
    gap = (F.col(pos) - F.lag(pos).over(w) >= apart).cast("int")
    d = d.withColumn("_stretch", F.sum(F.coalesce(gap, F.lit(0))).over(w))

    def walk(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column(pos).to_numpy(), kind="stable")
        keep, last = [], None
        for i, p in zip(order.tolist(), t.column(pos).to_numpy()[order].tolist(), strict=True):
            if last is None or p - last >= apart:
                keep.append(i)
                last = p
        return t.take(keep)

    return d.groupBy(*keys, "_stretch").applyInArrow(walk, d.schema).drop("_stretch")


def spaced_top(d: DataFrame, keys: list[str], pos: str, n: str, most: int, apart: int) -> DataFrame:
    """Of the places that ``spaced`` leaves, those with the first most largest counts of each key; of equal counts the first places."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(n), pos))
    return spaced(d, keys, pos, apart).withColumn("_k", rank).filter(F.col("_k") <= most).drop("_k")


def log_histogram(d: DataFrame, x: str, base: float = 2.0) -> DataFrame:
    """Counts of positive values by the whole part of their logarithm."""
    k = F.floor(F.log(F.col(x)) / F.log(F.lit(base)) + 1e-12)
    return d.filter(F.col(x) > 0).groupBy(k.alias("bin")).agg(F.count("*").alias("n"))


def equal_count_histogram(d: DataFrame, x: str, bins: int) -> DataFrame:
    """bin (from 0), n, low and high: bins of nearly equal counts that never part equal values. Values are counted, and added up over ranges of their order."""
    n = d.filter(F.col(x).isNotNull()).groupBy(x).agg(F.count("*").alias("_n"))
    n = running_totals(n, [x], "_n", "_before")
    n = n.join(F.broadcast(n.agg(F.sum("_n").alias("_all")))).withColumn("bin", F.floor(F.col("_before") * bins / F.col("_all")))
    return n.groupBy("bin").agg(F.sum("_n").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"))


def sampled_at(d: DataFrame, group: str, order: list[str], depth: int, measure: str) -> DataFrame:
    """A running measure of each group at its read number depth; groups with fewer reads have none."""
    return d.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_k") == depth).select(group, measure)
