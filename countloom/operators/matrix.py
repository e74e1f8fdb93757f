"""Count matrices in long form: one row (feature, cell, value) for each cell of the matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rpm(cells: DataFrame, column: str, value: str) -> DataFrame:
    """Adds rpm: value per million of its column's sum, 0 for an empty column. Sums are aggregated first and joined."""
    sums = cells.groupBy(column).agg(F.sum(value).alias("_total"))
    return cells.join(sums, column).withColumn("rpm", F.when(F.col("_total") != 0, F.col(value) * 1e6 / F.col("_total")).otherwise(0.0)).drop("_total")


def absolute(cells: DataFrame, column: str, value: str, is_spike: Column, molecules: int = 2500) -> DataFrame:
    """Adds absolute: value times spike / (molecules * total) of its column, 0 without spikes."""
    sums = cells.groupBy(column).agg(F.sum(F.when(is_spike, F.col(value)).otherwise(0)).alias("_spike"), F.sum(value).alias("_total"))
    factor = F.when((F.col("_spike") == 0) | (F.col("_total") == 0), 0.0).otherwise(F.col("_spike") / (molecules * F.col("_total")))
    return cells.join(sums, column).withColumn("absolute", F.col(value) * factor).drop("_spike", "_total")


def size_factors(cells: DataFrame, column: str, value: str) -> DataFrame:
    """The mean of the non-zero column sums over each column's sum; 0 for an empty column."""
    sums = cells.groupBy(column).agg(F.sum(value).alias("total"))
    mean = sums.agg(F.avg(F.when(F.col("total") != 0, F.col("total"))).alias("mean"))
    return sums.join(F.broadcast(mean)).select(column, "total", F.when(F.col("total") != 0, F.col("mean") / F.col("total")).otherwise(0.0).alias("factor"))


def merged_tables(tables: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """The union of the keys of named tables with one column for each, 0 where a table lacks the key; the least value of a repeated key counts."""
    long = None
    for name, t in tables.items():
        x = t.groupBy(key).agg(F.min(value).alias(value)).withColumn("_table", F.lit(name))
        long = x if long is None else long.unionByName(x)
    return long.groupBy(key).pivot("_table", list(tables)).agg(F.first(value)).fillna(0, list(tables))


def cv_by_feature(cells: DataFrame, feature: str, value: str) -> DataFrame:
    return cells.groupBy(feature).agg(F.avg(value).alias("mean"), (F.stddev_samp(value) / F.avg(value)).alias("cv"))


def plate(values: DataFrame, well: str, value: str, rows: int = 8) -> DataFrame:
    """Each well's value over the mean of all, as a plate: one row for each plate row, one column for each of 12 plate columns."""
    mean = values.agg(F.avg(value).alias("_mean"))
    d = values.join(F.broadcast(mean)).select((F.col(well) % rows).alias("plate_row"), F.floor(F.col(well) / rows).alias("_col"), (F.col(value) / F.col("_mean")).alias("_ratio"))
    return d.groupBy("plate_row").agg(*[F.round(F.max(F.when(F.col("_col") == k, F.col("_ratio"))), 6).alias(f"c{k}") for k in range(12)])


def running_first_seen(reads: DataFrame, group: str, order: list[str], item: list[str], every: int) -> DataFrame:
    """Saturation: after each so many reads of a group, how many distinct items it has seen."""
    by = Window.partitionBy(group).orderBy(*order)
    new = (F.row_number().over(Window.partitionBy(group, *item).orderBy(*order)) == 1).cast("long")
    d = reads.withColumn("_new", new).withColumn("n_read", F.row_number().over(by)).withColumn("n_distinct", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return d.filter(F.col("n_read") % every == 0).select(group, F.col("n_read").cast("long").alias("n_read"), "n_distinct")


def first_reads(reads: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first n reads of each group."""
    return reads.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_k") <= n).drop("_k")
