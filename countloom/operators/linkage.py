"""Linkages of groups of points, from sums: the work grows with the points, not with their pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_sums(d: DataFrame, group: str, point: str) -> DataFrame:
    """For each group and place of its points: n, the mean and the mean square."""
    values = d.select(group, F.posexplode(F.col(point).cast("array<double>")).alias("place", "value"))
    return values.groupBy(group, "place").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.avg(F.col("value") * F.col("value")).alias("square"))


def linkages(d: DataFrame, group: str, point: str) -> DataFrame:
    """first, second (groups, first < second), their sizes, and centroid, ward and average linkage in squared Euclidean distance.

    Ward's factor is the integer n1 * n2 div (n1 + n2). The average over all pairs of points needs only means and mean
    squares: E|x - y|^2 = E x^2 + E y^2 - 2 E x E y at each place. Groups meet by place, so a row of the
    join stands for two groups, never for two points. Points are of equal length without nulls; null groups have no linkage.
    """
    sums = group_sums(d.filter(F.col(group).isNotNull()), group, point)
    a = sums.select("place", F.col(group).alias("first"), F.col("n").alias("n_first"), F.col("mean").alias("_m1"), F.col("square").alias("_q1"))
    b = sums.select("place", F.col(group).alias("second"), F.col("n").alias("n_second"), F.col("mean").alias("_m2"), F.col("square").alias("_q2"))
    gap = F.col("_m1") - F.col("_m2")
    both = a.join(b, "place").filter("first < second").groupBy("first", "second", "n_first", "n_second")
    out = both.agg(F.sum(gap * gap).alias("centroid"), F.sum(F.col("_q1") + F.col("_q2") - 2 * F.col("_m1") * F.col("_m2")).alias("average"))
    return out.withColumn("ward", F.expr("n_first * n_second div (n_first + n_second)") * F.col("centroid"))
