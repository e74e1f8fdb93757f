"""Descriptive statistics as aggregates, and transforms over windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_skewness(x: Column) -> Column:
    n = F.count(x)
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(x: Column) -> Column:
    """Bias-corrected excess kurtosis."""
    n = F.count(x)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def nearest_rank(d: DataFrame, keys: list[str], x: str, p: float) -> DataFrame:
    """keys and value: that at place int(n * p) of each group's sorted values, without interpolation; the last one for p = 1.

    Equal values are counted before the window, which runs over distinct values. Nulls are left out.
    """
    n = d.filter(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys)
    upto, total = F.sum("_n").over(w.orderBy(x)), F.sum("_n").over(w)
    n = n.withColumn("_upto", upto).withColumn("_place", F.least(F.floor(total * p) + 1, total))
    return n.filter("_upto >= _place and _upto - _n < _place").select(*keys, F.col(x).alias("value"))


def medians(d: DataFrame, keys: list[str], x: str) -> DataFrame:
    """keys and median. Equal values are counted before the window, so no task holds the rows of a group."""
    n = d.filter(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys)
    n = n.withColumn("_upto", F.sum("_n").over(w.orderBy(x))).withColumn("_all", F.sum("_n").over(w))
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    holds = lambda k: (F.col("_upto") >= k) & (F.col("_upto") - F.col("_n") < k)
    return n.groupBy(*keys).agg(((F.max(F.when(holds(low), F.col(x))) + F.max(F.when(holds(high), F.col(x)))) / 2).alias("median"))


def describe(d: DataFrame, keys: list[str], x: str) -> DataFrame:
    c = F.col(x)
    moments = d.groupBy(*keys).agg(
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.var_samp(c).alias("variance"), F.stddev_samp(c).alias("sd"), (F.stddev_samp(c) / F.sqrt(F.count(c))).alias("sem"),
        (F.stddev_samp(c) / F.avg(c)).alias("cv"), sample_skewness(c).alias("skewness"), sample_kurtosis(c).alias("kurtosis"),
    )
    return moments.join(medians(d, keys, x), keys, "left")


def robust_mean(d: DataFrame, keys: list[str], x: str, c: float = 5.0, epsilon: float = 1e-4) -> DataFrame:
    """One step of Tukey's biweight about the median, in units of c times the median absolute deviation. All steps run on counted values."""
    n = d.filter(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count("*").alias("_times"))
    e = n.join(medians(d, keys, x), keys).withColumn("_a", F.abs(F.col(x) - F.col("median")))
    far = e.groupBy(*keys, "_a").agg(F.sum("_times").alias("_n"))
    w = Window.partitionBy(*keys)
    far = far.withColumn("_upto", F.sum("_n").over(w.orderBy("_a"))).withColumn("_all", F.sum("_n").over(w))
    holds = lambda k: (F.col("_upto") >= k) & (F.col("_upto") - F.col("_n") < k)
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    mad = far.groupBy(*keys).agg(((F.max(F.when(holds(low), F.col("_a"))) + F.max(F.when(holds(high), F.col("_a")))) / 2).alias("_mad"))
    u = (F.col(x) - F.col("median")) / (c * F.col("_mad") + epsilon)
    weight = F.when(F.abs(u) < 1, F.pow(1 - u * u, 2)).otherwise(0.0) * F.col("_times")
    return e.join(mad, keys).withColumn("_w", weight).groupBy(*keys).agg((F.sum(F.col("_w") * F.col(x)) / F.sum("_w")).alias("robust_mean"))


def histogram(d: DataFrame, x: str, low: float, width: float, bins: int) -> DataFrame:
    """Counts of values in [low + k width, low + (k + 1) width); others and NaN are left out."""
    k = F.floor((F.col(x) - low) / width)
    return d.withColumn("bin", k).filter((F.col("bin") >= 0) & (F.col("bin") < bins) & ~F.isnan(x)).groupBy("bin").agg(F.count("*").alias("n"))


def ranks(d: DataFrame, keys: list[str], x: str, alias: str) -> DataFrame:
    """d with ranks, the mean rank for ties. The window runs over counted values, which are joined back by value."""
    n = d.groupBy(*keys, x).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(x))
    n = n.select(*keys, x, (upto - (F.col("_n") - 1) / 2).alias(alias))
    return d.join(n, [*keys, x])


def correlation(x: str, y: str) -> Column:
    """Pearson's r as an aggregate, 0 where a variance is 0."""
    return F.coalesce(F.nanvl(F.corr(x, y), F.lit(0.0)), F.lit(0.0))


def spearman(d: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    both = d.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return ranks(ranks(both, keys, x, "_rx"), keys, y, "_ry").groupBy(*keys).agg(correlation("_rx", "_ry").alias("rho"))


def z_scores(d: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Adds z. Means are aggregated before the join."""
    m = d.groupBy(*keys).agg(F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_sd"))
    return d.join(m, keys).withColumn("z", F.when(F.col("_sd") > 0, (F.col(x) - F.col("_mean")) / F.col("_sd")).otherwise(0.0)).drop("_mean", "_sd")


def moving_average(d: DataFrame, keys: list[str], order: str, x: str, half: int) -> DataFrame:
    """Centred mean of 2 half + 1 values; at the edges the first and last full mean."""
    w = Window.partitionBy(*keys).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.when(F.count(x).over(w.rowsBetween(-half, half)) == 2 * half + 1, F.avg(x).over(w.rowsBetween(-half, half)))
    d = d.withColumn("_full", full).withColumn("_k", F.row_number().over(w))
    early = F.col("_k") <= half
    return d.withColumn("smoothed", F.coalesce("_full", F.when(early, F.first("_full", ignorenulls=True).over(whole)).otherwise(F.last("_full", ignorenulls=True).over(whole)))).drop("_full", "_k")
