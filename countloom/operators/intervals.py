"""Joins of points with intervals, as-of joins, and algebra of intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Width of the bins that turn a range join into an equality join.
BIN = 30_000


def stab_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, how: str = "inner", bin_width: int = BIN) -> DataFrame:
    """Points with the intervals [start, end] that hold them; how as in join (inner, left, left_semi, left_anti).

    Intervals are repeated for each bin they touch; a point has one bin, so no pair comes twice.
    """
    p = points.withColumn("_bin", F.floor(F.col(point) / bin_width))
    bins = F.explode(F.sequence(F.floor(F.col(start) / bin_width), F.floor(F.col(end) / bin_width)))
    i = intervals.filter(F.col(start) <= F.col(end)).withColumn("_bin_i", bins)
    on = (p["_bin"] == i["_bin_i"]) & (p[point] >= i[start]) & (p[point] <= i[end])
    return p.join(i, on, how).drop("_bin", "_bin_i")


def cascade(points: DataFrame, layers: list[tuple[str, DataFrame]], key: str, point: str, start: str, end: str, bin_width: int = BIN) -> DataFrame:
    """Each point's first layer with an interval that holds it and how many of that layer do, by one join over all layers and a minimum; null and 0 where none does."""
    both = None
    for k, (name, layer) in enumerate(layers):
        x = layer.select(F.col(start), F.col(end), F.lit(k).alias("_k"), F.lit(name).alias("_layer"))
        both = x if both is None else both.unionByName(x)
    hits = stab_join(points.select(key, point), both, point, start, end, bin_width=bin_width).groupBy(key, "_k", "_layer").agg(F.count("*").alias("n_hits"))
    first = hits.groupBy(key).agg(F.min(F.struct("_k", F.col("_layer").alias("layer"), "n_hits")).alias("_x"))
    return points.join(first.select(key, "_x.layer", "_x.n_hits"), key, "left").withColumn("n_hits", F.coalesce("n_hits", F.lit(0)))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, since: str, value: str) -> DataFrame:
    """left with the value of right's last row at or before its time, by one sort of both sides."""
    r = right.select(*keys, F.col(since).alias("_t"), F.lit(0).alias("_side"), F.struct(F.col(since).alias("since"), F.col(value).alias("value")).alias("_v"))
    own = F.struct(*[F.col(c) for c in left.columns])
    l = left.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_side"), own.alias("_row"))  # noqa: E741
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = r.unionByName(l, allowMissingColumns=True).withColumn("_v", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1")
    return out.select("_row.*", F.col("_v.since").alias(since), F.col("_v.value").alias(value))


def _islands(d: DataFrame, within: list[str], keys: list[str], start: str, end: str) -> DataFrame:
    w = Window.partitionBy(*within).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_new", F.coalesce((F.col(start) > reach + 1).cast("int"), F.lit(1)))
    return d.withColumn("_island", F.sum("_new").over(w)).groupBy(*within, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).select(*keys, start, end)


def merged(intervals: DataFrame, keys: list[str], start: str, end: str, block: int = 1 << 20) -> DataFrame:
    """Unions of overlapping or touching integer intervals, whatever order they come in.

    Intervals are merged first among those that begin in the same block of positions, so that a key's rows spread over its blocks, and then what is left
    of a key is merged over its blocks.
    """
    d = intervals.select(*keys, start, end).withColumn("_block", F.floor(F.col(start) / block))
    return _islands(_islands(d, [*keys, "_block"], keys, start, end), keys, keys, start, end)


def gaps(intervals: DataFrame, keys: list[str], start: str, end: str, block: int = 1 << 20) -> DataFrame:
    """What lies between the merged intervals of a key."""
    before = F.lag(end).over(Window.partitionBy(*keys).orderBy(start))
    d = merged(intervals, keys, start, end, block).withColumn("_before", before).filter("_before is not null")
    return d.select(*keys, (F.col("_before") + 1).alias("gap_start"), (F.col(start) - 1).alias("gap_end"))


def coverage(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Runs of equal depth: +1 at each start, -1 after each end, and a running sum."""
    ends = intervals.select(*keys, F.col(start).alias("pos"), F.lit(1).alias("d")).unionByName(intervals.select(*keys, (F.col(end) + 1).alias("pos"), F.lit(-1).alias("d")))
    w = Window.partitionBy(*keys).orderBy("pos")
    runs = ends.groupBy(*keys, "pos").agg(F.sum("d").alias("d")).withColumn("depth", F.sum("d").over(w)).withColumn("run_end", F.lead("pos").over(w) - 1)
    return runs.filter("depth > 0").select(*keys, F.col("pos").alias("run_start"), "run_end", "depth")
