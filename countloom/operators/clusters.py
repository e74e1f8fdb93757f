"""Agglomerative clustering of a bounded number of items (groups, cells, features) from the table of their distances.

The table has the square of the items, as the method itself does. Single, complete and average linkage never bring a merged cluster nearer to a third one
than its parts were, so all pairs that are each other's nearest can merge in one round, with the same tree as one merge at a time. With a
neighbourhood that is not so, and each round merges the nearest neighbouring pair alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import kept


def point_distances(points: DataFrame, item: str, place: str, value: str) -> DataFrame:
    """first < second and their squared Euclidean distance, of points in long form without absent values; items meet by place."""
    a = points.select(F.col(item).alias("first"), place, F.col(value).alias("_a"))
    b = points.select(F.col(item).alias("second"), place, F.col(value).alias("_b"))
    gap = F.col("_a") - F.col("_b")
    return a.join(b, place).filter("first < second").groupBy("first", "second").agg(F.sum(gap * gap).alias("distance"))


def agglomerated(pairs: DataFrame, linkage: str = "average", neighbours: DataFrame | None = None, keep: int = 1) -> list[tuple]:
    """The merges (first, second, height), lowest first, down to ``keep`` clusters. A cluster has the least of its items as its name.

    pairs: first < second, distance, for all pairs of items. neighbours: first < second; only clusters that touch then merge. The merges
    are one row for each item at most, which is what comes to the driver.
    """
    if linkage not in ("single", "complete", "average"):
        raise ValueError(f"no linkage {linkage!r}")
    d = pairs.select("first", "second", "distance", F.lit(1).cast("long").alias("w"))
    if neighbours is None:
        d = d.withColumn("near", F.lit(True))
    else:
        n = neighbours.select("first", "second").distinct().withColumn("_near", F.lit(True))
        d = d.join(n, ["first", "second"], "left").withColumn("near", F.coalesce("_near", F.lit(False))).drop("_near")
    how = {"single": F.min("distance"), "complete": F.max("distance"), "average": F.sum(F.col("distance") * F.col("w")) / F.sum("w")}[linkage]
    d, merges = kept(d), []
    left = d.select("first").unionByName(d.select(F.col("second").alias("first"))).distinct().count()
    while True:
        near = d.filter("near")
        at = F.struct("distance", "first", "second")
        if neighbours is None:
            sides = near.select(F.col("first").alias("c"), at.alias("x")).unionByName(near.select(F.col("second").alias("c"), at.alias("x")))
            best = sides.groupBy("c").agg(F.min("x").alias("x"))
            found = best.groupBy("x").agg(F.count("*").alias("n")).filter("n = 2").select("x.*").collect()
        else:
            top = near.agg(F.min(at).alias("x")).select("x.*").first()
            found = [top] if left > keep and top["first"] is not None else []
        if not found:
            break
        merges += [(r["first"], r["second"], r["distance"]) for r in found]
        left -= len(found)
        names = F.broadcast(d.sparkSession.createDataFrame([(r["second"], r["first"]) for r in found], f"_old {pairs.schema['first'].dataType.simpleString()}, _new {pairs.schema['first'].dataType.simpleString()}"))
        e = d
        for c in ("first", "second"):
            e = e.join(names, F.col(c) == F.col("_old"), "left").withColumn(c, F.coalesce("_new", c)).drop("_old", "_new")
        e = e.filter("first != second").select(F.least("first", "second").alias("first"), F.greatest("first", "second").alias("second"), "distance", "w", "near")
        new = e.groupBy("first", "second").agg(how.alias("distance"), F.sum("w").alias("w"), F.max("near").alias("near"))
        d = kept(new)
    merges.sort(key=lambda m: m[2])
    return merges[: len(merges) - (keep - 1)] if neighbours is None and keep > 1 else merges


def members(items: list, merges: list[tuple]) -> dict:
    """item -> the name of its cluster after the merges."""
    name = {i: i for i in items}
    for a, b, _ in merges:
        name = {i: a if c == b else c for i, c in name.items()}
    return name
