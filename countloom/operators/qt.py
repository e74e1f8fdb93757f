"""Quality-threshold clustering of a bounded number of items from the table of their similarities.

From every item as a seed a cluster grows: the item whose least similarity to the members is greatest joins, as long as that reaches the threshold. The largest cluster is taken out
and the rest goes on. A seed's growth only changes when one of its members is taken out, so a round grows only those seeds again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import kept

#: Items whose similarities the driver and each task may hold: the square in doubles is 32 MB.
MOST = 2000


def correlation_similarities(pairs: DataFrame, r: str) -> DataFrame:
    """first, second and similarity (1 + r) / 2 of pairs with a correlation."""
    return pairs.select("first", "second", ((1 + F.col(r)) / 2).alias("similarity"))


def grown(seed: int, s: np.ndarray, threshold: float) -> list[int]:
    """The members of a seed's cluster in the order they join; of equally similar items the first one joins. Rows and columns of taken items are -1 in s."""
    least, members = s[seed].copy(), [seed]
    least[seed] = -1.0
    while True:
        best = int(least.argmax())
        if least[best] < threshold or least[best] < 0:
            return members
        members.append(best)
        least = np.minimum(least, s[best])
        least[best] = -1.0


def quality_clusters(pairs: DataFrame, threshold: float = 0.5, most: int = MOST) -> DataFrame:
    """item, cluster (from 1, in the order they are taken out) and place (the order in which the item joined, from 1).

    pairs: first, second and similarity of each pair once, in either order; pairs without a row have similarity 0. Of equally large clusters that of the least seed goes first. The driver makes the similarities
    a matrix, which every task holds, so the number of items is bounded by ``most``, and more are refused.
    """
    spark = pairs.sparkSession
    sides = kept(pairs.select("first", "second", F.col("similarity").cast("double").alias("similarity")))
    items = sorted(r[0] for r in sides.select("first").union(sides.select("second")).distinct().limit(most + 1).collect())
    if len(items) > most:
        raise ValueError(f"more than {most} items")
    kind = sides.schema["first"].dataType.simpleString()
    number = {x: i for i, x in enumerate(items)}
    s = np.zeros((len(items), len(items)))
    for b in sides.toArrow().to_batches():
        i, j = (np.array([number[x] for x in b.column(c).to_pylist()], np.int64) for c in ("first", "second"))
        s[i, j] = s[j, i] = b.column("similarity").to_numpy()
    held = spark.sparkContext.broadcast(s)

    def clusters(seeds: DataFrame, gone: list[int]) -> DataFrame:
        def run(batches):
            m = held.value.copy()
            m[gone, :] = m[:, gone] = -1.0
            for b in batches:
                ids = b.column("seed").to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([grown(i, m, threshold) for i in ids], pa.list_(pa.int32()))], ["seed", "members"])

        return seeds.mapInArrow(run, "seed int, members array<int>")

    d = kept(clusters(spark.range(len(items)).select(F.col("id").cast("int").alias("seed")), []))
    gone: list[int] = []
    rows: list[tuple] = []
    while len(gone) < len(items):
        top = d.orderBy(F.desc(F.size("members")), "seed").first()
        new, cluster = list(top["members"]), rows[-1][1] + 1 if rows else 1
        rows += [(items[m], cluster, k) for k, m in enumerate(new, 1)]
        gone += new
        left = d.filter(~F.col("seed").isin(new))
        hit = F.arrays_overlap("members", F.array(*map(F.lit, new)))
        d = kept(left.filter(~hit).unionByName(clusters(left.filter(hit).select("seed").repartition(spark.sparkContext.defaultParallelism), gone)))
    return spark.createDataFrame(rows, f"item {kind}, cluster int, place int")
