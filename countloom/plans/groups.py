"""The queries of linkages, ranked values and reversed sequences, as (function, DuckDB SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.functions import sequence
from countloom.operators import alignment, cells, clusters, linkage, stats

from .profiles import rounded, spread, table
from .variants import oligos

QUERIES = []


def query(sql: str):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


@query("""WITH v AS (SELECT label, unnest(range(0, len(embedding))) AS place, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings WHERE label IS NOT NULL),
    m AS (SELECT label, place, count(x) AS n, avg(x) AS m FROM v GROUP BY ALL),
    c AS (SELECT a.label AS first, b.label AS second, a.n AS n_first, b.n AS n_second, sum((a.m - b.m) ** 2) AS d FROM m a JOIN m b USING (place) WHERE a.label < b.label GROUP BY ALL),
    p AS (SELECT a.label AS first, b.label AS second, avg(list_sum(list_transform(list_zip(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), lambda z: (z[1] - z[2]) ** 2))) AS e FROM embeddings a JOIN embeddings b ON a.label < b.label GROUP BY ALL)
    SELECT first, second, n_first, n_second, round(d, 6) AS centroid, round((n_first * n_second // (n_first + n_second)) * d, 6) AS ward, round(e, 6) AS average FROM c JOIN p USING (first, second)""")
def group_linkages(spark, sf_dir):
    return rounded(linkage.linkages(table(spark, sf_dir, "embeddings"), "label", "embedding"), "centroid", "ward", "average")


def _ranked(name: str, p: float):
    sql = f"SELECT l_returnflag, list_sort(list(l_quantity))[least(CAST(floor(count(l_quantity) * {p}) AS BIGINT) + 1, count(l_quantity))] AS value FROM lineitem GROUP BY ALL"

    def run(spark, sf_dir):
        return stats.nearest_rank(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", p)

    run.__name__ = name
    query(sql)(run)


_ranked("percentile_90", 0.9)
_ranked("percentile_last", 1.0)


@query("SELECT p_partkey, reverse(translate(upper(p_name), 'ACGTRYKMBDHV', 'TGCAYRMKVHDB')) AS revcomp FROM part")
def revcomp(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", sequence.reverse_complement(F.upper("p_name")).alias("revcomp"))


def _nation_points(spark, sf_dir):
    """Nations as points: their customers' mean balance in each segment, 0 where there is none."""
    c = table(spark, sf_dir, "customer")
    names = c.select("c_mktsegment").distinct()
    means = c.groupBy("c_nationkey", "c_mktsegment").agg(F.avg("c_acctbal").alias("v"))
    every = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey")).crossJoin(F.broadcast(names))  # 25 nations by 5 segments
    return every.join(means, ["c_nationkey", "c_mktsegment"], "left").select("c_nationkey", "c_mktsegment", F.round(F.coalesce("v", F.lit(0.0)), 6).alias("v"))


def hac_clusters(spark, sf_dir):
    """The merges of nations by average linkage."""
    pairs = clusters.point_distances(_nation_points(spark, sf_dir), "c_nationkey", "c_mktsegment", "v")
    return spark.createDataFrame(clusters.agglomerated(pairs), "first int, second int, height double")


def spatial_hac(spark, sf_dir):
    """The merges of nations by complete linkage where only touching clusters merge; nations lie on a grid of five columns."""
    pairs = clusters.point_distances(_nation_points(spark, sf_dir), "c_nationkey", "c_mktsegment", "v")
    grid = table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") % 5).alias("x"), F.floor(F.col("n_nationkey") / 5).alias("y"))
    near = cells.neighbours(grid, "n_nationkey", "x", "y", True)
    return spark.createDataFrame(clusters.agglomerated(pairs, "complete", near, 15), "first int, second int, height double")


QUERIES += [(hac_clusters, None), (spatial_hac, None)]


def local_alignments(spark, sf_dir):
    """Each part's oligonucleotide against the reverse complement of its neighbour's; no SQL."""
    d = oligos(spark, sf_dir)
    other = d.select((F.col("p_partkey") + 1).alias("p_partkey"), sequence.reverse_complement(F.col("seq")).alias("target"))
    return alignment.local_scores(spread(d.join(other, "p_partkey")), "p_partkey", "seq", "target")


QUERIES += [(local_alignments, None)]
