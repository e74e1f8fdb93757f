"""Mixing sources to target weights, in DataFrame functions only.

Targets are a water level: every source gets its weight's share of all words, but never more than
``most`` times its own size; what a capped source cannot take is shared again by weight. Documents
get a hash-random key, are range-bucketed by it within each source, and a two-level prefix sum (sums
of buckets, then a window inside each bucket) gives the place of each document in its source's
random order, so that no task ever holds a whole source. The order is cut at the exact budget; whole
epochs come before the last, partial one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """One row per source (no_source, source, source_size) with its target in words.

    Weights go round in the order of the sources' code points, the null source last. There is one
    row per source, so the windows without partitions see that many rows and no documents.
    """
    order = Window.orderBy("no_source", "source")
    level = Window.orderBy("ratio", "no_source", "source")
    ranked = sizes.withColumn("k", (F.row_number().over(order) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") + 1).cast("int"))
    ranked = (
        ranked.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("caps_below", F.coalesce(F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weights_left", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("lam", (F.col("total") - F.col("caps_below")) / F.col("weights_left"))
    )
    # The first source, by ratio, that the level does not fill sets the level for all after it.
    free = F.when(F.col("ratio") > F.col("lam"), F.struct("ratio", "no_source", "source", "lam"))
    ranked = ranked.withColumn("free", F.min(free).over(Window.partitionBy()))
    target = F.when(F.col("free").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("free.lam") * F.col("weight")))
    return ranked.select("no_source", "source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """How many words of each document the mix takes.

    Returns doc_id, size, source_size, target, taken, source. ``taken`` counts repeats, so it is at
    most ``most`` times size; the document at the cut gives the part that fills the budget. Null texts have
    size 0; the null source is a source of its own; documents with equal ids follow in the order of
    their size; an empty table gives an empty result. Columns other than doc_id, text and source
    are not read.
    """
    d = placed(docs, weights, most, seed, [])
    return d.select("doc_id", "size", "source_size", "target", "taken", "source")


def placed(docs: DataFrame, weights: tuple[float, ...], most: int, seed: str, extra: list) -> DataFrame:
    """The rows of mix_sources() with further columns of docs, made from (doc_id, text, source). Words are counted once and written."""
    key = F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"|{seed}"))), 1, 16)
    d = docs.select("doc_id", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"), word_count(F.col("text")).alias("size"), key.alias("key"), *extra)
    d = written(d.withColumn("bucket", F.substring("key", 1, 3)), "mix-sizes")
    buckets = d.groupBy("no_source", "source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(buckets.groupBy("no_source", "source").agg(F.sum("words").alias("source_size")), weights, most)
    before = Window.partitionBy("no_source", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words").join(targets, ["no_source", "source"])
    inside = Window.partitionBy("no_source", "source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(buckets, ["no_source", "source", "bucket"])
    budget = F.floor(F.col("target") + 0.5)
    d = d.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0))
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("before") - F.col("inside")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return d.withColumn("taken", taken.cast("long")).withColumn("source", F.when(~F.col("no_source"), F.col("source")))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """docs as the mix takes them: a row for each epoch of a document, none where nothing is taken. The document at the cut comes whole.

    Columns stay as they are, whatever their names. Null and empty texts have no words and are not taken; the null source is one of its own;
    documents with one id are told apart by source and text, and rows equal in all three are taken alike, as often as the most taken
    of them; very long texts are counted whole; an empty table stays empty.
    """
    names, digest = docs.columns, F.md5("text")
    taken = placed(docs, weights, most, seed, [digest.alias("digest")]).filter("taken > 0")
    taken = taken.groupBy(F.col("doc_id").alias("id"), F.col("source").alias("of"), "digest").agg(F.max(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias("copies_taken"))
    rows = docs.select(F.struct(*names).alias("row"), digest.alias("own_digest"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & F.col("row.source").eqNullSafe(F.col("of")) & (F.col("own_digest") == F.col("digest"))
    rows = rows.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies_taken"))))
    return rows.select(*[F.col("row")[c].alias(c) for c in names])


#: DuckDB SQL for mix_sources(documents).
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         substring(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|mix'), 1, 16) AS key
  FROM documents),
s AS (SELECT no_source, source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY no_source, source) - 1) % 3]::DOUBLE AS weight,
             source_size * 3.0::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / weight AS ratio,
        (sum(source_size) OVER ()::DOUBLE
         - coalesce(sum(cap) OVER (ORDER BY cap / weight, no_source, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
        / sum(weight) OVER (ORDER BY cap / weight, no_source, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam FROM w),
t AS (SELECT no_source, source, source_size,
        CASE WHEN lv IS NULL THEN cap ELSE least(cap, lv * weight) END AS target
      FROM l, (SELECT arg_min(lam, (ratio, no_source, source)) AS lv FROM l WHERE ratio > lam)),
p AS (SELECT doc_id, size, d.source, no_source, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS budget,
        coalesce(CAST(sum(size) OVER (PARTITION BY no_source, d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start
      FROM d JOIN t USING (no_source, source)),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, CASE WHEN NOT no_source THEN source END AS source, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - start)) AS BIGINT) AS taken
FROM e
"""
