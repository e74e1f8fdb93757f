"""Assembly of overlapping words: each word's end is joined to at most one word's start.

Two words overlap if one without its first letter starts as the other without its last does. The heaviest overlaps win: in a round every free end and every free start name
their best overlap, and those that both name are taken. A ring of words loses its lightest overlap for good. Rounds go on while free ends and starts overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import kept


def _rings(taken: DataFrame) -> DataFrame:
    """The overlaps of taken (first, second, k) that lie on a ring, with the ring's least word, by doubling of pointers: on a path the pointers run out, on a ring they don't."""
    d = taken.select(F.col("first").alias("word"), F.col("second").alias("reach"), F.least("first", "second").alias("least"))
    steps, n = 1, taken.count()
    while steps <= n:
        on = d.select(F.col("word").alias("reach"), F.col("reach").alias("_next"), F.col("least").alias("_least"))
        d = kept(d.join(on, "reach").select("word", F.col("_next").alias("reach"), F.least("least", "_least").alias("least")))
        steps *= 2
    return taken.join(d.select(F.col("word").alias("first"), "least"), "first")


def joined_words(words: DataFrame, word: str, weight: str) -> DataFrame:
    """first and second of the overlaps that hold. The weight of an overlap is the lesser of its words' weights; of equal ones the greater sum wins, then the least words. Words are distinct, of one length of two or more, and not null."""
    w = words.select(F.col(word).alias("word"), F.col(weight).alias("n"))
    a = w.select(F.col("word").alias("first"), F.col("n").alias("_n"), F.expr("substr(word, 2)").alias("_part"))
    b = w.select(F.col("word").alias("second"), F.col("n").alias("_m"), F.expr("left(word, length(word) - 1)").alias("_part"))
    key = F.struct((-F.least("_n", "_m")).alias("a"), (-(F.col("_n") + F.col("_m"))).alias("b"), "first", "second")
    edges = kept(a.join(b, "_part").filter("first != second").select("first", "second", key.alias("k")))
    taken, free = None, edges
    while not free.isEmpty():
        by_end, by_start = (free.groupBy(c).agg(F.min("k").alias("k")).select("k") for c in ("first", "second"))
        new = by_end.join(by_start, "k").select("k.first", "k.second", "k")
        taken = kept(new if taken is None else taken.unionByName(new))
        rings = kept(_rings(taken))
        if not rings.isEmpty():
            worst = rings.groupBy("least").agg(F.max("k").alias("k")).select("k.first", "k.second")
            taken = kept(taken.join(worst, ["first", "second"], "left_anti"))
            edges = kept(edges.join(worst, ["first", "second"], "left_anti"))
        free = kept(edges.join(taken.select("first"), "first", "left_anti").join(taken.select("second"), "second", "left_anti"))
    return taken.select("first", "second") if taken is not None else edges.select("first", "second")


def assembled(words: DataFrame, word: str, weight: str) -> DataFrame:
    """start, n_words, consensus and total weight of each chain of words, single words included. A chain is gathered by its start; words that many reads share are few, which bounds its length."""
    w = words.select(F.col(word).alias("word"), F.col(weight).alias("n"))
    links = kept(joined_words(words, word, weight))
    d = w.join(links.select(F.col("second").alias("word"), F.col("first").alias("start")), "word", "left").select("word", "n", F.coalesce("start", "word").alias("start"), F.when(F.col("start").isNull(), 0).otherwise(1).alias("place"))
    d = kept(d)
    while True:  # pointers to earlier words double their reach
        on = d.select(F.col("word").alias("start"), F.col("start").alias("_start"), F.col("place").alias("_place"))
        step = kept(d.join(on, "start").select("word", "n", F.col("_start").alias("start"), (F.col("place") + F.col("_place")).alias("place"), (F.col("_place") > 0).alias("_moved")))
        d = step.drop("_moved")
        if step.filter("_moved").isEmpty():
            break
    chain = F.array_sort(F.collect_list(F.struct("place", "word")))
    g = d.groupBy("start").agg(F.count("*").alias("n_words"), F.sum("n").alias("weight"), chain.alias("_c"))
    rest = F.array_join(F.transform(F.slice(F.col("_c"), 2, F.greatest(F.size("_c") - 1, F.lit(0))), lambda x: F.right(x["word"], F.lit(1))), "")
    return g.select("start", "n_words", F.concat("start", rest).alias("consensus"), "weight")
