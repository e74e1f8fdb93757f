"""Mappings of reads against transcripts and repeats: matches, and what becomes of reads with several mappings.

Mappings have pos and strand; genes have gene, strand and exons (s and e, both inclusive, in genome order and apart); repeats have start and end. A mapping between
the exons of a gene isn't in its transcript, and distances count along the transcript. Joins are binned (``stab_join``), so a mapping meets only the intervals of its own bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import stab_join
from .profiles import transcript_position
from .storage import written

#: Mappings of a task, and pairs of genes.
ROWS, PAIRS = 1_000_000, 2_000_000


def _exons(genes: DataFrame) -> DataFrame:
    return genes.select("gene", F.col("strand").alias("_strand"), F.col("exons").alias("_exons"), F.explode("exons").alias("_x")).select("gene", "_strand", "_exons", F.col("_x.s").alias("_s"), F.col("_x.e").alias("_e"))


def _sense(mappings: DataFrame, genes: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """Mappings with the genes that have an exon there on their strand, and the distance from the transcript's 5' end."""
    hits = stab_join(mappings.select(*keys, "pos", "strand"), _exons(genes), "pos", "_s", "_e", bin_width=bins).filter(F.col("strand") == F.col("_strand"))
    distance = transcript_position(F.col("_exons"), F.col("pos"), F.col("_strand") == "+")
    return hits.select(*keys, "pos", "strand", "gene", distance.alias("distance"))


def nearest_match(mappings: DataFrame, genes: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """Each mapping's gene with the nearest 5' end of the transcript (the least of equally near ones), and whether there were others."""
    hits = _sense(mappings, genes, keys, bins).groupBy(*keys).agg(F.min(F.struct("distance", "gene")).alias("x"), F.count("*").alias("n"))
    return hits.select(*keys, "x.gene", "x.distance", (F.col("n") > 1).alias("has_variants"))


def all_matches(mappings: DataFrame, genes: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """All genes of each mapping, marked where there are several. The window holds the genes over one place."""
    return _sense(mappings, genes, keys, bins).withColumn("has_variants", F.count("*").over(Window.partitionBy(*keys)) > 1)


def _judged(mappings: DataFrame, genes: DataFrame, repeats: DataFrame, read: str, k: str, bins: int) -> DataFrame:
    """One row for each mapping: genes (null without), distance, is_repeat; and of its read: first, bad (its first mapping in a repeat outside transcripts, if there are several).

    Genes and repeats are found once for each place and strand. The mappings pass by the places' tables without being sorted, and reads are dealt to as many tasks as the mappings ask for, so that no task's
    memory grows with the table.
    """
    m = written(mappings)
    at = written(m.select("pos", "strand").distinct())
    sense = _sense(at, genes, [], bins).groupBy("pos", "strand").agg(F.min("distance").alias("distance"), F.collect_set("gene").alias("genes"))
    r = repeats.select(F.col("start").alias("_s"), F.col("end").alias("_e"))
    in_repeat = stab_join(at, r, "pos", "_s", "_e", "left_semi", bins).withColumn("is_repeat", F.lit(True))
    of = sense.join(in_repeat, ["pos", "strand"], "full")
    parts = max(m.count() // ROWS, int(m.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = F.struct("pos", "strand")  # equal also where a strand is null
    of = of.select(place.alias("_place"), "distance", "genes", "is_repeat").repartition(parts, "_place").hint("shuffle_hash")
    d = m.withColumn("_place", place).repartition(parts, "_place").join(of, "_place", "left").drop("_place").repartition(parts, read)
    w = Window.partitionBy(read)
    d = d.withColumn("_n", F.count("*").over(w)).withColumn("first", F.min(k).over(w))
    bad = F.col("is_repeat") & F.col("genes").isNull() & (F.col("_n") > 1)
    return d.withColumn("bad", F.min(F.when(bad, F.col(k))).over(w)).drop("_n")


def resolved(mappings: DataFrame, genes: DataFrame, repeats: DataFrame, read: str, k: str, rule: str, bins: int) -> DataFrame:
    """The mappings that count for each read, with in_transcript.

    A read with several mappings of which one lies in a repeat outside transcripts counts at that one, outside transcripts. Else its mappings in
    transcripts count: all, the one nearest a 5' end (the first of equally near ones), or a random one, drawn by a hash of read and mapping, so that
    reruns agree. A read without a mapping in a transcript counts at its first one. The windows hold the mappings of one read.
    """
    d = _judged(mappings, genes, repeats, read, k, bins)
    order: Column | None = {"all": None, "nearest": F.struct("distance", k), "random": F.struct(F.md5(F.concat(F.col(read).cast("string"), F.lit(":"), F.col(k).cast("string"))), k)}[rule]
    inside = F.col("genes").isNotNull()
    if order is not None:
        best = F.min(F.when(inside, order)).over(Window.partitionBy(read))
        inside = inside & (order == best)
    d = d.withColumn("_inside", inside).withColumn("_any", F.max(F.col("_inside")).over(Window.partitionBy(read)))
    take = F.when(F.col("bad").isNotNull(), F.col(k) == F.col("bad")).when(F.col("_any"), F.col("_inside")).otherwise(F.col(k) == F.col("first"))
    return d.filter(take).withColumn("in_transcript", F.col("bad").isNull() & F.col("_any")).drop("_inside", "_any", "first", "bad", "distance", "is_repeat")


def shared_genes(mappings: DataFrame, genes: DataFrame, repeats: DataFrame, read: str, k: str, bins: int) -> DataFrame:
    """gene, other and n_reads: the reads for which two genes compete. Pairs are made inside a read, whose genes are few; reads of the same genes are counted first, and pairs dealt to as many tasks as they ask for."""
    d = _judged(mappings, genes, repeats, read, k, bins).filter("bad is null and genes is not null")
    of = d.groupBy(read).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("genes")))).alias("genes")).filter(F.size("genes") > 1)
    sets = written(of.groupBy("genes").agg(F.count("*").alias("n_reads")))
    n = sets.agg(F.sum(F.size("genes").cast("long") * (F.size("genes") - 1))).first()[0] or 0
    parts = max(n // PAIRS, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = sets.repartition(parts).select(F.explode("genes").alias("gene"), "genes", "n_reads").select("gene", F.explode("genes").alias("other"), "n_reads").filter("gene != other")
    return pairs.repartition(parts, "gene", "other").groupBy("gene", "other").agg(F.sum("n_reads").alias("n_reads"))


def other_features(mappings: DataFrame, genes: DataFrame, layers: dict[str, DataFrame], keys: list[str], bins: int) -> DataFrame:
    """The mappings outside transcripts with what they lie in: an exon's other strand (antisense) first, then the layers in order, else null."""
    sense = _sense(mappings, genes, keys, bins).select(*keys).distinct()
    d = mappings.join(sense, keys, "left_anti")
    hits = stab_join(d.select(*keys, "pos", "strand"), _exons(genes).select("_s", "_e", "_strand"), "pos", "_s", "_e", bin_width=bins).filter("strand != _strand").select(*keys, F.lit(0).alias("_rank"), F.lit("antisense").alias("layer"))
    for rank, (name, layer) in enumerate(layers.items(), 1):
        x = layer.select(F.col("start").alias("_s"), F.col("end").alias("_e"))
        hits = hits.unionByName(stab_join(d.select(*keys, "pos"), x, "pos", "_s", "_e", bin_width=bins).select(*keys, F.lit(rank).alias("_rank"), F.lit(name).alias("layer")))
    return d.select(*keys).join(hits.groupBy(*keys).agg(F.min_by("layer", "_rank").alias("layer")), keys, "left")
