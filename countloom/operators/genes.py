"""Gene models: rows with exons, an array of (s, e) in genome order, both ends inclusive, and strand. Overlaps, masks, hits and exon algebra.

Joins of genes with genes or masks are binned by position; everything inside a gene is an expression over its exons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def span(exons: Column) -> tuple[Column, Column]:
    return F.element_at(exons, 1)["s"], F.element_at(exons, -1)["e"]


def transcript_length(exons: Column) -> Column:
    return F.aggregate(exons, F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"] + 1)


def introns(exons: Column) -> Column:
    """What lies between the exons; each intron ends at the next exon's first base."""
    return F.transform(F.slice(exons, F.lit(1), F.size(exons) - 1), lambda x, i: F.struct((x["e"] + 1).alias("s"), F.get(exons, i + 1)["s"].alias("e")))


def intronic_length(exons: Column) -> Column:
    start, end = span(exons)
    return end - start + 1 - transcript_length(exons)


def genome_position(exons: Column, place: Column, forward: Column) -> Column:
    """The genome position of a place (from 0) in a transcript, null outside it: the inverse of transcript_position."""
    at = F.when(forward, place).otherwise(transcript_length(exons) - 1 - place)
    zero = F.struct(at.cast("long").alias("left"), F.lit(None).cast("long").alias("hit"))

    def step(a, x):
        n = x["e"] - x["s"] + 1
        inside = (a["left"] >= 0) & (a["left"] < n)
        return F.struct((a["left"] - n).cast("long").alias("left"), F.when(inside, x["s"] + a["left"]).otherwise(a["hit"]).cast("long").alias("hit"))

    return F.aggregate(exons, zero, step)["hit"]


def overlapping(a: DataFrame, b: DataFrame, intrusion: int, bins: int) -> DataFrame:
    """Pairs of rows of a and b (key, start, end each; b's columns get the suffix _b) that overlap by more than so many bases. A pair meets in the bin of the later start only."""
    of = lambda d: d.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / bins), F.floor(F.col("end") / bins))))
    y = of(b).select("_bin", *[F.col(c).alias(f"{c}_b") for c in b.columns])
    near = (F.col("start_b") <= F.col("end") - intrusion) & (F.col("end_b") >= F.col("start") + intrusion)
    once = F.col("_bin") == F.floor(F.greatest("start", "start_b") / bins)
    return of(a).join(y, "_bin").filter(near & once).drop("_bin")


def exons_within(exons: Column, start: Column, end: Column, intrusion: int) -> Column:
    return F.exists(exons, lambda x: (start <= x["e"] - intrusion) & (end >= x["s"] + intrusion))


def same_transcript(a: Column, b: Column, strand_a: Column, strand_b: Column, inner: int = 5, outer: int = 100) -> Column:
    """Whether two exon arrays are one transcript: equal strands and counts, ends within outer and all other borders within inner bases."""
    both = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda z, i: F.struct(z["a"].alias("a"), z["b"].alias("b"), i.alias("i")))
    left = lambda z: F.abs(z["a"]["s"] - z["b"]["s"]) <= F.when(z["i"] == 0, outer).otherwise(inner)
    right = lambda z: F.abs(z["a"]["e"] - z["b"]["e"]) <= F.when(z["i"] == F.size(a) - 1, outer).otherwise(inner)
    return F.when((strand_a != strand_b) | (F.size(a) != F.size(b)), False).otherwise(F.forall(both, lambda z: left(z) & right(z)))


def masked_exons(genes: DataFrame, bins: int) -> DataFrame:
    """gene and exon (from 0) of the exons that exons of the other strand overlap."""
    e = genes.select("gene", "strand", F.posexplode("exons").alias("exon", "x")).select("gene", "strand", "exon", F.col("x.s").alias("start"), F.col("x.e").alias("end"))
    hits = overlapping(e, e, 1, bins).filter("strand != strand_b")
    return hits.select("gene", "exon").distinct()


def masked_introns(genes: DataFrame, bins: int) -> DataFrame:
    """gene and intron (from 0) of the introns into which an exon of another gene reaches, whatever its strand."""
    e = genes.select("gene", F.explode("exons").alias("x")).select("gene", F.col("x.s").alias("start"), F.col("x.e").alias("end"))
    i = genes.filter(F.size("exons") > 1).select("gene", F.posexplode(introns(F.col("exons"))).alias("intron", "x"))
    i = i.select("gene", "intron", (F.col("x.s") - 1).alias("start"), F.col("x.e").alias("end"))
    hits = overlapping(i, e, 1, bins).filter("gene != gene_b")
    return hits.select("gene", "intron").distinct()


def masked_flanks(genes: DataFrame, flank: int, bins: int) -> DataFrame:
    """gene and side (upstream or downstream) of the flanks, so many bases on each side, into which an exon of another gene reaches, whatever its strand."""
    e = genes.select("gene", F.explode("exons").alias("x")).select("gene", F.col("x.s").alias("start"), F.col("x.e").alias("end"))
    start, end = span(F.col("exons"))
    side = lambda left: F.when((F.col("strand") == "+") == F.lit(left), "upstream").otherwise("downstream")
    sides = F.array(F.struct(side(True).alias("side"), (start - flank).alias("start"), start.alias("end")), F.struct(side(False).alias("side"), end.alias("start"), (end + flank).alias("end")))
    f = genes.select("gene", F.explode(sides).alias("f")).select("gene", "f.*")
    return overlapping(f, e, 1, bins).filter("gene != gene_b").select("gene", "side").distinct()


def joined_exons(exons: Column, gap: int = 10, least: int = 1) -> Column:
    """Exons with neighbours that are no more than gap apart joined, if that removes at least so many exons; else as they are."""
    kind = "array<struct<s:bigint,e:bigint>>"
    out = F.aggregate(
        exons,
        F.array().cast(kind),
        lambda a, x: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["e"] + gap >= x["s"]),
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["s"].alias("s"), x["e"].cast("long").alias("e")))),
        ).otherwise(F.concat(a, F.array(F.struct(x["s"].cast("long").alias("s"), x["e"].cast("long").alias("e"))))),
    )
    return F.when(F.size(out) + least <= F.size(exons), out).otherwise(exons.cast(kind))


def split_at_introns(exons: Column, longest: int) -> Column:
    """Masks (s, e): the exons with introns of up to longest bases between them filled."""
    return joined_exons(exons, longest, 0)


def flanked(genes: DataFrame, keys: list[str], flank: int) -> DataFrame:
    """genes (start, end) with left and right: flanks of up to so many bases that stop before the neighbours of the same keys (as strand). The window holds a key's genes."""
    w = Window.partitionBy(*keys).orderBy("start", "end", "gene")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    # What follows is what comes before in the reverse order: a frame that grows is one pass, one that shrinks is read anew for each row.
    back = Window.partitionBy(*keys).orderBy(F.desc("start"), F.desc("end"), F.desc("gene"))
    after = F.min("start").over(back.rowsBetween(Window.unboundedPreceding, -1))
    left = F.least(F.col("start"), F.greatest(F.col("start") - flank, F.coalesce(before + 1, F.col("start") - flank)))
    right = F.greatest(F.col("end"), F.least(F.col("end") + flank, F.coalesce(after - 1, F.col("end") + flank)))
    return genes.withColumn("left", left).withColumn("right", right)


def inverse(exons: Column, length: Column) -> Column:
    """Exons seen from the other end of a chromosome."""
    return F.reverse(F.transform(exons, lambda x: F.struct((length - 1 - x["e"]).alias("s"), (length - 1 - x["s"]).alias("e"))))


def exon_hits(hits: DataFrame, genes: DataFrame, cap: int) -> DataFrame:
    """gene, exon (from 1), n_mols, n_cap: those of unique hits nearer than cap to the gene's 5' end, and n_junction: those of hits that begin in the exon and end in a later one. hits: gene, pos, last (the last base), n_mols, is_unique."""
    d = hits.join(genes.select("gene", "strand", "exons"), "gene").withColumn("x", F.explode(F.transform("exons", lambda x, i: F.struct(x["s"].alias("s"), x["e"].alias("e"), (i + 1).alias("exon")))))
    start, end = span(F.col("exons"))
    first = F.when(F.col("strand") == "+", start).otherwise(end)
    near = F.col("is_unique") & (F.abs(F.col("pos") - first) < cap)
    over = F.exists("exons", lambda y: (y["s"] > F.col("x.e")) & F.col("last").between(y["s"], y["e"]))
    d = d.filter(F.col("pos").between(F.col("x.s"), F.col("x.e")))
    of = lambda c: F.sum(F.when(c, F.col("n_mols")).otherwise(0))
    return d.groupBy("gene", F.col("x.exon").alias("exon")).agg(F.sum("n_mols").alias("n_mols"), of(near).alias("n_cap"), of(over).alias("n_junction"))


def splice_counts(hits: DataFrame, by: list[str] = ()) -> DataFrame:
    """Molecules of each junction of a gene, named by its two exons; hits: gene, from_exon, to_exon, n_mols."""
    name = F.concat_ws("-", "from_exon", "to_exon").alias("junction")
    return hits.groupBy("gene", name, *by).agg(F.sum("n_mols").alias("n_mols"))


def locus_histogram(hits: DataFrame, genes: DataFrame, size: int, flank: int) -> DataFrame:
    """gene, bin and n: hits by distance from the 5' end of a gene's locus (with flank) in bins of so many bases; reverse genes are read backwards. hits: gene, pos."""
    start, end = span(F.col("exons"))
    d = hits.join(genes.select("gene", "strand", (start - flank).alias("_s"), (end + flank).alias("_e")), "gene").filter("pos between _s and _e")
    at = F.when(F.col("strand") == "+", F.col("pos") - F.col("_s")).otherwise(F.col("_e") - F.col("pos"))
    return d.groupBy("gene", F.floor(at / size).alias("bin")).agg(F.count("*").alias("n"))


def painted(hits: DataFrame, genes: DataFrame, length: int) -> DataFrame:
    """gene, pos and depth: reads of so many bases about their middle, clipped to the gene. hits: gene, mid.

    A read is a step up at its first base and a step down after its last; equal steps are added before they are sorted, and the running sum of a gene's steps is the depth up to the next one.
    So what is sorted and shuffled doesn't grow with the reads' length. The window holds the places of a gene at which the depth may change.
    """
    start, end = span(F.col("exons"))
    mids = hits.groupBy("gene", "mid").agg(F.count("*").alias("_n"))
    d = mids.join(genes.select("gene", start.alias("_s"), end.alias("_e")), "gene").filter(F.col("mid").between(F.col("_s"), F.col("_e")))
    up = F.struct(F.greatest("_s", F.col("mid") - length // 2).alias("pos"), F.col("_n").alias("step"))
    down = F.struct((F.least("_e", F.col("mid") + length // 2) + 1).alias("pos"), (-F.col("_n")).alias("step"))
    steps = d.select("gene", F.inline(F.array(up, down))).groupBy("gene", "pos").agg(F.sum("step").alias("step"))
    w = Window.partitionBy("gene").orderBy("pos")
    depth, after = F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lead("pos").over(w)
    runs = steps.select("gene", "pos", depth.alias("depth"), after.alias("_after")).filter("depth > 0")
    return runs.select("gene", F.explode(F.sequence(F.col("pos"), F.col("_after") - 1)).alias("pos"), "depth")


def fragments(exons: Column, step: int) -> Column:
    """The places (from 0) in a transcript at which fragments begin, every step bases."""
    return F.sequence(F.lit(0).cast("long"), transcript_length(exons) - 1, F.lit(step).cast("long"))


def profile_sections(hits: DataFrame, sections: int) -> DataFrame:
    """section (from 0) and n over transcripts cut into so many equal parts, 5' first. hits: place (from 0), length."""
    return hits.groupBy(F.least(F.floor(F.col("place") * sections / F.col("length")), F.lit(sections - 1)).alias("section")).agg(F.count("*").alias("n"))
