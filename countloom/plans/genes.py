"""The queries of gene models, as (function, DuckDB SQL). Parts stand in for genes: three exons each, from key and size."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.operators import genes, profiles

from .profiles import table

QUERIES = []


def query(sql: str):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


#: Exons of a part: lengths and gaps by key and size, all on one line of positions.
EXONS = "[{'s': p * 40, 'e': p * 40 + z % 5 + 3}, {'s': p * 40 + z % 5 + 4 + z % 17, 'e': p * 40 + z % 5 + 12 + z % 17}, {'s': p * 40 + 40 + z, 'e': p * 40 + 45 + z}]"
GENES = f"p AS (SELECT p_partkey AS p, CAST(p_size AS BIGINT) AS z FROM part), g AS (SELECT p AS gene, z, CASE WHEN p % 2 = 0 THEN '+' ELSE '-' END AS strand, {EXONS} AS exons FROM p), b AS (SELECT *, exons[1].s AS lo, exons[3].e AS hi FROM g)"
EACH = "x AS (SELECT gene, strand, i - 1 AS exon, exons[i].s AS s, exons[i].e AS e FROM g, (SELECT unnest(range(1, 4)) AS i))"


def models(spark, sf_dir):
    p, z = F.col("p_partkey"), F.col("p_size").cast("long")
    ends = [(p * 40, p * 40 + z % 5 + 3), (p * 40 + z % 5 + 4 + z % 17, p * 40 + z % 5 + 12 + z % 17), (p * 40 + 40 + z, p * 40 + 45 + z)]
    exons = F.array(*[F.struct(s.alias("s"), e.alias("e")) for s, e in ends])
    d = table(spark, sf_dir, "part")
    return d.select(p.alias("gene"), z.alias("z"), F.when(p % 2 == 0, "+").otherwise("-").alias("strand"), exons.alias("exons"))


def spans(spark, sf_dir):
    start, end = genes.span(F.col("exons"))
    return models(spark, sf_dir).select("gene", "strand", start.alias("start"), end.alias("end"), "exons")


@query(f"WITH {GENES} SELECT gene, CAST(list_sum([x.e - x.s + 1 for x in exons]) AS BIGINT) AS length, CAST(hi - lo + 1 - list_sum([x.e - x.s + 1 for x in exons]) AS BIGINT) AS intronic FROM b")
def gene_lengths(spark, sf_dir):
    return models(spark, sf_dir).select("gene", genes.transcript_length(F.col("exons")).alias("length"), genes.intronic_length(F.col("exons")).alias("intronic"))


@query(f"WITH {GENES} SELECT a.gene AS gene, b.gene AS other FROM b a JOIN b ON b.lo <= a.hi - 5 AND b.hi >= a.lo + 5 AND a.gene < b.gene")
def gene_overlaps(spark, sf_dir):
    d = spans(spark, sf_dir).select("gene", "start", "end")
    return genes.overlapping(d, d, 5, 200).filter("gene < gene_b").select("gene", F.col("gene_b").alias("other"))


@query(f"WITH {GENES}, {EACH} SELECT DISTINCT a.gene AS gene, x.gene AS other FROM b a JOIN x ON a.lo <= x.e - 2 AND a.hi >= x.s + 2 AND a.gene <> x.gene")
def gene_exon_overlaps(spark, sf_dir):
    d = spans(spark, sf_dir)
    pairs = genes.overlapping(d.select("gene", "start", "end"), d.select("gene", "start", "end", "exons"), 0, 200)
    near = genes.exons_within(F.col("exons_b"), F.col("start"), F.col("end"), 2)
    return pairs.filter(near & (F.col("gene") != F.col("gene_b"))).select("gene", F.col("gene_b").alias("other"))


@query(f"""WITH {GENES} SELECT a.gene AS gene, c.gene AS other FROM b a JOIN b c ON a.gene < c.gene AND a.strand = c.strand AND abs(a.exons[1].s - c.exons[1].s) <= 100 AND abs(a.exons[3].e - c.exons[3].e) <= 100
    AND abs(a.exons[1].e - c.exons[1].e) <= 100 AND abs(a.exons[2].s - c.exons[2].s) <= 100 AND abs(a.exons[2].e - c.exons[2].e) <= 100 AND abs(a.exons[3].s - c.exons[3].s) <= 100""")
def same_transcripts(spark, sf_dir):
    d = spans(spark, sf_dir)
    pairs = genes.overlapping(d.withColumn("end", F.col("end") + 100), d.withColumn("end", F.col("end") + 100), 0, 200).filter("gene < gene_b")
    same = genes.same_transcript(F.col("exons"), F.col("exons_b"), F.col("strand"), F.col("strand_b"), 100, 100)
    return pairs.filter(same).select("gene", F.col("gene_b").alias("other"))


@query(f"WITH {GENES}, {EACH} SELECT DISTINCT a.gene, CAST(a.exon AS INTEGER) AS exon FROM x a JOIN x c ON a.strand <> c.strand AND c.s < a.e AND c.e > a.s")
def antisense_mask(spark, sf_dir):
    return genes.masked_exons(models(spark, sf_dir), 200)


@query(f"WITH {GENES}, {EACH}, i AS (SELECT gene, k - 1 AS intron, exons[k].e AS s, exons[k + 1].s AS e FROM g, (SELECT unnest([1, 2]) AS k)) SELECT DISTINCT i.gene, CAST(intron AS INTEGER) AS intron FROM i JOIN x ON x.gene <> i.gene AND x.s < i.e AND x.e > i.s")
def intron_mask(spark, sf_dir):
    return genes.masked_introns(models(spark, sf_dir), 200)


@query(f"""WITH {GENES}, {EACH}, f AS (SELECT gene, CASE strand WHEN '+' THEN 'upstream' ELSE 'downstream' END AS side, lo - 60 AS s, lo AS e FROM b UNION ALL SELECT gene, CASE strand WHEN '+' THEN 'downstream' ELSE 'upstream' END, hi, hi + 60 FROM b)
    SELECT DISTINCT f.gene, side FROM f JOIN x ON x.gene <> f.gene AND x.s < f.e AND x.e > f.s""")
def flank_mask(spark, sf_dir):
    return genes.masked_flanks(models(spark, sf_dir), 60, 200)


@query(f"""WITH {GENES}, j AS (SELECT gene, exons, exons[1].e + 10 >= exons[2].s AS a, exons[2].e + 10 >= exons[3].s AS c FROM g)
    SELECT gene, CASE WHEN a AND c THEN 1 WHEN a OR c THEN 2 ELSE 3 END AS n_exons, CASE WHEN a AND c THEN exons[3].e WHEN a THEN exons[2].e ELSE exons[1].e END AS first_end FROM j""")
def joined_exons(spark, sf_dir):
    d = models(spark, sf_dir).select("gene", genes.joined_exons(F.col("exons")).alias("x"))
    return d.select("gene", F.size("x").alias("n_exons"), F.element_at("x", 1)["e"].alias("first_end"))


@query(f"WITH {GENES} SELECT gene, 1 + CASE WHEN exons[1].e + 20 >= exons[2].s THEN 0 ELSE 1 END + CASE WHEN exons[2].e + 20 >= exons[3].s THEN 0 ELSE 1 END AS n_masks FROM g")
def intron_aware_masks(spark, sf_dir):
    return models(spark, sf_dir).select("gene", F.size(genes.split_at_introns(F.col("exons"), 20)).alias("n_masks"))


@query(f"""WITH {GENES}, w AS (SELECT *, max(hi) OVER (PARTITION BY strand, gene % 3 ORDER BY lo, hi, gene ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe, min(lo) OVER (PARTITION BY strand, gene % 3 ORDER BY lo, hi, gene ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ns FROM b)
    SELECT gene, least(lo, greatest(lo - 60, coalesce(pe + 1, lo - 60))) AS "left", greatest(hi, least(hi + 60, coalesce(ns - 1, hi + 60))) AS "right" FROM w""")
def flanks(spark, sf_dir):
    d = spans(spark, sf_dir).withColumn("chr", F.col("gene") % 3)
    return genes.flanked(d, ["strand", "chr"], 60).select("gene", "left", "right")


@query(f"WITH {GENES} SELECT gene, 999999 - exons[3].e AS first_start, 999999 - exons[1].s AS last_end FROM g")
def inverse_model(spark, sf_dir):
    d = models(spark, sf_dir).select("gene", genes.inverse(F.col("exons"), F.lit(1_000_000)).alias("x"))
    return d.select("gene", F.element_at("x", 1)["s"].alias("first_start"), F.element_at("x", -1)["e"].alias("last_end"))


@query(f"""WITH {GENES}, n AS (SELECT gene, z, strand, exons, CAST(list_sum([x.e - x.s + 1 for x in exons]) AS BIGINT) AS len, exons[1].e - exons[1].s + 1 AS l1, exons[2].e - exons[2].s + 1 AS l2 FROM g),
    a AS (SELECT *, CASE WHEN strand = '+' THEN z ELSE len - 1 - z END AS k FROM n)
    SELECT gene, CASE WHEN k < 0 OR k >= len THEN NULL WHEN k < l1 THEN exons[1].s + k WHEN k < l1 + l2 THEN exons[2].s + k - l1 ELSE exons[3].s + k - l1 - l2 END AS pos FROM a""")
def genome_positions(spark, sf_dir):
    return models(spark, sf_dir).select("gene", genes.genome_position(F.col("exons"), F.col("z"), F.col("strand") == "+").alias("pos"))


HITS = "h AS (SELECT l_partkey AS gene, l_partkey * 40 + l_orderkey % 60 AS pos, CAST(l_quantity AS BIGINT) AS n_mols, l_returnflag = 'R' AS is_unique, l_suppkey FROM lineitem)"


def hits(spark, sf_dir):
    gene = F.col("l_partkey")
    d = table(spark, sf_dir, "lineitem")
    return d.select(gene.alias("gene"), (gene * 40 + F.col("l_orderkey") % 60).alias("pos"), F.col("l_quantity").cast("long").alias("n_mols"), (F.col("l_returnflag") == "R").alias("is_unique"), "l_suppkey", "l_linenumber")


@query(f"""WITH {GENES}, {EACH}, {HITS} SELECT h.gene, CAST(x.exon + 1 AS INTEGER) AS exon, CAST(sum(n_mols) AS BIGINT) AS n_mols,
    CAST(sum(CASE WHEN is_unique AND abs(pos - CASE WHEN x.strand = '+' THEN lo ELSE hi END) < 20 THEN n_mols ELSE 0 END) AS BIGINT) AS n_cap,
    CAST(sum(CASE WHEN len([y for y in b.exons if y.s > x.e AND pos + 24 BETWEEN y.s AND y.e]) > 0 THEN n_mols ELSE 0 END) AS BIGINT) AS n_junction FROM h JOIN x ON h.gene = x.gene AND pos BETWEEN x.s AND x.e JOIN b ON b.gene = h.gene GROUP BY ALL""")
def exon_and_cap_hits(spark, sf_dir):
    return genes.exon_hits(hits(spark, sf_dir).withColumn("last", F.col("pos") + 24), models(spark, sf_dir), 20)


def _junctions(spark, sf_dir):
    d = hits(spark, sf_dir)
    return d.select("gene", "l_suppkey", "n_mols", F.least("l_linenumber", F.lit(2)).alias("from_exon"), (F.least("l_linenumber", F.lit(2)) + F.when(F.col("is_unique"), 1).otherwise(2)).alias("to_exon"))


JUNCTION = "least(l_linenumber, 2) || '-' || (least(l_linenumber, 2) + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 2 END)"


@query(f"SELECT l_partkey AS gene, {JUNCTION} AS junction, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n_mols FROM lineitem GROUP BY ALL")
def splice_counts(spark, sf_dir):
    return genes.splice_counts(_junctions(spark, sf_dir))


@query(f"SELECT l_partkey AS gene, {JUNCTION} AS junction, l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n_mols FROM lineitem GROUP BY ALL")
def splice_counts_by_barcode(spark, sf_dir):
    return genes.splice_counts(_junctions(spark, sf_dir), ["l_suppkey"])


@query(f"WITH {GENES}, {HITS}, a AS (SELECT gene, CASE WHEN strand = '+' THEN pos - (lo - 20) ELSE hi + 20 - pos END AS at FROM h JOIN b USING (gene) WHERE pos BETWEEN lo - 20 AND hi + 20) SELECT gene, CAST(at // 25 AS BIGINT) AS bin, count(*) AS n FROM a GROUP BY ALL".replace(" AS at FROM h", " AS d FROM h").replace("at // 25", "d // 25"))
def locus_histogram(spark, sf_dir):
    return genes.locus_histogram(hits(spark, sf_dir).select("gene", "pos"), models(spark, sf_dir), 25, 20)


@query(f"WITH {GENES}, {HITS}, c AS (SELECT gene, unnest(range(greatest(lo, pos - 12), least(hi, pos + 12) + 1)) AS pos FROM h JOIN b USING (gene) WHERE pos BETWEEN lo AND hi) SELECT gene, pos, count(*) AS depth FROM c GROUP BY ALL")
def painted_genes(spark, sf_dir):
    d = hits(spark, sf_dir).select("gene", F.col("pos").alias("mid"))
    return genes.painted(d, models(spark, sf_dir), 24)


@query(f"WITH {GENES} SELECT gene, unnest(range(0, CAST(list_sum([x.e - x.s + 1 for x in exons]) AS BIGINT), 7)) AS place FROM g")
def transcript_fragments(spark, sf_dir):
    return models(spark, sf_dir).select("gene", F.explode(genes.fragments(F.col("exons"), 7)).alias("place"))


@query(f"""WITH {GENES}, {HITS}, {EACH}, n AS (SELECT gene, CAST(list_sum([x.e - x.s + 1 for x in exons]) AS BIGINT) AS len FROM g), o AS (SELECT gene, exon, s, e, coalesce(sum(e - s + 1) OVER (PARTITION BY gene ORDER BY exon ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, strand FROM x),
    t AS (SELECT h.gene, pos, min(CASE WHEN strand = '+' THEN before + pos - s ELSE len - 1 - (before + pos - s) END) FILTER (true) AS place, any_value(len) AS len, h.k FROM (SELECT *, row_number() OVER () AS k FROM h) h JOIN o ON o.gene = h.gene AND pos BETWEEN s AND e JOIN n ON n.gene = h.gene GROUP BY ALL)
    SELECT CAST(least(floor(place * 10 / len), 9) AS BIGINT) AS section, count(*) AS n FROM t GROUP BY ALL""".replace("FROM h) h JOIN", "FROM h) h JOIN"))
def five_to_three_profile(spark, sf_dir):
    d = hits(spark, sf_dir).join(models(spark, sf_dir), "gene")
    place = profiles.transcript_position(F.col("exons"), F.col("pos"), F.col("strand") == "+")
    return genes.profile_sections(d.select(place.alias("place"), genes.transcript_length(F.col("exons")).alias("length")).filter("place >= 0"), 10)
