"""Variants: mismatches of reads, coverage, verification by molecular barcodes, and reports over samples and projects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import stab_join


def mismatch_sites(reads: DataFrame, margin: int, least: int) -> DataFrame:
    """chr, pos, n_snps and the counts of A, C, G and T at places where enough single-mapping reads have a mismatch.

    reads: read_id, chr, start, length, n_mappings, mismatches (array of (rel, ref, alt), rel from the read's first base on the chromosome). Mismatches
    within margin bases of a read's ends are left out.
    """
    one = reads.filter("n_mappings = 1").select("chr", "start", "length", F.explode("mismatches").alias("m"))
    inner = one.filter((F.col("m.rel") >= margin) & (F.col("m.rel") < F.col("length") - margin)).select("chr", (F.col("start") + F.col("m.rel")).alias("pos"), F.col("m.alt").alias("alt"))
    counts = [F.count_if(F.col("alt") == b).alias(f"n_{b.lower()}") for b in "ACGT"]
    return inner.groupBy("chr", "pos").agg(F.count("*").alias("n_snps"), *counts).filter(F.col("n_snps") >= least)


def site_coverage(sites: DataFrame, starts: DataFrame, length: int, margin: int, bins: int) -> DataFrame:
    """sites (chr, pos) with n_total: the reads that begin in pos - length + 1 + margin to pos - margin. starts: chr, start.

    Starts are counted by place first, and each count meets only the sites of its bin.
    """
    n = starts.groupBy("chr", "start").agg(F.count("*").alias("_n")).withColumn("_chr", F.col("chr")).drop("chr")
    windows = sites.select("chr", "pos", (F.col("pos") - length + 1 + margin).alias("_from"), (F.col("pos") - margin).alias("_to"))
    hits = stab_join(n, windows, "start", "_from", "_to", bin_width=bins).filter(F.col("chr") == F.col("_chr"))
    total = hits.groupBy("chr", "pos").agg(F.sum("_n").alias("n_total"))
    return sites.join(total, ["chr", "pos"], "left").withColumn("n_total", F.coalesce("n_total", F.lit(0)))


def valid_bases(reads: DataFrame, site: list[str], cell: str, umi: str, base: str, factor: float, least: int) -> DataFrame:
    """For each site and cell the bases that molecules vouch for, in order, and whether there are several (heterozygous).

    A molecule vouches for its commonest base if that has at least so many reads and more than factor times those of the next. Windows run over a molecule's counted bases.
    """
    n = reads.groupBy(*site, cell, umi, base).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*site, cell, umi).orderBy(F.desc("_n"), base)
    top = n.withColumn("_k", F.row_number().over(w)).withColumn("_next", F.coalesce(F.lead("_n").over(w), F.lit(0)))
    good = top.filter((F.col("_k") == 1) & (F.col("_n") >= least) & (F.col("_n") > F.col("_next") * factor))
    out = good.groupBy(*site, cell).agg(F.array_join(F.array_sort(F.collect_set(base)), "").alias("bases"), F.count("*").alias("n_umis"))
    return out.withColumn("heterozygous", F.length("bases") > 1)


def collapsed(d: DataFrame, place: str, row: str, symbol: str) -> DataFrame:
    """One row for each place: its rows joined with +, in order, and their distinct symbols."""
    return d.groupBy(place).agg(F.array_join(F.array_sort(F.collect_list(row)), "+").alias("rows"), F.array_join(F.array_sort(F.collect_set(symbol)), ",").alias("symbols"))


def region_tags(d: DataFrame, regions: DataFrame, pos: str, key: str, default: str, bins: int) -> DataFrame:
    """d with region: the name of the last region (by order) that holds its position, else a default. regions: start, end, name, order."""
    r = regions.select(F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("name").alias("_name"), F.col("order").alias("_order"))
    last = stab_join(d.select(key, pos), r, pos, "_s", "_e", bin_width=bins).groupBy(key).agg(F.max_by("_name", "_order").alias("region"))
    return d.join(last, key, "left").withColumn("region", F.coalesce("region", F.lit(default)))


def covered(d: DataFrame, site: list[str], sample: str, coverage: str, least: int, last: int) -> DataFrame:
    """Sites at which all samples but the last reach a coverage."""
    ok = F.bool_and((F.col(coverage) >= least) | (F.col(sample) == last))
    return d.groupBy(*site).agg(ok.alias("_ok"), F.count("*").alias("n_samples")).filter("_ok").drop("_ok")


def presence(d: DataFrame, site: list[str], project: str) -> DataFrame:
    """How many sites are found in exactly so many projects."""
    n = d.groupBy(*site).agg(F.countDistinct(project).alias("n_projects"))
    return n.groupBy("n_projects").agg(F.count("*").alias("n_sites"))


def site_table(d: DataFrame, site: list[str], project: str, projects: int, call: str, heterozygous: Column, known: DataFrame) -> DataFrame:
    """A row for each site of any project: its call in each, in how many it is, whether one is heterozygous, and whether it is known (site columns)."""
    calls = [F.max(F.when(F.col(project) == p, F.col(call))).alias(f"p{p}") for p in range(projects)]
    t = d.groupBy(*site).agg(*calls, F.countDistinct(project).alias("n_projects"), F.bool_or(heterozygous).alias("any_het"))
    k = known.select(*site).distinct().withColumn("_known", F.lit(True))
    return t.join(k, site, "left").withColumn("is_known", F.coalesce("_known", F.lit(False))).drop("_known")


def quality_bands(d: DataFrame, site: str, project: str, call: str, score: str, bands: list[tuple[str, float, float]], projects: int) -> DataFrame:
    """band, project and n: the score of a project over that of project 0, 0 for another call, at sites in all projects that are homozygous in project 0 (call of two equal letters)."""
    everywhere = d.groupBy(site).agg(F.countDistinct(project).alias("_n")).filter(F.col("_n") == projects).select(site)
    first = d.filter(F.col(project) == 0).filter(F.substring(call, 1, 1) == F.substring(call, 2, 1)).select(site, F.col(call).alias("_call"), F.col(score).alias("_score"))
    e = d.filter(F.col(project) > 0).join(everywhere, site, "left_semi").join(first, site)
    ratio = F.when(F.col(call) == F.col("_call"), F.col(score) / F.col("_score")).otherwise(0.0)
    band = F.when(F.lit(False), "")
    for name, low, high in bands:
        band = band.when((ratio > low) & (ratio <= high), name)
    return e.groupBy(band.alias("band"), project).agg(F.count("*").alias("n"))


def filtered_variants(d: DataFrame, site: list[str], cov: str, ref: str, total_least: int, missing: int, low: int, deep: int, known: DataFrame) -> DataFrame:
    """Sites with enough reads in all, whose samples without coverage are fewer than missing and those below deep reads fewer than low, with the name of known ones."""
    n = d.groupBy(*site).agg(F.sum(cov).alias("total"), F.count_if(F.col(cov) == 0).alias("n_missing"), F.count_if(F.col(cov) < deep).alias("n_low"), F.min(ref).alias(ref))
    n = n.filter((F.col("total") >= total_least - 1) & (F.col("n_missing") < missing) & (F.col("n_low") < low))
    return n.join(known, site, "left")


def consequences(variants: DataFrame, notes: DataFrame, key: str, columns: list[str], extra: str, field: str) -> DataFrame:
    """variants with n_notes, the notes' columns joined by ":" in order, and a field of extra ("k=v;k=v"), "no gene" where none has it."""
    n = notes.withColumn("_field", F.expr(f"str_to_map({extra}, ';', '=')")[field])
    joined = [F.array_join(F.array_sort(F.collect_list(c)), ":").alias(c) for c in columns]
    g = n.groupBy(key).agg(F.count("*").alias("n_notes"), *joined, F.array_join(F.array_sort(F.collect_set("_field")), ":").alias(field))
    out = variants.join(g, key, "left").withColumn("n_notes", F.coalesce("n_notes", F.lit(0)))
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in columns}).withColumn(field, F.when(F.coalesce(F.length(field), F.lit(0)) > 0, F.col(field)).otherwise("no gene"))


def call_distances(d: DataFrame, target: str, cell: str, call: str) -> DataFrame:
    """first < second, and 10 times the share of differing calls over the targets that both cells have called. Cells meet by target."""
    a = d.select(target, F.col(cell).alias("first"), F.col(call).alias("_a"))
    b = d.select(target, F.col(cell).alias("second"), F.col(call).alias("_b"))
    both = a.join(b, target).filter("first < second")
    return both.groupBy("first", "second").agg((10 * F.avg((F.col("_a") != F.col("_b")).cast("int"))).alias("distance"), F.count("*").alias("n_targets"))


def block_consensus(d: DataFrame, block: str, text: str, length: int) -> DataFrame:
    """For each block its commonest word of so many letters (the least of equally common ones), its count, and the block's reads."""
    n = d.groupBy(block, F.substring(text, 1, length).alias("word")).agg(F.count("*").alias("_n"))
    best = n.groupBy(block).agg(F.min(F.struct((-F.col("_n")).alias("less"), "word")).alias("x"), F.sum("_n").alias("n_reads"))
    return best.select(block, "x.word", (-F.col("x.less")).alias("n_word"), "n_reads")


def block_corrected(d: DataFrame, block: str, text: str, length: int, most: int) -> DataFrame:
    """d with word and n_changed: a read's first letters, replaced by its block's commonest letter at each place (the least of equally common ones) if that changes no more than ``most`` of them.

    Letters are counted by block and place before they meet, so a block of very many reads is ``length`` times its letters; shorter reads stay as they are.
    """
    place = F.explode(F.sequence(F.lit(1), F.lit(length)))
    long = F.length(text) >= length
    n = d.filter(long).select(block, F.col(text).alias("_t"), place.alias("_i")).groupBy(block, "_i", F.expr("substr(_t, _i, 1)").alias("_c")).agg(F.count("*").alias("_n"))
    letters = n.groupBy(block, "_i").agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_c").alias("c"))).alias("_x"))
    words = letters.groupBy(block).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x.c"))), lambda x: x["c"]), "").alias("_common"))
    d = d.withColumn("word", F.substring(text, 1, length)).join(words, block, "left")
    differ = F.aggregate(F.sequence(F.lit(1), F.lit(length)), F.lit(0), lambda s, i: s + F.when(F.substring(F.col("word"), i, F.lit(1)) != F.substring(F.col("_common"), i, F.lit(1)), 1).otherwise(0))
    d = d.withColumn("_d", F.when(long, differ))
    near = F.coalesce(F.col("_d") <= most, F.lit(False))
    return d.withColumn("word", F.when(near, F.col("_common")).otherwise(F.col("word"))).withColumn("n_changed", F.when(near, F.col("_d")).otherwise(0)).drop("_common", "_d")
