"""Smaller operators of reports and bookkeeping: binned profiles, upserts and claims, blobs, shuffles, merged tables, exon choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import running_totals


def effect_filter(d: DataFrame, effects: str, listed: list[str]) -> DataFrame:
    """Rows of which any effect (an array) is listed."""
    return d.filter(F.exists(effects, lambda x: x.isin(listed)))


def is_pseudogene(name: Column) -> Column:
    """Names that end in -ps and a number, or in p and a number."""
    return name.rlike("(?i)(-ps[0-9]*|[a-z0-9]+p[0-9]+)$")


def chains(d: DataFrame, target: str, score: str, order: str) -> DataFrame:
    """The chains of one target in order, and numbered in it. The window holds one target's chains."""
    return d.filter(F.col("target") == target).withColumn("place", F.row_number().over(Window.partitionBy("target").orderBy(order, F.desc(score), "id")))


def length_sections(hits: DataFrame, edges: list[int], sections: int) -> DataFrame:
    """bin (by the transcript's length, between edges), section (from 0, 5' first) and the mean share of a transcript's hits in it. hits: transcript, place, length.

    Shares are of the transcript's own hits; transcripts without hits in a section count as 0 there.
    """
    level = F.lit(0)
    for e in edges:
        level = level + F.when(F.col("length") >= e, 1).otherwise(0)
    n = hits.groupBy("transcript", level.alias("bin"), F.least(F.floor(F.col("place") * sections / F.col("length")), F.lit(sections - 1)).alias("section")).agg(F.count("*").alias("n"))
    total = n.groupBy("transcript", "bin").agg(F.sum("n").alias("_all"))
    size = F.broadcast(total.groupBy("bin").agg(F.count("*").alias("_size")))
    shares = n.join(total, ["transcript", "bin"]).groupBy("bin", "section").agg(F.sum(F.col("n") / F.col("_all")).alias("_sum"))
    return shares.join(size, "bin").select("bin", "section", (F.col("_sum") / F.col("_size")).alias("share"))


def density_by_level(genes: DataFrame, gene: str, level: str, density: str, per_bin: int) -> DataFrame:
    """bin, n and the median density: genes in order of their level, about so many in each bin. Places in the order are counted over ranges of it."""
    d = running_totals(genes.select(gene, level, density, F.lit(1).cast("long").alias("_one")), [level, gene], "_one", "_k")
    d = d.withColumn("bin", F.floor(F.col("_k") / per_bin)).groupBy("bin", density).agg(F.count("*").alias("_n"))
    v = Window.partitionBy("bin")
    d = d.withColumn("_upto", F.sum("_n").over(v.orderBy(density))).withColumn("_all", F.sum("_n").over(v))
    holds = lambda k: (F.col("_upto") >= k) & (F.col("_upto") - F.col("_n") < k)
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    return d.groupBy("bin").agg(F.max("_all").alias("n"), ((F.max(F.when(holds(low), F.col(density))) + F.max(F.when(holds(high), F.col(density)))) / 2).alias("median"))


def upserted(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """old with the rows of new: equal keys take the new values that are not null, other keys are added."""
    n = new.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return old.join(n, key, "full").select(key, *[F.coalesce(f"_{c}", c).alias(c) for c in columns])


def claimed(queue: DataFrame, claims: DataFrame, key: str, status: str, expected: str) -> DataFrame:
    """queue after compare-and-set claims (key, claimant): a row takes the first claimant if its status is the expected one, and the others fail."""
    first = claims.groupBy(key).agg(F.min("claimant").alias("_first"))
    d = queue.join(first, key, "left")
    won = (F.col(status) == expected) & F.col("_first").isNotNull()
    return d.withColumn("owner", F.when(won, F.col("_first"))).withColumn(status, F.when(won, "claimed").otherwise(F.col(status))).drop("_first")


def blobs(cells: DataFrame, cell: str, place: str, value: str) -> DataFrame:
    """cell and blob: its values in order of their place, as big-endian 32-bit numbers in hexadecimal. A cell's vector is as long as there are features."""
    items = F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), F.lpad(F.hex(F.col(value).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0").alias("h"))))
    return cells.groupBy(cell).agg(F.array_join(F.transform(items, lambda x: x["h"]), "").alias("blob"))


def unblobbed(d: DataFrame, cell: str, blob: str) -> DataFrame:
    """cell, place (from 0) and value of blobs()."""
    words = F.regexp_extract_all(blob, F.lit("[0-9A-F]{8}"), F.lit(0))
    return d.select(cell, F.posexplode(words).alias("place", "_h")).select(cell, "place", F.conv("_h", 16, 10).cast("long").cast("int").alias("value"))


def permuted(d: DataFrame, keys: list[str], order: DataFrame, place: str) -> DataFrame:
    """d with the place that order (keys, place) gives each row."""
    return d.join(order.select(*keys, place), keys)


def hash_shuffled(d: DataFrame, keys: list[str], seed: str) -> DataFrame:
    """d with a random place that reruns agree on: rows are sorted by a hash over the cluster, without a window."""
    return d.withColumn("place", F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys]))).orderBy("place")


def extremes(d: DataFrame, keys: list[str], value: str, item: str) -> DataFrame:
    """The least and greatest value of each group with their items; of equal values the least item."""
    low, high = F.min(F.struct(value, item)), F.min(F.struct((-F.col(value)).alias("v"), item))
    return d.groupBy(*keys).agg(low.alias("_l"), high.alias("_h")).select(*keys, F.col(f"_l.{value}").alias("low"), F.col(f"_l.{item}").alias("low_item"), (-F.col("_h.v")).alias("high"), F.col(f"_h.{item}").alias("high_item"))


def without_rows(moments: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Moments (n, s, q: count, sum, sum of squares) with those of removed rows taken away, and the mean and variance that are left."""
    g = gone.select(*keys, *[F.col(c).alias(f"_{c}") for c in ("n", "s", "q")])
    left = lambda c: F.col(c) - F.coalesce(f"_{c}", F.lit(0))
    d = moments.join(g, keys, "left").select(*keys, *[left(c).alias(c) for c in ("n", "s", "q")]).filter("n > 1")
    return d.select(*keys, "n", (F.col("s") / F.col("n")).alias("mean"), ((F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)).alias("variance"))


def drawn_from_bins(d: DataFrame, bins: DataFrame, value: str, key: str, seed: str) -> DataFrame:
    """d (key, value) with drawn: an item of the bin its value falls into (bins: low, items, an array), chosen by a hash. The bins are a small table, in order of low."""
    all_of = F.broadcast(bins.agg(F.array_sort(F.collect_list(F.struct("low", "items"))).alias("_bins")))
    e = d.join(all_of).withColumn("_fit", F.filter("_bins", lambda b: b["low"] <= F.col(value)))
    items = F.element_at("_fit", -1)["items"]
    pick = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return e.withColumn("drawn", F.when(F.size("_fit") > 0, F.get(items, (pick % F.size(items)).cast("int")))).drop("_bins", "_fit")


def exon_choices(genes: DataFrame, gene: str, exons: str, skip: int, longest: int, least: int = 0, most: int | None = None) -> DataFrame:
    """gene, chosen and length: the runs of exon numbers (from 1) that go upwards, leave out at most skip exons between neighbours, have at most longest exons, and together from least to most bases.

    Each pass adds one exon to all choices that aren't too long already.
    """
    size = lambda i: F.element_at(F.col(exons), i)["e"] - F.element_at(F.col(exons), i)["s"] + 1
    within = lambda d: d if most is None else d.filter(F.col("length") <= most)
    n = genes.select(gene, exons, F.size(exons).alias("_n")).withColumn("_last", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    found = out = within(n.withColumn("chosen", F.array("_last")).withColumn("length", size(F.col("_last"))))
    for _ in range(longest - 1):
        step = F.explode(F.sequence(F.col("_last") + 1, F.least(F.col("_n"), F.col("_last") + 1 + skip)))
        found = found.filter("_last < _n").withColumn("_last", step).withColumn("chosen", F.concat("chosen", F.array("_last"))).withColumn("length", F.col("length") + size(F.col("_last")))
        found = within(found)
        out = out.unionByName(found)
    return out.filter(F.col("length") >= least).select(gene, F.array_join("chosen", "-").alias("chosen"), "length")


def merged_rpm(tables: dict[str, DataFrame], key: str, value: str, least: int) -> DataFrame:
    """The union of tables (key, value) with whole reads per million in a column for each, without the tables whose total is below least."""
    long = None
    for name, t in tables.items():
        x = t.groupBy(key).agg(F.min(value).alias("_v")).withColumn("_table", F.lit(name))
        long = x if long is None else long.unionByName(x)
    totals = F.broadcast(long.groupBy("_table").agg(F.sum("_v").alias("_all")).filter(F.col("_all") >= least))
    d = long.join(totals, "_table").withColumn("_rpm", F.expr("_v * 1000000 div _all"))
    return d.groupBy(key).pivot("_table", list(tables)).agg(F.first("_rpm")).fillna(0, list(tables))


def bad_barcodes(codes: DataFrame, code: str) -> DataFrame:
    """code and problem of barcodes that occur more than once or differ in length from most (the shortest of equally common lengths)."""
    n = codes.groupBy(code).agg(F.count("*").alias("_n")).withColumn("_length", F.length(code))
    usual = F.broadcast(n.groupBy("_length").agg(F.sum("_n").alias("_m")).agg(F.min(F.struct((-F.col("_m")).alias("m"), "_length")).alias("_x")).select(F.col("_x._length").alias("_usual")))
    return n.join(usual).select(code, F.when(F.col("_n") > 1, "duplicate").when(F.col("_length") != F.col("_usual"), "length").alias("problem")).filter("problem is not null")


def variant_profiles(counts: DataFrame, keys: list[str], umi: str, length: int, distance: int) -> DataFrame:
    """Codes of a key without those that lie nearer than a distance to a code with more reads, or with as many and a lower number. Codes of a key are at most the code space."""
    from countloom.functions.sequence import code_distance

    o = counts.select(*keys, F.col(umi).alias("_o"), F.col("n_reads").alias("_n"))
    near = counts.join(o, keys).filter((F.col(umi) != F.col("_o")) & (code_distance(F.col(umi), F.col("_o")) < distance))
    bad = near.filter((F.col("_n") > F.col("n_reads")) | ((F.col("_n") == F.col("n_reads")) & (F.col("_o") < F.col(umi)))).select(*keys, umi).distinct()
    return counts.join(bad, [*keys, umi], "left_anti")


def pivoted(d: DataFrame, key: str, attribute: str, value: str, names: dict[str, str]) -> DataFrame:
    """One column for each named attribute with its greatest value of a key, null where it has none."""
    return d.groupBy(key).agg(*[F.max(F.when(F.col(attribute) == a, F.col(value))).alias(c) for a, c in names.items()])


def set_members(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The union of two sets of keys, with where each key is found: both, first or second."""
    x = a.select(key).withColumn("_side", F.lit(1)).unionByName(b.select(key).withColumn("_side", F.lit(2))).groupBy(key).agg(F.sum(F.col("_side")).alias("_n"), F.max("_side").alias("_m"), F.min("_side").alias("_l"))
    return x.select(key, F.when(F.col("_m") != F.col("_l"), "both").when(F.col("_m") == 1, "first").otherwise("second").alias("found"))


def limited(reads: DataFrame, order: list[str], most: int, valid: Column | None = None) -> DataFrame:
    """The first reads up to ``most``, of all, or until so many valid ones are found; the order is total."""
    if valid is None:
        return reads.orderBy(*order).limit(most)
    last = reads.filter(valid).orderBy(*order).limit(most).agg(F.max(F.struct(*order)).alias("_last"), F.count("*").alias("_n"))
    return reads.join(F.broadcast(last)).filter((F.col("_n") < most) | (F.struct(*order) <= F.col("_last"))).drop("_last", "_n")


def block_index(mappings: DataFrame, chromosome: str) -> DataFrame:
    """Where each chromosome's mappings begin in the file sorted by chromosome and position. The window runs over one row a chromosome."""
    n = mappings.groupBy(chromosome).agg(F.count("*").alias("n"))
    return n.withColumn("first", F.coalesce(F.sum("n").over(Window.orderBy(chromosome).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
