"""Further counts: expected distances of codes, depth curves, repeats, seeds of words, resampled pairs, log-odds, local maxima."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countloom.functions.sequence import code_distance

from .storage import small_or_not


def code_distances(counts: DataFrame, keys: list[str], umi: str, length: int) -> DataFrame:
    """distance, n_pairs and expected of the codes of a key: what codes drawn at random, base by base with the bases' shares, would show.

    With q the chance that two bases differ (1 - sum of squared shares), a distance k is binomial in length and q.
    """
    b = counts.select(*keys, F.col(umi).alias("_other"))
    pairs = counts.join(b, keys).filter(F.col(umi) < F.col("_other")).groupBy(code_distance(F.col(umi), F.col("_other")).alias("distance")).agg(F.count("*").alias("n_pairs"))
    bases = counts.select(F.explode(F.array(*[F.shiftright(F.col(umi), 2 * i).bitwiseAND(F.lit(3)) for i in range(length)])).alias("base")).groupBy("base").agg(F.count("*").alias("n"))
    same = F.broadcast(bases.agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("_same")))
    total = F.broadcast(pairs.agg(F.sum("n_pairs").alias("_all")))
    ways = F.expr(f"factorial({length}) / (factorial(distance) * factorial({length} - distance))")
    expected = F.col("_all") * ways * F.pow(1 - F.col("_same"), F.col("distance")) * F.pow(F.col("_same"), length - F.col("distance"))
    return pairs.join(same).join(total).select("distance", "n_pairs", expected.alias("expected"))


def one_and_two_off(length: int) -> tuple[list[int], list[int]]:
    """The masks that change one base of a code of so many bases, and those that change two."""
    one = [[v << 2 * i for v in (1, 2, 3)] for i in range(length)]
    return [m for x in one for m in x], [m | n for i, x in enumerate(one) for y in one[i + 1 :] for m in x for n in y]


#: Codes of a place up to which they are all compared with each other.
PAIRED = 1024


def arrivals(reads: DataFrame, group: str, order: list[str], place: list[str], umi: str, length: int) -> DataFrame:
    """The first read of each code at a place, with _near1 and _near2: whether a code one base off, or up to two bases off, had come to the place before it.

    The codes of a place are compared with each other where they meet, up to ``PAIRED`` of them; at places with more, each arrival asks for the codes off by one or two bases by equality,
    so that work grows with the arrivals, not with their square. Asks are many rows to shuffle, pairs none.
    """
    first = reads.groupBy(group, *place, umi).agg(F.min(F.struct(*order)).alias("_at"))
    spot = [group, *place]
    first = first.withColumn("_n", F.count("*").over(Window.partitionBy(*spot)))
    few = first.filter(F.col("_n") <= PAIRED)
    pairs = few.join(few.select(*spot, F.col(umi).alias("_other"), F.col("_at").alias("_earlier")), spot).filter(F.col("_earlier") < F.col("_at"))
    pairs = pairs.withColumn("_k", code_distance(F.col(umi), F.col("_other"))).filter(F.col("_k").between(1, 2)).select(*spot, umi, "_k")
    one, two = one_and_two_off(length)
    masks = F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).alias("k")) for k, ms in ((1, one), (2, two)) for m in ms))
    many = first.filter(F.col("_n") > PAIRED)
    asks = many.withColumn("_m", F.explode(masks)).select(*spot, F.col(umi).alias("_code"), F.col("_at").alias("_mine"), F.col(umi).cast("long").bitwiseXOR(F.col("_m.mask")).alias("_other"), F.col("_m.k").alias("_k"))
    asked = asks.join(many.select(*spot, F.col(umi).cast("long").alias("_other"), "_at"), [*spot, "_other"]).filter(F.col("_at") < F.col("_mine")).select(*spot, F.col("_code").alias(umi), "_k")
    met = lambda d: d.groupBy(*spot, umi).agg((F.min("_k") == 1).alias("_near1"))
    met = met(pairs).unionByName(met(asked))
    d = first.join(met, [group, *place, umi], "left")
    return d.select(group, *place, umi, "_at.*", F.coalesce("_near1", F.lit(False)).alias("_near1"), F.col("_near1").isNotNull().alias("_near2"))


def depth_curves(reads: DataFrame, group: str, order: list[str], place: list[str], umi: str, every: int, length: int) -> DataFrame:
    """After each so many reads of a group: how many codes, places and codes seen once it has met, and how many codes had no code one base off, or up to two bases off, at their place before them.

    order names a read within its group. The windows hold the reads of a group and of a molecule.
    """
    by = Window.partitionBy(group).orderBy(*order)
    molecule, spot = Window.partitionBy(group, *place, umi).orderBy(*order), Window.partitionBy(group, *place).orderBy(*order)
    k = F.row_number().over(molecule)
    near = arrivals(reads, group, order, place, umi, length).select(group, *order, "_near1", "_near2")
    d = reads.join(near, [group, *order], "left")
    d = d.withColumn("_new", (k == 1).cast("int")).withColumn("_again", (k == 2).cast("int")).withColumn("_place", (F.row_number().over(spot) == 1).cast("int")).withColumn("n_read", F.row_number().over(by))
    run = by.rowsBetween(Window.unboundedPreceding, 0)
    so_far = lambda c: F.sum(c).over(run)
    far = lambda c: F.coalesce((~F.col(c)).cast("int"), F.lit(0))
    d = d.withColumn("n_molecules", so_far("_new")).withColumn("n_places", so_far("_place")).withColumn("n_singletons", F.col("n_molecules") - so_far("_again"))
    d = d.withColumn("n_not_one_off", so_far(far("_near1"))).withColumn("n_not_two_off", so_far(far("_near2")))
    return d.filter(F.col("n_read") % every == 0).select(group, F.col("n_read").cast("long").alias("n_read"), "n_molecules", "n_places", "n_singletons", "n_not_one_off", "n_not_two_off")


def repeat_totals(hits: DataFrame, name: str, value: str, by: list[str] = ()) -> DataFrame:
    return hits.groupBy(name, *by).agg(F.sum(value).alias("total"), F.count("*").alias("n_hits"))


def base_balance(reads: DataFrame, seq: str) -> DataFrame:
    """position (from 1), base and share: the colour balance of each cycle."""
    d = reads.select(F.posexplode(F.split(seq, "")).alias("at", "base")).filter("base != ''")
    n = d.groupBy((F.col("at") + 1).alias("position"), "base").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("position"))).drop("n")


def lengths(reads: DataFrame, seq: str) -> DataFrame:
    return reads.groupBy(F.length(seq).alias("length")).agg(F.count("*").alias("n"))


def resampled_correlation(pairs: DataFrame, keys: list[str], x: str, y: str, times: int, seed: str) -> DataFrame:
    """Mean and variance of Pearson's r over resamples of each group's pairs with replacement: each pair gets a Poisson weight by a hash, so that no resample is made row by row."""
    at = F.explode(F.sequence(F.lit(1), F.lit(times))).alias("_t")
    u = (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), "_t", F.col("_key"))), 1, 8), 16, 10).cast("double") + 0.5) / 2.0**32
    weight = F.lit(0)
    total, term = 0.0, 2.718281828459045**-1
    for k in range(1, 12):  # the inverse of the Poisson distribution of mean 1
        total += term
        weight = weight + F.when(u > total, 1).otherwise(0)
        term /= k
    d = pairs.select("*", at).withColumn("_w", weight)
    s = lambda c: F.sum(F.col("_w") * c)
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    m = d.groupBy(*keys, "_t").agg(F.sum("_w").alias("n"), s(a).alias("sx"), s(b).alias("sy"), s(a * a).alias("sxx"), s(b * b).alias("syy"), s(a * b).alias("sxy"))
    var = (F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) * (F.col("syy") - F.col("sy") * F.col("sy") / F.col("n"))
    r = F.when((F.col("n") > 1) & (var > 1e-12), (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(var)).otherwise(0.0)
    return m.withColumn("r", r).groupBy(*keys).agg(F.avg("r").alias("mean"), F.var_samp("r").alias("variance"))


def log_odds(d: DataFrame, x: str, positive: Column, low: float, high: float, bins: int, floor: float) -> DataFrame:
    """bin and log_odds, log10 of the shares of positive and other values in a bin; values outside the ends go to the outermost bins, and empty shares count as floor."""
    k = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(x) - low) * bins / (high - low))))
    n = d.groupBy(k.cast("long").alias("bin")).agg(F.count_if(positive).alias("_p"), F.count_if(~positive).alias("_q"))
    all_of = F.broadcast(d.agg(F.count_if(positive).alias("_all_p"), F.count_if(~positive).alias("_all_q")))
    share = lambda c, a: F.greatest(F.col(c) / F.greatest(F.col(a), F.lit(1)), F.lit(floor))
    return n.join(all_of).select("bin", F.log10(share("_p", "_all_p") / share("_q", "_all_q")).alias("log_odds"))


def local_maxima(grid: DataFrame, x: str, y: str, value: str, reach: int) -> DataFrame:
    """Places of a grid above all others in the neighbourhood from -reach up to, but without, reach. Each place gives its value to the neighbourhoods that hold it, so the join is a grouping."""
    step = F.sequence(F.lit(-(reach - 1)), F.lit(reach))
    near = grid.select(F.col(x).alias("_x"), F.col(y).alias("_y"), F.col(value).alias("_v")).withColumn("_dx", F.explode(step)).withColumn("_dy", F.explode(step)).filter("_dx != 0 or _dy != 0")
    top = near.groupBy((F.col("_x") + F.col("_dx")).alias(x), (F.col("_y") + F.col("_dy")).alias(y)).agg(F.max("_v").alias("_top"))
    return grid.join(top, [x, y], "left").filter(F.col("_top").isNull() | (F.col(value) > F.col("_top"))).drop("_top")


def over_occupied_codes(counts: DataFrame, keys: list[str], umi: str, codes: int, share: float) -> DataFrame:
    """Groups that use more than a share of all codes, with the sorted codes; a group's list has at most codes entries."""
    g = counts.groupBy(*keys).agg(F.count("*").alias("n_codes"), F.array_sort(F.collect_set(umi)).alias("codes"))
    return g.filter(F.col("n_codes") > int(share * codes)).withColumn("codes", F.array_join("codes", ","))


def upstream_matches(hits: DataFrame, genome: DataFrame, table: DataFrame, length: int) -> DataFrame:
    """barcode, matched and n: how often the bases just before a unique hit (contig, pos, barcode) are themselves a barcode (table: match, index), and n_tests of each barcode."""
    d = hits.join(genome, "contig").filter(F.col("pos") >= length).select("barcode", F.substring("text", F.col("pos") - length + 1, F.lit(length)).alias("_word"))
    tests = d.groupBy("barcode").agg(F.count("*").alias("n_tests"))
    found = d.join(small_or_not(table.select(F.col("match").alias("_word"), F.col("index").alias("matched"))), "_word").groupBy("barcode", "matched").agg(F.count("*").alias("n"))
    return found.join(tests, "barcode")
