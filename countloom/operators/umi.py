"""Molecule counting: reads per barcode and position, thresholds, near-code filter, collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countloom.functions.sequence import code_distance


def read_counts(reads: DataFrame, keys: list[str], umi: str) -> DataFrame:
    return reads.groupBy(*keys, umi).agg(F.count("*").alias("n_reads"))


#: Thresholds by name: aggregates over a key's n_reads; a molecule counts if n_reads is above.
THRESHOLDS = {
    "none": lambda p: F.lit(0),
    "lowpass": lambda p: F.lit(p),
    "singleton": lambda p: F.when(F.max("n_reads") > p, 1).otherwise(0),
    "fraction_of_max": lambda p: F.floor(F.max("n_reads") / p),
    "fraction_of_mean": lambda p: F.bround(F.avg("n_reads") / p),
}


def molecule_counts(counts: DataFrame, keys: list[str], rule: str = "none", param: int = 1) -> DataFrame:
    """Reads and molecules of each key, counting codes with more reads than the rule's threshold. Three rules aggregate the threshold first and join it back by key."""
    limits = counts.groupBy(*keys).agg(THRESHOLDS[rule](param).cast("long").alias("limit"))
    d = counts.join(limits, keys) if rule not in ("none", "lowpass") else counts.withColumn("limit", F.lit(0 if rule == "none" else param).cast("long"))
    return d.groupBy(*keys).agg(F.sum("n_reads").alias("n_reads"), F.count("*").alias("n_umis"), F.count_if(F.col("n_reads") > F.col("limit")).alias("n_molecules"))


def dense_rule(rule: str, param: int) -> tuple[str, int]:
    """The rule that a dense counter applies, which only tells none, one and more reads of a code: a low pass at 1 is the singleton rule at 0, and rules that need counts raise an error."""
    if (rule, param) == ("lowpass", 1):
        rule, param = "singleton", 0
    if rule != "none" and (rule, param) not in (("lowpass", 0), ("singleton", 0)):
        raise ValueError(f"{rule} at {param} needs read counts")
    return rule, param


def dense_molecule_counts(reads: DataFrame, keys: list[str], umi: str, rule: str = "none", param: int = 1) -> DataFrame:
    """As molecule_counts, from counters that stop at two reads of a code; n_reads counts all reads of a key."""
    rule, param = dense_rule(rule, param)
    counts = read_counts(reads, keys, umi).withColumn("_all", F.col("n_reads")).withColumn("n_reads", F.least("n_reads", F.lit(2)).cast("long"))
    limit = 1 if rule == "singleton" else 0
    return counts.groupBy(*keys).agg(F.sum("_all").alias("n_reads"), F.count("*").alias("n_umis"), F.count_if(F.col("n_reads") > limit).alias("n_molecules"))


def drop_near_singletons(counts: DataFrame, keys: list[str], umi: str, length: int) -> DataFrame:
    """Leaves out codes of one read that lie one substitution from a code with more reads, or from a lower code.

    Each code makes its 3 * length neighbours, so the join is by equality.
    """
    base = lambda i: F.shiftright(F.col(umi), 2 * i).bitwiseAND(F.lit(3))
    near = [F.col(umi) + ((base(i) + k) % 4 - base(i)) * (4**i) for i in range(length) for k in (1, 2, 3)]
    single = counts.filter("n_reads = 1").select(*keys, umi, F.explode(F.array(*near)).alias("near"))
    others = counts.select(*keys, F.col(umi).alias("near"), F.col("n_reads").alias("n_near"))
    bad = single.join(others, [*keys, "near"]).filter((F.col("n_near") > 1) | (F.col("near") < F.col(umi))).select(*keys, umi).distinct()
    return counts.join(bad, [*keys, umi], "left_anti")


def compensated(molecules: Column, n_codes: int) -> Column:
    """Molecules corrected for codes that met twice; when every code is used, as if one were free."""
    m = F.least(molecules, F.lit(n_codes - 1))
    return F.bround(F.log(1 - m / n_codes) / F.log(F.lit(1 - 1 / n_codes))).cast("long")


def code_pairs(counts: DataFrame, keys: list[str], umi: str) -> DataFrame:
    """Number of code pairs of a key by distance; codes of a key are at most the code space."""
    b = counts.select(*keys, F.col(umi).alias("other"))
    pairs = counts.join(b, keys).filter(F.col(umi) < F.col("other"))
    return pairs.groupBy(code_distance(F.col(umi), F.col("other")).alias("distance")).agg(F.count("*").alias("n_pairs"))


def cross_barcode_filter(counts: DataFrame, place: list[str], ratio: float) -> DataFrame:
    """Rows whose count is at least ratio times the largest of the same place over all barcodes."""
    return counts.withColumn("largest", F.max("n_reads").over(Window.partitionBy(*place))).filter(F.col("n_reads") >= ratio * F.col("largest")).drop("largest")


def leakage(counts: DataFrame, place: list[str], barcode: str, ratio: float) -> DataFrame:
    """Places where the top barcode has more than ratio times the reads of the second, with the reads per molecule of both. counts: place, barcode, n_reads, n_mols."""
    order = Window.partitionBy(*place).orderBy(F.desc("n_reads"), barcode)
    ranked = counts.withColumn("k", F.row_number().over(order)).filter("k <= 2")
    of = lambda k, c: F.max(F.when(F.col("k") == k, c))
    each = F.col("n_reads") / F.col("n_mols")
    two = ranked.groupBy(*place).agg(of(1, F.col(barcode)).alias("top"), of(1, F.col("n_reads")).alias("n_top"), of(2, F.col("n_reads")).alias("n_second"), of(1, each).alias("per_molecule_top"), of(2, each).alias("per_molecule_second"))
    return two.filter(F.col("n_top") > ratio * F.col("n_second"))
