"""Counts by position, calls by majority and share, contingency tables, tests of groups and fitted lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def letter_profile(d: DataFrame, text: str) -> DataFrame:
    """position (from 1), letter, n, share and the position's conservation, 2 + sum of p log2 p.

    The windows run over the counted letters of a position, so their size is that of the alphabet.
    """
    letters = d.select(F.posexplode(F.split(text, "")).alias("at", "letter")).filter("letter != ''")
    n = letters.groupBy((F.col("at") + 1).alias("position"), "letter").agg(F.count("*").alias("n"))
    w = Window.partitionBy("position")
    n = n.withColumn("share", F.col("n") / F.sum("n").over(w))
    return n.withColumn("conservation", 2 + F.sum(F.col("share") * F.log2("share")).over(w))


def code_profile(d: DataFrame, text: str, base: int = 0) -> DataFrame:
    """position (from 1), n and mean character code less base: quality by cycle."""
    codes = d.select(F.posexplode(F.split(text, "")).alias("at", "letter")).filter("letter != ''")
    return codes.groupBy((F.col("at") + 1).alias("position")).agg(F.count("*").alias("n"), F.avg(F.ascii("letter") - base).alias("mean_code"))


def majority(d: DataFrame, keys: list[str], item: str) -> DataFrame:
    """The commonest item of each group and its count; of equally common ones the least."""
    n = d.groupBy(*keys, item).agg(F.count("*").alias("n"))
    best = n.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("less"), item)).alias("x"))
    return best.select(*keys, F.col(f"x.{item}").alias(item), (-F.col("x.less")).alias("n"))


def genotypes(d: DataFrame, keys: list[str], is_alt: Column, total: int = 10, share: float = 0.04, least: int = 2) -> DataFrame:
    """Groups with enough reads and variant reads, called ALT above 0.75 of variant reads, HET above 0.25, else REF."""
    n = d.groupBy(*keys).agg(F.count("*").alias("n_reads"), F.count_if(is_alt).alias("n_alt"))
    part = F.col("n_alt") / F.col("n_reads")
    call = F.when(part > 0.75, "ALT").when(part > 0.25, "HET").otherwise("REF")
    return n.filter((F.col("n_reads") >= total) & (part >= share) & (F.col("n_alt") >= least)).withColumn("genotype", call)


def marginals(d: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by all keys and all their marginals; a null stands for all values of its key."""
    return d.cube(*keys).agg(F.count("*").alias("n_reads"))


def unique_reads(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Of the read counts of molecules: reads, first reads and repeated reads."""
    return counts.groupBy(*keys).agg(F.sum("n_reads").alias("n_reads"), F.count("*").alias("n_unique"), (F.sum("n_reads") - F.count("*")).alias("n_duplicate"))


def reads_per_molecule(counts: DataFrame, most: int = 5000) -> DataFrame:
    """How many molecules have each number of reads; numbers above most count as most."""
    return counts.groupBy(F.least("n_reads", F.lit(most)).alias("n_reads")).agg(F.count("*").alias("n_molecules"))


def over_occupied(counts: DataFrame, keys: list[str], codes: int, share: float = 0.8) -> DataFrame:
    """Groups in which more than floor(share * codes) codes are in use."""
    return counts.groupBy(*keys).agg(F.count("*").alias("n_codes")).filter(F.col("n_codes") > int(share * codes))


def joined_names(d: DataFrame, keys: list[str], name: str, sep: str = "#") -> DataFrame:
    """The sorted distinct names of each group in one string; its length is that of the set of names."""
    names = d.select(*keys, name).distinct().groupBy(*keys)
    return names.agg(F.array_join(F.array_sort(F.collect_list(name)), sep).alias("names"))


def chi_square_cells(d: DataFrame, row: str, column: str) -> DataFrame:
    """n, expected count and (n - expected)^2 / expected of each cell of a contingency table."""
    n = d.groupBy(row, column).agg(F.count("*").alias("n"))
    rows, columns = n.groupBy(row).agg(F.sum("n").alias("of_row")), n.groupBy(column).agg(F.sum("n").alias("of_column"))
    cells = n.join(rows, row).join(columns, column)
    cells = cells.withColumn("expected", F.col("of_row") * F.col("of_column") / n.agg(F.sum("n")).scalar())
    return cells.select(row, column, "n", "expected", (F.pow(F.col("n") - F.col("expected"), 2) / F.col("expected")).alias("chi_square"))


def welch(d: DataFrame, keys: list[str], x: str, first: Column, second: Column) -> DataFrame:
    """Welch's t and its degrees of freedom between the rows of first and those of second, by group."""
    a, b = F.when(first, F.col(x)), F.when(second, F.col(x))
    m = d.groupBy(*keys).agg(F.avg(a).alias("ma"), F.avg(b).alias("mb"), F.var_samp(a).alias("va"), F.var_samp(b).alias("vb"), F.count(a).alias("na"), F.count(b).alias("nb"))
    p, q = F.col("va") / F.col("na"), F.col("vb") / F.col("nb")
    df = F.pow(p + q, 2) / (F.pow(p, 2) / (F.col("na") - 1) + F.pow(q, 2) / (F.col("nb") - 1))
    return m.select(*keys, ((F.col("ma") - F.col("mb")) / F.sqrt(p + q)).alias("t"), df.alias("df"))


def one_sample(d: DataFrame, keys: list[str], x: str, reference: float) -> DataFrame:
    """t and degrees of freedom of each group's mean against a reference."""
    m = d.groupBy(*keys).agg(((F.avg(x) - reference) / (F.stddev_samp(x) / F.sqrt(F.count(x)))).alias("t"), (F.count(x) - 1).alias("df"))
    return m.select(*keys, "t", "df")


def fitted_line(d: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Least squares through the mean y of each distinct x."""
    means = d.groupBy(*keys, x).agg(F.avg(y).alias(y))
    return means.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def correlations(d: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Pearson's r of each group, 0 where a side is constant."""
    return d.groupBy(*keys).agg(F.coalesce(F.nanvl(F.corr(x, y), F.lit(0.0)), F.lit(0.0)).alias("r"))


def correlation_bins(r: DataFrame, bins: int = 20) -> DataFrame:
    """How many groups have an absolute r in each of bins equal parts of 0 to 1; 1 is in the last."""
    return r.groupBy(F.least(F.floor(F.abs("r") * bins), F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def top(d: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    return d.orderBy(F.desc(by), tie).limit(n)


def page(d: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """Page number (from 0) of size rows."""
    return d.orderBy(*order).offset(number * size).limit(size)


def annotated(d: DataFrame, notes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """d with columns of notes by key, "" where there is no note; they replace columns of the same names."""
    found = d.drop(*columns).join(notes.select(key, *columns), key, "left")
    return found.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def weighted_moments(d: DataFrame, keys: list[str], x: str, weight: str) -> DataFrame:
    """Weighted mean, the weighted variance scaled by n / (n - 1), and the weighted skewness and excess kurtosis, from sums of powers; null where the values don't vary."""
    w, v = F.col(weight), F.col(x)
    m = d.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(w).alias("w"), *(F.sum(w * v**k).alias(f"s{k}") for k in (1, 2, 3, 4)))
    a, b, c, e = (F.col(f"s{k}") / F.col("w") for k in (1, 2, 3, 4))
    m2, m3, m4 = b - a * a, c - 3 * a * b + 2 * a**3, e - 4 * a * c + 6 * a * a * b - 3 * a**4
    varies = m2 > 0
    return m.select(*keys, a.alias("mean"), (m2 * F.col("n") / (F.col("n") - 1)).alias("variance"), F.when(varies, m3 / m2**1.5).alias("skewness"), F.when(varies, m4 / (m2 * m2) - 3).alias("kurtosis"))


def with_efficiency(molecules: Column, codes: int, efficiency: float) -> Column:
    """The number of true molecules behind counted ones, where a share efficiency of codes labels; at most codes - 1 count."""
    return F.bround(F.log(1 - F.least(molecules, F.lit(codes - 1)) / codes) / F.log(F.lit(1 - efficiency / codes)), 0).cast("long")


def longest_run(text: Column) -> Column:
    """The length of the longest run of one character."""
    runs = F.transform(F.regexp_extract_all(text, F.lit(r"(?s)((.)\2*+)"), F.lit(1)), F.length)
    return F.coalesce(F.array_max(runs), F.lit(0))


def transcript_position(exons: Column, at: Column, forward: Column) -> Column:
    """The place (from 0) of a genome position in a transcript, -1 outside its exons.

    exons: array of (s, e), both inclusive, in genome order; a reverse transcript begins at its last base.
    """
    zero = F.struct(F.lit(0).cast("long").alias("len"), F.lit(-1).cast("long").alias("hit"))

    def step(a, x):
        inside = (at >= x["s"]) & (at <= x["e"])
        return F.struct((a["len"] + x["e"] - x["s"] + 1).cast("long").alias("len"), F.when(inside, a["len"] + at - x["s"]).otherwise(a["hit"]).cast("long").alias("hit"))

    out = F.aggregate(exons, zero, step)
    return F.when(out["hit"] < 0, out["hit"]).when(forward, out["hit"]).otherwise(out["len"] - 1 - out["hit"])
