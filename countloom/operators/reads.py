"""From raw reads to mappable inserts: trimming, barcodes, UMIs, and the statuses of rejected reads.

All steps are expressions over one row, so a whole extraction is one projection; only barcodes join, with a table of at most
(3 * length + 1) rows for each barcode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import small_or_not

#: Sequences that tell artefacts, in the order of their tests.
ARTEFACTS = (("P1", "AATGATACGGCGACC"), ("PHIX", "TAGTCACACAGTCCTTGACG"), ("RNA45S", "ACCTCAGATCAGACGTGGCGACCCGCTGAA"))
#: Fixed value: the transposase's sequence.
TN5 = "CTGTCTCTTATACAC"
#: Pairs of bases whose repeats are no insert.
PAIRS = ("AC", "AG", "AT", "CG", "CT", "GT")


def quality_trimmed(qual: Column, control: str = "B") -> Column:
    """The length without the bases at the end that carry the control quality."""
    return F.length(F.rtrim(qual, F.lit(control)))


def insert_start(seq: Column, at: int, switch: str, extra: int, base: str = "G") -> Column:
    """Where the insert begins (from 0) behind the switch sequence at a place and up to so many further bases; null where the sequence is not there."""
    rest = F.substring(seq, at + len(switch) + 1, extra)
    more = F.length(F.regexp_extract(rest, f"^{base}*", 0))
    return F.when(F.substring(seq, at + 1, len(switch)) == switch, at + len(switch) + more)


def umi_status(seq: Column, qual: Column, at: int, length: int, least: str) -> Column:
    """LOW_QUALITY_IN_UMI or N_IN_UMI by the first place of the UMI that fails, else VALID."""
    place = lambda i: F.when(F.substring(qual, i, 1) < least, "LOW_QUALITY_IN_UMI").when(F.substring(seq, i, 1) == "N", "N_IN_UMI")
    return F.coalesce(*[place(at + 1 + i) for i in range(length)], F.lit("VALID"))


def without_tail(seq: Column, length: Column, least: int, primers: list[str], shortest: int) -> tuple[Column, Column]:
    """The length left without trailing N and without the start of a primer at the end, and a status where too little is left.

    Trailing A stay, but a read that is too short without them is rejected. A primer counts if its first ``shortest`` bases stand in the
    read, last, and go on to its end as the primer does.
    """
    trimmed = F.greatest(F.length(F.rtrim(F.substring(seq, F.lit(1), length), F.lit("N"))), F.lit(least - 1))
    no_a = F.length(F.rtrim(F.substring(seq, F.lit(1), trimmed), F.lit("A")))
    found = F.when(F.greatest(no_a, F.lit(least - 1)) < least, F.struct(F.lit("TOO_LONG_TRAILING_pApN").alias("status"), F.greatest(no_a, F.lit(least - 1)).alias("length")))
    left = F.struct(F.lit("VALID").alias("status"), trimmed.alias("length"))
    for primer in primers:
        head = primer[:shortest]
        at = F.length(seq) - F.instr(F.reverse(seq), head[::-1]) + 1 - shortest
        rest = F.substring(seq, at + shortest + 1, F.length(seq))
        hit = seq.contains(head) & F.lit(primer[shortest:]).startswith(rest)
        cut = F.struct(F.when(at < least, "TOO_LONG_TRAILING_PRIMER_SEQ").otherwise("VALID").alias("status"), at.alias("length"))
        left = F.when((left["status"] == "VALID") & hit, cut).otherwise(left)
    out = F.coalesce(found, left)
    return out["length"], out["status"]


def complex_enough(insert: Column, least: int) -> Column:
    """Whether so many bases are neither A nor N."""
    return F.length(F.regexp_replace(insert, "[AaNn]", "")) >= least


def pair_repeat(insert: Column) -> Column:
    """Whether one pair of bases, repeated, fills the insert but for six bases; each insert by its own length."""
    times = F.floor((F.length(insert) - 6) / 2).cast("int")
    return F.when(times > 0, reduce(Column.__or__, [insert.contains(F.repeat(F.lit(p), times)) for p in PAIRS])).otherwise(F.length(insert) >= 0)


def holds_start(seq: Column, whole: str, least: int = 12) -> Column:
    """Whether the first ``least`` bases of a sequence stand in the read, and where they first do the read goes on as the sequence does, to the end of either."""
    at = F.instr(seq, whole[:least])
    return (at > 0) & F.lit(whole).startswith(F.substring(seq, at, F.lit(len(whole))))


def artefact(seq: Column, prefix: str, tests=ARTEFACTS, run: int = 20, transposase: str = TN5) -> Column:
    """The artefact that a read without barcode (or switch sequence) is: the transposase's sequence, also at the read's end, a known sequence, or mostly one base. A run of ``run`` equal bases counts as all of them."""
    out = F.when(holds_start(seq, transposase), f"{prefix}_TN5")
    for name, s in tests:
        out = out.when(seq.contains(s), f"{prefix}_{name}")
    for base in "ACGT":
        many = (F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))) > F.floor(F.length(seq) / 2)
        out = out.when(many | seq.contains(base * run), f"{prefix}_MANY_{base}")
    return out.otherwise(f"{prefix}_OTHER")


def barcode_index(barcodes: DataFrame, code: str, index: str, length: int) -> DataFrame:
    """match and index: the barcodes and their single substitutions, without those that are barcodes themselves or belong to several."""
    own = barcodes.select(F.col(code).alias("match"), index)
    mutants = [F.concat(F.substring(code, 1, i), F.lit(b), F.substring(code, i + 2, length)) for i in range(length) for b in "ACGT"]
    mutants = barcodes.select(F.explode(F.array_distinct(F.array(*mutants))).alias("match"), index).join(own.select("match"), "match", "left_anti")
    one = mutants.groupBy("match").agg(F.min(index).alias(index), F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    return own.unionByName(one)


def with_barcode(reads: DataFrame, code: str, table: DataFrame, index: str) -> DataFrame:
    """reads with the index of their barcode, -1 without one. The table of barcodes is small: one row for each barcode or mutant of it."""
    t = small_or_not(table.select(F.col("match").alias("_match"), index))
    return reads.join(t, F.col(code) == F.col("_match"), "left").withColumn(index, F.coalesce(index, F.lit(-1))).drop("_match")


def index_status(reads: DataFrame, code: str, index: str, others: DataFrame, unused: Column) -> DataFrame:
    """reads with status: VALID, MIXIN_SAMPLE_BC for barcodes of other samples (others, one column) or unused ones, UNKNOWN_BC else."""
    o = small_or_not(others.select(F.col(others.columns[0]).alias("_other")).distinct())
    status = F.when(F.col(index) == -1, F.when(F.col("_other").isNotNull(), "MIXIN_SAMPLE_BC").otherwise("UNKNOWN_BC")).otherwise(F.when(unused, "MIXIN_SAMPLE_BC").otherwise("VALID"))
    return reads.join(o, F.col(code) == F.col("_other"), "left").withColumn("status", status).drop("_other")


def extracted(reads: DataFrame, seq: str, qual: str, layout: dict, least: int, primers: list[str] = (), forbidden: list[str] = ()) -> DataFrame:
    """reads (with index, -1 without barcode) with status, umi and insert; umi and insert are null where the status is not VALID.

    layout: umi_at, umi_length, switch_at, switch, extra, least_quality, shortest_primer, least_bases.
    The tests run in the order quality, barcode, switch sequence, tail, forbidden sequence, UMI, complexity, repeats.
    """
    s, q = F.col(seq), F.col(qual)
    d = reads.withColumn("_trimmed", quality_trimmed(q)).withColumn("_start", insert_start(s, layout["switch_at"], layout["switch"], layout["extra"]))
    length, tail = without_tail(s, F.col("_trimmed"), least, list(primers), layout["shortest_primer"])
    inner = reduce(Column.__or__, [s.contains(x) for x in forbidden], F.lit(False))
    d = d.withColumn("_tail", F.struct(length.alias("length"), F.when((tail == "VALID") & inner, "FORBIDDEN_INTERNAL_SEQ").otherwise(tail).alias("status")))
    d = d.withColumn("_insert", F.expr(f"substring({seq}, _start + 1, _tail.length - _start)"))
    umi_ok = umi_status(s, q, layout["umi_at"], layout["umi_length"], layout["least_quality"])
    status = (
        F.when(F.col("_trimmed") <= least, "SEQ_QUALITY_ERROR")
        .when(F.col("index") == -1, artefact(s, "NO_BC"))
        .when(F.col("_start").isNull(), artefact(s, "NO_TSSEQ", ARTEFACTS[:1]))
        .when(F.col("_tail.status") != "VALID", F.col("_tail.status"))
        .when(umi_ok != "VALID", umi_ok)
        .when(~complex_enough(F.col("_insert"), layout["least_bases"]), "COMPLEXITY_ERROR")
        .when(s.contains(ARTEFACTS[0][1]), "P1_IN_READ")
        .when(pair_repeat(F.col("_insert")), "COMPLEXITY_ERROR")
        .otherwise("VALID")
    )
    valid = lambda c: F.when(F.col("status") == "VALID", c)
    d = d.withColumn("status", status).withColumn("umi", valid(F.substring(s, layout["umi_at"] + 1, layout["umi_length"]))).withColumn("insert", valid(F.col("_insert")))
    return d.drop("_trimmed", "_start", "_tail", "_insert")


def status_counts(reads: DataFrame, by: list[str]) -> DataFrame:
    """Reads of each status, and how many of them passed the machine's filter."""
    return reads.groupBy(*by, "status").agg(F.count("*").alias("n_reads"), F.count_if("pf").alias("n_pf"))


def zipped(first: DataFrame, second: DataFrame, key: str, header: str) -> DataFrame:
    """Records of two files by their place in the file. The job fails where a record has no partner, or their headers differ before the first space."""
    name = lambda c: F.substring_index(c, " ", 1)
    b = second.select(key, *[F.col(c).alias(f"{c}_2") for c in second.columns if c != key], F.lit(True).alias("_right"))
    d = first.withColumn("_left", F.lit(True)).join(b, key, "full")
    at = F.col(key).cast("string")
    wrong = F.when(F.col("_left").isNull() | F.col("_right").isNull(), F.raise_error(F.concat(F.lit("no partner for record "), at)).cast("boolean"))
    wrong = wrong.when(~name(F.col(header)).eqNullSafe(name(F.col(f"{header}_2"))), F.raise_error(F.concat(F.lit("headers differ at record "), at)).cast("boolean")).otherwise(True)
    return d.filter(wrong).drop("_left", "_right")


def max_mappings(mappings: DataFrame, read: str, most: int) -> DataFrame:
    """Mappings of reads that have no more than so many; the counts are aggregated before the join."""
    few = mappings.groupBy(read).agg(F.count("*").alias("_n")).filter(F.col("_n") <= most).select(read)
    return mappings.join(few, read, "left_semi")
