"""The sorted order of all suffixes of a table of contigs, and search in it with mismatches.

The order is found by one sort by first letters, and by prefix doubling for those that it leaves tied: a rank by h letters together with the rank of the suffix h letters on gives the rank by
2 h letters. Every round is a count, a range sort and a join over the cluster, of the tied suffixes only. Suffixes end with their contigs.

A search goes down the order as down a trie, ``STEP`` letters at a time: a read's letters with the substitutions that it may still have are joined with the prefixes
that suffixes have, so it goes on only where some suffix does. What is left is an interval of ranks. Mismatches are raised from 0 until a read has a hit, so most reads are settled by the exact join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranks import running_totals
from .storage import kept, small_or_not, written

#: Letters of the first ranking (27 of four letters and the end fit a long), of its groups, and of a step of the search; places of a contig that are spread at once.
START, HEAD, STEP, PIECE = 27, 8, 8, 4096
#: Suffixes of a task, and of a group that one task may sort.
ROWS, HEAVY = 2_000_000, 8_000_000


def _pieces(contigs: DataFrame, contig: str, text: str, length: int) -> DataFrame:
    """contig, _at, _n (letters of the whole text) and _raw: PIECE places from _at and the letters that the last ones go on with, dealt to all cores, since a table of few bytes is read by one task."""
    raw = F.col(text).cast("binary")
    d = contigs.select(F.col(contig).alias("contig"), raw.alias("_raw"), F.octet_length(raw).alias("_n")).filter("_n > 0")
    d = d.withColumn("_at", F.explode(F.expr(f"sequence(0, _n - 1, {PIECE})"))).withColumn("_raw", F.substring("_raw", F.col("_at") + 1, F.lit(PIECE + length)))
    return d.repartition(4 * contigs.sparkSession.sparkContext.defaultParallelism)


def places(contigs: DataFrame, contig: str, text: str, length: int) -> DataFrame:
    """contig, pos (from 0) and the first letters of the suffix there. Texts are of one-byte letters, so that a place is found without reading what is before it."""
    d = _pieces(contigs, contig, text, length).withColumn("_k", F.explode(F.expr(f"sequence(0, least(_n - _at, {PIECE}) - 1)")))
    return d.select("contig", (F.col("_at") + F.col("_k")).alias("pos"), F.substring("_raw", F.col("_k") + 1, F.lit(length)).cast("string").alias("prefix"))


def _keyed(contigs: DataFrame, contig: str, text: str, start: int, letters: str) -> tuple[DataFrame, int]:
    """contig, pos, _left (letters to the contig's end), key and head, and the number of first letters by whose order keys are ordered. Heads are those of the first HEAD letters.

    A key is a number with the letters' places as digits and 0 after the end, if texts have no other letters and digits suffice; else it is the letters themselves.
    """
    digits = "123456789abcdefghijklmnopqrstuvwxyz"[: len(letters)]
    base = len(letters) + 1
    if base > 36 or not contigs.filter(F.length(F.translate(text, letters, "")) > 0).isEmpty():
        d = places(contigs, contig, text, start).join(small_or_not(contigs.select(F.col(contig).alias("contig"), F.octet_length(F.col(text).cast("binary")).alias("_n"))), "contig")
        return d.select("contig", "pos", (F.col("_n") - F.col("pos")).alias("_left"), F.col("prefix").alias("key"), F.left("prefix", F.lit(HEAD)).alias("head")), start
    while base**start >= 2**63:
        start -= 1
    d = _pieces(contigs, contig, text, start).withColumn("_raw", F.concat(F.translate(F.col("_raw").cast("string"), "".join(sorted(letters)), digits), F.lit("0" * start)).cast("binary"))
    d = d.withColumn("_k", F.explode(F.expr(f"sequence(0, least(_n - _at, {PIECE}) - 1)")))
    d = d.withColumn("key", F.conv(F.substring("_raw", F.col("_k") + 1, F.lit(start)).cast("string"), base, 10).cast("long"))
    return d.select("contig", (F.col("_at") + F.col("_k")).alias("pos"), (F.col("_n") - F.col("_at") - F.col("_k")).alias("_left"), "key", F.expr(f"key div {base ** max(start - HEAD, 0)}L").alias("head")), start


def _first_ranks(d: DataFrame) -> DataFrame:
    """d of _keyed with rank by key, and _same, the number of rows with its key. Each head is sorted in one task; if one is too frequent for that, equal keys are counted before they are sorted."""
    heads = kept(d.groupBy("head").agg(F.count("*").alias("_n")))
    total, most = heads.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if most > HEAVY:
        same = running_totals(d.groupBy("key").agg(F.count("*").alias("_n")), ["key"], "_n", "rank")
        return written(d.join(same, "key").select("contig", "pos", "_left", "rank", F.col("_n").alias("_same")))
    w = Window.partitionBy("head")
    parts = max(total // ROWS, int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = d.repartition(parts, "head").withColumn("_in", F.rank().over(w.orderBy("key"))).withColumn("_same", F.count("*").over(Window.partitionBy("head", "key")))
    before = running_totals(heads, ["head"], "_n", "_before").drop("_n")
    return written(d.join(small_or_not(before), "head").select("contig", "pos", "_left", (F.col("_before") + F.col("_in") - 1).alias("rank"), "_same"))


def suffix_order(contigs: DataFrame, contig: str, text: str, start: int = START, letters: str = "ACGT") -> DataFrame:
    """contig, pos and rank: the number of suffixes that sort before this one; equal suffixes share a rank. Contigs are named once and not null; null and empty ones have no suffixes. Texts of the letters alone are sorted as numbers."""
    d, h = _keyed(contigs, contig, text, start, letters)
    first = _first_ranks(d)
    tied, settled = kept(first.filter((F.col("_same") > 1) & (F.col("_left") >= h)).select("contig", "pos", "_left", "rank")), None
    while not tied.isEmpty():
        asked = tied.filter(F.col("_left") > h).select("contig", (F.col("pos") + h).alias("pos"))
        known = first.select("contig", "pos", "rank").join(asked, ["contig", "pos"])
        later = (tied if settled is None else tied.unionByName(settled)).select("contig", "pos", F.col("rank").alias("_later"))
        ahead = known.join(later, ["contig", "pos"], "left").select("contig", (F.col("pos") - h).alias("pos"), F.coalesce("_later", "rank").alias("_ahead"))
        both = kept(tied.join(ahead, ["contig", "pos"], "left").withColumn("_ahead", F.coalesce("_ahead", F.lit(-1))))
        counts = running_totals(both.groupBy("rank", "_ahead").agg(F.count("*").alias("_same")), ["rank", "_ahead"], "_same", "_among")
        counts = kept(counts)
        counts = counts.join(counts.groupBy("rank").agg(F.min("_among").alias("_first")), "rank")
        d = kept(both.join(counts, ["rank", "_ahead"]).select("contig", "pos", "_left", (F.col("rank") + F.col("_among") - F.col("_first")).alias("rank"), ((F.col("_same") > 1) & (F.col("_left") > h)).alias("_tied")))
        done = d.filter("not _tied").drop("_tied")
        tied, settled, h = d.filter("_tied").drop("_tied"), done if settled is None else settled.unionByName(done), 2 * h
    first = first.select("contig", "pos", "rank")
    if settled is None:
        return first
    return first.join(settled.select("contig", "pos", F.col("rank").alias("_rank")), ["contig", "pos"], "left").select("contig", "pos", F.coalesce("_rank", "rank").alias("rank"))


def substituted(d: DataFrame, chunk: str, most: str, changes: int, letters: str) -> DataFrame:
    """d with _chunk and _changes: chunk with up to so many letters changed, and no more than the column most says."""
    d = d.withColumn("_chunk", F.col(chunk)).withColumn("_changes", F.lit(0))
    found, d = d, d.withColumn("_at", F.lit(0))
    for k in range(1, changes + 1):
        d = d.filter((F.col(most) >= k) & (F.length("_chunk") > F.col("_at")))
        d = d.withColumn("_at", F.explode(F.expr("sequence(_at + 1, length(_chunk))"))).withColumn("_letter", F.explode(F.array(*map(F.lit, letters))))
        d = d.filter(F.expr("_letter != substr(_chunk, _at, 1)")).withColumn("_chunk", F.expr("overlay(_chunk placing _letter from _at)")).withColumn("_changes", F.lit(k)).drop("_letter")
        found = found.unionByName(d.drop("_at"))
    return found


def _searched(reads: DataFrame, read: str, seq: str, prefixes: DataFrame, mismatches: int, letters: str, found_at) -> DataFrame | None:
    """The hits of reads with the fewest mismatches. prefixes has the column prefix; found_at(n) gives the table, by path, of what a whole path of n letters hits.

    Spark takes the size of a few reads for that of all their substitutions, and would broadcast them: so both sides of the last join are dealt by path to as many tasks as their rows ask
    for, and the substitutions of one task are hashed.
    """
    left = reads.select(F.col(read).alias("read"), F.col(seq).alias("seq")).filter("seq != ''")
    lengths = sorted(r[0] for r in left.select(F.length("seq")).distinct().collect())
    steps = sorted({e for n in lengths for e in range(STEP, n, STEP)})
    level = {e: kept(prefixes.filter(F.length("prefix") >= e).select(F.left("prefix", F.lit(e)).alias("path")).distinct()) for e in steps}
    level = {e: small_or_not(d.hint("merge")) for e, d in level.items() if 2 * d.count() <= len(letters) ** e}  # with most paths there, asking for them leaves out little
    ends = {n: found_at(n) for n in lengths}
    n_prefixes, least = prefixes.count(), int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = None
    for k in range(mismatches + 1):
        hits, n_left = None, left.count()
        for n in lengths:
            parts = max(least, (n_prefixes + n_left * math.comb(n, k) * (len(letters) - 1) ** k) // ROWS) if n <= 2 * STEP else max(least, n_prefixes // ROWS)
            d, before = left.filter(F.length("seq") == n).withColumn("path", F.lit("")).withColumn("n_mismatches", F.lit(0)), 0
            for end in [*range(STEP, n, STEP), n]:
                d = d.withColumn("_part", F.substring("seq", before + 1, end - before)).withColumn("_most", k - F.col("n_mismatches"))
                d = substituted(d, "_part", "_most", k, letters)
                d = d.select("read", "seq", F.concat("path", "_chunk").alias("path"), (F.col("n_mismatches") + F.col("_changes")).alias("n_mismatches"))
                if end == n:
                    d = d.filter(F.col("n_mismatches") == k).select("read", "n_mismatches", "path").repartition(parts, "path").hint("shuffle_hash")
                    d = d.join(ends[n].repartition(parts, "path"), "path").drop("path")
                elif k and end in level:
                    d = d.join(level[end], "path", "left_semi")
                before = end
            hits = d if hits is None else hits.unionByName(d)
        if hits is None:
            break
        hits = kept(hits)
        found = hits if found is None else found.unionByName(hits)
        if k < mismatches:
            left = kept(left.join(hits.select("read").distinct().hint("merge"), "read", "left_anti"))
    return found


def interval_hits(reads: DataFrame, read: str, seq: str, suffixes: DataFrame, mismatches: int, letters: str = "ACGT") -> DataFrame:
    """read, n_mismatches, from and to: the intervals of ranks whose suffixes start with the read, with the fewest mismatches, up to a number, that hit anything.

    suffixes: prefix and rank (of suffix_order), with prefixes as long as the longest read. Reads are joined level by level, one pass for each of their lengths, of which there should be few. Places with
    other letters than the given ones are only hit where the read has the same. Null and empty reads hit nothing.
    """
    reads, counts = kept(reads.select(read, seq)), kept(suffixes.groupBy("prefix").agg(F.min("rank").alias("from"), F.max("rank").alias("to")))
    at = lambda n: kept(counts.filter(F.length("prefix") >= n).groupBy(F.left("prefix", F.lit(n)).alias("path")).agg(F.min("from").alias("from"), F.max("to").alias("to")))
    found = _searched(reads, read, seq, counts, mismatches, letters, at)
    return found if found is not None else reads.select(F.col(read).alias("read"), F.lit(0).alias("n_mismatches"), F.lit(0).cast("long").alias("from"), F.lit(0).cast("long").alias("to")).limit(0)


def mismatch_hits(reads: DataFrame, contigs: DataFrame, read: str, seq: str, contig: str, text: str, mismatches: int, letters: str = "ACGT") -> DataFrame:
    """read, n_mismatches, contig and pos: the places of contigs where a read stands with the fewest mismatches, up to a number; matches never cross contigs. Reads and contigs are named once.

    The search of interval_hits, with the places themselves in place of intervals, so that nothing needs ranks.
    """
    reads = kept(reads.select(read, seq))
    longest = reads.agg(F.max(F.length(seq))).first()[0] or 1
    d = written(places(contigs, contig, text, longest))
    at = lambda n: d.filter(F.length("prefix") >= n).select(F.left("prefix", F.lit(n)).alias("path"), "contig", "pos")
    found = _searched(reads, read, seq, d, mismatches, letters, at)
    return found if found is not None else d.select(F.lit(None).cast(reads.schema[read].dataType).alias("read"), F.lit(0).alias("n_mismatches"), "contig", "pos").limit(0)
