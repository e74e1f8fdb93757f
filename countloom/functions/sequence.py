"""Nucleotide sequences and molecular barcodes as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def umi_code(umi: Column) -> Column:
    """The base-4 number of a barcode, A=0, C=1, G=2, T=3, first base highest; null where it holds another letter."""
    return F.when(umi.rlike("^[ACGT]+$"), F.conv(F.translate(umi, "ACGT", "0123"), 4, 10).cast("long"))


def umi_text(code: Column, length: int) -> Column:
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), length, "0"), "0123", "ACGT")


def reverse_complement(seq: Column) -> Column:
    """Reverse complement with the IUPAC codes; other characters stay as they are."""
    return F.reverse(F.translate(seq, "ACGTRYKMBDHVacgt", "TGCAYRMKVHDBtgca"))


def code_distance(a: Column, b: Column) -> Column:
    """Hamming distance of two base-4 codes of up to 31 bases."""
    x = a.bitwiseXOR(b)
    low = F.lit(0x5555555555555555)
    return F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(low))


def phred_probability(q: Column) -> Column:
    return F.pow(F.lit(10.0), -q / 10)


def kmers(text: Column, k: int) -> Column:
    """The distinct strings of k characters in text; a lookahead reads them in one pass, however long the text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1)))
