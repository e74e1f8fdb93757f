"""Gene models of several annotations, and reads from broken files."""

import pytest
from pyspark.sql import functions as F

from countloom.sources import readers


def models(d):
    return sorted((r.gene, r.transcript, r.chr, r.strand, r.start, r.end, [tuple(x) for x in r.exons], r.type) for r in d.collect())


def test_gencode(spark, tmp_path):
    line = lambda t, chrom, strand, starts, ends, name: "\t".join(["585", t, chrom, strand, starts.split(",")[0], ends.rstrip(",").split(",")[-1], "0", "0", "2", starts, ends, "0", name, "a", "b", "c"])
    (tmp_path / "Comp.txt").write_text("#bin\tname\n" + line("T1", "chr1", "+", "10,30,", "20,40,", "G1") + "\n\n" + line("T2", "chrX", "-", "5,", "9,", "G2") + "\n")
    (tmp_path / "Attrs.txt").write_text("E1\tName1\tcoding\tKNOWN\tT1\tName1-001\tprotein\n")
    d = readers.gene_models(spark, "GENC", str(tmp_path / "Comp.txt"), str(tmp_path / "Attrs.txt"))
    assert models(d) == [("G2", "T2", "X", "-", 5, 8, [(5, 8)], ""), ("Name1", "T1", "1", "+", 10, 39, [(10, 19), (30, 39)], "protein")]
    (tmp_path / "short.txt").write_text("a\tb\n")
    with pytest.raises(Exception, match="fewer than 16"):
        readers.gencode(spark, str(tmp_path / "short.txt")).collect()


def test_biomart(spark, tmp_path):
    head = ["Strand", "Ensembl Transcript ID", "Exon Chr Start (bp)", "Exon Chr End (bp)", "Chromosome Name", "Associated Gene Name", "Gene Biotype"]
    rows = [("1", "T1", 101, 110, "4", "A", "coding"), ("1", "T1", 50, 60, "4", "A", "coding"), ("1", "T1", 108, 130, "4", "A", "coding"), ("1", "T1", 7, 7, "4", "A", "coding"), ("-1", "T2", 1, 9, "5", "", "rna")]
    (tmp_path / "mart.txt").write_text("\n".join("\t".join(map(str, r)) for r in [head, *rows]) + "\n")
    assert models(readers.gene_models(spark, "VEGA", str(tmp_path / "mart.txt"))) == [("A", "T1", "4", "+", 49, 129, [(49, 59), (100, 129)], "coding"), ("T2", "T2", "5", "-", 0, 8, [(0, 8)], "rna")]
    (tmp_path / "bad.txt").write_text("Strand\tChromosome Name\n1\t4\n")
    with pytest.raises(ValueError, match="transcript"):
        readers.biomart(spark, str(tmp_path / "bad.txt"))


def test_broken_fastq(spark, tmp_path):
    """A lost line, a cut record, a quality line that begins with @: the records behind them are read."""
    record = lambda k, q="IIII": f"@r{k} x\nACGT\n+\n{q}\n"
    (tmp_path / "a.fq").write_text(record(1) + "@r2\nACGT\n+\n" + record(3, "@III") + record(4, "@+II") + "@r5\nAC\n" + record(6) + "noise\n" + record(7, "+@@I"))
    (tmp_path / "b.fq").write_text("".join(record(k, "@@@@") for k in range(50)))
    d = readers.fastq_resynchronised(spark, str(tmp_path)).withColumn("f", F.element_at(F.split("file", "/"), -1))
    got = {}
    for r in d.collect():
        got.setdefault(r.f, []).append((r.line, r.read_id, r.qual))
    assert [x[1] for x in sorted(got["a.fq"])] == ["r1", "r3", "r4", "r6", "r7"]
    assert [x[1] for x in sorted(got["b.fq"])] == [f"r{k}" for k in range(50)]
    assert readers.fastq(spark, str(tmp_path / "b.fq")).count() == 50


def test_genbank(spark, tmp_path):
    text = """LOCUS       AB000001     24 bp    DNA     linear   PRI 01-JAN-2000
DEFINITION  Some gene of
            two lines.
SOURCE      x
  ORGANISM  Homo sapiens
FEATURES             Location/Qualifiers
     source          1..24
                     /organism="Homo sapiens"
     CDS             join(1..6,
                     10..15)
                     /gene="ABC"
                     /note="first
                     second"
                     /pseudo
ORIGIN
        1 acgtacgtac gtacgtacgt
       21 acgt
//
LOCUS       AB000002     4 bp
DEFINITION  Short.
ORIGIN
        1 ttaa
//
"""
    (tmp_path / "a.gb").write_text(text)
    got = {r.locus: r for r in readers.genbank(spark, str(tmp_path / "a.gb")).collect()}
    a = got["AB000001"]
    assert (a.definition, a.organism, a.seq) == ("Some gene of two lines.", "Homo sapiens", "ACGT" * 6)
    assert [(f.kind, f.place, f.qualifiers) for f in a.features] == [("source", "1..24", {"organism": "Homo sapiens"}), ("CDS", "join(1..6,10..15)", {"gene": "ABC", "note": "firstsecond", "pseudo": ""})]
    assert got["AB000002"].seq == "TTAA" and got["AB000002"].features == []


def test_chain(spark, tmp_path):
    (tmp_path / "a.chain").write_text("##head\nchain 4900 chrY 58368225 + 25985403 25985638 chr5 151006098 - 43549808 43549970 2\n16 0 2\n60 4 0\n10\n\nchain 7 chr1 100 + 5 9 chr2 90 + 1 5 3\n4\n")
    got = sorted(tuple(r) for r in readers.chain(spark, str(tmp_path / "a.chain")).collect())
    t, q = 25985403, 43549808
    assert got == [("2", 4900, "chrY", "+", t, "chr5", "-", q, 16), ("2", 4900, "chrY", "+", t + 16, "chr5", "-", q + 18, 60), ("2", 4900, "chrY", "+", t + 80, "chr5", "-", q + 78, 10), ("3", 7, "chr1", "+", 5, "chr2", "+", 1, 4)]
