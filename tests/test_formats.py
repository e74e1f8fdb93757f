from pyspark.sql import functions as F

from countloom.sources import readers, writers


def rows(d):
    return sorted(tuple(r) for r in d.collect())


def test_fasta_and_ontology(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 first one\nACGT\nAC\n>s2\nGG\n")
    assert rows(readers.fasta(spark, str(tmp_path / "a.fa"))) == [("s1", "first one", "ACGTAC"), ("s2", "", "GG")]
    (tmp_path / "a.obo").write_text("format: 1\n\n[Term]\nid: G:1\nname: one\n\n[Term]\nid: G:2\nname: two\nis_a: G:1 ! one\n\n[Typedef]\nid: x\n")
    assert rows(readers.ontology(spark, str(tmp_path / "a.obo"))) == [("G:1", "one", []), ("G:2", "two", ["G:1"])]


def test_fastq_over_blocks(spark, tmp_path):
    want = [(f"r{i}", "ACGTA"[: 1 + i % 5], "@!+I~"[: 1 + i % 5]) for i in range(400)]
    (tmp_path / "a.fq").write_text("".join(f"@{n} x\n{s}\n+\n{q}\n" for n, s, q in want) + "@bad\nAC\n+\nI\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        d = readers.fastq(spark, str(tmp_path / "a.fq"))
        assert [tuple(r) for r in d.orderBy("record").select("read_id", "seq", "qual").collect()] == want
        assert readers.quality_base(d).first().base == 33
        writers.fastq(d.withColumn("bc", F.length("seq")), str(tmp_path / "out"), "bc")
        again = readers.fastq(spark, str(tmp_path / "out" / "bc=3"))
        assert rows(again.select("read_id", "seq", "qual")) == sorted(x for x in want if len(x[1]) == 3)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gene_models(spark, tmp_path):
    (tmp_path / "a.gff").write_text("##gff\nchr1\ts\tSNV\t3\t4\t.\t+\t.\tID=v1;Ref=A;\nshort\n")
    r = readers.gff3(spark, str(tmp_path / "a.gff")).collect()
    assert len(r) == 1 and r[0].attributes == {"ID": "v1", "Ref": "A"} and r[0].score is None
    (tmp_path / "ref.txt").write_text("G\tT\tchr2\t-\t10\t40\t10\t40\t2\t10,30,\t20,40,\n")
    r = readers.ref_flat(spark, str(tmp_path / "ref.txt")).first()
    assert (r.chr, r.start, r.end) == ("2", 10, 39) and [tuple(e) for e in r.exons] == [(10, 19), (30, 39)]
    (tmp_path / "bc.txt").write_text("#umi=6\na\tACGT\nb\tGGTT\n")
    keys, codes = readers.barcodes(spark, str(tmp_path / "bc.txt"))
    assert rows(keys) == [("umi", "6")] and rows(codes) == [("a", "ACGT"), ("b", "GGTT")]


def test_sinks(spark, tmp_path):
    text = lambda name: [r.value for r in spark.read.text(str(tmp_path / name)).collect()]
    writers.wiggle(spark.createDataFrame([("1", 4, 6, 2)], "chr string, start long, end long, depth long"), str(tmp_path / "w"))
    assert text("w") == ["variableStep chrom=chr1 span=3", "5 2"]
    writers.bed(spark.createDataFrame([("1", 4, 6, "n", 0, "+")], "chr string, start long, end long, name string, score int, strand string"), str(tmp_path / "b"))
    assert text("b") == ["1\t4\t6\tn\t0\t+"]
    writers.rejected(spark.createDataFrame([("r", "A", "I", "VALID"), ("s", "C", "I", "NO_BC")], "read_id string, seq string, qual string, status string"), str(tmp_path / "r"), "status")
    assert text("r") == ["@s_NO_BC", "C", "+", "I"]
    writers.wide(spark.createDataFrame([("g", "a", 1), ("g", "b", 2), ("h", "b", 3)], "gene string, cell string, n long"), str(tmp_path / "m"), "gene", "cell", "n", ["a", "b"])
    assert {"g\t3\t1\t2", "h\t3\t0\t3"} < set(text("m"))


def test_quality_bases(spark):
    import pytest

    base = lambda *q: readers.quality_base(spark.createDataFrame([(x,) for x in q], "qual string")).first().base
    assert base("!+I", "5") == 33 and base("fgh", "@~") == 0
    with pytest.raises(Exception, match="quality codes"):
        base("I", "é")


def test_tables(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("a\tn\nx\t1\n#c\ny\t2\n")
    assert rows(readers.typed(spark, str(tmp_path / "t.tsv"), "a string, n int")) == [("x", 1), ("y", 2)]
    (tmp_path / "bad.tsv").write_text("a\tn\nx\tone\n")
    try:
        readers.typed(spark, str(tmp_path / "bad.tsv"), "a string, n int").collect()
        raise AssertionError("a bad value passed")
    except AssertionError:
        raise
    except Exception as e:
        assert "MALFORMED" in str(e) or "one" in str(e)
    (tmp_path / "m.tsv").write_text("h\tk\n\na\t2\nb\t3\n")
    assert rows(readers.mapped(spark, str(tmp_path / "m.tsv"), {"s": lambda f: f[0], "n": lambda f: f[1].cast("int")}, header=True)) == [("a", 2), ("b", 3)]
    (tmp_path / "e.tsv").write_text("note\n\tSample:\ts1\ts2\nGeneA\t\t1\t2\nRNA_SPIKE_1\t\t5\t6\nr_Alu\t\t1\t1\nGENEB\t\t0\t4\n")
    assert rows(readers.expression(spark, str(tmp_path / "e.tsv"))) == [("genea", "s1", 1.0), ("genea", "s2", 2.0), ("geneb", "s1", 0.0), ("geneb", "s2", 4.0)]
    (tmp_path / "p.tsv").write_text("Well\tSpecies\tMerge\tAge\nA01\tMm\tx\t3\nA02\tHs\t\t4\n")
    assert [tuple(r) for r in readers.plate_layout(spark, str(tmp_path / "p.tsv")).orderBy("well").collect()] == [("A01", "Mm", "x", {"Age": "3"}), ("A02", "Hs", "", {"Age": "4"})]
    (tmp_path / "s.tsv").write_text("#c\nspike1\t0.25\nspike2\t0.5\n")
    assert rows(readers.spikes(spark, str(tmp_path / "s.tsv"))) == [("spike1", 0.25), ("spike2", 0.5)]
    (tmp_path / "x.tsv").write_text("\tc1\tc2\nX\t0\t1\nY\t5\t6\ng1\t3\t4\n")
    cells, counts = readers.spatial_matrix(spark, str(tmp_path / "x.tsv"))
    assert rows(cells) == [("c1", 0, 5), ("c2", 1, 6)] and rows(counts) == [("g1", "c1", 3.0), ("g1", "c2", 4.0)]


def test_sequence_formats(spark, tmp_path):
    (tmp_path / "c.csfasta").write_text("# title\n>r1 /lib=a /pos=3\nT012\n301\n>r2\nT0\n")
    assert [(r.id, r.annotations, r.seq) for r in readers.colour_fasta(spark, str(tmp_path / "c.csfasta")).collect()] == [("r1", {"lib": "a", "pos": "3"}, "T012301"), ("r2", {}, "T0")]
    (tmp_path / "q.txt").write_text("M\t1\t2\t3\t4\t5\t0\t1\tAC.T\tIIII\t1\nM\t1\t2\t3\t4\t6\t0\t1\tACGT\tIIII\t0\nshort\n")
    assert rows(readers.sequence_lines(spark, str(tmp_path / "q.txt"))) == [("M:2:3:4:5", "ACNT", "IIII", True), ("M:2:3:4:6", "ACGT", "IIII", False)]
    (tmp_path / "a.map").write_text("r1\t+\tchr1\t10\tACGT\tIIII\t1\t2:A>C\nr1\t-\tchr2\t20\tACGT\tIIII\t1\t\nr2\t+\tchr1\t5\tAC\tII\t0\t\n")
    got = {r.read_id: (r.n_other, [(m.strand, m.chr, m.pos) for m in r.mappings]) for r in readers.multi_mappings(spark, str(tmp_path / "a.map")).collect()}
    assert got == {"r1": (1, [("+", "1", 10), ("-", "2", 20)]), "r2": (0, [("+", "1", 5)])}
    (tmp_path / "r.out").write_text("   SW perc\n\n  463 1.3 0.6 1.7 chr1 10001 10468 (24) + (CCCTAA)n Simple 1 463 (0) 1\n  363 1.3 0.6 1.7 chr1 20001 20468 (24) C AluY SINE 1 463 (0) 1\n")
    assert rows(readers.repeat_masker(spark, str(tmp_path / "r.out"))) == [("1", 10000, 10467, "+", "r_(CCCTAA)n"), ("1", 20000, 20467, "-", "r_AluY")]
    (tmp_path / "rmsk.txt").write_text("585\t463\t13\t6\t17\tchr1\t10000\t10468\t-1\t+\tL1\tLINE\tL1\t1\n")
    assert rows(readers.repeat_masker(spark, str(tmp_path / "rmsk.txt"))) == [("1", 10000, 10467, "+", "r_L1")]
    (tmp_path / "a.psl").write_text("psLayout version 3\n\nmatch\n\n----\n" + "\t".join("59 9 0 0 1 823 1 96 +- q1 92 0 91 t1 100 10 90 2 48,20, 5,60, 10,70,".split()) + "\n")
    r = readers.psl(spark, str(tmp_path / "a.psl")).collect()
    assert [(x.query, x.strand, x.target, x.start, x.end, x.matches, [tuple(b) for b in x.blocks]) for x in r] == [("q1", "+-", "t1", 10, 90, 59, [(48, 5, 10), (20, 60, 70)])]
    (tmp_path / "ga.txt").write_text("!c\nDB\tid\tG1\t\tGO:1\nDB\tid\tG1\tNOT\tGO:2\n")
    assert rows(readers.gene_association(spark, str(tmp_path / "ga.txt"))) == [("G1", "GO:1")]
    (tmp_path / "kg.txt").write_text("uc1\tchr3\t+\t10\t40\t10\t40\t2\t10,30,\t20,40,\tP\n")
    assert [(r.gene, r.chr, [tuple(e) for e in r.exons]) for r in readers.known_gene(spark, str(tmp_path / "kg.txt")).collect()] == [("uc1", "3", [(10, 19), (30, 39)])]


def test_lanes_and_contigs(spark):
    d = spark.createDataFrame([("R1:12:AC,GT",), ("R2:3",)], "p string")
    assert rows(readers.lanes(d, "p").select("run", "lane", "index")) == [("R1", "1", "AC"), ("R1", "2", "GT"), ("R2", "3", "")]
    c = spark.createDataFrame([("k1", "2", 101, "+", "ref"), ("k2", "2", 501, "-", "ref"), ("k3", "2", 901, "+", "alt")], "contig string, chr string, start long, orientation string, label string")
    f = spark.createDataFrame([("k1", 5), ("k2", 5), ("k3", 5)], "contig string, pos long")
    assert rows(readers.lifted(f, c, "ref").select("contig", "chr", "pos")) == [("k1", "2", 105)]


def test_matrix_sinks(spark, tmp_path):
    text = lambda name: [r.value for r in spark.read.text(str(tmp_path / name)).coalesce(1).collect()]
    writers.fixed_wiggle(spark.createDataFrame([("1", 4, 2), ("1", 5, 3), ("1", 9, 1)], "chr string, pos long, depth long"), str(tmp_path / "fw"))
    assert text("fw") == ["fixedStep chrom=chr1 start=5 step=1", "2", "3", "fixedStep chrom=chr1 start=10 step=1", "1"]
    cells = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 3.0), ("h", "b", 3.0)], "gene string, cell string, n double")
    writers.with_moments(cells, str(tmp_path / "mm"), "gene", "cell", "n", ["a", "b"])
    assert any(x.startswith("g\t4.0\t2.0\t0.707") for x in text("mm"))
    writers.r_table(cells, str(tmp_path / "rt"), "gene", "cell", "n", ["a", "b"])
    assert text("rt") == ["a\tb", "g\t1.0\t3.0", "h\t0.0\t3.0"]
    genes = spark.createDataFrame([("g", "1"), ("h", "2")], "gene string, chr string")
    writers.cef(cells, str(tmp_path / "cef"), genes, "gene", "cell", "n", {"a": {"age": "3"}, "b": {"age": "4"}})
    assert text("cef") == ["CEF\t0\t2\t2\t2\t2", "\t\tage\t3\t4", "\t\tcell\ta\tb", "gene\tchr", "g\t1\t\t1.0\t3.0", "h\t2\t\t0.0\t3.0"]
    assert writers.newick([("a", "b", 1.0, "x"), ("x", "c", 2.5, "y")]) == "((a:1,b:1):1.5,c:2.5);"


def test_xml(spark, tmp_path):
    d = spark.createDataFrame([("a", [1, 2]), ("b", [3])], "x string, y array<int>")
    writers.xml(d, str(tmp_path / "x"))
    back = spark.read.format("xml").option("rowTag", "point").schema("x string, y array<int>").load(str(tmp_path / "x"))
    assert sorted((r.x, r.y) for r in back.collect()) == [("a", [1, 2]), ("b", [3])]
