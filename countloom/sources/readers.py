"""Text formats as DataFrames. Compressed files are read by their suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countloom.operators.storage import small_or_not


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of a SAM file: 0-based positions, strand from flag 0x10, mapping count from XM:i. Headers, short lines and unaligned reads are left out."""
    c = F.split("value", "\t")
    d = spark.read.text(path).filter(~F.col("value").startswith("@")).filter(F.size(c) >= 11)
    d = d.select(
        c[0].alias("read_id"), F.when(c[1].cast("int").bitwiseAND(16) != 0, "-").otherwise("+").alias("strand"), F.regexp_replace(c[2], "^chr", "").alias("chr"),
        (c[3].cast("long") - 1).alias("pos"), c[9].alias("seq"), F.regexp_extract("value", r"\tXM:i:(\d+)", 1).try_cast("int").alias("n_mappings"),
    )
    return d.filter("pos >= 0")


def bowtie_map(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of a map file, one row each; lines of fewer than 8 columns are left out. Mismatches are structs (offset, ref, alt)."""
    c = F.split("value", "\t")
    one = lambda m: F.struct(F.split(m, ":")[0].cast("int").alias("offset"), F.substring(F.split(m, ":")[1], 1, 1).alias("ref"), F.substring(F.split(m, ":")[1], 3, 1).alias("alt"))
    d = spark.read.text(path).filter(F.size(c) >= 8)
    return d.select(c[0].alias("read_id"), c[1].alias("strand"), F.regexp_replace(c[2], "^chr", "").alias("chr"), c[3].cast("long").alias("pos"), c[4].alias("seq"), c[5].alias("qual"), c[6].cast("int").alias("n_other"), F.transform(F.filter(F.split(c[7], ","), lambda m: m != ""), one).alias("mismatches"))


def matrix(spark: SparkSession, path: str, missing: float = 0.0, sep: str = "\t") -> DataFrame:
    """An annotated matrix in long form (row_key, column, value): the header names the columns, cells that are no numbers are missing."""
    wide = spark.read.csv(path, sep=sep, header=True)
    key, *columns = wide.columns
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`").try_cast("double"), F.lit(missing)).alias("value")) for c in columns]))
    return wide.select(F.col(f"`{key}`").alias("row_key"), cells.alias("c")).select("row_key", "c.*")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, description and seq of each record; sequences of several lines are joined. Files split between records."""
    record = F.regexp_replace(F.regexp_replace("value", r"\r", ""), "^>", "")
    d = spark.read.option("lineSep", "\n>").text(path).select(F.split(record, "\n", 2).alias("x")).select(F.split(F.col("x")[0], r"\s+", 2).alias("h"), F.get("x", F.lit(1)).alias("s"))
    d = d.select(F.col("h")[0].alias("id"), F.coalesce(F.get("h", F.lit(1)), F.lit("")).alias("description"), F.regexp_replace(F.coalesce("s", F.lit("")), r"\s", "").alias("seq"))
    return d.filter("id != ''")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, value and line (from 0): a line's number is its place in its block of the file, plus the lines of the blocks before it, so files are read in blocks."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return lines.join(blocks, ["file", "block"]).select("file", "value", (F.col("before") + F.col("at") - F.col("first")).alias("line"))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """file, record, read_id, seq and qual of each four-line record; records that are not well formed are left out. Lines are numbered by block, and each record is put together after one shuffle."""
    lines = numbered_lines(spark, path)
    part = lambda k: F.max(F.when(F.col("line") % 4 == k, F.rtrim("value")))
    d = lines.groupBy("file", F.floor(F.col("line") / 4).alias("record")).agg(part(0).alias("h"), part(1).alias("seq"), part(2).alias("plus"), part(3).alias("qual"))
    d = d.filter(F.col("h").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("qual")))
    return d.select("file", "record", F.split(F.regexp_replace("h", "^@", ""), r"\s", 2)[0].alias("read_id"), "seq", "qual")


def quality_base(reads: DataFrame) -> DataFrame:
    """One row with base: 33 where only that one fits, 0 where 64 fits too; fails where a code is below 33 or above 126.

    Codes from 64 on fit both bases, so 64 alone is never the answer.
    """
    codes = reads.select(F.explode(F.split("qual", "")).alias("c")).filter("c != ''").agg(F.min(F.ascii("c")).alias("low"), F.max(F.ascii("c")).alias("high"))
    none = F.raise_error(F.concat(F.lit("quality codes from "), "low", F.lit(" to "), "high")).cast("int")
    return codes.select(F.when((F.col("low") < 33) | (F.col("high") > 126), none).when(F.col("low") < 64, 33).otherwise(0).alias("base"))


def typed(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A table of the given columns; a value that doesn't fit its type fails the job. Lines that begin with # are left out."""
    return spark.read.csv(path, schema=schema, sep="\t", header=header, mode="FAILFAST", comment="#", enforceSchema=not header)


def mapped(spark: SparkSession, path: str, columns: dict, header: bool = False) -> DataFrame:
    """Lines of tab-separated files through expressions over their fields: name -> function of the array of fields. Blank lines are left out, and with a header the first line of each file.

    A line is read as a table of one column, so that Spark itself drops the header wherever a file begins; a line may not hold the character U+0001.
    """
    d = spark.read.csv(path, schema="value string", sep="\x01", quote="", header=header).filter(F.trim("value") != "")
    return d.select(F.split("value", "\t").alias("_f")).select(*[f(F.col("_f")).alias(name) for name, f in columns.items()])


def expression(spark: SparkSession, path: str) -> DataFrame:
    """A table of counts in long form (gene, sample, value): the line with the cell "Sample:" names the samples, the columns behind it hold their counts.

    Spikes, repeats and single-molecule rows are left out; gene names are in lower case.
    """
    d = spark.read.text(path).select(F.split(F.rtrim("value"), "\t").alias("f"))
    head = F.broadcast(d.filter(F.array_contains("f", "Sample:")).select(F.col("f").alias("h"), F.array_position("f", "Sample:").cast("int").alias("at")).limit(1))
    rows = d.filter(~F.array_contains("f", "Sample:") & (F.size("f") > 1) & ~F.col("f")[0].rlike("(?i)^(RNA_SPIKE|r_|SingleMol)")).join(head, F.size("f") >= F.size("h"))
    cells = F.explode(F.transform(F.sequence(F.col("at"), F.size("h") - 1), lambda i: F.struct(F.get("h", i).alias("sample"), F.get("f", i).try_cast("double").alias("value"))))
    return rows.select(F.lower(F.col("f")[0]).alias("gene"), cells.alias("c")).select("gene", "c.*").filter("value is not null")


def colour_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, annotations (a map of the header's /key=value) and seq; lines that begin with # are left out. Files split between records."""
    d = fasta_records(spark, path)
    pairs = F.regexp_extract_all("header", F.lit(r"/(\w+=[^\s/]*)"), F.lit(1))
    return d.select(F.regexp_extract("header", r"^(\S+)", 1).alias("id"), F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.split(p, "=")[0], F.split(p, "=")[1]))).alias("annotations"), "seq")


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """header and seq of records, without lines that begin with #."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", r"\r", ""), r"(?m)^#.*\n?", ""), "^>", "")
    d = spark.read.option("lineSep", "\n>").text(path).select(F.split(text, "\n", 2).alias("x"))
    return d.select(F.col("x")[0].alias("header"), F.regexp_replace(F.coalesce(F.get("x", F.lit(1)), F.lit("")), r"\s", "").alias("seq")).filter("header != ''")


def sequence_lines(spark: SparkSession, path: str) -> DataFrame:
    """read_id, seq, qual and pf of a file with one read a line: 11 columns whose last is the filter's flag, bases . read as N."""
    c = F.split("value", "\t")
    d = spark.read.text(path).filter(F.size(c) >= 11)
    return d.select(F.concat_ws(":", c[0], c[2], c[3], c[4], c[5]).alias("read_id"), F.replace(c[8], F.lit("."), F.lit("N")).alias("seq"), c[9].alias("qual"), (F.trim(c[10]) == "1").alias("pf"))


def multi_mappings(spark: SparkSession, path: str) -> DataFrame:
    """read_id, n_other and mappings (structs in the order of the file's places) of a map file, one row a read."""
    d = bowtie_map(spark, path).withColumn("_k", F.monotonically_increasing_id())
    one = F.struct("_k", "strand", "chr", "pos", "mismatches")
    g = d.groupBy("read_id").agg(F.max("n_other").alias("n_other"), F.array_sort(F.collect_list(one)).alias("m"))
    return g.select("read_id", "n_other", F.transform("m", lambda x: F.struct(x["strand"].alias("strand"), x["chr"].alias("chr"), x["pos"].alias("pos"), x["mismatches"].alias("mismatches"))).alias("mappings"))


def plate_layout(spark: SparkSession, path: str) -> DataFrame:
    """well, species, merge and annotations (a map of the other columns) of a layout table; a row without Merge merges with none."""
    wide = spark.read.csv(path, sep="\t", header=True, comment="#")
    well, species, *rest = wide.columns
    notes = [x for c in rest if c != "Merge" for x in (F.lit(c), F.col(f"`{c}`"))]
    merge = F.coalesce(F.col("Merge"), F.lit("")) if "Merge" in rest else F.lit("")
    return wide.select(F.col(f"`{well}`").alias("well"), F.col(f"`{species}`").alias("species"), merge.alias("merge"), F.create_map(*notes).alias("annotations") if notes else F.create_map().alias("annotations"))


def repeat_masker(spark: SparkSession, path: str) -> DataFrame:
    """chr, start, end, strand and name (with the prefix r_) of repeats, 0-based and inclusive: of an .out file (columns apart by blanks) or a database table (by tabs, with a bin before)."""
    d = spark.read.text(path).select(F.col("value"), F.split(F.trim("value"), r"\s+").alias("o"), F.split("value", "\t").alias("t"))
    table = (F.size("t") >= 13) & F.col("t")[6].rlike("^[0-9]+$")
    out = ~table & (F.size("o") >= 11) & F.col("o")[5].rlike("^[0-9]+$")
    pick = lambda a, b: F.when(table, a).otherwise(b)
    strand = F.when(pick(F.get("t", F.lit(9)), F.get("o", F.lit(8))) == "+", "+").otherwise("-")
    return d.filter(table | out).select(
        F.regexp_replace(pick(F.get("t", F.lit(5)), F.get("o", F.lit(4))), "^chr", "").alias("chr"),
        pick(F.get("t", F.lit(6)).try_cast("long"), F.get("o", F.lit(5)).try_cast("long") - 1).alias("start"), (pick(F.get("t", F.lit(7)), F.get("o", F.lit(6))).try_cast("long") - 1).alias("end"),
        strand.alias("strand"), F.concat(F.lit("r_"), pick(F.get("t", F.lit(10)), F.get("o", F.lit(9)))).alias("name"),
    )


def psl(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of a PSL file: query, strand, target, start and end (0-based, end exclusive), matches, mismatches and blocks (structs size, q, t); header and short lines are left out."""
    c = F.split("value", "\t")
    numbers = lambda x: F.transform(F.filter(F.split(x, ","), lambda v: v != ""), lambda v: v.cast("long"))
    blocks = F.transform(F.arrays_zip(numbers(c[18]).alias("size"), numbers(c[19]).alias("q"), numbers(c[20]).alias("t")), lambda z: z)
    d = spark.read.text(path).filter((F.size(c) >= 21) & c[0].rlike("^[0-9]+$"))
    return d.select(c[9].alias("query"), c[8].alias("strand"), c[13].alias("target"), c[15].cast("long").alias("start"), c[16].cast("long").alias("end"), c[0].cast("long").alias("matches"), c[1].cast("long").alias("mismatches"), blocks.alias("blocks"))


def gene_association(spark: SparkSession, path: str) -> DataFrame:
    """gene and term of an association file, without those marked NOT; lines that begin with ! are left out."""
    c = F.split("value", "\t")
    d = spark.read.text(path).filter(~F.col("value").startswith("!") & (F.size(c) >= 5) & ~c[3].contains("NOT"))
    return d.select(c[2].alias("gene"), c[4].alias("term")).distinct()


def spikes(spark: SparkSession, path: str) -> DataFrame:
    """name and fraction of a spike table."""
    return spark.read.csv(path, sep="\t", comment="#", schema="name string, fraction double").filter("fraction is not null")


def known_gene(spark: SparkSession, path: str) -> DataFrame:
    """Gene models of a knownGene table, with the columns of ref_flat; the transcript's name stands for the gene's."""
    c = F.split("value", "\t")
    numbers = lambda x: F.transform(F.filter(F.split(x, ","), lambda v: v != ""), lambda v: v.cast("long"))
    exons = F.zip_with(numbers(c[8]), numbers(c[9]), lambda s, e: F.struct(s.alias("s"), (e - 1).alias("e")))
    d = spark.read.text(path).filter(~F.col("value").startswith("#")).filter(F.size(c) >= 10)
    return d.select(c[0].alias("gene"), c[0].alias("transcript"), F.regexp_replace(c[1], "^chr", "").alias("chr"), c[2].alias("strand"), c[3].cast("long").alias("start"), (c[4].cast("long") - 1).alias("end"), exons.alias("exons"))


def lanes(d: DataFrame, pattern: str) -> DataFrame:
    """run, lane and index of patterns like run:12[:ACGT,TTGA]: a row for each lane digit, with the index of its place where there are any."""
    p = F.split(pattern, ":")
    d = d.select("*", p[0].alias("run"), F.posexplode(F.filter(F.split(p[1], ""), lambda x: x != "")).alias("_k", "lane"), F.split(F.coalesce(F.get(p, F.lit(2)), F.lit("")), ",").alias("_i"))
    return d.withColumn("index", F.coalesce(F.get("_i", F.col("_k")), F.lit(""))).drop("_k", "_i")


def lifted(features: DataFrame, contigs: DataFrame, label: str) -> DataFrame:
    """features (contig, pos) on chromosomes: start + pos - 1 of the contigs (contig, chr, start, orientation, label) of a label that lie forward. The contigs are a small table."""
    c = contigs.filter((F.col("label") == label) & (F.col("orientation") == "+")).select("contig", "chr", F.col("start").alias("_start"))
    return features.join(small_or_not(c), "contig").withColumn("pos", F.col("_start") + F.col("pos") - 1).drop("_start")


def spatial_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """cells (cell, x, y) and counts (gene, cell, value) of a matrix whose first line names the cells and whose lines X and Y hold their places."""
    d = spark.read.text(path).select(F.split(F.rtrim("value"), "\t").alias("f")).withColumn("_k", F.monotonically_increasing_id())
    names = d.filter("_k = 0").select(F.posexplode("f").alias("i", "cell")).filter("i > 0")
    place = lambda n: d.filter(F.upper(F.col("f")[0]) == n).select(F.posexplode("f").alias("i", "_v")).select("i", F.col("_v").try_cast("int").alias(n.lower()))
    cells = names.join(place("X"), "i").join(place("Y"), "i").select("i", "cell", "x", "y")
    rows = d.filter(~F.upper(F.col("f")[0]).isin("X", "Y") & (F.col("_k") > 0)).select(F.col("f")[0].alias("gene"), F.posexplode("f").alias("i", "value")).filter("i > 0")
    counts = rows.join(small_or_not(names), "i").select("gene", "cell", F.col("value").try_cast("double").alias("value"))
    return cells.drop("i"), counts


def gff3(spark: SparkSession, path: str) -> DataFrame:
    """Features of a GFF3 or GVF file with their attributes as a map; comments and short lines are left out."""
    c = F.split("value", "\t")
    d = spark.read.text(path).filter(~F.col("value").startswith("#")).filter(F.size(c) >= 9)
    attributes = F.str_to_map(F.regexp_replace(F.rtrim(c[8]), ";$", ""), F.lit(";"), F.lit("="))
    return d.select(c[0].alias("chr"), c[1].alias("source"), c[2].alias("type"), c[3].try_cast("long").alias("start"), c[4].try_cast("long").alias("end"), c[5].try_cast("double").alias("score"), c[6].alias("strand"), attributes.alias("attributes"))


def ref_flat(spark: SparkSession, path: str) -> DataFrame:
    """Gene models: exons are structs (s, e) of 0-based inclusive places in genome order."""
    c = F.split("value", "\t")
    numbers = lambda x: F.transform(F.filter(F.split(x, ","), lambda v: v != ""), lambda v: v.cast("long"))
    exons = F.zip_with(numbers(c[9]), numbers(c[10]), lambda s, e: F.struct(s.alias("s"), (e - 1).alias("e")))
    d = spark.read.text(path).filter(~F.col("value").startswith("#")).filter(F.size(c) >= 11)
    return d.select(c[0].alias("gene"), c[1].alias("transcript"), F.regexp_replace(c[2], "^chr", "").alias("chr"), c[3].alias("strand"), c[4].cast("long").alias("start"), (c[5].cast("long") - 1).alias("end"), exons.alias("exons"))


def ontology(spark: SparkSession, path: str) -> DataFrame:
    """id, name and parents (is_a) of the terms of an OBO file. Files split between stanzas."""
    d = spark.read.option("lineSep", "\n[").text(path).filter(F.col("value").startswith("Term]"))
    one = lambda key: F.regexp_extract("value", rf"\n{key}: ([^\n\r]*)", 1)
    return d.select(one("id").alias("id"), one("name").alias("name"), F.regexp_extract_all("value", F.lit(r"\nis_a: (\S+)"), F.lit(1)).alias("parents"))


def barcodes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The directives (key, value) and the codes (id, seq) of a barcode file."""
    d, c = spark.read.text(path), F.split(F.rtrim("value"), "\t")
    part = lambda k: F.regexp_extract("value", r"^#(\w+)=(.*?)\s*$", k)
    keys = d.select(part(1).alias("key"), part(2).alias("value")).filter("key != ''")
    return keys, d.filter(~F.col("value").startswith("#")).filter(F.size(c) >= 2).select(c[0].alias("id"), c[1].alias("seq"))


def gencode(spark: SparkSession, path: str, attributes: str | None = None) -> DataFrame:
    """Gene models of a Gencode table of 16 columns (its first is a bin number), with the columns of ref_flat and type; a shorter line fails the job.

    attributes: a table of gene id, name, type and status and transcript id, name and type, which names a transcript's gene and gives its type where it has it.
    """
    c = F.split(F.trim("value"), "\t")
    numbers = lambda x: F.transform(F.filter(F.split(x, ","), lambda v: v != ""), lambda v: v.cast("long"))
    exons = F.zip_with(numbers(c[9]), numbers(c[10]), lambda s, e: F.struct(s.alias("s"), (e - 1).alias("e")))
    d = spark.read.text(path).filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    d = d.filter(F.when(F.size(c) < 16, F.raise_error(F.concat(F.lit("fewer than 16 columns: "), F.substring("value", 1, 80))).cast("boolean")).otherwise(True))
    d = d.select(F.trim(c[12]).alias("gene"), F.trim(c[1]).alias("transcript"), F.regexp_replace(c[2], "^chr", "").alias("chr"), F.substring(c[3], 1, 1).alias("strand"), c[4].cast("long").alias("start"), (c[5].cast("long") - 1).alias("end"), exons.alias("exons"))
    if attributes is None:
        return d.withColumn("type", F.lit(""))
    a = spark.read.text(attributes).select(F.split("value", "\t").alias("a")).filter(F.size("a") >= 7)
    a = a.groupBy(F.trim(F.col("a")[4]).alias("transcript")).agg(F.max(F.struct(F.trim(F.col("a")[1]).alias("name"), F.trim(F.col("a")[6]).alias("kind"))).alias("_a"))
    return d.join(a, "transcript", "left").select(F.coalesce("_a.name", "gene").alias("gene"), "transcript", "chr", "strand", "start", "end", "exons", F.coalesce("_a.kind", F.lit("")).alias("type"))


def biomart(spark: SparkSession, path: str) -> DataFrame:
    """Gene models of a BioMart table of an exon a line, with the columns of ref_flat and type. The header names the columns, in any order; a column that misses raises an error.

    A transcript's exons are put in order, those that overlap are joined, and those of one base or none are left out. A gene without a name goes by its transcript.
    """
    wide = spark.read.csv(path, sep="\t", header=True, quote="")
    found = lambda *fits: next((c for c in wide.columns if any(f(c.strip()) for f in fits)), None)
    names = {
        "transcript": found(lambda c: "transcript id" in c.lower()), "first": found(lambda c: c.startswith("Exon Chr Start")), "last": found(lambda c: c.startswith("Exon Chr End")), "chr": found(lambda c: c == "Chromosome Name"),
        "strand": found(lambda c: c == "Strand"), "gene": found(lambda c: c in ("External Gene ID", "Associated Gene Name")), "type": found(lambda c: c in ("Transcript Biotype", "Gene Biotype")),
    }
    if missing := [k for k, c in names.items() if c is None]:
        raise ValueError(f"no column for {', '.join(missing)}")
    d = wide.select(*(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(k) for k, c in names.items()))
    exon = F.struct((F.col("first").cast("long") - 1).alias("s"), (F.col("last").cast("long") - 1).alias("e"))
    g = d.groupBy("transcript").agg(F.max(F.struct("gene", "chr", "strand", "type")).alias("g"), F.array_sort(F.collect_list(F.when(F.col("last").cast("long") > F.col("first").cast("long"), exon))).alias("x")).filter(F.size("x") > 0)
    kind = "array<struct<s:bigint,e:bigint>>"

    def join(a, x):
        last = F.element_at(a, -1)
        both = F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(a) > 0) & (x["s"] <= F.get(a, F.size(a) - 1)["e"]), both).otherwise(F.concat(a, F.array(x)))

    exons = F.aggregate(F.slice("x", F.lit(2), F.greatest(F.size("x") - 1, F.lit(0))), F.slice("x", F.lit(1), F.lit(1)).cast(kind), join)
    g = g.withColumn("exons", exons)
    name = F.when(F.col("g.gene") != "", F.col("g.gene")).otherwise(F.col("transcript"))
    strand = F.when(F.col("g.strand") == "1", "+").otherwise("-")
    return g.select(name.alias("gene"), "transcript", F.col("g.chr").alias("chr"), strand.alias("strand"), F.col("exons")[0]["s"].alias("start"), F.element_at("exons", -1)["e"].alias("end"), "exons", F.col("g.type").alias("type"))


def gene_models(spark: SparkSession, annotation: str, path: str, attributes: str | None = None) -> DataFrame:
    """Gene models of an annotation: UCSC (refFlat), UALL (knownGene), GENC (Gencode), else BioMart; with the columns gene, transcript, chr, strand, start, end, exons and type."""
    if annotation == "GENC":
        return gencode(spark, path, attributes)
    if annotation in ("UCSC", "UALL"):
        return (ref_flat if annotation == "UCSC" else known_gene)(spark, path).withColumn("type", F.lit(""))
    return biomart(spark, path)


def fastq_resynchronised(spark: SparkSession, path: str) -> DataFrame:
    """file, line, read_id, seq and qual of the records of FASTQ files in which lines may be missing or broken: a record is four lines of which the first begins with @, the third with +, and the others are equally long.

    Every line is the possible start of a record; of starts that overlap the first one counts, in runs of starts less than four lines apart walked from their first. Lines are numbered as in ``fastq``, and each goes to the four records it may belong to.
    """
    lines = numbered_lines(spark, path)
    part = F.explode(F.sequence(F.lit(0), F.lit(3)))
    d = lines.withColumn("_k", part).withColumn("line", F.col("line") - F.col("_k")).filter("line >= 0")
    of = lambda k: F.max(F.when(F.col("_k") == k, F.rtrim("value")))
    d = d.groupBy("file", "line").agg(of(0).alias("h"), of(1).alias("seq"), of(2).alias("plus"), of(3).alias("qual"))
    d = d.filter(F.col("h").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("qual")) & (F.length("seq") > 0))
    # Starts that overlap are rare (a quality line that begins with @), so only they are gathered.
    w = Window.partitionBy("file").orderBy("line")
    d = d.withColumn("_run", F.sum(F.coalesce((F.col("line") - F.lag("line").over(w) >= 4).cast("int"), F.lit(1))).over(w))
    runs = d.groupBy("file", "_run").agg(F.array_sort(F.collect_list("line")).alias("_l"))
    walk = F.aggregate("_l", F.array().cast("array<bigint>"), lambda a, x: F.when((F.size(a) == 0) | (x - F.coalesce(F.get(a, F.size(a) - 1), F.lit(-9)) >= 4), F.concat(a, F.array(x))).otherwise(a))
    kept = runs.select("file", F.explode(walk).alias("line"))
    return d.join(kept, ["file", "line"]).select("file", "line", F.split(F.regexp_replace("h", "^@", ""), r"\s", 2)[0].alias("read_id"), "seq", "qual")


def genbank(spark: SparkSession, path: str) -> DataFrame:
    """locus, definition, organism, features and seq of the records of Genbank files: features are structs (kind, place, qualifiers), qualifiers a map, where of a repeated name the last counts. Files split between records."""
    record = F.concat(F.lit("\n"), F.regexp_replace("value", r"\r", ""))
    d = spark.read.option("lineSep", "\n//").text(path).select(record.alias("r")).filter(F.col("r").contains("\nLOCUS"))
    line = lambda name: F.regexp_extract("r", rf"\n {{0,2}}{name} +([^\n]*)", 1)
    definition = F.regexp_replace(F.regexp_extract("r", r"\nDEFINITION +([^\n]*(?:\n {12}[^\n]*)*)", 1), r"\n +", " ")
    table = F.regexp_extract("r", r"\nFEATURES[^\n]*((?:\n {5}[^\n]*)*)", 1)
    entries = F.regexp_extract_all(table, F.lit(r"\n {5}\S[^\n]*(?:\n {21}[^\n]*)*"), F.lit(0))
    flat = lambda x: F.regexp_replace(x, r"\n {21}(?!/)", "")
    pairs = lambda x: F.regexp_extract_all(flat(x), F.lit(r"\n {21}/([^\n]*)"), F.lit(1))
    named = lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.when(p.contains("="), F.regexp_replace(F.regexp_extract(p, r"=(.*)$", 1), '^"|"$', "")).otherwise("").alias("v"))
    last = lambda a: F.map_from_entries(F.filter(a, lambda x, i: ~F.exists(F.slice(a, i + 2, F.size(a)), lambda y: y["k"] == x["k"])))
    feature = lambda x: F.struct(F.regexp_extract(x, r"\n {5}(\S+)", 1).alias("kind"), F.regexp_extract(flat(x), r"\n {5}\S+ +(\S+)", 1).alias("place"), last(F.transform(pairs(x), named)).alias("qualifiers"))
    seq = F.upper(F.regexp_replace(F.regexp_extract("r", r"\nORIGIN[^\n]*\n([\s\S]*)", 1), r"[^A-Za-z]", ""))
    return d.select(F.split(line("LOCUS"), r"\s+")[0].alias("locus"), definition.alias("definition"), line("ORGANISM").alias("organism"), F.transform(entries, feature).alias("features"), seq.alias("seq"))


def chain(spark: SparkSession, path: str) -> DataFrame:
    """Alignment chains, a row for each block: id, score, target, target_start and target_strand, query, query_start and query_strand, and size; places are from 0, on the strand itself. Files split between chains."""
    d = spark.read.option("lineSep", "\nchain ").text(path).select(F.regexp_replace(F.regexp_replace("value", r"\r", ""), r"^(#[^\n]*\n)*(chain )?", "").alias("r")).filter(F.trim("r") != "")
    lines = F.filter(F.split("r", "\n"), lambda x: (F.trim(x) != "") & ~x.startswith("#"))
    d = d.select(lines.alias("_l")).filter(F.size("_l") > 0).select(F.split(F.get("_l", F.lit(0)), r"\s+").alias("h"), F.slice("_l", F.lit(2), F.size("_l")).alias("b"))
    n = lambda c: c.cast("long")
    block = lambda x: F.struct(n(F.split(F.trim(x), r"\s+")[0]).alias("size"), F.coalesce(n(F.get(F.split(F.trim(x), r"\s+"), F.lit(1))), F.lit(0)).alias("dt"), F.coalesce(n(F.get(F.split(F.trim(x), r"\s+"), F.lit(2))), F.lit(0)).alias("dq"))
    h = F.col("h")
    d = d.select(h[11].alias("id"), n(h[0]).alias("score"), h[1].alias("target"), h[3].alias("target_strand"), n(h[4]).alias("t"), h[6].alias("query"), h[8].alias("query_strand"), n(h[9]).alias("q"), F.transform("b", block).alias("blocks"))
    d = d.select("*", F.posexplode("blocks").alias("k", "block"))
    before = lambda gap: F.aggregate(F.slice("blocks", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda s, x: s + x["size"] + x[gap])
    return d.select("id", "score", "target", "target_strand", (F.col("t") + before("dt")).alias("target_start"), "query", "query_strand", (F.col("q") + before("dq")).alias("query_start"), F.col("block.size").alias("size"))
