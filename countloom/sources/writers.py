"""DataFrames as text formats. Every sink writes a folder of part files from the tasks that hold the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tsv(d: DataFrame, path: str) -> None:
    d.write.csv(path, sep="\t", header=True)


def bed(d: DataFrame, path: str) -> None:
    """Lines chr, start, end, name, score, strand in genome order over the part files; end is exclusive."""
    d.select("chr", "start", "end", "name", "score", "strand").orderBy("chr", "start", "end").write.csv(path, sep="\t")


def wiggle(runs: DataFrame, path: str) -> None:
    """Coverage runs (chr, start and end inclusive and 0-based, depth) as variableStep blocks, in genome order.

    A run is one block with its length as the span, so its size in the file does not grow with its length.
    """
    head = F.concat(F.lit("variableStep chrom=chr"), "chr", F.lit(" span="), (F.col("end") - F.col("start") + 1).cast("string"))
    line = F.concat_ws("\n", head, F.concat_ws(" ", (F.col("start") + 1).cast("string"), F.col("depth").cast("string")))
    runs.orderBy("chr", "start").select(line.alias("value")).write.text(path)


def fastq(reads: DataFrame, path: str, by: str) -> None:
    """Reads (read_id, seq, qual) in one folder for each value of by."""
    record = F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual")
    reads.select(by, record.alias("value")).write.partitionBy(by).text(path)


def rejected(reads: DataFrame, path: str, status: str, valid: str = "VALID") -> None:
    """The reads whose status is not valid, with the status appended to their id."""
    named = reads.filter(~F.col(status).eqNullSafe(valid)).withColumn("read_id", F.concat_ws("_", "read_id", status))
    named.select(F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual").alias("value")).write.text(path)


def wide(cells: DataFrame, path: str, row: str, column: str, value: str, columns: list, extra: dict[str, Column] | None = None) -> None:
    """A long matrix as a table with a total of each row; absent cells are 0. columns names the table's columns, extra adds aggregates by row."""
    extra = extra or {}
    d = cells.groupBy(row).agg(F.sum(value).alias("total"), *[c.alias(k) for k, c in extra.items()], *[F.coalesce(F.sum(F.when(F.col(column) == x, F.col(value))), F.lit(0)).alias(str(x)) for x in columns])
    d.orderBy(row).write.csv(path, sep="\t", header=True)


def fixed_wiggle(depths: DataFrame, path: str) -> None:
    """Depths (chr, pos 0-based, depth) as fixedStep blocks: a header where places are not next to each other, then a depth a line, in genome order."""
    w = Window.partitionBy("chr").orderBy("pos")
    new = F.coalesce(F.lag("pos").over(w) + 1 != F.col("pos"), F.lit(True))
    head = F.concat(F.lit("fixedStep chrom=chr"), "chr", F.lit(" start="), (F.col("pos") + 1).cast("string"), F.lit(" step=1"))
    line = F.concat_ws("\n", F.when(new, head), F.col("depth").cast("string"))
    depths.select("chr", "pos", line.alias("value")).orderBy("chr", "pos").select("value").write.text(path)


def with_moments(cells: DataFrame, path: str, row: str, column: str, value: str, columns: list) -> None:
    """A long matrix as a table with the mean and coefficient of variation of each row over the named columns; absent cells are 0."""
    v, n = F.coalesce(F.col(value), F.lit(0.0)), len(columns)
    mean = F.sum(v) / n
    sd = F.sqrt(F.greatest((F.sum(v * v) - F.sum(v) * F.sum(v) / n) / max(1, n - 1), F.lit(0.0)))
    wide(cells.filter(F.col(column).isin(columns)), path, row, column, value, columns, {"mean": mean, "cv": F.when(mean > 0, sd / mean)})


def cef(cells: DataFrame, path: str, rows: DataFrame, row: str, column: str, value: str, columns: dict[str, dict[str, str]]) -> None:
    """A matrix in CEF text: a line of counts, a line for each attribute of the columns, the names of the row attributes, and a line a row.

    rows: row and its attributes; columns: name -> attributes, the same for each. The lines are put in order over the part files.
    """
    spark, notes = cells.sparkSession, [c for c in rows.columns if c != row]
    marks = list(next(iter(columns.values())))
    n = rows.count()
    pad = "\t" * (len(notes) + 1)
    head = ["\t".join(["CEF", "0", str(len(notes) + 1), str(len(marks) + 1), str(n), str(len(columns))])]
    head += [pad + "\t".join([m, *[columns[c][m] for c in columns]]) for m in [*marks]]
    head += [pad + "\t".join([column, *columns]), "\t".join([row, *notes])]
    values = [F.coalesce(F.sum(F.when(F.col(column) == c, F.col(value))), F.lit(0)).alias(f"_v{i}") for i, c in enumerate(columns)]
    body = rows.join(cells.groupBy(row).agg(*values), row, "left")
    line = F.concat_ws("\t", row, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in notes], F.lit(""), *[F.coalesce(F.col(f"_v{i}").cast("string"), F.lit("0")) for i in range(len(columns))])
    top = spark.createDataFrame([(i, "", x) for i, x in enumerate(head)], "k int, name string, value string")
    body = body.select(F.lit(len(head)).alias("k"), F.col(row).cast("string").alias("name"), line.alias("value"))
    top.unionByName(body).orderBy("k", "name").select("value").write.text(path)


def r_table(cells: DataFrame, path: str, row: str, column: str, value: str, columns: list) -> None:
    """A table for R or MATLAB: the header names the columns only, so it is one cell shorter than the rows."""
    values = [F.coalesce(F.sum(F.when(F.col(column) == c, F.col(value))), F.lit(0)).cast("string").alias(f"_v{i}") for i, c in enumerate(columns)]
    body = cells.groupBy(row).agg(*values).select(F.lit(1).alias("k"), F.col(row).cast("string").alias("name"), F.concat_ws("\t", row, *[f"_v{i}" for i in range(len(columns))]).alias("value"))
    top = cells.sparkSession.createDataFrame([(0, "", "\t".join(map(str, columns)))], "k int, name string, value string")
    top.unionByName(body).orderBy("k", "name").select("value").write.text(path)


def newick(merges: list[tuple], names: dict | None = None) -> str:
    """The Newick text of a merge list (first, second, height), as agglomeration gives it, of a bounded number of clusters. The merged cluster goes by its first part's name, or by a fourth entry."""
    text, height = dict(names or {}), {}
    part = lambda c, h: f"{text.get(c, c)}:{h - height.get(c, 0.0):g}"
    top = ""
    for first, second, h, *named in merges:
        merged = named[0] if named else first
        top = text[merged] = f"({part(first, h)},{part(second, h)})"
        height[merged] = h
    return top + ";"


def xml(d: DataFrame, path: str, root: str = "summary", row: str = "point") -> None:
    """Rows as elements of XML files; structs and arrays become nested elements."""
    d.write.format("xml").option("rootTag", root).option("rowTag", row).save(path)


def phylip(pairs: DataFrame, path: str, items: list) -> None:
    """The square table of distances (first, second, distance; each pair once) of a bounded number of items in the PHYLIP format: their number, then a line for each with its name, ten letters wide, and its distances to all. Absent pairs are at distance 0."""
    both = pairs.select(F.col("first").alias("a"), F.col("second").alias("b"), "distance").unionByName(pairs.select(F.col("second").alias("a"), F.col("first").alias("b"), "distance"))
    d = both.groupBy("a").pivot("b", items).agg(F.first("distance"))
    name = F.rpad(F.col("a").cast("string"), 10, " ")
    order = F.array_position(F.array(*map(F.lit, items)), F.col("a"))
    body = d.select(order.alias("k"), F.concat_ws(" ", name, *[F.format_string("%.6f", F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).cast("double")) for c in items]).alias("value"))
    top = pairs.sparkSession.createDataFrame([(0, str(len(items)))], "k long, value string")
    top.unionByName(body).coalesce(1).sortWithinPartitions("k").select("value").write.text(path)
