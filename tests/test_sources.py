from countloom.sources import readers
from countloom.streaming.molecules import windowed_molecules


def test_sam_and_map_and_matrix(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\nr1\t16\tchr2\t10\t0\t4M\t*\t0\t0\tACGT\tIIII\tXM:i:3\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\nshort\t1\n")
    assert [tuple(r) for r in readers.sam(spark, str(tmp_path / "a.sam")).collect()] == [("r1", "-", "2", 9, "ACGT", 3)]
    (tmp_path / "a.map").write_text("r1\t+\tchr1\t5\tACGT\tIIII\t0\t1:A>C,3:G>T\nr2\t-\tchrX\t7\tAC\tII\t2\t\nbad\n")
    rows = readers.bowtie_map(spark, str(tmp_path / "a.map")).orderBy("read_id").collect()
    assert [tuple(m) for m in rows[0].mismatches] == [(1, "A", "C"), (3, "G", "T")] and rows[1].mismatches == [] and len(rows) == 2
    (tmp_path / "m.tsv").write_text("gene\tc1\tc2\ng1\t1\tx\ng2\t\t4\n")
    got = sorted(tuple(r) for r in readers.matrix(spark, str(tmp_path / "m.tsv")).collect())
    assert got == [("g1", "c1", 1.0), ("g1", "c2", 0.0), ("g2", "c1", 0.0), ("g2", "c2", 4.0)]


def test_stream(spark, tmp_path):
    d = spark.sql("select timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) as ts, id % 2 as cell, id % 3 as umi from range(30)")
    d.write.parquet(str(tmp_path / "in"))
    out = windowed_molecules(spark.readStream.schema(d.schema).parquet(str(tmp_path / "in")), ["cell"], "umi")
    q = out.writeStream.format("memory").queryName("molecules").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.cell: r.n_molecules for r in spark.table("molecules").collect()} == {0: 3, 1: 3}
