"""BAM, base-call folders and databases: files written here are read back."""

import gzip
import struct
import zlib

import numpy as np
import pytest

from countloom.sources import aligned, database


def block(data):
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def alignment(name, ref, pos, flag, cigar, seq, qual, tags=b""):
    ops = b"".join(struct.pack("<I", n << 4 | aligned.OPERATIONS.index(o)) for n, o in cigar)
    codes = [aligned.BASES.index(c) for c in seq] + [0]
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2))
    q = bytes(ord(c) - 33 for c in qual) if qual else b"\xff" * len(seq)
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 37, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + ops + packed + q + tags
    return struct.pack("<i", len(body)) + body


def bin_of(start, end):
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == end - 1 >> shift:
            return first + (start >> shift)
    return 0


def write_bam(path, reads, index):
    """Blocks of 300 bytes, so that records cross them."""
    names = [("chr1", 50_000), ("chr2", 3000), ("scaffold", 100)]
    head = b"BAM\1" + struct.pack("<i", 4) + b"@CO\n" + struct.pack("<i", len(names)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in names)
    data, spans = head, []
    for r in reads:
        a = alignment(*r)
        spans.append((len(data), len(data) + len(a)))
        data += a
    out, starts = b"", []
    for i in range(0, len(data), 300):
        starts.append(len(out))
        out += block(data[i : i + 300])
    starts.append(len(out))
    path.write_bytes(out + block(b""))
    virtual = lambda x: starts[x // 300] << 16 | x % 300
    if not index:
        return
    bai = b"BAI\1" + struct.pack("<i", len(names))
    for ref in range(len(names)):
        bins, linear = {}, {}
        for (_, k, pos, _, cigar, *_), (a, b) in zip(reads, spans, strict=True):
            if k == ref:
                end = pos + sum(n for n, o in cigar if o in aligned.MOVING)
                bins.setdefault(bin_of(pos, end), []).append((virtual(a), virtual(b)))
                for w in range(pos >> 14, (end - 1 >> 14) + 1):
                    linear[w] = min(linear.get(w, 1 << 62), virtual(a))
        bai += struct.pack("<i", len(bins)) + b"".join(struct.pack("<Ii", n, len(c)) + b"".join(struct.pack("<QQ", *x) for x in c) for n, c in bins.items())
        top = max(linear, default=-1) + 1
        bai += struct.pack("<i", top) + b"".join(struct.pack("<Q", linear.get(w, 0)) for w in range(top))
    (path.parent / (path.name + ".bai")).write_bytes(bai)


@pytest.fixture(scope="module")
def reads():
    rng = np.random.default_rng(1)
    out = []
    for ref, size, n in ((0, 50_000, 60), (1, 3000, 20)):
        for i, pos in enumerate(sorted(rng.integers(0, size - 60, n).tolist())):
            cigar = [[(20, "M")], [(5, "S"), (10, "M"), (2000 if ref == 0 and pos < 40_000 else 20, "N"), (5, "M")], [(9, "M"), (2, "I"), (9, "M")]][i % 3]
            tags = [b"", b"NHC\x05XMC\x02", b"MDZ20\0ZBBS\x02\0\0\0\x01\0\x02\0XMi\x07\0\0\0"][i % 3]
            out.append((f"r{ref}.{i}", ref, pos, 16 * (i % 2), cigar, "".join(rng.choice(list("ACGTN"), 20)), "".join(map(chr, rng.integers(35, 70, 20))) if i % 4 else None, tags))
    out.append(("lost", -1, -1, 4, [], "ACG", "III", b""))
    return out


def rows(reads):
    marks = {b"": None}
    out = []
    for name, ref, pos, flag, cigar, seq, qual, tags in reads:
        end = pos + sum(n for n, o in cigar if o in "MDN=X")
        xm = marks.get(tags, 2 if b"NHC" in tags else 7)
        out.append((name, flag, ["1", "2"][ref] if ref >= 0 else None, "-" if flag & 16 else "+", pos if ref >= 0 else None, end if ref >= 0 else None, 37, "".join(f"{n}{o}" for n, o in cigar) or None, seq, qual, xm))
    return sorted(out, key=str)


def test_bam(spark, tmp_path, reads):
    aligned.register(spark)
    write_bam(tmp_path / "a.bam", reads, True)
    (tmp_path / "plain").mkdir()
    write_bam(tmp_path / "plain" / "b.bam", reads, False)
    d = spark.read.format("bam").option("window", 25_000).load(f"file://{tmp_path}/a.bam")
    assert sorted(map(tuple, d.collect()), key=str) == rows(reads[:-1])
    assert d.rdd.getNumPartitions() == 3  # two windows of chr1 and one of chr2
    whole = spark.read.format("bam").load(f"file://{tmp_path}/plain")
    assert sorted(map(tuple, whole.collect()), key=str) == rows(reads)
    few = d.filter("chrom = '1' and pos < 20000")
    assert sorted(map(tuple, few.collect()), key=str) == [r for r in rows(reads[:-1]) if r[2] == "1" and r[4] < 20_000]


def test_bam_pushdown(reads, tmp_path):
    """Filters choose windows."""
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    write_bam(tmp_path / "a.bam", reads, True)
    r = aligned.BamReader(f"file://{tmp_path}/a.bam", 10_000)
    assert len(r.partitions()) == 6
    assert len(list(r.pushFilters([EqualTo(("chrom",), "1"), GreaterThanOrEqual(("pos",), 20_000), LessThan(("pos",), 30_000)]))) == 3
    assert [(p.start, p.end) for p in r.partitions()] in ([(20_000, 30_000)], [(20_000, 30_000), (30_000, 40_000)])


def test_bcl(spark, tmp_path):
    """Two tiles, a rerun cycle, a packed and a short file, a missing cycle, a tile without a filter."""
    aligned.register(spark)
    calls = tmp_path / "120101_M_0007_FLOWX" / "Data" / "Intensities" / "BaseCalls"
    rng = np.random.default_rng(2)
    (calls / "L001").mkdir(parents=True)
    (calls / "config.xml").write_text('<B><Run><RunParameters><Reads Index="1"><FirstCycle>1</FirstCycle><LastCycle>4</LastCycle></Reads><Reads Index="2"><FirstCycle>5</FirstCycle><LastCycle>5</LastCycle></Reads></RunParameters><TileSelection><Lane Index="1"><Tile>1101</Tile><Tile>1102</Tile><Tile>1103</Tile></Lane></TileSelection></Run></B>')
    want = []
    for tile in (1101, 1102):
        columns = []
        for cycle, rerun in ((1, 1), (2, 1), (2, 2), (4, 1)):
            x = rng.integers(0, 160, 30).astype(np.uint8)
            folder = calls / "L001" / f"C{cycle}.{rerun}"
            folder.mkdir(exist_ok=True)
            if cycle == 4 and tile == 1102:
                x = x[:20]
            data = struct.pack("<I", len(x)) + x.tobytes()
            name = folder / f"s_1_{tile}.bcl"
            if rerun == 2:
                name.with_name(name.name + ".gz").write_bytes(gzip.compress(data))
            else:
                name.write_bytes(data)
            columns.append(np.append(x, np.full(30 - len(x), 8, np.uint8)))
        del columns[1]
        passed = rng.integers(0, 2, 30).astype(np.uint8)
        (calls / "L001" / f"s_1_{tile}.filter").write_bytes(struct.pack("<III", 0, 3, 30) + passed.tobytes())
        for i in range(30):
            want.append((f"Run0007_FLOWX_L1_R1_T{tile}_C{i}", tile, i, "".join("ACGT"[c[i] & 3] for c in columns), "".join(chr((c[i] >> 2) + 33) for c in columns), bool(passed[i])))
    d = spark.read.format("bcl").option("lane", 1).option("read", 1).load(f"file://{tmp_path}/120101_M_0007_FLOWX")
    assert d.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, d.collect())) == sorted(want)


def test_database(spark, tmp_path):
    """A round trip; a pushed predicate and aggregate; a batch that is sent again or broke off changes nothing."""
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    c = database._connection(spark, url, {"driver": driver})
    database._run(c, "CREATE TABLE hits (id BIGINT NOT NULL PRIMARY KEY, name VARCHAR(40), n DOUBLE)")
    d = spark.range(1000).selectExpr("id", "concat('x', id % 7) AS name", "id / 2.0D AS n")
    assert database.written_batch(d, url, "hits", ["id"], "first", 100, driver=driver)
    assert not database.written_batch(d.limit(3), url, "hits", ["id"], "first", driver=driver)
    # A second batch replaces some rows, finds leavings of a broken try, and has rows that a repeated task left twice.
    database._run(c, "CREATE TABLE hits_second_stage (id BIGINT)")
    more = spark.range(990, 1010).selectExpr("id", "'new' AS name", "1.5D AS n")
    assert database.written_batch(more.union(more), url, "hits", ["id"], "second", driver=driver)
    whole = database.scanned(spark, url, "hits", driver=driver)
    want = {(i, f"x{i % 7}", i / 2) for i in range(990)} | {(i, "new", 1.5) for i in range(990, 1010)}
    assert {tuple(r) for r in whole.toDF("id", "name", "n").collect()} == want and whole.count() == 1010
    some = database.scanned(spark, url, "hits", "ID", 4, "ID >= 500 AND NAME = 'x3'", driver=driver)
    assert some.rdd.getNumPartitions() == 4
    assert {r[0] for r in some.collect()} == {i for i in range(500, 990) if i % 7 == 3}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ID,500)" in plan and "EqualTo(NAME,x3)" in plan
    with pytest.raises(Exception, match="(?i)column|does not exist|not"):
        database.written_batch(d.withColumnRenamed("n", "m"), url, "hits", ["id"], "third", driver=driver)
    assert whole.count() == 1010
    c.close()
