"""WARC archives: round trips, and recovery from damage."""

import gzip
import hashlib
import io
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from countloom.llm import warc

PAGES = "page_id long, url string, html string, digest string, first long, key string, bytes int"


def sha(x):
    return hashlib.sha256(x).hexdigest()


def record(i, payload, **more):
    return warc.record_bytes(f"urn:page:{i}", f"http://x/{i}", more.get("refers_to"), sha(payload), len(payload), payload)


def read(data, lo=0, hi=None):
    return list(warc.scanned(warc.Archive(io.BytesIO(data), len(data)), "f", lo, len(data) if hi is None else hi))


def brute(rows):
    least = {}
    for page, _, html in rows:
        b = (html or "").encode()
        if len(b) >= 100 and page is not None:
            least[b] = min(page, least.get(b, page))
    out = []
    for page, _, html in rows:
        b = (html or "").encode()
        first = least.get(b)
        again = first is not None and first != page
        out.append((page, len(b), sha(b), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size, often, small", [(warc.ARCHIVE, warc.OFTEN, warc.SMALL), (3000, 5, 0)])
def test_page_archive(spark, tmp_path, monkeypatch, size, often, small):
    """Nulls, empty and very long pages, ties, repeated rows, and columns with clashing names; several archives; hot payloads beyond the broadcast."""
    for name, value in (("OFTEN", often), ("SMALL", small)):
        monkeypatch.setattr(warc, name, value)
    rng = np.random.default_rng(6)
    noise = "".join(map(chr, rng.integers(32, 500, 5000)))
    rows = [(i, f"http://a.b/{i} x\ny", "copy " * 40) for i in range(60, 20, -1)] + [(i, None, f"page {i} " + noise[: i * 30]) for i in range(20)]
    rows += [(100, "http://c", "z" * 99), (101, "http://c", "z" * 99), (102, "u", "é" * 50), (103, "u", "é" * 50), (104, "u", None), (105, None, ""), (None, "u", "é" * 50), (None, "v", "no ids " * 30), (None, "v", "no ids " * 30)]
    rows += [(102, "u", "é" * 50), (200, "long", "WARC/1.1\r\n" * 90_000), (-7, "long", "<p>" + noise * 30)]
    d = spark.createDataFrame([(*r, "d", 5, "k", 1) for r in rows], PAGES)
    write = warc.write_archives
    monkeypatch.setattr(warc, "write_archives", lambda records, folder: write(records, folder, size))
    got = warc.page_archive(d, f"file://{tmp_path}/a")
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_no_pages(spark, tmp_path):
    d = spark.createDataFrame([], "page_id string, url string, html string")
    assert warc.page_archive(d, f"file://{tmp_path}/none").collect() == []


def test_text_ids(spark, tmp_path):
    rows = [("a b>", "u", "x" * 200), ("Z/é", "u", "x" * 200), ("", "u", "y")]
    got = warc.page_archive(spark.createDataFrame(rows, "page_id string, url string, html string"), f"file://{tmp_path}/t").collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in got} == {("Z/é", "response", None), ("a b>", "revisit", "Z/é"), ("", "response", None)}


@pytest.mark.parametrize("pack", [bytes, warc.member])
def test_any_byte_lost(pack):
    """Whatever single byte is changed or lost, all other records are read, and no wrong one is."""
    texts = [b"first page", b"second page", b"third page"]
    parts = [pack(record(i, x)) for i, x in enumerate(texts)]
    data, ends = b"".join(parts), np.cumsum([len(p) for p in parts])
    for at in range(0, len(data), 3):
        hit = int(np.searchsorted(ends, at, "right"))
        for broken in (data[:at] + bytes([data[at] ^ 0x55]) + data[at + 1 :], data[:at] + data[at + 1 :]):
            good = [r[11] for r in read(broken) if r[3] is None]
            assert set(texts) - {texts[hit]} <= set(good) <= set(texts) and len(good) == len(set(good))


def test_reasons():
    """Each check has its reason; the reader goes on behind it."""
    a, b = record(1, b"one"), record(2, b"two")
    length = lambda n: re.sub(rb"Content-Length: \d+", b"Content-Length: " + n, a, count=1)
    cases = {
        "no record start": b"junk" + a, "record runs past the end of the file": length(b"99999"), "no record end": a[:-2] + b"xx", "block digest differs": a.replace(b"\r\n\r\none", b"\r\n\r\nONE"),
        "bad length": length(b"-1"), "bad header line": a.replace(b"WARC-Date: " + warc.DATE.encode(), b"no colon"), "member and length differ": warc.member(a + b),
        "member holds no record": warc.member(b"something else entirely"), "member runs past the end of the file": warc.member(a)[:-9],
    }
    for reason, data in cases.items():
        assert data != a
        rows = read(data + (b if "past" not in reason else b""))
        assert rows[0][3] == reason, (reason, rows[0])
        if "past" not in reason:
            assert rows[-1][11] == b"two"
    folded = a.replace(b"WARC-Date: 20", b"WARC-Date:\r\n 20")
    assert read(folded)[0][7] == warc.DATE
    wrong = record(1, b"one").replace(sha(b"one").encode(), sha(b"two").encode(), 1)
    assert read(wrong)[0][3] == "payload digest differs"


def test_long_members():
    """Records longer than what is read at a time, plain and packed, in ranges of any size: each is read once."""
    rng = np.random.default_rng(7)
    payloads = [rng.bytes(int(n)) for n in (10, 900_000, 1, 300_000, 0, 2_000_000)]
    for pack in (bytes, warc.member):
        data = b"".join(pack(record(i, p)) for i, p in enumerate(payloads))
        for step in (100_000, 777_777, len(data)):
            rows = [r for lo in range(0, len(data), step) for r in read(data, lo, min(len(data), lo + step))]
            assert [r[11] for r in rows if r[3] is None] == payloads


def test_salvage(spark, tmp_path):
    """Archives within an archive, damage in the middle, a truncated end, a whole file of junk: records and gaps, whatever the ranges."""
    inner = b"".join(record(90 + i, b"inner %d" % i) for i in range(5))
    records = [record(1, b"one"), record(2, inner), record(3, b"three"), record(4, b"four" * 100), record(5, b"five")]
    data = records[0] + records[1] + b"#" * 50 + records[2][:40] + records[3] + records[4][:-30]
    gz = b"".join(warc.member(r) for r in records)
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gz[:-1])
    (tmp_path / "c.warc").write_bytes(b"nothing here")
    (tmp_path / "d.warc").write_bytes(b"")
    (tmp_path / "e.warc.gz").write_bytes(gzip.compress(records[0], mtime=0) + warc.member(records[4]))
    files = warc.archive_files(spark, f"file://{tmp_path}/*")
    name = F.element_at(F.split("file", "/"), -1)
    for split in (300, 1 << 20):
        rows = warc.read_archives(files, split=split)
        good = {(r.n, r.record_id, bytes(r.payload)) for r in warc.valid_records(rows).select(name.alias("n"), "record_id", "payload").collect()}
        whole = {(n, f"urn:page:{i}", p) for n, i, p in [("a.warc", 1, b"one"), ("a.warc", 2, inner), ("a.warc", 4, b"four" * 100), *[("b.warc.gz", i, p) for i, p in [(1, b"one"), (2, inner), (3, b"three"), (4, b"four" * 100)]], ("e.warc.gz", 1, b"one"), ("e.warc.gz", 5, b"five")]}
        assert good == whole
        lost = len(records[0] + records[1])
        gaps = {(r.n, r.start, r.end) for r in warc.quarantined(rows, files).select(name.alias("n"), "start", "end").collect()}
        last = len(gz) - len(warc.member(records[4]))
        assert gaps == {("a.warc", lost, lost + 90), ("a.warc", len(data) - len(records[4]) + 30, len(data)), ("b.warc.gz", last, len(gz) - 1), ("c.warc", 0, 12)}
    reasons = {(r.n, r.reason) for r in warc.quarantined(warc.read_archives(files), files).select(name.alias("n"), "reason").collect()}
    assert reasons == {("a.warc", "no record start"), ("a.warc", "record runs past the end of the file"), ("b.warc.gz", "member runs past the end of the file"), ("c.warc", "no record start")}
