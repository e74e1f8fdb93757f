"""WARC archives: a writer with revisits, and a salvage reader.

The writer gives every record a gzip member of its own. Each task writes its archives under names of its own attempt, and only
the archives that the tasks' results name belong to the output, so a task that is run again leaves nothing double.

The reader takes ranges of files, so that a long archive is read by many tasks: a range has the records that start in it. A record counts
only if all its checks hold: version line, header, length, the end marks, CRC of the member, and the digests it carries. After a failed check the reader searches for
the next gzip magic or version line and tries again from there, so later records are recovered; each failed try is a row with its reason. The bytes of a file that
no valid record covers are its quarantined gaps.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import short_batches, small_bytes_or_not, written

#: Payloads of so many bytes may be revisits; a digest with so many rows is joined by broadcast whatever the size of the others.
LEAST, OFTEN = 100, 50_000
#: Bytes of first records that are broadcast.
SMALL = 32_000_000
#: Bytes of html after which a task starts a new archive, and bytes of a range of one.
ARCHIVE, RANGE = 1 << 28, 1 << 26
#: The longest header, the bytes read at a time, and the end of a record.
HEADER, CHUNK, END = 1 << 20, 1 << 18, b"\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC, _VERSION = b"\x1f\x8b\x08", re.compile(rb"WARC/\d\.\d\r?\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r?\n")
RECORD = "file string, offset long, length long, error string, type string, record_id string, uri string, date string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def _open(path: str):
    from pyarrow.fs import FileSystem

    fs, name = FileSystem.from_uri(path if "://" in path or path.startswith("/") else re.sub(r"^file:/*", "file:///", path))
    return fs, name


def page_id_uri(c: Column) -> Column:
    return F.when(c.isNull(), "urn:nopage").otherwise(F.concat(F.lit("urn:page:"), F.url_encode(c.cast("string"))))


def page_records(pages: DataFrame) -> DataFrame:
    """The records to write for pages (page_id, url, html): record_id, uri, refers_to, digest and payload.

    A null html is an empty payload. Of the pages with equal payloads of at least ``LEAST`` bytes that with the smallest page_id is the response and the others
    revisit it; rows that repeat that page_id are responses too, null page_ids come last, and pages that have none at all are all responses. Other columns are not read.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.expr("X''"))
    d = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    same = d.filter(F.octet_length("payload") >= LEAST).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
    same = written(same, "same-payloads")
    often = same.filter(F.col("n") > OFTEN).select("digest", F.col("first").alias("often"))
    rest = same.filter(F.col("n") <= OFTEN).select(F.col("digest").alias("key"), "first")
    # Digests of very many rows are few, at most one for each OFTEN rows; their rows get keys of their own, so that the other join has no hot key.
    d = d.join(F.broadcast(often), "digest", "left").withColumn("key", F.when(F.col("often").isNull(), F.col("digest")).otherwise(F.unhex(F.sha2(F.col("page_id").cast("string"), 256))))
    d = d.withColumn("key", F.coalesce("key", F.unhex(F.sha2(F.coalesce(F.col("url"), F.lit("")), 256))))
    d = d.join(small_bytes_or_not(rest, SMALL), "key", "left").withColumn("first", F.coalesce("often", F.when(F.col("key") == F.col("digest"), F.col("first"))))
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    refers = F.when(revisit, page_id_uri(F.col("first")))
    return d.select(page_id_uri(F.col("page_id")).alias("record_id"), F.col("url").alias("uri"), refers.alias("refers_to"), F.lower(F.hex("digest")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"), F.when(~revisit, F.col("payload")).alias("payload"))


def record_bytes(record_id: str, uri: str | None, refers_to: str | None, digest: str, size: int, payload: bytes | None, date: str = DATE) -> bytes:
    """A response record, or a revisit record of the same HTTP header if it refers to one."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if uri is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)))
    if refers_to:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    else:
        block += payload or b""
    fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + END


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(records: DataFrame, folder: str, size: int = ARCHIVE) -> DataFrame:
    """Write records (see page_records) as archives of a gzip member a record; gives file, bytes and records of each archive."""

    def run(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        # Two attempts of a task never share a name.
        name = f"{folder}/part-{context.partitionId():05d}-{uuid.uuid4().hex}"
        fs, _ = _open(folder)
        fs.create_dir(_open(folder)[1], recursive=True)
        out, at, n, k, put = None, "", 0, 0, 0
        for b in batches:
            for x in zip(*(b.column(c) for c in ("record_id", "uri", "refers_to", "digest", "bytes", "payload")), strict=True):
                if out is None:
                    at, n, put, k = f"{name}-{k:04d}.warc.gz", 0, 0, k + 1
                    out = fs.open_output_stream(_open(at)[1], compression=None)
                data = record_bytes(*(v.as_py() for v in x))
                m = member(data)
                out.write(m)
                n, put, whole = n + 1, put + len(m), len(data)
                if put >= size:
                    out.close()
                    out = None
                    yield _archive(at, put, n)
        if out is not None:
            out.close()
            yield _archive(at, put, n)

    with short_batches(records.sparkSession):
        return written(records.mapInArrow(run, "file string, bytes long, records long"), "archives")


def _archive(file: str, size: int, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], ["file", "bytes", "records"])


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """file and bytes of the files that a path or pattern names."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


class Broken(ValueError):
    """A failed check."""


def _digests_hold(named: str, data: bytes) -> bool:
    """Whether a digest field (algorithm:value, in hexadecimal or base 32) fits the data; an unknown algorithm says nothing."""
    algorithm, _, value = named.strip().partition(":")
    algorithm = algorithm.lower().replace("-", "")
    if algorithm not in ("md5", "sha1", "sha256", "sha512"):
        return True
    found = hashlib.new(algorithm, data)
    return value.lower() == found.hexdigest() or value.upper().rstrip("=") == base64.b32encode(found.digest()).decode().rstrip("=")


def _parsed(head: bytes) -> tuple[dict[str, str], int]:
    """The fields of a header (from the version line up to the empty line) and the length of its block."""
    if not _VERSION.match(head):
        raise Broken("no version line")
    fields: dict[str, str] = {}
    for line in re.sub(r"\r?\n[ \t]+", " ", head.decode("utf-8", "replace")).strip().splitlines()[1:]:
        key, colon, value = line.partition(":")
        if not colon:
            raise Broken("bad header line")
        fields.setdefault(key.strip().lower(), value.strip())
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")):
        raise Broken("bad length")
    return fields, int(fields["content-length"])


def _header_end(data: bytes) -> int:
    at = data.find(END)
    if at < 0:
        raise Broken("no end of header")
    return at + len(END)


class Archive:
    """A file that is read by places; records are plain or gzip members, each for itself."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def bytes_at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def next_start(self, at: int, end: int) -> int:
        """The next place from at, and before end, that looks like the start of a record; end if there is none."""
        while at < end:
            data = self.bytes_at(at, CHUNK)
            m = _START.search(data)
            if m:
                return min(at + m.start(), end)
            if at + len(data) >= self.size:
                break
            at += max(1, len(data) - 16)
        return end

    def record(self, at: int) -> tuple[int, dict[str, str], bytes]:
        """The end of the record at a place, its fields and block; Broken if a check fails."""
        first = self.bytes_at(at, 16)
        if first.startswith(_MAGIC):
            end, data = self._member(at)
            head = _header_end(data)
            fields, n = _parsed(data[:head])
            if data[head + n :] != END:
                raise Broken("member and length differ")
            block = data[head : head + n]
        elif _VERSION.match(first):
            data = self.bytes_at(at, CHUNK)
            if END not in data:
                data = self.bytes_at(at, HEADER)
            head = _header_end(data)
            fields, n = _parsed(data[:head])
            end = at + head + n + len(END)
            if end > self.size:
                raise Broken("record runs past the end of the file")
            if self.bytes_at(end - len(END), len(END)) != END:
                raise Broken("no record end")
            block = data[head : head + n] if len(data) >= head + n else self.bytes_at(at + head, n)
        else:
            raise Broken("no record start")
        if "warc-block-digest" in fields and not _digests_hold(fields["warc-block-digest"], block):
            raise Broken("block digest differs")
        return end, fields, block

    def _member(self, at: int) -> tuple[int, bytes]:
        z, parts, size, most, place = zlib.decompressobj(31), [], 0, None, at
        try:
            while not z.eof:
                data = self.bytes_at(place, CHUNK)
                if not data:
                    raise Broken("member runs past the end of the file")
                place += len(data)
                while data and not z.eof:
                    parts.append(z.decompress(data, 4 * CHUNK))
                    size += len(parts[-1])
                    if most is None and (size >= 16 or z.eof):
                        so_far = b"".join(parts)
                        if not _VERSION.match(so_far):
                            raise Broken("member holds no record")
                        if END in so_far or size > HEADER or z.eof:
                            head = _header_end(so_far)
                            most = head + _parsed(so_far[:head])[1] + len(END)
                        parts = [so_far]
                    if most is not None and size > most:
                        raise Broken("member and length differ")
                    data = z.unconsumed_tail
        except zlib.error as e:
            raise Broken(f"member: {e}") from None
        return place - len(z.unused_data), b"".join(parts)


def _row(file: str, at: int, end: int, fields: dict[str, str], block: bytes, keep: bool) -> tuple:
    kind, named = fields.get("warc-type"), fields.get("warc-payload-digest", "")
    payload, size, digest = None, None, named.partition(":")[2].lower() if named.lower().replace("-", "").startswith("sha256:") else None
    if kind in ("response", "revisit", "request") and block.startswith((b"HTTP/", b"GET ", b"POST ")):
        head, _, payload = block.partition(END)
        if kind == "revisit":
            payload = None
            m = re.search(rb"(?im)^content-length:[ \t]*(\d{1,18})", head)
            size = int(m[1]) if m else None
    elif kind != "revisit":
        payload = block
    if payload is not None:
        if named and not _digests_hold(named, payload):
            raise Broken("payload digest differs")
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    bare = lambda k: fields[k].strip("<>") if k in fields else None
    return (file, at, end - at, None, kind, bare("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"), bare("warc-refers-to"), digest, size, payload if keep else None)


def scanned(archive: Archive, file: str, lo: int, hi: int, keep: bool = True):
    """The rows of the records and failed tries that start in [lo, hi)."""
    at = lo if lo == 0 else archive.next_start(lo, hi)
    while at < hi:
        try:
            end, fields, block = archive.record(at)
            yield _row(file, at, end, fields, block, keep)
            at = end
        except Broken as e:
            yield (file, at, 0, str(e), *[None] * 8)
            at = archive.next_start(at + 1, hi)


def read_archives(files: DataFrame, payload: bool = True, split: int = RANGE) -> DataFrame:
    """A row for each record of the archives (file, bytes), and one with an error for each failed try.

    Plain and gzip archives may be mixed. A record is held whole by its task, never a range; null sizes and empty files give no rows. ``payload`` false leaves the payloads out.
    Payload digests and bytes are those of the full payload; a revisit carries what its header says.
    """
    ranges = files.select("file", "bytes", F.explode(F.sequence(F.lit(0), F.expr(f"(bytes - 1) div {split}"))).alias("k")).filter("bytes > 0")

    def run(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 7, pa.int64(), pa.binary()]
        names = [x.split()[0] for x in RECORD.split(", ")]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for b in batches:
            for file, size, k in zip(*(b.column(c).to_pylist() for c in ("file", "bytes", "k")), strict=True):
                fs, name = _open(file)
                with fs.open_input_file(name) as f:
                    rows, held = [], 0
                    for row in scanned(Archive(f, size), file, k * split, min(size, (k + 1) * split), payload):
                        rows.append(row)
                        held += len(row[-1] or b"")
                        if len(rows) == 1000 or held > 8_000_000:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    n = max(1, files.sparkSession.sparkContext.defaultParallelism)
    return ranges.repartition(4 * n, "file", "k").mapInArrow(run, RECORD)


def valid_records(rows: DataFrame) -> DataFrame:
    """The records among the rows of read_archives. What lies inside an earlier record (an archive within an archive, met by the task of a later range) is none."""
    by = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    good = rows.filter("error is null")
    covered = F.coalesce(F.max(F.col("offset") + F.col("length")).over(by), F.lit(0))
    return good.withColumn("_covered", covered).filter("offset >= _covered").drop("_covered")


def quarantined(rows: DataFrame, files: DataFrame) -> DataFrame:
    """file, start, end and reason of the gaps: the bytes of files (file, bytes) outside all valid records, with the first failed check in each."""
    good = valid_records(rows.select("file", "offset", "length", "error")).select("file", F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("end"))
    marks = good.unionByName(files.select("file", F.col("bytes").alias("start"), F.col("bytes").alias("end")))
    before = F.coalesce(F.lag("end").over(Window.partitionBy("file").orderBy("start", "end")), F.lit(0))
    gaps = marks.select("file", before.alias("start"), F.col("start").alias("end")).filter("start < end")
    tries = rows.filter("error is not null").select(F.col("file").alias("_file"), F.col("offset").alias("_at"), F.col("error").alias("_error"))
    inside = F.expr("file = _file and _at >= start and _at < end")
    return gaps.join(tries, inside, "left").groupBy("file", "start", "end").agg(F.min_by("_error", "_at").alias("reason"))


def page_archive(pages: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of the pages, as read back from the archives written for them in the folder.

    See page_records() for nulls, ties and repeated rows; very long pages are records of their length; an empty table gives no archives and no rows.
    """
    kind = pages.schema["page_id"].dataType
    rows = valid_records(written(read_archives(write_archives(page_records(pages), folder), payload=False), "archived"))
    id_of = lambda c: F.when(c.startswith("urn:page:"), F.url_decode(F.substring(c, 10, 2**30))).cast(kind)
    return rows.select(id_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), id_of(F.col("refers_to")).alias("refers_to"))


#: DuckDB SQL for page_archive(pages).
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS b, sha256(h) AS s FROM p),
f AS (SELECT *, CASE WHEN b >= 100 THEN min(page_id) OVER (PARTITION BY s) END AS first FROM d)
SELECT page_id, b AS payload_bytes, s AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""
