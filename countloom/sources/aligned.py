"""Binary sequencing files as Spark data sources, planned as partitions: BAM by windows of its index, base-call (BCL) folders by tile.

Register with ``register(spark)``, then ``spark.read.format("bam").load(path)`` and ``spark.read.format("bcl").option("lane", 1).option("read", 1).load(run_folder)``.
Paths are anything that pyarrow's file systems open.
"""

from __future__ import annotations

import re
import struct
import xml.etree.ElementTree as ElementTree
import zlib
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

#: Places of a window.
WINDOW = 10_000_000
#: The letters of four-bit bases and of CIGAR operations, and those operations that move along the reference.
BASES, OPERATIONS, MOVING = "=ACMGRSVTWYHKDBN", "MIDNSHP=X", "MDN=X"
BAM = "name string, flag int, chrom string, strand string, pos long, end long, mapq int, cigar string, seq string, qual string, n_mappings int"
BCL = "name string, tile int, cluster long, seq string, qual string, passed boolean"


def register(spark: SparkSession) -> None:
    """Make the formats known to a session, with filters pushed to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)
    spark.dataSource.register(BclSource)


def _file_system(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _whole(fs, path: str) -> bytes:
    with fs.open_input_stream(path, compression=None) as f:
        return f.read()


class Blocks:
    """The uncompressed bytes of a BGZF file from a virtual offset (block start << 16 | place in the block) on; one block is held at a time."""

    def __init__(self, file, at: int = 0):
        self.file, self.next, self.data, self.place = file, at >> 16, b"", 0
        self.block = self.next
        if self._load():
            self.place = at & 0xFFFF

    def _load(self) -> bool:
        self.file.seek(self.next)
        head = self.file.read(12)
        if len(head) < 12:
            return False
        if head[:4] != b"\x1f\x8b\x08\x04":
            raise ValueError(f"no BGZF block at {self.next}")
        extra, size, k = self.file.read(struct.unpack("<H", head[10:])[0]), None, 0
        while k + 4 <= len(extra):
            n = struct.unpack_from("<H", extra, k + 2)[0]
            if extra[k : k + 2] == b"BC":
                size = struct.unpack_from("<H", extra, k + 4)[0] + 1
            k += 4 + n
        if size is None:
            raise ValueError(f"no size in the BGZF block at {self.next}")
        body = self.file.read(size - 12 - len(extra))
        self.block, self.next, self.place = self.next, self.next + size, 0
        self.data = zlib.decompress(body[:-8], -15)
        if zlib.crc32(self.data) != struct.unpack("<I", body[-8:-4])[0]:
            raise ValueError(f"bad checksum of the BGZF block at {self.block}")
        return True

    def offset(self) -> int:
        """The virtual offset of the next byte."""
        return self.block << 16 | self.place if self.place < len(self.data) else self.next << 16

    def read(self, n: int) -> bytes:
        """The next n bytes, fewer only at the end of the file."""
        out = b""
        while len(out) < n:
            if self.place == len(self.data) and not self._load():
                break
            part = self.data[self.place : self.place + n - len(out)]
            self.place += len(part)
            out += part
        return out


def _references(blocks: Blocks) -> list[tuple[str, int]]:
    if blocks.read(4) != b"BAM\1":
        raise ValueError("no BAM file")
    blocks.read(struct.unpack("<i", blocks.read(4))[0])
    out = []
    for _ in range(struct.unpack("<i", blocks.read(4))[0]):
        name = blocks.read(struct.unpack("<i", blocks.read(4))[0])[:-1].decode()
        out.append((name, struct.unpack("<i", blocks.read(4))[0]))
    return out


def _index(data: bytes) -> list[tuple[dict[int, list[tuple[int, int]]], list[int]]]:
    """Of each reference: the chunks of its bins, and the least offset of each stretch of 16384 places."""
    if data[:4] != b"BAI\1":
        raise ValueError("no BAM index")
    at, out = 8, []
    for _ in range(struct.unpack_from("<i", data, 4)[0]):
        bins, n = {}, struct.unpack_from("<i", data, at)[0]
        at += 4
        for _ in range(n):
            number, chunks = struct.unpack_from("<Ii", data, at)
            at += 8
            bins[number] = [struct.unpack_from("<QQ", data, at + 16 * i) for i in range(chunks)]
            at += 16 * chunks
        n = struct.unpack_from("<i", data, at)[0]
        out.append((bins, list(struct.unpack_from(f"<{n}Q", data, at + 4))))
        at += 4 + 8 * n
    return out


def _chunks(bins: dict, linear: list[int], start: int, end: int) -> list[tuple[int, int]]:
    """The merged chunks that may hold reads between two places."""
    last = end - 1
    numbers = [0] + [first + i for first, shift in ((1, 26), (9, 23), (73, 20), (585, 17), (4681, 14)) for i in range(start >> shift, (last >> shift) + 1)]
    least = linear[min(start >> 14, len(linear) - 1)] if linear else 0
    out: list[tuple[int, int]] = []
    for a, b in sorted(c for n in numbers for c in bins.get(n, ()) if c[1] > least):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@dataclass
class Window(InputPartition):
    """The reads of a file that start between two places of a reference; without chunks, the whole file."""

    file: str
    names: tuple[str, ...]
    reference: int | None = None
    start: int = 0
    end: int = 0
    chunks: tuple[tuple[int, int], ...] | None = None

    def __post_init__(self):
        super().__init__((self.file, self.reference, self.start))


def _tag(data: bytes, name: bytes) -> int | None:
    """An integer tag of a read."""
    kinds, at = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}, 0
    while at + 3 <= len(data):
        key, kind = data[at : at + 2], chr(data[at + 2])
        at += 3
        if kind in "ZH":
            at = data.index(b"\0", at) + 1
        elif kind == "B":
            sub, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            at += 5 + n * struct.calcsize("<" + kinds[sub])
        else:
            if key == name and kind not in "Af":
                return struct.unpack_from("<" + kinds[kind], data, at)[0]
            at += struct.calcsize("<" + kinds[kind])
    return None


def parsed_read(data: bytes, names: tuple[str, ...]) -> tuple:
    """A row from an alignment record (without its length). Reads without a place have null chrom, pos and end; a chromosome's leading ``chr`` is dropped."""
    ref, pos, n_name, mapq, _, n_cigar, flag, n_seq = struct.unpack_from("<iiBBHHHi", data)
    at = 32
    name = data[at : at + n_name - 1].decode()
    at += n_name
    ops = [(x >> 4, OPERATIONS[x & 15]) for x in struct.unpack_from(f"<{n_cigar}I", data, at)]
    at += 4 * n_cigar
    packed = data[at : at + (n_seq + 1) // 2]
    seq = "".join(BASES[x >> 4] + BASES[x & 15] for x in packed)[:n_seq]
    at += len(packed)
    raw = data[at : at + n_seq]
    qual = None if raw[:1] == b"\xff" else "".join(chr(x + 33) for x in raw)
    chrom = names[ref].removeprefix("chr") if ref >= 0 else None
    placed = chrom is not None and pos >= 0
    moved = sum(n for n, o in ops if o in MOVING)
    return (name, flag, chrom if placed else None, "-" if flag & 16 else "+", pos if placed else None, pos + moved if placed else None, mapq, "".join(f"{n}{o}" for n, o in ops) or None, seq, qual, _tag(data[at + n_seq :], b"XM"))


class BamReader(DataSourceReader):
    def __init__(self, path: str, window: int):
        self.path, self.window = path, window
        self.chrom, self.low, self.high = None, 0, None

    def pushFilters(self, filters):
        """A chromosome and bounds of pos choose windows; Spark filters the rows again."""
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("chrom",) and isinstance(f, EqualTo):
                self.chrom = f.value
            elif column == ("pos",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value)
            elif column == ("pos",) and isinstance(f, (LessThan, LessThanOrEqual)):
                self.high = f.value + 1 if self.high is None else min(self.high, f.value + 1)
            elif column == ("pos",) and isinstance(f, EqualTo):
                self.low, self.high = max(self.low, f.value), f.value + 1
            yield f

    def partitions(self) -> list[Window]:
        from pyarrow.fs import FileSelector, FileType

        fs, name = _file_system(self.path)
        info = fs.get_file_info(name)
        files = [name] if info.type == FileType.File else sorted(f.path for f in fs.get_file_info(FileSelector(name)) if f.path.endswith(".bam"))
        out = []
        for file in files:
            with fs.open_input_file(file) as f:
                references = _references(Blocks(f))
            names = tuple(n for n, _ in references)
            index = next((p for p in (file + ".bai", file.removesuffix(".bam") + ".bai") if fs.get_file_info(p).type == FileType.File), None)
            if index is None:
                out.append(Window(file, names))
                continue
            for i, ((chrom, length), (bins, linear)) in enumerate(zip(references, _index(_whole(fs, index)), strict=True)):
                if self.chrom is not None and chrom.removeprefix("chr") != self.chrom:
                    continue
                for start in range(0, length, self.window):
                    end = min(length, start + self.window)
                    if end <= self.low or (self.high is not None and start >= self.high):
                        continue
                    if chunks := _chunks(bins, linear, start, end):
                        out.append(Window(file, names, i, start, end, tuple(chunks)))
        return out

    def read(self, part: Window):
        fs, _ = _file_system(self.path)
        with fs.open_input_file(part.file) as f:
            if part.chunks is None:
                blocks = Blocks(f)
                _references(blocks)
                while len(head := blocks.read(4)) == 4:
                    yield parsed_read(blocks.read(struct.unpack("<i", head)[0]), part.names)
                return
            for start, end in part.chunks:
                blocks = Blocks(f, start)
                while blocks.offset() < end and len(head := blocks.read(4)) == 4:
                    data = blocks.read(struct.unpack("<i", head)[0])
                    ref, pos = struct.unpack_from("<ii", data)
                    if ref == part.reference and part.start <= pos < part.end:
                        yield parsed_read(data, part.names)


class BamSource(DataSource):
    """Alignments of a BAM file or a folder of them. With an index, partitions are windows (option ``window``, places) and a read belongs to the one it starts in; reads without a place are then left out, as no window has them. Without, a file is one partition and has all its reads."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return BAM

    def reader(self, schema) -> BamReader:
        return BamReader(self.options["path"], int(self.options.get("window", WINDOW)))


@dataclass
class Tile(InputPartition):
    lane: str
    tile: int
    index: int
    run: str
    cycles: tuple[str | None, ...]

    def __post_init__(self):
        super().__init__((self.lane, self.tile))


class BclReader(DataSourceReader):
    def __init__(self, path: str, lane: int, read: int):
        self.path, self.lane, self.number = path.rstrip("/"), lane, read

    def partitions(self) -> list[Tile]:
        from pyarrow.fs import FileSelector, FileType

        fs, top = _file_system(self.path)
        parts = top.rstrip("/").rsplit("/", 1)[-1].split("_")
        if len(parts) < 4 or not parts[2].isdigit():
            raise ValueError("the run folder's name has no run number and flow cell")
        calls = f"{top}/Data/Intensities/BaseCalls"
        lane = f"{calls}/L{self.lane:03d}"
        if fs.get_file_info(lane).type != FileType.Directory:
            return []
        config = ElementTree.fromstring(_whole(fs, f"{calls}/config.xml"))
        spans = [(int(r.find(".//FirstCycle").text), int(r.find(".//LastCycle").text)) for r in config.iter("Reads") if int(r.get("Index")) == self.number]
        if not spans:
            return []
        tiles = {int(t.text) for x in config.iter("Lane") if x.get("Index") == str(self.lane) for t in x.iter("Tile")}
        listed = [f.path.rsplit("/", 1)[-1] for f in fs.get_file_info(FileSelector(lane))]
        newest: dict[int, int] = {}
        for m in filter(None, (re.fullmatch(r"C(\d+)\.(\d+)", n) for n in listed)):
            newest[int(m[1])] = max(int(m[2]), newest.get(int(m[1]), 0))
        found = sorted(int(m[1]) for n in listed if (m := re.fullmatch(rf"s_{self.lane}_(\d+)\.filter", n)) and int(m[1]) in tiles)
        cycles = tuple(f"{lane}/C{c}.{newest[c]}" if c in newest else None for c in range(spans[0][0], spans[0][1] + 1))
        return [Tile(lane, t, self.number, f"{parts[2]}_{parts[3]}", cycles) for t in found]

    def read(self, part: Tile):
        import numpy as np
        import pyarrow as pa
        from pyarrow.fs import FileType

        fs, _ = _file_system(self.path)
        columns = []
        for folder in part.cycles:
            name = f"{folder}/s_{self.lane}_{part.tile}.bcl"
            for path in (name, name + ".gz") if folder else ():
                if fs.get_file_info(path).type == FileType.File:
                    data = _whole(fs, path)
                    columns.append(np.frombuffer(zlib.decompress(data, 31) if path.endswith(".gz") else data, np.uint8)[4:])
                    break
        n = max(map(len, columns), default=0)
        # What a cycle lacks counts as base A of quality 2.
        calls = np.stack([np.append(c, np.full(n - len(c), 8, np.uint8)) for c in columns]) if columns else np.zeros((0, 0), np.uint8)
        passed = np.frombuffer(_whole(fs, f"{part.lane}/s_{self.lane}_{part.tile}.filter"), np.uint8)[12:] == 1
        passed = np.append(passed[:n], np.zeros(max(0, n - len(passed)), bool))
        for lo in range(0, n, 10_000):
            some = calls[:, lo : lo + 10_000].T
            seq = [x.tobytes().decode() for x in np.frombuffer(b"ACGT", np.uint8)[some & 3]]
            qual = [x.tobytes().decode() for x in (some >> 2) + np.uint8(33)]
            k = np.arange(lo, lo + len(seq))
            names = [f"Run{part.run}_L{self.lane}_R{part.index}_T{part.tile}_C{i}" for i in k]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.full(len(k), part.tile, np.int32)), pa.array(k), pa.array(seq), pa.array(qual), pa.array(passed[lo : lo + len(k)])], [x.split()[0] for x in BCL.split(", ")])


class BclSource(DataSource):
    """The reads of a lane (options ``lane`` and ``read``) from base-call files, a partition for each tile that has a filter file and stands in config.xml; of rerun cycles the last counts, cycles without files are left out. A tile's calls are held at once."""

    @classmethod
    def name(cls) -> str:
        return "bcl"

    def schema(self) -> str:
        return BCL

    def reader(self, schema) -> BclReader:
        return BclReader(self.options["path"], int(self.options.get("lane", 1)), int(self.options.get("read", 1)))
