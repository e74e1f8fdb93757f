"""Repeated substrings: every byte that a string of ``length`` bytes covers which also starts elsewhere.

Suffixes are compared block by block. A sequential difference-cover construction keeps the ranks of a sample of places
such that any two suffixes have a sampled place at the same distance ahead. Here the sample
is chosen by content (the least hash of the ``GRAM``-byte strings inside each window of ``length`` bytes):
equal windows have their sampled place, the anchor, at the same distance, and one place in about
``(length - GRAM) / 2`` is sampled instead of one in the square root of the period. An anchor's
hash is its rank: anchors whose hash occurs once settle their suffixes at once. The suffixes
around the other anchors go to buckets by the anchor's hash; a bucket is sorted at a time, by
(anchor, distance, name of the window), and equal neighbours are repeated strings. Buckets with very
many suffixes are sorted by the whole cluster instead of in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_or_not, written

LENGTH, GRAM = 200, 32
#: Window starts looked at together in one text, and segments of a bucket that one task sorts at most.
STRETCH, BUCKET = 1 << 18, 20_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(7).integers(1, 2**63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


_UP, _DOWN = _powers(_ODD, STRETCH + 2 * LENGTH), _powers(_BACK, STRETCH + 2 * LENGTH)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def names(data: np.ndarray, size: int, table: int) -> np.ndarray:
    """64-bit names of all strings of so many bytes in data."""
    n = len(data) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[table][data] * _UP[: len(data)], out=total[1:])
    return mixed((total[size:] - total[:n]) * _DOWN[:n])


def anchors(data: np.ndarray, length: int, first: int = 0):
    """Anchors of the window starts of data: arrays of places, hashes, first and last window start, all moved by first."""
    grams = names(data, GRAM, 0)
    windows, inner = len(data) - length + 1, length - GRAM + 1
    # The place in the low bits makes the leftmost of equal strings the least.
    low = np.uint64((1 << 20) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= inner:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[:windows], least[inner - width : inner - width + windows])
    own = (least & low).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    end = np.concatenate([start[1:], [windows]]) - 1
    place = own[start]
    return place + first, grams[place], start + first, end + first


def all_anchors(data: np.ndarray, length: int):
    """anchors() over a text of any length, a stretch of window starts at a time."""
    for lo in range(0, len(data) - length + 1, STRETCH):
        yield anchors(data[lo : lo + STRETCH + length - 1], length, lo)


def _hashes(batches, length: int, with_place: bool):
    for b in batches:
        ids = b.column("id").to_pylist()
        texts = b.column("text").cast(pa.binary())
        out = []
        for i, x in zip(ids, texts, strict=True):
            data = np.frombuffer(x.as_buffer(), np.uint8) if x.is_valid else np.empty(0, np.uint8)
            for place, gram, lo, hi in all_anchors(data, length):
                out.append((i, place, gram, lo, hi))
        n = [len(x[1]) for x in out]
        gram = np.concatenate([np.empty(0, np.uint64), *[x[2] for x in out]]).view(np.int64)
        place = np.concatenate([np.empty(0, np.int64), *[x[1] for x in out]])
        if not with_place:
            own = np.repeat(np.array([int.from_bytes(x[0][:8], "little") for x in out], np.uint64), n)
            occurrence = mixed(own + place.astype(np.uint64) * _ODD).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(occurrence)], ["gram", "occurrence"])
        else:
            own = pa.array([x[0] for x in out], pa.binary()).take(pa.array(np.repeat(np.arange(len(out)), n)))
            yield pa.RecordBatch.from_arrays([pa.array(gram), own, pa.array(place)], ["gram", "id", "place"])


def _segments(batches, length: int):
    """For each text and the places of its repeated anchors: the bytes of the windows that the anchor has, with the first start and the anchor's distance."""
    for b in batches:
        for lo in range(0, b.num_rows, 64):
            part = b.slice(lo, 64)
            rows: list[tuple] = []
            for i, x, at in zip(part.column("id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), part.column("places").to_pylist(), strict=True):
                wanted = np.array(sorted(at), np.int64)
                for place, gram, first, last in all_anchors(np.frombuffer(x, np.uint8), length):
                    for k in np.flatnonzero(np.isin(place, wanted)).tolist():
                        s, e = int(first[k]), int(last[k])
                        rows.append((gram[k].view(np.int64), i, s, int(place[k]) - s, x[s : e + length]))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["gram", "id", "start", "distance", "bytes"])


def _named(t: pa.Table, length: int):
    """The windows of segments: segment number, start in the text, and two 64-bit names that hold anchor, distance and bytes."""
    t = t.combine_chunks()
    data = np.frombuffer(b"".join(t.column("bytes").to_pylist()), np.uint8)
    sizes = np.array([len(x) for x in t.column("bytes").to_pylist()], np.int64)
    ends = np.cumsum(sizes)
    count = sizes - length + 1
    seg = np.repeat(np.arange(len(sizes)), count)
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(ends - sizes, count) + step
    both = []
    for table in (0, 1):
        parts = [names(data[lo : lo + STRETCH + length - 1], length, table) for lo in range(0, len(data) - length + 1, STRETCH)]
        both.append(np.concatenate([np.empty(0, np.uint64), *parts])[at])
    distance = t.column("distance").to_numpy().astype(np.int64)[seg] - step
    gram = t.column("gram").to_numpy().view(np.uint64)[seg]
    own = mixed(gram + distance.astype(np.uint64) * _ODD)
    return seg, t.column("start").to_numpy()[seg] + step, own ^ both[0], both[1] + own * _ODD


def _runs(t: pa.Table, seg: np.ndarray, start: np.ndarray, length: int):
    """Spans (id, first, end) of the given windows, neighbours joined; windows are in order within a segment."""
    if not len(seg):
        return pa.array([], pa.binary()), np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(seg)]]) - 1
    return t.column("id").combine_chunks().take(pa.array(seg[first])), start[first], start[last] + length


def _sorted_buckets(batches, length: int):
    """Whole buckets, one sort at a time over as many as come together; rows come ordered by gram."""

    def spans(t: pa.Table):
        seg, start, one, two = _named(t, length)
        order = np.argsort(one, kind="stable")
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        repeated = np.zeros(len(one), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        ids, lo, hi = _runs(t, seg[repeated], start[repeated], length)
        return pa.RecordBatch.from_arrays([ids, pa.array(lo), pa.array(hi)], ["id", "first", "last"])

    carry = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([carry, t]) if carry is not None else t
        gram = t.column("gram").to_numpy()
        if not len(gram):
            continue
        cut = int(np.argmax(gram == gram[-1]))  # the last bucket may go on in the next batch
        carry = t.slice(cut)
        if cut:
            yield spans(t.slice(0, cut))
    if carry is not None and carry.num_rows:
        yield spans(carry)


def _window_rows(batches, length: int):
    for b in batches:
        for lo in range(0, b.num_rows, 2_000):
            t = pa.Table.from_batches([b.slice(lo, 2_000)])
            seg, start, one, two = _named(t, length)
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), t.column("id").combine_chunks().take(pa.array(seg)), pa.array(start)], ["one", "two", "id", "start"])


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _cut(batches):
    """What is left of texts without their spans."""
    for b in batches:
        removed, n, left, digests = [], [], [], []
        for x, spans in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("spans").to_pylist(), strict=True):
            runs, parts, at = merged([(s["first"], s["last"]) for s in spans]), [], 0
            for lo, hi in runs:
                parts.append(x[at:lo])
                at = hi
            kept = b"".join([*parts, x[at:]])
            left.append(kept)
            digests.append(hashlib.sha256(kept).hexdigest())
            removed.append(len(x) - len(kept))
            n.append(len(runs))
        keep = [c for c in b.schema.names if c not in ("text", "spans")]
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(digests), pa.array(left, pa.binary())], [*keep, "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_spans(texts: DataFrame, length: int, most: int) -> DataFrame:
    """id and spans (array of first, last, end exclusive) of the distinct texts (id, text) in which a window occurs that starts elsewhere too."""
    texts = texts.filter(F.octet_length("text") >= length)
    grams = texts.mapInArrow(lambda x: _hashes(x, length, False), "gram long, occurrence long")
    repeated = grams.groupBy("gram").agg(F.min("occurrence").alias("x"), F.max("occurrence").alias("y")).filter("x != y").select("gram")
    places = texts.mapInArrow(lambda x: _hashes(x, length, True), "gram long, id binary, place long")
    places = places.join(repeated, "gram", "left_semi").groupBy("id").agg(F.collect_set("place").alias("places"))
    places = written(places, "repeat-places")
    chosen = texts.join(places, "id")
    segments = chosen.select("id", "text", "places").mapInArrow(lambda x: _segments(x, length), "gram long, id binary, start long, distance int, bytes binary")
    segments = written(segments, "repeat-segments")
    hot = written(segments.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > BUCKET).select("gram"), "repeat-hot")
    # Each row stands for over BUCKET segments.
    hot_rows = hot.count()
    cool = segments.join(small_or_not(hot, hot_rows, most), "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
    found = cool.mapInArrow(lambda x: _sorted_buckets(x, length), "id binary, first long, last long")
    if hot_rows:
        windows = segments.join(small_or_not(hot, hot_rows, most), "gram", "left_semi").mapInArrow(lambda x: _window_rows(x, length), "one long, two long, id binary, start long")
        twice = windows.groupBy("one", "two").agg(F.min(F.xxhash64("id", "start")).alias("x"), F.max(F.xxhash64("id", "start")).alias("y")).filter("x != y")
        found = found.unionByName(windows.join(twice.select("one", "two"), ["one", "two"], "left_semi").select("id", F.col("start").alias("first"), (F.col("start") + length).alias("last")))
    return found.groupBy("id").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def without_repeats(docs: DataFrame, length: int = LENGTH, most: int = 1_000_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) of each document.

    Texts are UTF-8 bytes, null ones empty; those shorter than length lose nothing. Documents with equal texts of at
    least that length lose all. Repeated rows are documents with equal texts; an empty table gives an empty
    result. ``most`` bounds the rows of what is broadcast (texts with copies, very frequent anchors);
    beyond it Spark shuffles. Columns other than doc_id and text are not read.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("id", F.unhex(F.md5("text")))
    copies = d.groupBy("id").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep")).filter("copies > 1")
    copies = written(copies, "repeat-copies")
    copies = small_or_not(copies, copies.count(), most)
    d = d.join(copies, "id", "left")
    one = d.filter(F.col("copies").isNull() | F.col("doc_id").eqNullSafe(F.col("rep"))).select("id", "text")
    spans = written(repeated_spans(one, length, most), "repeat-spans")
    d = d.withColumn("n_bytes", F.octet_length("text").cast("long"))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    d = d.withColumn("whole", F.coalesce(whole, F.lit(False))).join(spans, "id", "left")
    cut = d.filter("not whole and spans is not null").select("doc_id", "n_bytes", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = cut.mapInArrow(_cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    rest = d.filter("whole or spans is null")
    kept = F.when(F.col("whole"), F.lit("")).otherwise(F.col("text"))
    rest = rest.select("doc_id", "n_bytes", F.when(F.col("whole"), F.col("n_bytes")).otherwise(0).alias("n_removed"), F.col("whole").cast("long").alias("n_spans"), F.sha2(kept.cast("binary"), 256).alias("kept_sha256"), kept.cast("binary").alias("kept"))
    return cut.unionByName(rest)
