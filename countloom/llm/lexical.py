"""Ranked lexical search over a bit-sliced impact index.

The impact of a term on a document is ``1000000000 * tf div (1000 * tf + 8 * m)``, an integer of 20 bits, where m is the document's length in
percent of the mean, softened. The index holds, for each block of documents and each of its terms, the documents that have the term and
one bitmap for each bit of their impacts. A block is what one task reads in a row, up to a number of documents and of bytes, so that building needs no
shuffle. Inside a block documents stand in order of their ids.

A search adds bitmaps: a term's weight is a sum of powers of two, and for each of them the term's slices are added to the item's slices that
many places higher, by carry-save arithmetic on whole words of 64 documents. The k best documents of a block come from its sums by going down from the most
significant slice: of the documents that are still in the race those with the bit are in, if they aren't more than the places left; else the race goes on among them.
Each block gives at most k documents of an item, with exact scores, and the best k of these are the item's.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import UPPER, short_batches, small_bytes_or_not, written

#: A term: a maximal run of digits, letters and code points above 127. On lower-cased UTF-8 bytes, and as a pattern of code points.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of an impact, which lies below 1000000.
BITS = 20
#: A block's documents (positions have 16 bits) and bytes of text.
BLOCK, BYTES = 8192, 16_000_000
#: Items that are searched together in a block.
ITEMS = 256
#: Bytes of the items' terms that are broadcast; beyond it they are joined by shuffle.
SMALL = 16_000_000


def _terms(text: bytes | None) -> list[bytes]:
    return _TERM.findall(text.lower()) if text else []  # bytes: A-Z only


def _sizes(batches):
    for b in batches:
        n = [len(_terms(x)) for x in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([sum(x > 0 for x in n)], pa.int64()), pa.array([sum(n)], pa.int64())], ["docs", "terms"])


def packed_slices(impacts: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of each run of impacts, least bit first, without gaps inside a run; and the byte at which each run starts, with the end."""
    ends = np.concatenate([[0], np.cumsum(-(-counts * BITS // 8))])
    bits = np.zeros(ends[-1] * 8, np.uint8)
    place = np.repeat(ends[:-1] * 8 - starts, counts) + np.arange(len(impacts))
    step = np.repeat(counts, counts)
    for b in range(BITS):
        bits[place + b * step] = impacts >> b & 1
    return np.packbits(bits, bitorder="little"), ends


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _index_block(block: int, ids: list, texts: list[np.ndarray], names: dict[bytes, int], docs: int, terms: int, kind: pa.DataType):
    """The index rows of a block: one with its documents (and no term), and one for each term."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
    n = np.array([len(texts[i]) for i in order], np.int64)
    m = 100 - 75 + 75 * n * docs // terms
    key, tf = np.unique((np.concatenate([texts[i] for i in order]) << 16) | np.repeat(np.arange(len(order)), n), return_counts=True)
    at = key & 0xFFFF
    impacts = 10**9 * tf // (1000 * tf + 8 * m[at])
    counts = np.bincount(key >> 16, minlength=len(names))
    starts = np.cumsum(counts) - counts
    slices, ends = packed_slices(impacts, starts, counts)
    columns = [
        pa.array(np.full(len(names), block)), pa.array(list(names), pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64)),
        _binaries(at.astype("<u2"), 2 * np.append(starts, len(at))), _binaries(slices, ends), pa.nulls(len(names), pa.list_(kind)),
    ]
    labels = ["block", "term", "n", "at", "slices", "docs"]
    head = [[block], [None], [len(order)], [None], [None], [[ids[i] for i in order]]]
    yield pa.RecordBatch.from_arrays([pa.array(x, c.type) for x, c in zip(head, columns, strict=True)], labels)
    t = pa.RecordBatch.from_arrays(columns, labels)
    for lo in range(0, len(names), 20_000):
        yield t.slice(lo, 20_000)


def impact_index(docs: DataFrame) -> DataFrame:
    """The index of docs (doc_id, text), written to the shared folder: block, term, n, at, slices and docs.

    Every term of every whole text is indexed; a null or empty text has no terms and is in no block. Repeated rows are documents of their own, a null doc_id
    is the last in order, and a text longer than a block is a block by itself. An empty table gives an empty index. Other columns are not read.
    """
    spark, d = docs.sparkSession, docs.select("doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()

    with short_batches(spark):
        total = d.select("text").mapInArrow(_sizes, "docs long, terms long").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
        n_docs, n_terms = total.docs or 0, total.terms or 0

        def run(batches):
            from pyspark import TaskContext

            block = TaskContext.get().partitionId() << 32
            ids, texts, size, names = [], [], 0, defaultdict(int)
            names.default_factory = names.__len__
            for b in batches:
                doc_ids = b.column("doc_id")
                for name, text in zip(doc_ids.to_pylist(), b.column("text").cast(pa.binary()), strict=True):
                    raw = text.as_py()
                    terms = _terms(raw)
                    if not terms:
                        continue
                    if ids and (len(ids) == BLOCK or size + len(raw) > BYTES):
                        yield from _index_block(block, ids, texts, names, n_docs, n_terms, doc_ids.type)
                        block, size = block + 1, 0
                        ids.clear(), texts.clear(), names.clear()
                    ids.append(name)
                    texts.append(np.fromiter(map(names.__getitem__, terms), np.int64, len(terms)))
                    size += len(raw)
            if ids:
                yield from _index_block(block, ids, texts, names, n_docs, n_terms, doc_ids.type)

        return written(d.mapInArrow(run, f"block long, term string, n long, at binary, slices binary, docs array<{kind}>"), "impact-index")


def added(sums: np.ndarray, carries: np.ndarray, slices: np.ndarray, up: int) -> None:
    """Carry-save: sums + carries goes up by slices * 2^up. Row i of each holds the bits of weight 2^i."""
    s, c = sums[up:], carries[up:]
    either, both = s ^ c, s & c
    k = len(slices)
    both[:k] |= either[:k] & slices
    either[:k] ^= slices
    sums[up:] = either
    carries[up] = 0
    carries[up + 1 :] = both[:-1]


def settled(sums: np.ndarray, carries: np.ndarray) -> np.ndarray:
    """The slices of sums + carries, by a carry that ripples upwards."""
    out, carry = np.empty_like(sums), np.zeros_like(sums[0])
    for i, (s, c) in enumerate(zip(sums, carries, strict=True)):
        either = s ^ c
        out[i] = either ^ carry
        carry = s & c | either & carry
    return out


def _positions(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def top(slices: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions and values of the k largest values above 0, from the most significant slice down; of equal values the first positions."""
    chosen, race, left = np.zeros_like(slices[0]), np.bitwise_or.reduce(slices, axis=0), k
    for s in slices[::-1]:
        ahead = race & s
        n = int(np.bitwise_count(ahead).sum())
        if n > left:
            race = ahead
        else:
            chosen |= ahead
            race, left = race & ~s, left - n
            if not left:
                break
    at = np.concatenate([_positions(chosen), _positions(race)[:left]])
    word, bit = at // 64, (at % 64).astype(np.uint64)
    values = ((slices[:, word] >> bit & np.uint64(1)).astype(np.int64) << np.arange(len(slices))[:, None]).sum(axis=0)
    order = np.lexsort((at, -values))
    return at[order], values[order]


def _searcher(k: int):
    def run(t: pa.Table) -> pa.Table:
        heads = [x for x in t.column("docs").to_pylist() if x is not None]
        kind = t.schema.field("docs").type.value_type
        out: list[tuple[list, list, list]] = []
        if heads:
            docs, width = heads[0], -(-len(heads[0]) // 64)
            at, raw, uses = (t.column(c).to_pylist() for c in ("at", "slices", "uses"))
            items = defaultdict(list)
            for row, asked in enumerate(uses):
                for u in asked or ():
                    items[u["item"]].append((row, u["weight"]))
            dense: dict[int, np.ndarray] = {}

            def spread(row: int) -> np.ndarray:
                """A term's slices with a place for every document of the block."""
                if row in dense:
                    return dense[row]
                places = np.frombuffer(at[row], "<u2")
                bits = np.zeros((BITS, width * 64), np.uint8)
                bits[:, places] = np.unpackbits(np.frombuffer(raw[row], np.uint8), count=BITS * len(places), bitorder="little").reshape(BITS, -1)
                words = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
                if len(uses[row]) > 1:
                    dense[row] = words
                return words

            for item, terms in items.items():
                height = BITS + sum(w for _, w in terms).bit_length() + 1
                sums, carries = np.zeros((height, width), np.uint64), np.zeros((height, width), np.uint64)
                for row, weight in terms:
                    words = spread(row)
                    for up in range(weight.bit_length()):
                        if weight >> up & 1:
                            added(sums, carries, words, up)
                places, scores = top(settled(sums, carries), k)
                out.append(([item] * len(places), scores.tolist(), [docs[p] for p in places]))
        columns = [[x for part in out for x in part[c]] for c in range(3)]
        return pa.table([pa.array(c, x) for c, x in zip(columns, (pa.int64(), pa.int64(), kind), strict=True)], ["item", "score", "doc_id"])

    return run


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of the index for each row of items (item_id, text).

    Only documents with a score above 0 are ranked; equal scores go by ascending doc_id, nulls last. An item's repeated terms count each; an item that is null,
    empty or without indexed terms has no rows; repeated items each get theirs. Items meet a block in groups of about ``ITEMS``, and a group brings only the terms that it uses.
    """
    terms = F.regexp_extract_all(F.translate("text", UPPER, UPPER.lower()), F.lit(TERM), F.lit(0))
    named = written(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "search-items")
    groups = max(1, -(-named.count() // ITEMS))
    asked = named.select("item", F.explode(terms).alias("term")).groupBy("item", "term").agg(F.count("*").alias("times"))
    asked = written(asked, "search-terms")
    wanted = asked.select("term").distinct()
    n_docs = index.filter("term is null").agg(F.sum("n")).first()[0] or 0
    df = index.filter("term is not null").select("term", "n").join(small_bytes_or_not(written(wanted, "search-words"), SMALL), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long") * F.col("times")
    group = F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int")
    uses = asked.join(df, "term").groupBy(group.alias("group"), "term").agg(F.collect_list(F.struct("item", weight.alias("weight"))).alias("uses"))
    uses = written(uses, "search-uses")
    used = uses.agg(F.sum(F.octet_length("term") + 32 + 16 * F.size("uses"))).first()[0] or 0
    found = index.filter("term is not null").join(F.broadcast(uses) if used <= SMALL else uses, "term")
    heads = index.filter("term is null").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    rows = found.unionByName(heads, allowMissingColumns=True).select("block", "group", "at", "slices", "uses", "docs")
    kind = index.schema["docs"].dataType.elementType.simpleString()
    best = rows.groupBy("block", "group").applyInArrow(_searcher(k), f"item long, score long, doc_id {kind}")
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


#: DuckDB SQL for search(impact_index(documents), benchmark).
ORACLE = r"""
WITH lowered AS (SELECT doc_id, row_number() OVER () AS d, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
terms AS (SELECT doc_id, d, unnest(regexp_extract_all(t, '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term FROM lowered),
post AS (SELECT doc_id, d, term, count(*) AS tf FROM terms GROUP BY ALL), len AS (SELECT d, CAST(sum(tf) AS BIGINT) AS n FROM post GROUP BY d), tot AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM len),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM post, tot GROUP BY term, docs),
items AS (SELECT item_id, row_number() OVER () AS i, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
asked AS (SELECT item_id, i, unnest(regexp_extract_all(t, '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term FROM items),
scored AS (SELECT item_id, i, doc_id, d, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // l)))) AS BIGINT) AS score FROM asked JOIN post USING (term) JOIN len USING (d) JOIN w USING (term), tot GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
