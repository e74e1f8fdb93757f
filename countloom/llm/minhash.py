"""Near-duplicate documents by a MinHash LSH forest.

A document's set is its distinct 5-word shingles; documents with equal sets are one class. Each class gets
``TREES`` sorted signature orders of ``DEPTH`` MinHash values, range-sorted over the cluster. A run of classes
that share their first ``SHALLOWEST`` values is a region. Regions are cut into pieces of up to ``PIECE``
neighbours: where a region holds more, it is cut where neighbours share the fewest values, so that depth adapts to how dense it is.
Inside a piece whole signatures give a maximum spanning forest of the likely pairs, which is fewer pairs than classes
however many are alike; these pairs are confirmed on the full sets, and the links join components.

What the pieces left open is then settled for whole regions: in each region that still holds more than
one component, all classes outside its largest component meet all classes of other components, tile by tile. First each class gives
its ``FEW`` best pairs, which are confirmed. Classes with more pairs than these meet once more with their full sets, and every pair that is left
between components is tested inside the tile, which gives no pairs but the links that join components. So neither pieces nor ``FEW`` bound any
group, and classes of one component are never compared with each other. A pair with links is missed only where no order gives it a common
region (2e-6 at the similarity of a link) or its signatures agree five standard deviations too seldom
(``UNLIKELY``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let, short_batches, small_or_not, written
from .graph import components, least_labels, node_key, rep_of

WORDS, TREES, DEPTH, SHALLOWEST = 5, 24, 8, 3
#: Classes in a piece, and classes on each side of a tile.
PIECE, TILE = 512, 1024
#: Pairs that a class gives in the first sweep over a tile.
FEW = 4
#: Rows of the sorted orders in one range.
RANGE = 200_000
#: The share of agreeing values below which a pair is no candidate. At the similarity of a link its standard
#: deviation is 0.031 for all TREES * DEPTH values, so this is five of them below.
UNLIKELY = 0.59
#: A link: 100 * intersection >= SHARE * union.
SHARE = 75
_RANDOM = np.random.default_rng(20_240_229)
_STEPS = _RANDOM.integers(1, 2**63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_TURNS = (_RANDOM.integers(1, 2**31, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted distinct 64-bit fingerprints of a text's shingles."""
    from xxhash import xxh3_64_intdigest

    words = (text or b"").lower().split()  # bytes: A-Z only, and the white space of the word pattern
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(WORDS, len(h))
    s = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        s += h[k : len(h) - n + 1 + k] * _STEPS[k]
    return np.unique(mixed(s + np.uint64(n)))


def signature(s: np.ndarray) -> bytes:
    """DEPTH values of 16 bits for each tree, big-endian, so that byte order is the order of the values."""
    x, least = (s >> np.uint64(32)).astype(np.uint32), np.full(len(_TURNS), 2**32 - 1, np.uint32)
    for lo in range(0, len(x), 2048):
        np.minimum(least, (x[lo : lo + 2048, None] * _TURNS[None, :]).min(axis=0), out=least)
    # The least value of many is small: its low bits, mixed, are what tells sets apart.
    return (mixed(least.astype(np.uint64)) >> np.uint64(48)).astype(">u2").tobytes()


def _described(batches):
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            rows = []
            for x in part.column("text").cast(pa.binary()).to_pylist():
                s = shingles(x)
                rows.append((len(s), hashlib.md5(x or b"").hexdigest(), *((hashlib.md5(s.tobytes()).digest(), signature(s)) if len(s) else (None, None))))
            n, digest, node, sig = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest), pa.array(node, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "digest", "node", "sig"])


def _whole_sets(batches):
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            sets = [shingles(x) for x in b.column("text").slice(lo, 256).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "shingles"])


def _rows(t: pa.Table, column: str, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(column).to_pylist()), kind).reshape(t.num_rows, width)


def cut(common: np.ndarray, lo: int, hi: int, depth: int = SHALLOWEST) -> list[tuple[int, int]]:
    """The pieces of the sorted rows lo to hi, where common[i] is the prefix that row i shares with the next one."""
    if hi - lo <= PIECE:
        return [(lo, hi)]
    if depth == DEPTH:
        return [(k, min(hi, k + PIECE)) for k in range(lo, hi, PIECE)]
    ends = [lo, *(lo + 1 + np.flatnonzero(common[lo : hi - 1] <= depth)).tolist(), hi]
    out: list[tuple[int, int]] = []
    for a, b in zip(ends, ends[1:], strict=False):
        for x, y in cut(common, a, b, depth + 1):
            if out and y - out[-1][0] <= PIECE:  # neighbours in the order that fit into one piece
                out[-1] = (out[-1][0], y)
            else:
                out.append((x, y))
    return out


def _regions(batches):
    """Of a sorted range: the rows that share a region with another, and those of its first and last region, each with its place and piece."""
    from pyspark import TaskContext

    parts = [pa.Table.from_batches([b]) for b in batches]
    if not parts:
        return
    part, t = TaskContext.get().partitionId(), pa.concat_tables(parts).combine_chunks()
    n = t.num_rows
    tree, key = t.column("tree").to_numpy(), _rows(t, "key", ">u2", DEPTH)
    common = np.cumprod(key[1:] == key[:-1], axis=1).sum(axis=1) * (tree[1:] == tree[:-1])
    start = np.flatnonzero(np.concatenate([[True], common < SHALLOWEST]))
    end = np.concatenate([start[1:], [n]])
    wide = (end - start > 1) | (start == 0) | (end == n)
    start, end = start[wide], end[wide]
    take = np.concatenate([np.arange(a, b) for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    piece = np.repeat(start, end - start)
    for a, b in zip(start[end - start > PIECE].tolist(), end[end - start > PIECE].tolist(), strict=True):
        at = int(np.searchsorted(take, a))
        for x, y in cut(common, a, b):
            piece[at + x - a : at + y - a] = x
    node = t.column("node").combine_chunks()
    for lo in range(0, len(take), 10_000):
        rows = take[lo : lo + 10_000]
        place = pa.array([x.tobytes() for x in key[rows, :SHALLOWEST].astype(">u2")], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(tree[rows], pa.int32()), place, pa.array(piece[lo : lo + 10_000] + (part << 32), pa.int64()), node.take(pa.array(rows))], ["tree", "place", "piece", "node"])


def regions(classes: DataFrame, rows: int) -> DataFrame:
    """tree, place, piece and node of the classes (node, sig) that share a region. A region that a range's border cuts has one place and several pieces."""
    tree = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.expr("sig").substr(t * (2 * DEPTH) + 1, F.lit(2 * DEPTH)))).alias("tree", "key")
    order = ["tree", "key", "node"]
    ordered = classes.select(tree, "node").repartitionByRange(max(1, -(-rows * TREES // RANGE)), *order).sortWithinPartitions(*order)
    return ordered.mapInArrow(_regions, "tree int, place binary, piece long, node binary")


def _groups(batches, keys: list[str], work):
    """Calls work with tables of whole groups; rows come sorted by keys."""
    carry = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = (pa.concat_tables([carry, t]) if carry is not None else t).combine_chunks()
        if not t.num_rows:
            continue
        new = _borders(t, keys)
        carry = t.slice(new[-1])
        if new[-1]:
            yield from work(t.slice(0, new[-1]).combine_chunks())
    if carry is not None and carry.num_rows:
        yield from work(carry.combine_chunks())


def _borders(t: pa.Table, keys: list[str]) -> np.ndarray:
    """The first row of each group of neighbours with equal keys."""
    import pyarrow.compute as pc

    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for k in keys:
        c = t.column(k).combine_chunks()
        new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def likely(t: pa.Table, keys: list[str], comp: np.ndarray, side: np.ndarray | None = None):
    """Yields arrays (x, y, near) of the pairs of rows of one group that lie in different components, on different sides, and that sizes and whole signatures leave possible.

    near is the number of agreeing values. Distances within the groups are looked at one by one, over all groups at once.
    """
    start = _borders(t, keys)
    end = np.repeat(np.concatenate([start[1:], [t.num_rows]]), np.diff(np.concatenate([start, [t.num_rows]])))
    whole, size = _rows(t, "sig", np.uint16, TREES * DEPTH), t.column("size").to_numpy()
    at = np.arange(t.num_rows)
    k = 1
    while len(at := at[at + k < end[at]]):
        x = at[comp[at] != comp[at + k]]
        if side is not None:
            x = x[(side[x] != side[x + k]) | (side[x] == 2)]
        x = x[100 * np.minimum(size[x], size[x + k]) >= SHARE * np.maximum(size[x], size[x + k])]
        if len(x):
            near = np.concatenate([(whole[x[i : i + 4096]] == whole[x[i : i + 4096] + k]).sum(axis=1) for i in range(0, len(x), 4096)])
            x, near = x[near >= UNLIKELY * TREES * DEPTH], near[near >= UNLIKELY * TREES * DEPTH]
            if len(x):
                yield x, x + k, near
        k += 1


def _codes(column) -> np.ndarray:
    """Numbers in the order of a binary column's values."""
    return np.unique(np.array(column.to_pylist(), dtype=object), return_inverse=True)[1]


def _pair_batches(t: pa.Table, x: np.ndarray, y: np.ndarray, _near: np.ndarray):
    node = np.array(t.column("node").to_pylist(), dtype=object)
    for lo in range(0, len(x), 10_000):
        p, q = node[x[lo : lo + 10_000]], node[y[lo : lo + 10_000]]
        swap = p > q
        a, b = np.where(swap, q, p), np.where(swap, p, q)
        yield pa.RecordBatch.from_arrays([pa.array(a.tolist(), pa.binary()), pa.array(b.tolist(), pa.binary())], ["a", "b"])


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.concatenate([np.empty(0, np.int64), *[p[i] for p in parts]]) for i in range(3))


def spanning(t: pa.Table):
    """The maximum spanning forest of the likely pairs of each piece; of equally near pairs the one of the least nodes goes first, so that orders agree."""
    n, rank = t.num_rows, _codes(t.column("node"))
    x, y, near = _joined(list(likely(t, ["piece"], rank)))
    order = np.lexsort((np.maximum(rank[x], rank[y]), np.minimum(rank[x], rank[y]), -near))
    x, y, near = x[order], y[order], near[order]
    root, open_, chosen = np.arange(n), np.arange(len(x)), [np.empty(0, np.int64)]
    while len(open_):
        a, b = root[x[open_]], root[y[open_]]
        open_, a, b = open_[a != b], a[a != b], b[a != b]
        best = np.full(n, len(open_))
        np.minimum.at(best, a, np.arange(len(open_)))
        np.minimum.at(best, b, np.arange(len(open_)))
        pick = np.unique(best[best < len(open_)])
        chosen.append(open_[pick])
        p, q = a[pick], b[pick]
        while (apart := root[p] != root[q]).any():
            p, q = p[apart], q[apart]
            u, v = root[p], root[q]
            np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
            while (root[root] != root).any():
                root = root[root]
    take = np.concatenate(chosen)
    yield from _pair_batches(t, x[take], y[take], near[take])


def _best(few: int, x: np.ndarray, y: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Which pairs are among the few nearest ones of one of their rows."""
    side, pair = np.concatenate([x, y]), np.tile(np.arange(len(x)), 2)
    order = np.lexsort((-near[pair], side))
    first = np.searchsorted(side[order], side[order])
    keep = np.zeros(len(x), bool)
    keep[pair[order][np.arange(len(order)) - first < few]] = True
    return keep


def nearest(t: pa.Table):
    """Of each tile the FEW best likely pairs of each class between components. Classes with further pairs come as rows without b."""
    comp, side, held = _codes(t.column("comp")), t.column("side").to_numpy(), np.zeros(t.num_rows, bool)
    parts, rows = [], 0

    def best():
        x, y, near = _joined(parts)
        keep = _best(FEW, x, y, near)
        held[x[~keep]] = held[y[~keep]] = True
        return x[keep], y[keep], near[keep]

    for part in likely(t, TILES, comp, side):
        parts.append(part)
        rows += len(part[0])
        if rows > 500_000:
            parts = [best()]
            rows = len(parts[0][0])
    yield from _pair_batches(t, *best())
    left = t.column("node").combine_chunks().filter(pa.array(held))
    yield pa.RecordBatch.from_arrays([left, pa.nulls(len(left), pa.binary())], ["a", "b"])


def settled(t: pa.Table):
    """The links between components in each tile, on full sets, as a star for each component that they join; no pair leaves the task.

    A pair is tested in the first order that gives it a common region.
    """
    comp, side = _codes(t.column("comp")), t.column("side").to_numpy()
    shingles = t.column("shingles").combine_chunks()
    ends, values = shingles.offsets.to_numpy(), shingles.values.to_numpy()
    whole, tree = _rows(t, "sig", np.uint16, TREES * DEPTH).reshape(-1, TREES, DEPTH)[:, :, :SHALLOWEST], t.column("tree").to_numpy()
    node = _codes(t.column("node"))
    found_x, found_y = [], []
    for x, y, _ in likely(t, TILES, comp, side):
        for lo in range(0, len(x), 4096):
            p, q = x[lo : lo + 4096], y[lo : lo + 4096]
            first = (whole[p] == whole[q]).all(axis=2).argmax(axis=1) == tree[p]
            for i, j in zip(p[first].tolist(), q[first].tolist(), strict=True):
                a, b = values[ends[i] : ends[i + 1]], values[ends[j] : ends[j + 1]]
                both = np.concatenate([a, b])
                both.sort()
                n = int((both[1:] == both[:-1]).sum())
                if 100 * n >= SHARE * (len(both) - n):
                    found_x.append(node[i])
                    found_y.append(node[j])
    names = np.unique(np.array(t.column("node").to_pylist(), dtype=object))
    root = least_labels(np.array(found_x, np.int64), np.array(found_y, np.int64), len(names))
    own = np.flatnonzero(root != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([pa.array(names[root[own]].tolist(), pa.binary()), pa.array(names[own].tolist(), pa.binary())], ["a", "b"])


def tiles(shared: DataFrame, classes: DataFrame, roots: DataFrame, most: int) -> DataFrame | None:
    """The classes of regions that hold several components, dealt to tiles (tree, place, i, j); None where there is no such region.

    The classes outside a region's largest component are cut into j parts, and all classes into i parts. Rows have side 0 (of all),
    1 (outside) or, where a region is one tile, 2.
    """
    d = shared.select("tree", "place", "node").join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    d = written(d, "forest-members")
    sizes = d.groupBy("tree", "place", "comp").agg(F.count("*").alias("n")).groupBy("tree", "place").agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top"))
    sizes = sizes.filter("top.n < n").select("tree", "place", F.col("top.comp").alias("main"), F.ceil(F.col("n") / TILE).cast("int").alias("ni"), F.ceil((F.col("n") - F.col("top.n")) / TILE).cast("int").alias("nj"))
    sizes = written(sizes, "forest-open")
    rows = sizes.count()
    if not rows:
        return None
    d = d.join(small_or_not(sizes, rows, most), ["tree", "place"]).join(classes.select("node", "size", "sig"), "node")
    part = lambda n: F.expr(f"cast(pmod(xxhash64(node, tree), {n}) as int)")
    own = F.struct(part("ni").alias("i"), F.lit(0).alias("side"), F.lit(-1).alias("j"))
    all_of = F.transform(F.sequence(F.lit(0), F.col("nj") - 1), lambda j: F.struct(part("ni").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    outside = F.transform(F.sequence(F.lit(0), F.col("ni") - 1), lambda i: F.struct(i.alias("i"), part("nj").alias("j"), F.lit(1).alias("side")))
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side")))
    at = F.when(F.col("ni") == 1, one).when(F.col("comp") == F.col("main"), all_of).otherwise(F.concat(all_of, outside))
    d = d.select("tree", "place", F.explode(at).alias("at"), "node", "comp", "size", "sig")
    return d.select("tree", "place", "at.i", "at.j", "at.side", "node", "comp", "size", "sig")


PAIRS = "a binary, b binary"
#: What deals rows to tiles.
TILES = ["tree", "place", "i", "j"]


def full_sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, most: int) -> DataFrame:
    """plain (the 16 bytes that a class's key ends in) and shingles, made anew from the texts of the documents that stand for the classes in nodes. Rows of other classes with the same id may come along."""
    reps = written(nodes.join(classes.select("node", "rep"), "node").select("rep").distinct(), "forest-reps")
    texts = docs.select("doc_id", "text").join(small_or_not(reps, reps.count(), most), F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    with short_batches(docs.sparkSession):
        return written(texts.select("text").mapInArrow(_whole_sets, "plain binary, shingles array<bigint>").dropDuplicates(["plain"]), "forest-sets")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, most: int) -> DataFrame:
    """The pairs (a, b) that are links."""
    sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, classes, most)
    both = pairs.select("a", "b")
    for c in ("a", "b"):
        both = both.join(sets.select(F.col("plain").alias(f"plain_{c}"), F.col("shingles").alias(f"set_{c}")), F.substring(c, -16, 16) == F.col(f"plain_{c}"))
    shared = let("cast(size(array_intersect(set_a, set_b)) as bigint)", f"100 * n >= {SHARE} * (size(set_a) + size(set_b) - n)", "n")
    return written(both.filter(F.expr(shared)).select("a", "b"), "forest-links")


def linked_classes(docs: DataFrame, base: DataFrame, most: int) -> DataFrame:
    """node and root of the classes of base that link with others; keys as of node_key, so that a root has its component's least id."""
    kind = docs.schema["doc_id"].dataType
    classes = base.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size"), F.first("sig").alias("sig"))
    classes = written(classes.withColumn("node", node_key("rep", "node", kind)), "forest-classes")
    shared = written(regions(classes, classes.count()), "forest-regions")
    members = shared.join(classes.select("node", "size", "sig"), "node").repartition("piece").sortWithinPartitions("piece", "node")
    tried = written(members.mapInArrow(lambda x: _groups(x, ["piece"], spanning), PAIRS).distinct(), "forest-pairs")
    links = confirmed(tried, docs, classes, most)
    roots = components(links)
    dealt = tiles(shared, classes, roots, most)
    if dealt is None:
        return roots
    found = written(dealt.repartition(*TILES).sortWithinPartitions(*TILES).mapInArrow(lambda x: _groups(x, TILES, nearest), PAIRS).distinct(), "forest-pairs")
    more = confirmed(found.filter("b is not null").join(tried, ["a", "b"], "left_anti"), docs, classes, most)
    if more.count():
        links = links.unionByName(more)
        roots = components(links)
    held = written(found.filter("b is null").select(F.col("a").alias("node")).distinct(), "forest-held")
    if not held.count():
        return roots
    # A pair is held back only if both of its classes have more than FEW.
    dealt = tiles(shared.join(held, "node", "left_semi"), classes, roots, most)
    if dealt is None:
        return roots
    sets = full_sets(held, docs, classes, most)
    dealt = dealt.join(sets, F.substring("node", -16, 16) == F.col("plain")).drop("plain")
    with short_batches(docs.sparkSession):
        more = written(dealt.repartition(*TILES).sortWithinPartitions(*TILES).mapInArrow(lambda x: _groups(x, TILES, settled), PAIRS).distinct(), "forest-links")
    return components(links.unionByName(more)) if more.count() else roots


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (of the text), node (of the set; null without words) and signature of each document, written."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    with short_batches(docs.sparkSession):
        return written(docs.select("doc_id", "text").mapInArrow(_described, f"doc_id {kind}, n_shingles long, digest string, node binary, sig binary"), "forest-base")


def near_documents(docs: DataFrame, most: int = 200_000) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document.

    Null and empty texts and texts without words have an empty set and link with nothing. Documents with equal sets link,
    also if rows repeat an id; a null id never names a component of others. Repeated rows each get a row, and a tie of equal
    ids names the component alike. Texts of any length are taken whole. An empty table gives an empty result. ``most`` bounds the rows of what is
    broadcast (ids, or 16 bytes and an id); beyond it Spark shuffles. Columns other than doc_id and text are not read.
    """
    kind = docs.schema["doc_id"].dataType
    base = described(docs)
    roots = linked_classes(docs, base, most)
    copies = base.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    named = copies.join(roots.select(F.substring("node", -16, 16).alias("node"), rep_of(F.col("root"), kind).alias("least")), "node", "left")
    named = written(named.filter("n > 1 or least is not null").select("node", F.coalesce("least", "rep").alias("component_id")), "forest-named")
    component = F.coalesce("component_id", "doc_id")
    out = base.select("doc_id", "n_shingles", "node").join(small_or_not(named, named.count(), most), "node", "left")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, most: int = 200_000) -> DataFrame:
    """docs with one document of each group of linked ones: that with the least id (null last), then the least digest of its text.

    Rows are told apart by id and text, so that documents with repeated ids are judged one by one; of rows that are equal in both, one stays.
    Texts without words link with nothing and stay. Columns are as they were, whatever their names; an empty table
    stays empty.
    """
    kind, names = docs.schema["doc_id"].dataType, docs.columns
    base = described(docs)
    roots = linked_classes(docs, base, most)
    own = base.filter("node is not null").groupBy("doc_id", "digest", "node").agg(F.count("*").alias("n"))
    own = own.join(roots.select(F.substring("node", -16, 16).alias("node"), "root"), "node", "left").withColumn("group", F.coalesce(F.substring("root", -16, 16), "node"))
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "digest")
    own = written(own.select("group", order.alias("at"), "n"), "near-own")
    first = written(own.groupBy("group").agg(F.min("at").alias("first"), F.count("*").alias("rows")).filter("rows > 1"), "near-first")
    first = small_or_not(first, first.count(), most)
    gone = own.join(first, "group").filter("at != first").select("at").unionByName(own.filter("n > 1").select("at")).distinct()
    gone = written(gone.select(F.col("at.doc_id").alias("id"), F.col("at.digest").alias("digest")), "near-gone")
    again = written(own.filter("n > 1").join(first, "group", "left").filter("first is null or at = first").select(F.col("at.doc_id").alias("id"), F.col("at.digest").alias("digest")), "near-again")
    d = docs.select(F.struct(*names).alias("row"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("own_digest"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("own_digest") == F.col("digest"))
    out = d.join(small_or_not(gone, gone.count(), most), same, "left_anti")
    if n := again.count():
        out = out.unionByName(d.join(small_or_not(again, n, most), same).dropDuplicates(["id", "digest"]).select("row", "own_digest"))
    return out.select(*[F.col("row")[c].alias(c) for c in names])
