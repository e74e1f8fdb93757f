"""Near-duplicate vectors by int8 tile products with error bounds.

Equal vectors of a label are one class. The classes of a label are dealt to blocks of a fixed size, and every pair of
blocks is a tile, one task's work. In a tile the unit vectors are rounded to int8 with a scale of their
own; with s q the rounded vector and r = |u - s q|, the true cosine differs from the scaled integer
product by at most |s q| r' + r. Only pairs whose upper bound reaches the threshold are computed again in double
precision. A tile gives, for each class, the number of linked vectors and the least class it is
connected to inside the tile, never the pairs themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_or_not, written
from .graph import components, least_labels, node_key, rep_of

#: Covers the rounding of the estimate itself, which is computed in single precision.
SLACK = 2e-6


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Integer values (as float32, whose products are exact here), scales, norms of the rounded vectors, norms of the errors."""
    scale = np.abs(u).max(axis=1) / 127.0
    q = np.rint(u / scale[:, None])
    back = q * scale[:, None]
    return q.astype(np.float32), scale, np.linalg.norm(back, axis=1), np.linalg.norm(u - back, axis=1)


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float, same: bool, rows: int = 512):
    """Yields arrays (i, j) of the linked pairs of rows of a and b; of one block with itself, pairs i < j."""
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    qa, sa, ba, ra = quantised(a / na[:, None])
    qb, sb, _, rb = quantised(b / nb[:, None])
    step = max(1, (1 << 22) // a.shape[1])
    # Integer products stay exact in float32 below 2 ** 24, that is up to 1040 components.
    kind = np.float32 if a.shape[1] <= 1040 else np.float64
    qa, qb = qa.astype(kind), qb.astype(kind)
    for lo in range(0, len(a), rows):
        hi = min(lo + rows, len(a))
        upper = (qa[lo:hi] @ qb.T) * sa[lo:hi, None] * sb[None, :] + ba[lo:hi, None] * rb[None, :] + ra[lo:hi, None]
        i, j = np.nonzero(upper >= threshold - SLACK)
        i += lo
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), step):
            x, y = i[k : k + step], j[k : k + step]
            cosine = np.einsum("ij,ij->i", a[x], b[y]) / (na[x] * nb[y])
            yield x[cosine >= threshold], y[cosine >= threshold]


def tile(part: pa.Table, threshold: float) -> pa.Table:
    """One tile: its rows of side 0 against those of side 1 (side 0 against itself if there is no other)."""
    part = part.combine_chunks()
    side = part.column("side").to_numpy()
    order = np.argsort(side, kind="stable")
    dim = part.column("dim")[0].as_py()
    v = part.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)[order]
    # By powers of two, which round nothing, so that no square overflows or underflows.
    v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, initial=0.0))[1][:, None])
    weight = part.column("weight").to_numpy()[order]
    n, first = len(order), int((side == 0).sum())
    same = part.column("i")[0].as_py() == part.column("j")[0].as_py()
    count, root = np.zeros(n, np.int64), np.arange(n)
    for i, j in tile_links(v[:first], v if same else v[first:], threshold, same) if first and (same or first < n) else ():
        j = j if same else j + first
        np.add.at(count, i, weight[j])
        np.add.at(count, j, weight[i])
        heads = least_labels(root[i], root[j], n)
        root = heads[root]
    found = np.flatnonzero(count)
    ids = part.column("class_id").combine_chunks().take(pa.array(order))
    return pa.table({"class_id": ids.take(pa.array(found)), "links": pa.array(count[found]), "parent": ids.take(pa.array(root[found]))})


def near_vectors(embeddings: DataFrame, threshold: float = 0.98, block: int = 4096, most: int = 200_000) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector.

    Vectors are compared within labels (and lengths). A null label, a null or empty vector, null or
    non-finite components and zero vectors link with nothing. Rows with equal vectors link, also if
    they repeat a vec_id; null ids count as links but never name a component of others. A pair at the threshold itself is a link;
    vectors of any length are taken whole. An empty table
    gives an empty result. Columns other than vec_id, label and embedding are not read. ``block`` is the number of classes on each side of a tile;
    ``most`` bounds the rows that are broadcast, beyond which Spark shuffles.
    """
    sound = "label is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(embedding, x -> x != 0)"
    kind = embeddings.schema["vec_id"].dataType
    key = F.unhex(F.md5(F.concat_ws(",", F.col("label").cast("string"), F.col("embedding").cast("array<string>"))))
    d = embeddings.select("vec_id", "label", "embedding", F.when(F.expr(sound), key).alias("own"))
    classes = d.filter("own is not null").groupBy("own", "label").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
    classes = written(classes.withColumn("dim", F.size("embedding")).withColumn("class_id", node_key("rep", "own", kind)), "vector-classes")
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sizes = small_or_not(sizes, sizes.count(), 100_000)
    dealt = classes.join(sizes, ["label", "dim"]).withColumn("b", F.pmod(F.conv(F.hex(F.substring("own", 1, 4)), 16, 10).cast("long"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("label", "dim", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), F.when(F.col("b") <= F.col("o"), 0).otherwise(1).alias("side"), "class_id", "weight", "embedding")
    found = tiles.groupBy("label", "dim", "i", "j").applyInArrow(lambda part: tile(part, threshold), "class_id binary, links long, parent binary")
    found = written(found, "vector-links")
    roots = components(found.select(F.col("class_id").alias("a"), F.col("parent").alias("b")))
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    named = classes.select("own", "class_id", "weight", "rep").join(links, "class_id", "left").join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
    named = named.select("own", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce(rep_of(F.col("root"), kind), "rep").alias("component_id"))
    # Only classes that link, or that several vectors share, differ from what a vector has by itself.
    named = written(named.filter("n_links > 0"), "vector-named")
    out = d.select("vec_id", "own").join(small_or_not(named, named.count(), most), "own", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
