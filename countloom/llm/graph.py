"""Connected components of a table of links.

Links are dealt to chunks of a bounded number of rows, and each chunk is first brought down to stars by itself: a row
for each of its nodes, with the least node it reaches inside the chunk. One chunk is then done. Several are
joined by alternating large and small stars over the cluster. Nodes carry the order of the documents they stand
for (``node_key``), so the least node of a component names its least document without a further join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

from .common import written

#: Links that one task contracts by itself.
CHUNK = 200_000


def node_key(rep: str, node: str, kind: DataType) -> Column:
    """Binary that sorts as (rep, node), null reps last; rep is an integral or a text id, node a binary of 16 bytes."""
    if isinstance(kind, IntegralType):
        value = F.unhex(F.lpad(F.hex(F.col(rep).cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0"))
    else:
        value = F.encode(F.col(rep).cast("string"), "UTF-8")
    return F.when(F.col(rep).isNull(), F.concat(F.expr("X'01'"), node)).otherwise(F.concat(F.expr("X'00'"), value, node))


def rep_of(key: Column, kind: DataType) -> Column:
    """The rep in a key of node_key."""
    value = F.substring(key, F.lit(2), F.octet_length(key) - 17)
    if isinstance(kind, IntegralType):
        value = (F.conv(F.hex(value), 16, 10).cast("decimal(20,0)") - F.expr("9223372036854775808BD")).cast("long")
    else:
        value = F.decode(value, "UTF-8")
    return F.when(F.hex(F.substring(key, 1, 1)) == "00", value).cast(kind)


def least_labels(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 to n - 1 and the links (x, y): the least node each one reaches."""
    root = np.arange(n)
    while len(x):
        a, b = root[x], root[y]
        apart = a != b
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return root


def _stars(batches):
    """The stars of a task's links (u, v): each node that isn't the least of its component, with that least node."""
    parts = [pa.Table.from_batches([b]) for b in batches]
    if not parts:
        return
    t = pa.concat_tables(parts)
    both = pa.concat_arrays([c for k in ("u", "v") for c in t.column(k).chunks])
    names, code = np.unique(np.array(both.to_pylist(), dtype=object), return_inverse=True)
    root = least_labels(code[: t.num_rows], code[t.num_rows :], len(names))
    own = np.flatnonzero(root != np.arange(len(names)))
    for lo in range(0, len(own), 10_000):
        part = own[lo : lo + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(names[part].tolist(), both.type), pa.array(names[root[part]].tolist(), both.type)], ["u", "v"])


def _star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least of u and all v of u. The minimum is aggregated before the join, so no node gathers its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame, rounds: int = 60, chunk: int = CHUNK) -> DataFrame:
    """node and root (the least node of its component) for the nodes of links (a, b), binary and not null; nodes without links don't appear."""
    edges = written(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    chunks = -(-edges.count() // chunk)
    edges = written(edges.repartition(max(1, chunks)).mapInArrow(_stars, "u binary, v binary"), "edges")
    state = None
    for _ in range(rounds if chunks > 1 else 0):
        # Large star: all greater neighbours of u go to the least node around u.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        # Small star: u and its smaller neighbours go to the least of them.
        s = _star(large)
        small = s.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(s.select("u", F.col("m").alias("v")))
        edges = written(small.filter("u != v").distinct(), "edges")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    else:
        if chunks > 1:
            raise RuntimeError(f"no fixed point after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
