"""Local alignment scores of pairs of sequences; Spark deals the pairs, and a pair is one row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def best_local(a: bytes, b: bytes, match: int, mismatch: int, gap: int) -> tuple[int, int, int]:
    """Score and ends (exclusive) of the best local alignment with linear gaps, the first of equally good ones.

    A row of the table depends on itself only through gaps, which a running maximum of score plus gaps gives at once.
    """
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    before, slope, best = np.zeros(len(y) + 1, np.int64), np.arange(len(y) + 1) * gap, (0, 0, 0)
    for i, c in enumerate(x, 1):
        row = np.zeros_like(before)
        row[1:] = np.maximum(0, np.maximum(before[:-1] + np.where(y == c, match, -mismatch), before[1:] - gap))
        before = np.maximum.accumulate(row + slope) - slope
        j = int(before.argmax())
        if before[j] > best[0]:
            best = (int(before[j]), i, j)
    return best


def local_scores(pairs: DataFrame, key: str, query: str, target: str, match: int = 2, mismatch: int = 4, gap: int = 2) -> DataFrame:
    """key, score, query_end and target_end of each pair; a null sequence counts as empty and scores 0."""

    def run(batches):
        for b in batches:
            a, t = (b.column(c).cast(pa.binary()).to_pylist() for c in (query, target))
            found = [best_local(x or b"", y or b"", match, mismatch, gap) for x, y in zip(a, t, strict=True)]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column(key), *columns], [key, "score", "query_end", "target_end"])

    d = pairs.select(key, query, target)
    return d.mapInArrow(run, f"`{key}` {d.schema[key].dataType.simpleString()}, score long, query_end int, target_end int")


#: Directions of a cell of the table: the letter pair, a letter of the query alone, one of the target alone.
PAIR, QUERY, TARGET = 1, 2, 3


def _directions(x: np.ndarray, y: np.ndarray, match: int, mismatch: int, gap: int):
    """Score and end of the best local alignment, and two bit planes of the directions, a packed row for each letter of the query.

    Of equally good ways a pair of letters wins over a gap, and a letter of the target alone over one of the query alone; of equally good ends the first in row order wins.
    """
    before, slope, best, low, high = np.zeros(len(y) + 1, np.int64), np.arange(len(y) + 1) * gap, (0, 0, 0), [], []
    for i, c in enumerate(x, 1):
        pair, alone = before[:-1] + np.where(y == c, match, -mismatch), before[1:] - gap
        row = np.zeros_like(before)
        row[1:] = np.maximum(0, np.maximum(pair, alone))
        row = np.maximum.accumulate(row + slope) - slope
        left = row[:-1] - gap
        way = np.where((alone > left) & (alone > pair) & (alone > 0), QUERY, np.where((left > pair) & (left > 0), TARGET, np.where(pair > 0, PAIR, 0)))
        low.append(np.packbits(way & 1))
        high.append(np.packbits(way >> 1))
        before = row
        j = int(before.argmax())
        if before[j] > best[0]:
            best = (int(before[j]), i, j)
    return best, low, high


def traced(a: bytes, b: bytes, match: int = 2, mismatch: int = 4, gap: int = 2) -> tuple:
    """score, query_start, query_end, target_start, target_end, n_equal, and both aligned strings with ``-`` for gaps, of the best local alignment."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    (score, q_end, t_end), low, high = _directions(x, y, match, mismatch, gap)
    q, t, top, under, equal = q_end, t_end, bytearray(), bytearray(), 0
    while q and t:
        byte, bit = (t - 1) >> 3, 7 - ((t - 1) & 7)
        way = (low[q - 1][byte] >> bit & 1) | (high[q - 1][byte] >> bit & 1) << 1
        if not way:
            break
        q, t = q - (way != TARGET), t - (way != QUERY)
        top.append(a[q] if way != TARGET else 45)
        under.append(b[t] if way != QUERY else 45)
        equal += way == PAIR and a[q] == b[t]
    top.reverse()
    under.reverse()
    return score, q, q_end, t, t_end, int(equal), top.decode("latin-1"), under.decode("latin-1")


def local_alignments(pairs: DataFrame, key: str, query: str, target: str, match: int = 2, mismatch: int = 4, gap: int = 2) -> DataFrame:
    """key with the best local alignment of each pair, see ``traced``; starts from 0, ends exclusive. A null or empty sequence gives score 0 and empty strings.

    A task holds one pair's directions at a time, two bits for each pair of letters. Sequences are of one-byte letters.
    """
    kinds = [("score", pa.int64()), ("query_start", pa.int32()), ("query_end", pa.int32()), ("target_start", pa.int32()), ("target_end", pa.int32()), ("n_equal", pa.int32()), ("query_text", pa.string()), ("target_text", pa.string())]

    def run(batches):
        for batch in batches:
            a, t = (batch.column(c).cast(pa.binary()).to_pylist() for c in (query, target))
            for lo in range(0, len(a), 1000):
                found = [traced(x or b"", y or b"", match, mismatch, gap) for x, y in zip(a[lo : lo + 1000], t[lo : lo + 1000], strict=True)]
                columns = [pa.array([f[k] for f in found], kind) for k, (_, kind) in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(lo, 1000), *columns], [key, *(n for n, _ in kinds)])

    d = pairs.select(key, query, target)
    ints = ", ".join(f"{n} int" for n in ("query_start", "query_end", "target_start", "target_end", "n_equal"))
    return d.mapInArrow(run, f"`{key}` {d.schema[key].dataType.simpleString()}, score long, {ints}, query_text string, target_text string")
