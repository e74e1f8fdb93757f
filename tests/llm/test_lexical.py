"""Ranked lexical search against brute force."""

import collections
import math
import re

import numpy as np
import pytest

from countloom.llm import lexical

TERM = re.compile(lexical.TERM)
DOCS = "doc_id long, text string, block int, term string, n int, docs string, at string"


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, k=10):
    tf = [(name, collections.Counter(terms(text))) for name, text in docs]
    tf = [(name, c) for name, c in tf if c]
    total, df = sum(sum(c.values()) for _, c in tf), collections.Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scores = []
        for name, c in tf:
            m = 100 - 75 + 75 * sum(c.values()) * len(tf) // total
            score = sum(math.floor(1000 * math.log((2 * len(tf) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, name is None, name or 0, name))
        out += [(item, rank + 1, x[3], -x[0]) for rank, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def got(spark, docs, items, k=10):
    d = spark.createDataFrame([(*r, 1, "t", 2, "d", "a") for r in docs], DOCS)
    i = spark.createDataFrame([(*r, 1.0, 7, "g") for r in items], "item_id long, text string, score double, item int, uses string")
    return sorted([tuple(r) for r in lexical.search(lexical.impact_index(d), i, k).collect()], key=str)


@pytest.mark.parametrize("block, bytes_, items", [(lexical.BLOCK, lexical.BYTES, lexical.ITEMS), (7, lexical.BYTES, 2), (100, 400, 3)])
def test_search(spark, monkeypatch, block, bytes_, items):
    """Blocks and groups of any size; nulls, empty and very long texts, ties, repeated documents and items, columns with clashing names."""
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "BYTES", bytes_)
    monkeypatch.setattr(lexical, "ITEMS", items)
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)] + ["Straße", "É", "İ", "数据", "x_y", "😀a"]
    share = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(rng.choice(words, n, p=share / share.sum()))
    docs = [(i, text(rng.integers(1, 60))) for i in range(150)]
    docs += [(200 + i, "w1 w2 copies w3") for i in range(40)] + docs[:4]
    docs += [(None, "w1 copies"), (None, "w1 copies"), (1000, None), (1001, ""), (1002, " .,-_ "), (-5, text(30_000))]
    asked = [(i, text(12)) for i in range(6)] + [(0, "copies w1 w1 W1"), (0, "copies w1 w1 W1"), (None, "STRASSE straße 数据"), (8, None), (9, ""), (10, "unheard of"), (11, text(3000))]
    assert got(spark, docs, asked) == brute(docs, asked)


def test_shuffled_terms(spark, monkeypatch):
    """Items' terms beyond the broadcast bound give the same rows; k beyond the documents gives all."""
    monkeypatch.setattr(lexical, "SMALL", 0)
    docs = [(i, f"a{i % 7} b{i % 3} c") for i in range(50)]
    assert got(spark, docs, [(1, "a1 b2 c")], 500) == brute(docs, [(1, "a1 b2 c")], 500)


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id string, text string")
    i = spark.createDataFrame([(1, "a")], "item_id long, text string")
    out = lexical.search(lexical.impact_index(d), i)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []
    d = spark.createDataFrame([("x", "a b"), ("y", "b c"), ("z", "c d")], "doc_id string, text string")
    assert lexical.search(lexical.impact_index(d), i.limit(0)).collect() == []
    assert [r.doc_id for r in lexical.search(lexical.impact_index(d), i).collect()] == ["x"]


def test_carries():
    """Sums by carries and the best by slices equal plain integers."""
    rng = np.random.default_rng(5)
    values, weights = rng.integers(0, 2**20, (9, 128)), [1, 3, 0, 7, 100, 31_000, 2, 2, 65]
    sums, carries = np.zeros((40, 2), np.uint64), np.zeros((40, 2), np.uint64)
    for v, w in zip(values, weights, strict=True):
        slices = np.packbits((v[None, :] >> np.arange(20)[:, None] & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
        for up in range(w.bit_length()):
            if w >> up & 1:
                lexical.added(sums, carries, slices, up)
    want = (values * np.array(weights)[:, None]).sum(axis=0)
    at, found = lexical.top(lexical.settled(sums, carries), 128)
    assert found.tolist() == sorted(want.tolist(), reverse=True) and (want[at] == found).all()
    ties = np.zeros((3, 2), np.uint64)
    ties[1] = 2**64 - 1
    assert [x.tolist() for x in lexical.top(ties, 3)] == [[0, 1, 2], [2, 2, 2]]
