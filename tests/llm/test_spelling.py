"""Spelling variants against brute force."""

import itertools
import re
import zlib

import numpy as np
import pytest

from countloom.llm import spelling

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows):
    n = {}
    for name, text in rows:
        for run in LETTERS.findall(text or ""):
            w = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if name is None else name}:{w}".encode())
            if h % 31 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            n[w] = n.get(w, 0) + 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute(n):
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], -1)) for w in n)


def rows_of(d):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in d.collect())


def test_automaton():
    """Minimal, numbered, and both directions together find what comparing all words finds."""
    rng = np.random.default_rng(1)
    words = sorted({"".join(rng.choice(list("abc"), rng.integers(3, 9))) for _ in range(700)})
    forward = spelling.Automaton(words)
    assert [forward._follow(forward.start, 0, w) for w in words] == list(range(len(words)))
    assert forward._follow(forward.start, 0, "abcd") == -1
    # Words with equal endings share their states.
    assert len(spelling.Automaton(sorted(a + "tionlike" for a in "abcdef")).states) == 10
    turned = sorted(w[::-1] for w in words)
    backward = spelling.Automaton(turned)
    for w in words[::7]:
        half = len(w) // 2
        found = {words[k] for k in forward.near(w, half)} | {turned[k][::-1] for k in backward.near(w[::-1], len(w) - half)}
        assert found == {v for v in words if one_apart(w, v)}
    assert spelling.Automaton([]).near("abc", 1) == set()


@pytest.mark.parametrize("bucket", [spelling.BUCKET, 30])
def test_variants(spark, bucket):
    """With one bucket, and with halves that more words share than a bucket takes."""
    rng = np.random.default_rng(2)
    words = {"".join(rng.choice(list("ab"), 4)) + "".join(rng.choice(list("abcé"), rng.integers(3, 6))) for _ in range(900)}
    n = {w: int(10 ** rng.uniform(0.4, 6)) for w in words}
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), bucket)
    assert rows_of(got) == brute(n)
    assert {r.root for r in got.collect()} <= words


def test_chain(spark):
    """Forms of forms lead to one root."""
    names = ["abcdefg", "abcdefx", "abcdeyx", "abcdzyx", "abcuzyx", "abtuzyx"]
    n = {w: 2 * 10**k for k, w in enumerate(names)}
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert {r.root for r in got.values()} == {"abtuzyx"}
    assert [got[w].form for w in names] == [*names[1:], None]


def test_spelling_groups(spark):
    """Nulls, empty and very long texts, repeated rows, a hot source, ties, and columns with clashing names."""
    base = ["beispielsweise", "wörterbuch", "Éclatante", "internationally", "recognition", "x" * 300]
    rows = [(i, " ".join(base[(i + k) % 6] for k in range(1 + i % 5)), "a") for i in range(400)]
    rows += [(None, "Beispielsweise, beispielsweise; recognitio recognitio", "b"), (1, None, "c"), (2, "", "c"), (3, " ×÷ 1234567 ", "c"), *rows[:3]]
    rows.append((7, " ".join(itertools.islice(itertools.cycle(["wörterbuhc", "recognition", "ab"]), 60_000)), None))
    d = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, word string, half string, n int")
    want = brute(counted([(r[0], r[1]) for r in rows]))
    assert any(w[1] for w in want)
    assert rows_of(spelling.spelling_groups(d)) == want


def test_no_words(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    out = spelling.spelling_groups(d)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert out.collect() == []
