"""Agglomeration, null-aware NOT IN, and intervals over several blocks, against plain Python."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from countloom.functions import distributions, sequence
from countloom.operators import alignment, clusters, intervals, relational, stats


def merged_one_by_one(points, how, near=None, keep=1):
    """(first, second, height) by looking at all pairs of clusters each time; a cluster is named by its least item."""
    d = lambda i, j: sum((a - b) ** 2 for a, b in zip(points[i], points[j], strict=True))
    link = {"single": min, "complete": max, "average": lambda v: sum(v) / len(v)}[how]
    groups, out = {i: [i] for i in range(len(points))}, []
    while len(groups) > keep:
        pairs = [(link([d(i, j) for i in groups[a] for j in groups[b]]), a, b) for a, b in itertools.combinations(sorted(groups), 2) if near is None or any((min(i, j), max(i, j)) in near for i in groups[a] for j in groups[b])]
        if not pairs:
            break
        h, a, b = min(pairs)
        groups[a] += groups.pop(b)
        out.append((a, b, h))
    return out


@pytest.mark.parametrize("how", ["single", "complete", "average"])
def test_agglomerated(spark, how):
    rng = random.Random(7)
    points = [[rng.random(), rng.random()] for _ in range(14)]
    long = spark.createDataFrame([(i, k, v) for i, p in enumerate(points) for k, v in enumerate(p)], "item int, place int, value double")
    pairs = clusters.point_distances(long, "item", "place", "value")
    rounded = lambda m: [(a, b, round(h, 9)) for a, b, h in m]
    want = merged_one_by_one(points, how)
    assert rounded(clusters.agglomerated(pairs, how)) == rounded(want)
    assert rounded(clusters.agglomerated(pairs, how, keep=4)) == rounded(want[:-3])
    near = {(i, i + 1) for i in range(13)}
    edges = spark.createDataFrame(sorted(near), "first int, second int")
    assert sorted(rounded(clusters.agglomerated(pairs, how, edges, 9))) == sorted(rounded(merged_one_by_one(points, how, near, 9)))
    names = clusters.members(list(range(14)), want[:-2])
    assert len(set(names.values())) == 3


def test_not_in(spark):
    d = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    got = lambda *v: sorted(str(r.k) for r in relational.not_in(d, "k", spark.createDataFrame([(x,) for x in v], "o int")).collect())
    assert got(1) == ["2"] and got(1, None) == [] and got() == ["1", "2", "None"]


def test_blocks_of_intervals(spark):
    rng = random.Random(3)
    rows = [("a" if k % 2 else "b", s := rng.randrange(-300, 300), s + rng.randrange(0, 40)) for k in range(80)]
    d = spark.createDataFrame(rows, "k string, s long, e long")
    want = []
    for key in "ab":
        covered = sorted({x for k, s, e in rows if k == key for x in range(s, e + 1)})
        for x in covered:
            if want and want[-1][0] == key and want[-1][2] == x - 1:
                want[-1][2] = x
            else:
                want.append([key, x, x])
    for block in (7, 1 << 20):
        assert sorted(map(list, intervals.merged(d, ["k"], "s", "e", block).collect())) == sorted(want)


def test_medians(spark):
    d = spark.createDataFrame([("a", x) for x in (1.0, 1.0, 2.0, 9.0)] + [("b", 3.0), ("b", None), ("c", 5.0), ("c", 5.0), ("c", 7.0)], "k string, x double")
    assert {r.k: r.median for r in stats.medians(d, ["k"], "x").collect()} == {"a": 1.5, "b": 3.0, "c": 5.0}


def test_closure_of_a_cycle(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "c int, p int")
    got = {tuple(r) for r in relational.closure(e, "c", "p").collect()}
    assert got == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4)}


def test_codes_with_other_letters(spark):
    d = spark.createDataFrame([("ACGT",), ("ACNT",), ("",)], "u string").select(sequence.umi_code(F.col("u")).alias("c"))
    assert [r.c for r in d.collect()] == [27, None, None]


def test_distributions(spark):
    d = spark.range(1).select(
        distributions.ln_gamma(F.lit(0.3)).alias("g"), distributions.t_cdf(F.lit(-1.5), F.lit(7.5)).alias("t"), distributions.incomplete_beta(F.lit(0.2), F.lit(30.0), F.lit(4.0)).alias("b"), distributions.erf(F.lit(-0.5)).alias("e")
    )
    r = d.first()
    steps = 20_000
    pdf = lambda t, v: math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi) * (1 + t * t / v) ** (-(v + 1) / 2)
    t = 0.5 - sum(pdf((k + 0.5) * 1.5 / steps, 7.5) for k in range(steps)) * 1.5 / steps
    b = sum(math.comb(33, k) * 0.2**k * 0.8 ** (33 - k) for k in range(30, 34))
    assert abs(r.g - math.lgamma(0.3)) < 1e-9 and abs(r.t - t) < 1e-8 and abs(r.b - b) < 1e-12 and abs(r.e - math.erf(-0.5)) < 1e-12


def test_local_alignment(spark):
    rng = random.Random(5)
    pairs = [(k, "".join(rng.choices("ACGT", k=rng.randrange(0, 25))), "".join(rng.choices("ACGT", k=rng.randrange(0, 25)))) for k in range(60)] + [(60, None, "ACGT"), (61, "AACGTT", "AACGTT")]
    want = {}
    for k, a, b in pairs:
        a, b = a or "", b or ""
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        best = (0, 0, 0)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -4), h[i - 1][j] - 2, h[i][j - 1] - 2)
                if h[i][j] > best[0]:
                    best = (h[i][j], i, j)
        want[k] = best
    d = spark.createDataFrame(pairs, "k int, a string, b string")
    assert {r.k: (r.score, r.query_end, r.target_end) for r in alignment.local_scores(d, "k", "a", "b").collect()} == want
