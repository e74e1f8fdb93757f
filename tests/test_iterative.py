"""Operators that SQL can't express, against plain Python."""

import numpy as np
import pytest

from countloom.operators import alignment, assembly, posterior, qt, ranks, suffixes


def plain_alignment(a, b, match=2, mismatch=4, gap=2):
    s = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    way, best = {}, (0, 0, 0)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            q, t, m = s[i - 1][j] - gap, s[i][j - 1] - gap, s[i - 1][j - 1] + (match if a[i - 1] == b[j - 1] else -mismatch)
            if q > t and q > m and q > 0:
                s[i][j], way[i, j] = q, "q"
            elif t > m and t > 0:
                s[i][j], way[i, j] = t, "t"
            elif m > 0:
                s[i][j], way[i, j] = m, "p"
            if s[i][j] > best[0]:
                best = (s[i][j], i, j)
    score, i, j = best
    top = under = ""
    ends, equal = (i, j), 0
    while (i, j) in way:
        w = way[i, j]
        i, j = i - (w != "t"), j - (w != "q")
        top, under = (a[i] if w != "t" else "-") + top, (b[j] if w != "q" else "-") + under
        equal += w == "p" and a[i] == b[j]
    return score, i, ends[0], j, ends[1], equal, top, under


def test_local_alignments(spark):
    rng = np.random.default_rng(1)
    pairs = [("", "ACGT"), (None, "A"), ("AAAA", "CCCC"), ("ACGTACGT", "ACGTACGT"), ("ACGTTTACGT", "ACGTACGT"), ("ACGTACGT", "ACGTTTACGT"), ("AAAATTTT" * 40, "AAAACTTTT" * 50)]
    for _ in range(120):
        a = "".join(rng.choice(list("ACGT"), rng.integers(1, 40)))
        cut = int(rng.integers(0, len(a)))
        pairs.append((a, "".join(rng.choice(list("ACGT"), rng.integers(0, 9))) + a[:cut] + a[cut + 1 :] + "".join(rng.choice(list("ACGT"), rng.integers(0, 9)))))
    d = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id long, a string, b string")
    got = {r[0]: tuple(r[1:]) for r in alignment.local_alignments(d, "id", "a", "b").collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[i] == plain_alignment(a or "", b or ""), (a, b)


def greedy(words):
    """Overlaps from the heaviest down, where both ends are free and no ring closes."""
    edges = sorted((-min(n, m), -(n + m), a, b) for a, n in words.items() for b, m in words.items() if a != b and a[1:] == b[:-1])
    after, before = {}, {}
    for *_, a, b in edges:
        end = b
        while end in after:
            end = after[end]
        if a not in after and b not in before and end != a:
            after[a], before[b] = b, a
    out = []
    for w in words:
        if w not in before:
            chain = [w]
            while chain[-1] in after:
                chain.append(after[chain[-1]])
            out.append((w, len(chain), w + "".join(x[-1] for x in chain[1:]), sum(words[x] for x in chain)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_assembly(spark, seed):
    rng = np.random.default_rng(seed)
    text = "".join(rng.choice(list("ACGT"), 60))
    words = {text[i : i + 6]: int(rng.integers(1, 1000)) for i in range(0, 54)}
    words |= {"".join(rng.choice(list("ACGT"), 6)): int(rng.integers(1, 1000)) for _ in range(20)}
    words |= {"AAAAAA": 5000, "TATATA": 7, "ATATAT": 9}
    d = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sorted((r.start, r.n_words, r.consensus, r.weight) for r in assembly.assembled(d, "word", "n").collect())
    assert got == greedy(words)


def test_ring_and_none(spark):
    """A ring is cut where it is lightest; words without overlaps stay alone."""
    words = {"ABC": 9, "BCA": 5, "CAB": 7, "XYZ": 1}
    d = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sorted((r.start, r.consensus) for r in assembly.assembled(d, "word", "n").collect())
    assert got == sorted((x[0], x[2]) for x in greedy(words)) and ("XYZ", "XYZ") in got
    assert assembly.assembled(d.filter("word = 'XYZ'"), "word", "n").count() == 1


def plain_qt(n, s, threshold):
    left, out = set(range(n)), []
    while left:
        best = None
        for seed in sorted(left):
            members = [seed]
            while True:
                options = [(min(s[m][i] for m in members), -i) for i in left - set(members)]
                top = max(options, default=(-1, 0))
                if top[0] < threshold:
                    break
                members.append(-top[1])
            if best is None or len(members) > len(best):
                best = members
        out.append(best)
        left -= set(best)
    return out


def test_quality_clusters(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(40, 3)).round(1)
    s = np.round(1 / (1 + ((points[:, None] - points[None]) ** 2).sum(axis=2)), 2)
    d = spark.createDataFrame([(i, j, float(s[i, j])) for i in range(40) for j in range(i)], "first int, second int, similarity double")
    got = {(r.item, r.cluster, r.place) for r in qt.quality_clusters(d, 0.3).collect()}
    assert got == {(m, c, p) for c, members in enumerate(plain_qt(40, s, 0.3), 1) for p, m in enumerate(members, 1)}
    with pytest.raises(ValueError):
        qt.quality_clusters(d, 0.3, 39)


def test_running_totals(spark):
    """Sums and ranks over the whole order, with a value that holds most rows."""
    rng = np.random.default_rng(4)
    x = [5] * 3000 + rng.integers(0, 900, 2000).tolist()
    d = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "id long, v int")
    got = {r.id: r["rank"] for r in ranks.ranked(d, ["v"]).collect()}
    order = np.sort(x)
    assert got == {i: int(np.searchsorted(order, v)) for i, v in enumerate(x)}


def test_suffixes(spark):
    """Repeats that need several doublings, equal contigs, and contigs of any length."""
    texts = {1: "ABAB" * 30, 2: "ABAB" * 30, 3: "A", 4: "", 5: "B" * 70 + "A", 6: "AB" * 300}
    d = spark.createDataFrame(list(texts.items()), "name int, t string")
    every = sorted(t[i:] for t in texts.values() for i in range(len(t)))
    first = {}
    for k, x in enumerate(every):
        first.setdefault(x, k)
    got = {(r.contig, r.pos): r["rank"] for r in suffixes.suffix_order(d, "name", "t", 2).collect()}
    assert got == {(n, i): first[t[i:]] for n, t in texts.items() for i in range(len(t))}


def test_mismatch_hits(spark):
    """Reads of several lengths with up to three mismatches; reads without a place, letters outside the alphabet, null and empty reads."""
    rng = np.random.default_rng(5)
    contigs = {i: "".join(rng.choice(list("ACGT"), 300)) for i in range(4)} | {9: "ACGTN" * 20, 10: "AC"}
    reads = {100: None, 101: "", 102: "N" * 9, 103: "ACGTNACGT", 104: "A" * 13}
    for k in range(60):
        t, n = contigs[k % 4], [9, 13, 20][k % 3]
        at = int(rng.integers(0, 300 - n))
        r = list(t[at : at + n])
        for i in rng.choice(n, k % 5, replace=False):
            r[i] = "ACGT"[("ACGT".index(r[i]) + 1) % 4]
        reads[k] = "".join(r)
    want = set()
    for name, r in reads.items():
        places = [(sum(x != y for x, y in zip(r, t[p : p + len(r)], strict=True)), c, p) for c, t in contigs.items() for p in range(len(t) - len(r) + 1)] if r else []
        if name == 103 or name == 102:  # other letters match themselves only
            places = [x for x in places if x[0] == 0]
        places = [x for x in places if "N" not in contigs[x[1]][x[2] : x[2] + len(r)] or x[0] == 0]
        low = min((x[0] for x in places), default=9)
        want |= {(name, c, p, m) for m, c, p in places if m == low and m <= 3}
    r = spark.createDataFrame(list(reads.items()), "id int, seq string")
    c = spark.createDataFrame(list(contigs.items()), "name int, t string")
    got = {tuple(x) for x in suffixes.mismatch_hits(r, c, "id", "seq", "name", "t", 3).select("read", "contig", "pos", "n_mismatches").collect()}
    assert {x for x in got if x[0] != 103} == {x for x in want if x[0] != 103}
    assert {x for x in want if x[0] == 103} <= got


def test_interval_hits(spark):
    """The suffixes in an interval are those that start with the read, up to its mismatches."""
    texts = {1: "ACGTACGTTACGAACGT", 2: "TTACGTACG"}
    d = spark.createDataFrame(list(texts.items()), "name int, t string")
    order = suffixes.suffix_order(d, "name", "t").join(suffixes.places(d, "name", "t", 10), ["contig", "pos"])
    reads = {1: "ACGT", 2: "ACGTACGT", 3: "TACGAACGTT", 4: "GGGGG", 5: "TTACGTACC"}
    r = spark.createDataFrame(list(reads.items()), "id int, s string")
    rank = {(x.contig, x.pos): x["rank"] for x in order.collect()}
    got = {}
    for h in suffixes.interval_hits(r, "id", "s", order.select("prefix", "rank"), 1).collect():
        got.setdefault(h.read, set()).update((p, h.n_mismatches) for p, k in rank.items() if h["from"] <= k <= h["to"])
    for i, s in reads.items():
        near = [((c, p), sum(x != y for x, y in zip(s, t[p : p + len(s)], strict=True))) for c, t in texts.items() for p in range(len(t) - len(s) + 1)]
        low = min((n for _, n in near), default=9)
        assert got.get(i, set()) == {x for x in near if x[1] == low and low <= 1}


@pytest.mark.parametrize("outer", [False, True])
def test_posterior(spark, outer):
    """Mean and mode against sums over a grid, with labels of equal and of given frequencies."""
    import math

    def log_binomial(n, k, p):
        if not 0 <= k <= n or (p == 0 and k) or (p == 1 and k < n):
            return -math.inf
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + (k * math.log(p) if k else 0) + ((n - k) * math.log1p(-p) if n > k else 0)

    def value(m, labels, mean, var):
        total, f = sum(k for _, k in labels), sum(f for f, _ in labels) * m
        def given(z):
            p = 1.0
            for freq, k in labels:
                p *= sum(math.exp(log_binomial(m, n, freq) + log_binomial(total, k, n / z)) for n in range(z))
            return p
        like = sum(given(z) * math.exp(z * math.log(f) - f - math.lgamma(z + 1)) for z in range(1, m + 1)) if outer else given(max(1, round(f)))
        p, r = mean / var, mean * mean / (var - mean)
        return like * math.exp(math.lgamma(r + m) - math.lgamma(r) - math.lgamma(m + 1) + r * math.log(p) + m * math.log(1 - p))

    groups = {"a": [1, 2, 0, 0], "b": [5, 1, 1, 3], "c": [0, 0, 9, 0]}
    rows = [(g, 0.2 + 0.05 * i, k) for g, ks in groups.items() for i, k in enumerate(ks)]
    d = spark.createDataFrame(rows, "g string, f double, k long")
    even = posterior.posterior_counts(d.filter("k > 0").drop("f"), ["g"], "k", 4, 1.0, 6.0, 12.0, outer=outer)
    given = posterior.posterior_counts(d, ["g"], "k", 4, 1.0, 6.0, 12.0, "f", outer)
    for out, frequency in ((even, lambda i: 0.25), (given, lambda i: 0.2 + 0.05 * i)):
        got = {r.g: (r["mean"], r["mode"]) for r in out.collect()}
        for g, ks in groups.items():
            p = [value(m, [(frequency(i), k) for i, k in enumerate(ks)], 6.0, 12.0) for m in range(1, 45)]
            top = max(p)
            cut = next(i for i in range(p.index(top), 44) if p[i] < 0.05 * top)
            mean = sum(x * (i + 1) for i, x in enumerate(p[: cut + 1])) / sum(p[: cut + 1])
            assert got[g] == (round(mean), p.index(top) + 1)
