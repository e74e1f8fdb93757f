"""What keeps the work of larger tables in proportion: plans, and cases that small tables don't show."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from countloom.functions import distributions as dist
from countloom.operators import cells, counting, elimination, genes, mappings, posterior, relational, suffixes
from countloom.plans import queries


def test_arguments_named_once(spark):
    """A fold's step reads its arguments from a struct: an expression that a step names is worked out anew in each."""
    a, x, u = F.col("arg_a"), F.col("arg_x"), F.col("arg_u")
    for c in (dist.lower_gamma(a, x), dist.incomplete_beta(x, a, F.lit(3.0)), dist.quantile(lambda v: dist.exponential_cdf(v, F.lit(0.2)), u, F.lit(0.0), F.lit(1.0)), dist.discrete_quantile(lambda k: dist.poisson_cdf(k, F.lit(4.0)), u, 63)):
        assert max(str(c).count(n) for n in ("arg_a", "arg_x", "arg_u")) == 1
    rows = [(0.5, 0.2), (0.5, 3.0), (3.0, 0.0), (3.0, 2.0), (40.0, 41.0), (40.0, 90.0), (1.0, 1e-9)]
    d = spark.createDataFrame(rows, "arg_a double, arg_x double").select(dist.lower_gamma(a, x).alias("p"), dist.incomplete_beta(F.lit(0.3), a, F.lit(2.0)).alias("b"))
    for (k, v), got in zip(rows, d.collect(), strict=True):
        term, total = 1 / k, 1 / k
        for i in range(1, 400):
            term *= v / (k + i)
            total += term
        assert got["p"] == pytest.approx(total * math.exp(k * math.log(v) - v - math.lgamma(k)) if v else 0.0, abs=1e-9)
        assert got["b"] == pytest.approx(0.3**k * (1 + k * 0.7), abs=1e-9)


@pytest.mark.parametrize("name", ["continuous_cdfs", "discrete_distributions", "distribution_samples", "error_function", "mixture_values"])
def test_heavy_rows_are_dealt(spark, name):
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_flanks_without_shrinking_frames(spark):
    d = spark.createDataFrame([("+", 1, 5, 9), ("+", 2, 20, 24), ("+", 3, 22, 23), ("-", 4, 6, 7)], "strand string, gene int, start int, end int")
    f = genes.flanked(d, ["strand"], 10)
    assert "UNBOUNDED FOLLOWING" not in f._jdf.queryExecution().toString().upper().replace("UNBOUNDEDFOLLOWING$()", "UNBOUNDED FOLLOWING")
    assert sorted((r["gene"], r["left"], r["right"]) for r in f.collect()) == [(1, -5, 19), (2, 10, 24), (3, 22, 33), (4, -4, 17)]


def test_mode_of_several_peaks():
    """16 labels with about the same many reads fit every multiple of 16: a search for one peak stops at the first."""
    for counts in ([50] * 16, [47, 52, 50, 49] * 4, [3, 90] * 8, [0] * 8 + [60] * 8):
        p = posterior.Posterior([(1 / 16, k, counts.count(k)) for k in sorted(set(counts))], 20.0, 40.0)
        lp = [p(m) for m in range(1, 400)]
        mode = max(range(399), key=lambda i: (lp[i], -i)) + 1
        cut = next(i for i in range(mode, 400) if lp[i] < lp[mode - 1] + math.log(0.05)) + 1
        w = [math.exp(v - lp[mode - 1]) for v in lp[:cut]]
        assert (p.mode(), p.mean()) == (mode, round(sum(v * (i + 1) for i, v in enumerate(w)) / sum(w)))


def test_painting_by_steps(spark):
    """No row for each base of each read is made before reads are added up."""
    hits = spark.createDataFrame([(1, 12)] * 3 + [(1, 14), (1, 40), (2, 60), (1, 99)], "gene int, mid int")
    models = spark.createDataFrame([(1, [(10, 20), (30, 41)]), (2, [(55, 60)])], "gene int, exons array<struct<s:int,e:int>>")
    d = genes.painted(hits, models, 6)
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate")  # the last step, so the first line
    want = {}
    for g, lo, hi, mid in [(1, 10, 41, 12)] * 3 + [(1, 10, 41, 14), (1, 10, 41, 40), (2, 55, 60, 60)]:
        for pos in range(max(lo, mid - 3), min(hi, mid + 3) + 1):
            want[g, pos] = want.get((g, pos), 0) + 1
    assert {(r["gene"], r["pos"]): r["depth"] for r in d.collect()} == want


def test_correlations_in_tiles(spark):
    """Equal to the correlation of joined pairs, with absent cells and features without variation, and without a row for a pair."""
    d = spark.range(700).select((F.col("id") % 35).alias("f"), F.expr("id div 35").alias("c"), (F.hash("id") % 40).alias("v")).filter("v % 7 != 0").withColumn("v", F.when(F.col("f") == 3, 2).otherwise(F.col("v")))
    of, want = {}, {}
    for r in d.collect():
        of.setdefault(r["f"], {})[r["c"]] = r["v"]
    for a in of:
        for b in of:
            x, y = zip(*((of[a][c], of[b][c]) for c in of[a] if c in of[b]), strict=True)
            if a < b and len(set(x)) > 1 and len(set(y)) > 1:
                k = min(int(abs(np.corrcoef(x, y)[0, 1]) * 20), 19)
                want.setdefault(k, [0, 0])[a % 5 != b % 5] += 1
    got = cells.correlation_classes(d, "f", "c", "v", F.col("f") % 5, 20)
    rows, total = {r["bin"]: r for r in got.collect()}, [sum(v[i] for v in want.values()) for i in (0, 1)]
    assert {k: [r["n"], r["n_background"]] for k, r in rows.items()} == want
    assert all(r["share"] == pytest.approx(want[k][0] / total[0]) and r["share_background"] == pytest.approx(want[k][1] / total[1]) for k, r in rows.items())
    assert "FlatMapGroupsInArrow" in queries.QUERIES["class_correlations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()


@pytest.mark.parametrize("stretch", [2, 3, 7, 1000])
def test_tridiagonal_in_stretches(spark, stretch):
    """Systems of many lengths that begin anywhere, with zero coefficients, in stretches of several lengths."""
    rows, want = [], {}
    for k, n in enumerate([1, 2, 3, 5, 6, 7, 20, 41]):
        a, c, d, first = [(i * k) % 4 - 1.0 for i in range(n)], [(i + k) % 3 - 1.0 for i in range(n)], [i * 1.5 - k for i in range(n)], k * 3 - 5
        m = np.diag([9.0] * n) + np.diag(a[1:], -1) + np.diag(c[:-1], 1)
        want |= {(k, first + i): x for i, x in enumerate(np.linalg.solve(m, d))}
        rows += [(k, first + i, a[i], 9.0, c[i], d[i]) for i in range(n)]
    e = spark.createDataFrame(rows, "k int, i long, a double, b double, c double, d double")
    got = {(r["k"], r["i"]): r["x"] for r in elimination.tridiagonal(e, ["k"], "i", "a", "b", "c", "d", stretch).collect()}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], abs=1e-9) for x in want)


@pytest.mark.parametrize("paired", [0, 3, 1024])
def test_arrivals_by_pairs_and_asks(spark, monkeypatch, paired):
    monkeypatch.setattr(counting, "PAIRED", paired)
    d = spark.range(400).select((F.col("id") % 3).alias("g"), (F.col("id") % 5).alias("p"), "id", (F.abs(F.hash("id")) % 64).alias("u"))
    rows, met, want = sorted(d.collect(), key=lambda r: r["id"]), {}, {}
    far = lambda x, y: sum((x >> 2 * i & 3) != (y >> 2 * i & 3) for i in range(3))
    for r in rows:
        before = met.setdefault((r["g"], r["p"]), [])
        if r["u"] not in before:
            want[r["id"]] = (any(far(r["u"], v) == 1 for v in before), any(far(r["u"], v) <= 2 for v in before))
            before.append(r["u"])
    got = counting.arrivals(d, "g", ["id"], ["p"], "u", 3)
    assert {r["id"]: (r["_near1"], r["_near2"]) for r in got.collect()} == want


@pytest.mark.parametrize("name", ["aligned_strings", "local_alignments"])
def test_pairs_are_dealt(spark, name):
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_closure_without_broadcasts(spark, monkeypatch):
    """Every pass is shuffled, also where its tables are small enough to be broadcast."""
    plans, kept = [], relational.kept
    monkeypatch.setattr(relational, "kept", lambda d: (plans.append(d._jdf.queryExecution().executedPlan().toString()), kept(d))[1])
    d = spark.createDataFrame([(2, 1), (3, 1), (4, 2), (5, 4), (1, 5)], "c int, p int")
    got = {tuple(r) for r in relational.closure(d, "c", "p").collect()}
    assert got == {(c, p) for c in (1, 2, 4, 5) for p in (1, 2, 4, 5)} | {(3, p) for p in (1, 2, 4, 5)}
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_search_is_dealt(spark, monkeypatch):
    """Places come from all cores, and the substitutions of reads, whose number Spark can't tell, are never broadcast whole."""
    plans, kept = [], suffixes.kept
    monkeypatch.setattr(suffixes, "kept", lambda d: (plans.append(d._jdf.queryExecution().executedPlan().toString()), kept(d))[1])
    c = spark.createDataFrame([(1, "ACGTTGCAACCGGTTAACGT"), (2, "TTTTACGTTGCAACCG")], "name int, t string").coalesce(1)
    r = spark.createDataFrame([(1, "ACGTTGCAACCG"), (2, "ACGTAGCAACCG"), (3, "CCCCCCCCCCCC")], "id int, s string")
    assert suffixes.places(c, "name", "t", 4).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    got = sorted(map(tuple, suffixes.mismatch_hits(r, c, "id", "s", "name", "t", 1).select("read", "n_mismatches", "contig", "pos").collect()))
    assert got == [(1, 0, 1, 0), (1, 0, 2, 4), (2, 1, 1, 0), (2, 1, 2, 4)]
    assert sum("ShuffledHashJoin" in p for p in plans) == 2


@pytest.mark.parametrize(("heavy", "start"), [(10**9, 27), (10**9, 3), (2, 5)])
def test_only_tied_suffixes_go_on(spark, monkeypatch, heavy, start):
    """Texts as numbers, with groups sorted at once or counted first; without repeats there is no round of doubling."""
    rounds, totals = [], suffixes.running_totals
    monkeypatch.setattr(suffixes, "HEAVY", heavy)
    monkeypatch.setattr(suffixes, "running_totals", lambda d, order, *a: (rounds.append(order), totals(d, order, *a))[1])
    texts = {1: "ACGT" * 3 + "A" * 12, 2: "ACGT" * 3 + "A" * 12, 3: "T", 4: "GATTACA"} if start < 27 else {1: "ACGTTGCAAGGCCTTAACCGGATCTTGACA", 2: "TTGACA", 3: "C" * 20}
    d = spark.createDataFrame(list(texts.items()), "name int, t string")
    every = sorted(t[i:] for t in texts.values() for i in range(len(t)))
    got = {(r.contig, r.pos): r["rank"] for r in suffixes.suffix_order(d, "name", "t", start).collect()}
    assert got == {(n, i): every.index(t[i:]) for n, t in texts.items() for i in range(len(t))}
    assert any("_ahead" in o for o in rounds) == (start < 27)


def test_shared_genes_in_many_tasks(spark, monkeypatch):
    """Reads and pairs are dealt to as many tasks as there are rows for; a repeat counts also where a strand is null."""
    monkeypatch.setattr(mappings, "ROWS", 2)
    monkeypatch.setattr(mappings, "PAIRS", 1)
    m = spark.createDataFrame([(1, 1, 5, "+"), (1, 2, 25, "+"), (2, 1, 5, "+"), (2, 2, 25, "+"), (3, 1, 6, "+"), (4, 1, 5, "+"), (4, 2, 25, "+"), (4, 3, 90, None), (5, 1, None, "+"), (5, 2, 6, "+"), (6, 1, 90, "+")], "r int, k int, pos int, strand string")
    g = spark.createDataFrame([(1, "+", [(1, 9)]), (2, "+", [(20, 29)]), (3, "+", [(6, 6), (8, 8)])], "gene int, strand string, exons array<struct<s:int,e:int>>")
    d = mappings.shared_genes(m, g, spark.createDataFrame([(85, 95)], "start int, end int"), "r", "k", 10)
    assert sorted(map(tuple, d.collect())) == [(1, 2, 2), (1, 3, 2), (2, 1, 2), (3, 1, 2)]
    assert "REPARTITION_BY_NUM" in d._jdf.queryExecution().executedPlan().toString()
