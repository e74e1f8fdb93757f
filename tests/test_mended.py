"""Cases that once went wrong, and operators in further detail."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from countloom.functions import distributions as dist
from countloom.operators import clusters, counting, logodds, mappings, reads, series, simplex, umi
from countloom.sources import readers, writers


def test_headers_of_several_files(spark, tmp_path):
    """Small files are read together; each loses its own first line only."""
    for i in range(12):
        (tmp_path / f"f{i}.tsv").write_text(f"name\tn\n\na\"{i}\t{i}\n b\t{i}\n")
    d = readers.mapped(spark, str(tmp_path), {"s": lambda f: f[0], "n": lambda f: f[1].cast("int")}, header=True)
    assert sorted((r.s, r.n) for r in d.collect()) == sorted([(f'a"{i}', i) for i in range(12)] + [(" b", i) for i in range(12)])
    assert readers.mapped(spark, str(tmp_path), {"s": lambda f: f[0]}).count() == 36


def test_tree_of_merges(spark, tmp_path):
    """Agglomeration's own merge list makes a tree; distances make a PHYLIP table."""
    assert writers.newick([(1, 2, 0.5), (1, 3, 2.0)]) == "((1:0.5,2:0.5):1.5,3:2);"
    pairs = spark.createDataFrame([(1, 2, 1.0), (1, 3, 4.0), (2, 3, 5.0), (1, 4, 9.0), (2, 4, 9.5), (3, 4, 7.0)], "first int, second int, distance double")
    text = writers.newick(clusters.agglomerated(pairs, "single"), {1: "a", 2: "b", 3: "c", 4: "d"})
    assert text == "(((a:1,b:1):3,c:4):3,d:7);"
    writers.phylip(pairs, str(tmp_path / "p"), [1, 2, 3, 4])
    lines = [r.value for r in spark.read.text(str(tmp_path / "p")).collect()]
    assert lines[0] == "4" and lines[2].split() == ["2", "1.000000", "0.000000", "5.000000", "9.500000"]


def test_unequal_files(spark):
    a = spark.createDataFrame([(0, "x 1", "A"), (1, "y 1", "C"), (2, "z 1", "G")], "at long, header string, seq string")
    b = a.withColumn("header", F.concat(F.substring_index("header", " ", 1), F.lit(" 2")))
    assert reads.zipped(a, b, "at", "header").count() == 3
    for wrong, text in ((b.filter("at < 2"), "no partner for record 2"), (b.withColumn("header", F.lit("x 2")), "headers differ")):
        for x, y in ((a, wrong), (wrong, a)):
            with pytest.raises(Exception, match=text):
                reads.zipped(x, y, "at", "header").collect()


def test_transposase(spark):
    """The transposase comes first, also cut by the read's end; without a switch sequence only it and the first primer are known."""
    n = "ACGTACGTCA"
    rows = [n + reads.TN5 + n, n + reads.TN5[:13], n + reads.TN5[:12] + "GGG" + n, n + reads.ARTEFACTS[0][1] + reads.TN5, n + reads.ARTEFACTS[1][1], n + reads.ARTEFACTS[0][1]]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, s string")
    got = [tuple(r)[1:] for r in d.select("i", reads.artefact(F.col("s"), "BC"), reads.artefact(F.col("s"), "SW", reads.ARTEFACTS[:1])).orderBy("i").collect()]
    assert got == [("BC_TN5", "SW_TN5"), ("BC_TN5", "SW_TN5"), ("BC_OTHER", "SW_OTHER"), ("BC_TN5", "SW_TN5"), ("BC_PHIX", "SW_OTHER"), ("BC_P1", "SW_P1")]


def test_exons_and_transcript_distance(spark):
    """An intron is no transcript; a gene with a long first intron is nearer along its transcript than one whose start is nearer on the genome."""
    m = spark.createDataFrame([(1, 1000, "+"), (2, 500, "+"), (3, 1000, "-")], "k int, pos long, strand string")
    genes = spark.createDataFrame([("long", "+", [(0, 9), (995, 1010)]), ("near", "+", [(900, 1010)]), ("back", "-", [(990, 1001), (1100, 1104)])], "gene string, strand string, exons array<struct<s:long,e:long>>")
    got = sorted(tuple(r) for r in mappings.nearest_match(m, genes, ["k"], 100).collect())
    assert got == [(1, "long", 15, True), (3, "back", 6, False)]
    other = mappings.other_features(m, genes, {"repeat": spark.createDataFrame([(490, 510)], "start long, end long")}, ["k"], 100)
    assert [tuple(r) for r in other.collect()] == [(2, "repeat")]


def test_spacing(spark):
    """Places are spaced in order first; the largest of what is left come first."""
    d = spark.createDataFrame([("a", p, n) for p, n in ((0, 3), (4, 5), (8, 9), (30, 2), (31, 8), (36, 1))], "k string, p long, n int")
    assert sorted(r.p for r in series.spaced(d, ["k"], "p", 5).collect()) == [0, 8, 30, 36]
    assert [r.p for r in series.spaced_top(d, ["k"], "p", "n", 2, 5).orderBy(F.desc("n")).collect()] == [8, 0]


def test_simplex(spark):
    """A bent valley and a bowl with 100 different floors."""
    bent = lambda p, h: (h["a"] - p[:, 0]) ** 2 + 100 * (p[:, 1] - p[:, 0] ** 2) ** 2
    rows = [(i, i / 50 - 1, -1.5 + i / 40, 1.0) for i in range(100)] + [(1000, None, 1.0, 1.0)]
    d = spark.createDataFrame(rows, "id int, a double, x double, y double")
    got = {r.id: r for r in simplex.minimised(d, ["id"], ["x", "y"], ["a"], bent).collect()}
    assert all(abs(got[i].x[0] - a) < 1e-4 and abs(got[i].x[1] - a * a) < 1e-4 for i, a, _, _ in rows[:100])
    assert len(got) == 101 and got[1000].value == float("inf")
    bowl = lambda p, h: (p[:, 0] - h["a"]) ** 2 + 3 * (p[:, 1] + h["a"]) ** 2 + h["a"]
    got = {r.id: r for r in simplex.minimised(d.filter("id < 100"), ["id"], ["x", "y"], ["a"], bowl).collect()}
    assert all(abs(got[i].x[0] - a) < 1e-6 and abs(got[i].value - a) < 1e-9 for i, a, _, _ in rows[:100])


def test_samples(spark):
    """Draws repeat, and their moments are those of their distributions."""
    d = spark.range(3000).withColumn("u", dist.uniform_draw("seed", "id"))
    draws = {
        "normal": (dist.quantile(lambda x: dist.normal_cdf(x, 5.0, 2.0), F.col("u"), F.lit(0.0), F.lit(1.0), 20, 45), 5, 4),
        "gamma": (dist.quantile(lambda x: dist.gamma_cdf(x, F.lit(3.0), F.lit(2.0)), F.col("u"), F.lit(0.0), F.lit(1.0), 20, 40), 6, 12),
        "exponential": (dist.quantile(lambda x: dist.exponential_cdf(x, F.lit(0.5)), F.col("u"), F.lit(0.0), F.lit(1.0)), 2, 4),
        "binomial": (dist.discrete_quantile(lambda k: dist.binomial_cdf(k, F.lit(20), F.lit(0.3)), F.col("u"), 20), 6, 4.2),
    }
    out = d.select(*(c.alias(n) for n, (c, _, _) in draws.items()))
    first = out.agg(*(f(n).alias(f"{n}{i}") for n in draws for i, f in enumerate((F.avg, F.var_samp)))).first()
    for n, (_, mean, variance) in draws.items():
        assert abs(first[f"{n}0"] - mean) < 0.08 * mean and abs(first[f"{n}1"] - variance) < 0.12 * variance, n
    again = spark.range(3000, numPartitions=3).withColumn("u", dist.uniform_draw("seed", "id"))
    assert {tuple(r) for r in d.collect()} == {tuple(r) for r in again.collect()}
    x = spark.range(400).select((F.col("id") / 10 + 0.05).alias("x"))
    for pdf, cdf in ((dist.gamma_pdf(F.col("x"), F.lit(3.0), F.lit(2.0)), None), (dist.f_pdf(F.col("x"), F.lit(5.0), F.lit(9.0)), None), (dist.chi_square_pdf(F.col("x"), F.lit(4.0)), None), (dist.exponential_pdf(F.col("x"), F.lit(0.5)), None)):
        assert abs(x.agg(F.sum(pdf) / 10).first()[0] - 1) < 0.02


def test_arrivals(spark):
    """A code counts as off by one or two only if the other came before it at the same place."""
    rows = [(1, "p", 0b0000), (2, "p", 0b0001), (3, "p", 0b1111), (4, "q", 0b0001), (5, "p", 0b0001), (6, "q", 0b110001)]
    d = spark.createDataFrame([("g", *r) for r in rows], "g string, t int, p string, u int")
    got = {(r.p, r.u): (r._near1, r._near2) for r in counting.arrivals(d, "g", ["t"], ["p"], "u", 3).collect()}
    assert got == {("p", 0): (False, False), ("p", 1): (True, True), ("p", 15): (False, True), ("q", 1): (False, False), ("q", 0b110001): (True, True)}
    one, two = counting.one_and_two_off(6)
    assert len(set(one)) == 18 and len(set(two)) == 135


def test_equal_count_bins(spark):
    """Bins by ranks, with a value that holds most of a class, and fewer values than bins."""
    rng = np.random.default_rng(6)
    values = {True: [3.0] * 500 + rng.normal(size=223).round(3).tolist(), False: [1.0, 2.0, 4.0]}
    d = spark.createDataFrame([(k, v) for k, x in values.items() for v in x] + [(True, None)], "k boolean, x double")
    got = {(r.positive, r.bin): (r.n, r.low, r.high) for r in logodds.equal_count_bins(d, "x", F.col("k"), 7).collect()}
    want = {}
    for k, x in values.items():
        x = sorted(x)
        for b in range(7):
            part = x[b * len(x) // 7 : (b + 1) * len(x) // 7]
            if part:
                want[k, b] = (len(part), part[0], part[-1])
    assert {k: v for k, v in got.items() if k[0]} == {k: v for k, v in want.items() if k[0]}


def test_dense_rules(spark):
    """A low pass at 1 is the singleton rule at 0; rules on counts have no dense form."""
    assert umi.dense_rule("lowpass", 1) == ("singleton", 0) and umi.dense_rule("none", 7) == ("none", 7)
    for rule, param in (("lowpass", 2), ("singleton", 1), ("fraction_of_max", 3)):
        with pytest.raises(ValueError):
            umi.dense_rule(rule, param)
    d = spark.createDataFrame([("a", 1)] * 5 + [("a", 2), ("b", 3)], "k string, u long")
    assert sorted(tuple(r) for r in umi.dense_molecule_counts(d, ["k"], "u", "singleton", 0).collect()) == [("a", 6, 2, 1), ("b", 1, 1, 0)]
