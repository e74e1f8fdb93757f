"""The queries of posteriors, samples, mixtures, log odds, fits, systems, clusters and assembled words, as (function, DuckDB SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.functions import distributions as dist
from countloom.functions import sequence
from countloom.operators import algebra, alignment, assembly, cells, elimination, logodds, posterior, qt, simplex

from .cells import MATRIX, matrix
from .profiles import TAGS, _tags, rounded, spread, table
from .variants import oligos

QUERIES = []


def query(sql: str | None):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


@query(f"""{TAGS}, g AS (SELECT user_id, event_type, list(n ORDER BY n) AS p FROM tags GROUP BY ALL), u AS (SELECT DISTINCT p, CAST(list_sum(p) AS BIGINT) AS r FROM g),
    l AS (SELECT p, r, k, count(*) AS times FROM (SELECT p, r, unnest(p) AS k FROM u) GROUP BY ALL UNION ALL SELECT p, r, 0, 16 - len(p) FROM u WHERE len(p) < 16),
    t AS (SELECT p, r, k, times, m, n, lgamma(m + 1) - lgamma(n + 1) - lgamma(m - n + 1) + n * ln(1 / 16) + (m - n) * ln(15 / 16) + lgamma(r + 1) - lgamma(k + 1) - lgamma(r - k + 1) + CASE WHEN k = 0 THEN 0 ELSE k * ln(n / m) END + (r - k) * ln(1 - n / m) AS x
      FROM (SELECT *, unnest(range(0, m)) AS n FROM (SELECT *, unnest(range(2, 161)) AS m FROM l)) WHERE n > 0 OR k = 0),
    f AS (SELECT p, k, times, m, max(x) AS top FROM t GROUP BY ALL), s AS (SELECT f.p, f.m, f.k, f.times, any_value(f.top) + ln(sum(exp(t.x - f.top))) AS v FROM t JOIN f ON t.p = f.p AND t.k = f.k AND t.m = f.m GROUP BY f.p, f.m, f.k, f.times),
    q AS (SELECT p, m, sum(times * v) + lgamma(20 + m) - lgamma(20) - lgamma(m + 1) + 20 * ln(0.5) + m * ln(0.5) AS lp FROM s GROUP BY p, m), b AS (SELECT p, arg_max(m, (lp, -m)) AS mode, max(lp) AS top FROM q GROUP BY p),
    e AS (SELECT b.p, b.mode, b.top, min(q.m) AS cut FROM q JOIN b ON q.p = b.p WHERE q.m > b.mode AND q.lp < b.top + ln(0.05) GROUP BY b.p, b.mode, b.top),
    o AS (SELECT e.p, e.mode, CAST(round_even(sum(m * exp(lp - top)) / sum(exp(lp - top)), 0) AS BIGINT) AS mean FROM q JOIN e ON q.p = e.p WHERE m <= cut GROUP BY e.p, e.mode)
    SELECT user_id, event_type, mean, mode FROM g JOIN o USING (p)""")
def molecule_posterior(spark, sf_dir):
    return posterior.posterior_counts(_tags(spark, sf_dir), ["user_id", "event_type"], "n_reads", 16, 1.0, 20.0, 40.0)


DRAW = "(('0x' || substr(md5('{s}|' || c_custkey), 1, 13))::BIGINT + 0.5) / 2.0 ** 52"


@query(f"""WITH u AS (SELECT c_custkey, CAST({DRAW.format(s='e')} AS DOUBLE) AS a, CAST({DRAW.format(s='p')} AS DOUBLE) AS b FROM customer),
    p AS (SELECT k, sum(exp(k * ln(4) - 4 - lgamma(k + 1))) OVER (ORDER BY k) AS c FROM (SELECT unnest(range(0, 64)) AS k))
    SELECT c_custkey, round(-ln(1 - a) / 0.2, 5) AS exponential, round(10 + 20 * a, 5) AS uniform, (SELECT min(k) FROM p WHERE c >= b) AS poisson FROM u""")
def distribution_samples(spark, sf_dir):
    """The same for every run, as keys and a seed name the draws."""
    a, b = dist.uniform_draw("e", "c_custkey"), dist.uniform_draw("p", "c_custkey")
    exponential = dist.quantile(lambda x: dist.exponential_cdf(x, F.lit(0.2)), a, F.lit(0.0), F.lit(1.0))
    uniform = dist.quantile(lambda x: dist.uniform_cdf(x, 10.0, 30.0), a, F.lit(10.0), F.lit(30.0))
    poisson = dist.discrete_quantile(lambda k: dist.poisson_cdf(k, F.lit(4.0)), b, 63)
    return spread(table(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", F.round(exponential, 5).alias("exponential"), F.round(uniform, 5).alias("uniform"), poisson.alias("poisson"))


NORMAL = "0.5 * (1 + 2 / sqrt(pi()) * list_sum(list_transform(range(0, 90), lambda k: (-1) ** k * ((x - {m}) / ({s} * sqrt(2.0))) ** (2 * k + 1) / exp(lgamma(k + 1)) / (2 * k + 1))))"
BELL = "exp(-0.5 * ((x - {m}) / {s}) ** 2) / ({s} * sqrt(2 * pi()))"


@query(f"""WITH v AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x FROM part) SELECT p_partkey, round(0.3 * {NORMAL.format(m='20.0', s='10.0')} + 0.5 * {NORMAL.format(m='30.0', s='8.0')} + 0.2 * (1 - exp(-0.1 * x)), 6) AS cdf,
    round(0.3 * {BELL.format(m='20.0', s='10.0')} + 0.5 * {BELL.format(m='30.0', s='8.0')} + 0.2 * 0.1 * exp(-0.1 * x), 6) AS pdf FROM v""")
def mixture_values(spark, sf_dir):
    x, rate = F.col("p_size").cast("double"), F.lit(0.1)
    cdf = dist.mixture([(3, dist.normal_cdf(x, 20.0, 10.0)), (5, dist.normal_cdf(x, 30.0, 8.0)), (2, dist.exponential_cdf(x, rate))])
    pdf = dist.mixture([(3, dist.normal_pdf(x, 20.0, 10.0)), (5, dist.normal_pdf(x, 30.0, 8.0)), (2, dist.exponential_pdf(x, rate))])
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", F.round(cdf, 6).alias("cdf"), F.round(pdf, 6).alias("pdf"))


#: The densities of equal-count bins of a class: o is the number of a bin among those of some width.
BINS = """v AS (SELECT l_returnflag = 'R' AS c, CAST(l_extendedprice AS DOUBLE) AS x, row_number() OVER (PARTITION BY l_returnflag = 'R' ORDER BY l_extendedprice) - 1 AS r, count(*) OVER (PARTITION BY l_returnflag = 'R') AS n FROM lineitem),
    e AS (SELECT c, b, n, (b * n) // {bins} AS lo, ((b + 1) * n) // {bins} - 1 AS hi FROM (SELECT DISTINCT c, n FROM v), (SELECT unnest(range(0, {bins})) AS b)),
    d AS (SELECT e.c, e.b, (l.x + h.x) / 2 AS x, (hi - lo + 1) / (h.x - l.x) / e.n AS y, l.x AS low, h.x AS high FROM e JOIN v l ON l.c = e.c AND l.r = lo JOIN v h ON h.c = e.c AND h.r = hi),
    w AS (SELECT c, x, y, row_number() OVER (PARTITION BY c ORDER BY b) AS o, count(*) OVER (PARTITION BY c) AS m FROM d WHERE high > low), g AS (SELECT i, lo, lo + i * (hi - lo) / {points} AS x FROM (SELECT min(low) AS lo, max(high) AS hi FROM d), (SELECT unnest(range(0, {points})) AS i))"""
#: From densities z of both classes at the points to the clamped log odds.
ODDS = """q AS (SELECT p.i, p.x, log10(greatest(p.z, 1e-12) / greatest(q.z, 1e-12)) AS v FROM z p JOIN z q ON p.i = q.i WHERE p.c AND NOT q.c), k AS (SELECT arg_max(i, (v, -i)) AS ti, max(v) AS tv FROM q), n AS (SELECT arg_min(i, (v, i)) AS li, min(v) AS lv FROM q)
    SELECT i AS point, round(CASE WHEN i < li THEN lv WHEN i > ti THEN tv ELSE v END, 6) AS log_odds FROM q, k, n"""
STEPS = "z AS (SELECT g.i, g.x, a.c, CASE WHEN a.o = 1 AND g.x <= a.x THEN a.y WHEN b.o IS NULL THEN a.y ELSE a.y + (b.y - a.y) * (g.x - a.x) / (b.x - a.x) END AS z FROM g JOIN w a ON (g.x > a.x OR a.o = 1) LEFT JOIN w b ON b.c = a.c AND b.o = a.o + 1 WHERE b.o IS NULL OR g.x <= b.x OR (a.o = 1 AND g.x <= a.x) QUALIFY row_number() OVER (PARTITION BY g.i, a.c ORDER BY a.o) = 1)"


@query(f"WITH {BINS.format(bins=50, points=200)}, {STEPS}, {ODDS}")
def step_log_odds(spark, sf_dir):
    d = logodds.step_log_odds(table(spark, sf_dir, "lineitem"), "l_extendedprice", F.col("l_returnflag") == "R", 50, 200)
    return rounded(d, "log_odds").drop("x")


#: The bends of a natural spline by elimination forwards and insertion backwards, and its values at the points.
SPLINE = """h AS (SELECT c, o, m, x, y, x - lag(x) OVER s AS l, lead(x) OVER s - x AS a, 6 * ((lead(y) OVER s - y) / (lead(x) OVER s - x) - (y - lag(y) OVER s) / (x - lag(x) OVER s)) AS t FROM w WINDOW s AS (PARTITION BY c ORDER BY o)),
    fw AS (SELECT c, o, m, CAST(0 AS DOUBLE) AS u, CAST(0 AS DOUBLE) AS v FROM h WHERE o = 1 UNION ALL SELECT h.c, h.o, h.m, h.a / (2 * (h.l + h.a) - h.l * fw.u), (h.t - h.l * fw.v) / (2 * (h.l + h.a) - h.l * fw.u) FROM fw JOIN h ON h.c = fw.c AND h.o = fw.o + 1 WHERE h.o < h.m),
    bw AS (SELECT c, o, CAST(0 AS DOUBLE) AS bend FROM h WHERE o = m UNION ALL SELECT fw.c, fw.o, CASE WHEN fw.o = 1 THEN 0 ELSE fw.v - fw.u * bw.bend END FROM bw JOIN fw ON fw.c = bw.c AND fw.o = bw.o - 1),
    j AS (SELECT w.*, bend FROM w JOIN bw ON w.c = bw.c AND w.o = bw.o),
    z AS (SELECT i, gx AS x, c, CASE WHEN (o = 1 AND gx <= x) OR xb IS NULL THEN y ELSE p * y + s * yb + ((p ** 3 - p) * bend + (s ** 3 - s) * bb) * (xb - x) ** 2 / 6 END AS z FROM (SELECT *, (xb - gx) / (xb - x) AS p, (gx - x) / (xb - x) AS s FROM
      (SELECT g.i, g.x AS gx, a.c, a.o, a.x, a.y, a.bend, b.x AS xb, b.y AS yb, b.bend AS bb FROM g JOIN j a ON (g.x > a.x OR a.o = 1) LEFT JOIN j b ON b.c = a.c AND b.o = a.o + 1 WHERE b.o IS NULL OR g.x <= b.x OR (a.o = 1 AND g.x <= a.x) QUALIFY row_number() OVER (PARTITION BY g.i, a.c ORDER BY a.o) = 1)))"""


@query(f"WITH RECURSIVE {BINS.format(bins=12, points=200)}, {SPLINE}, {ODDS}")
def spline_log_odds(spark, sf_dir):
    d = logodds.spline_log_odds(table(spark, sf_dir, "lineitem"), "l_extendedprice", F.col("l_returnflag") == "R", 12, 200)
    return rounded(d, "log_odds").drop("x")


@query("""WITH b AS (SELECT CAST(greatest(0, least(199, floor((l_extendedprice - 1000) * 200 / 100000))) AS BIGINT) AS k, count(*) FILTER (l_returnflag = 'R') AS p, count(*) FILTER (l_returnflag <> 'R') AS q FROM lineitem GROUP BY ALL),
    t AS (SELECT sum(p) AS tp, sum(q) AS tq FROM b), s AS (SELECT bin, coalesce(sum(p), 0) AS p, coalesce(sum(q), 0) AS q FROM (SELECT unnest(range(0, 200)) AS bin) LEFT JOIN b ON k BETWEEN bin - 5 AND bin + 5 GROUP BY ALL)
    SELECT bin, round(log10(greatest(p / 11 / tp, 5 / tp) / greatest(q / 11 / tq, 5 / tp)), 6) AS log_odds FROM s, t""")
def smoothed_log_odds(spark, sf_dir):
    return rounded(logodds.smoothed_log_odds(table(spark, sf_dir, "lineitem"), "l_extendedprice", F.col("l_returnflag") == "R", 1000.0, 101000.0, 200), "log_odds")


@query("SELECT l_suppkey, round(corr(l_extendedprice, l_quantity), 4) AS slope, round(1 - corr(l_extendedprice, l_quantity) ** 2, 6) AS rest FROM lineitem GROUP BY ALL HAVING var_samp(l_quantity) > 0 AND var_samp(l_extendedprice) > 0")
def simplex_lines(spark, sf_dir):
    """A line through each supplier's scaled quantities and prices, found by stepping down the mean square, which is had from sums: its slope, and the share of the variance that it leaves."""
    d = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"))
    m = d.groupBy("l_suppkey").agg(F.stddev_pop("x").alias("sx"), F.stddev_pop("y").alias("sy"), F.corr("x", "y").alias("r")).filter("sx > 0 and sy > 0")
    m = m.withColumn("a", F.lit(0.5)).withColumn("b", F.lit(0.5))

    def squares(p, held):  # of y = a + b x with means 0 and variances 1
        return 1 - 2 * p[:, 1] * held["r"] + p[:, 1] ** 2 + p[:, 0] ** 2

    found = simplex.minimised(m, ["l_suppkey"], ["a", "b"], ["r"], squares)
    return found.select("l_suppkey", (F.round(F.col("x")[1], 4) + 0.0).alias("slope"), F.round("value", 6).alias("rest"))


def _normal_equations(spark, sf_dir):
    """The 25 by 25 matrix of how often nations share a market segment, with a weighty diagonal."""
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    a, b = c.select(F.col("c_nationkey").alias("row"), "c_mktsegment", "n"), c.select(F.col("c_nationkey").alias("column"), "c_mktsegment", F.col("n").alias("m"))
    shared = a.join(b, "c_mktsegment").groupBy("row", "column").agg((F.sum(F.col("n") * F.col("m")) / 1000.0).alias("value"))
    one = spark.range(25).select(F.col("id").alias("row"), F.col("id").alias("column"), (F.col("id") % 3 + 1.0).alias("value"))
    return shared.select(F.col("row").cast("long").alias("row"), F.col("column").cast("long").alias("column"), "value").unionByName(one).groupBy("row", "column").agg(F.sum("value").alias("value"))


@query("SELECT i AS row, j AS column, CASE WHEN i = j THEN 1.0 ELSE 0.0 END::DOUBLE AS value FROM (SELECT unnest(range(0, 25)) AS i), (SELECT unnest(range(0, 25)) AS j)")
def matrix_inverse(spark, sf_dir):
    """A matrix times its inverse, in blocks of ten."""
    a = _normal_equations(spark, sf_dir)
    d = algebra.product(a, elimination.inverse(a, 25, 10))
    return d.select("row", "column", (F.round("value", 6) + 0.0).alias("value"))


@query("""WITH v AS (SELECT l_quantity AS x, l_discount * 100 AS z, l_extendedprice AS y FROM lineitem), m AS (SELECT avg(x) AS mx, avg(z) AS mz, avg(y) AS my, covar_pop(x, x) AS xx, covar_pop(z, z) AS zz, covar_pop(x, z) AS xz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy FROM v),
    b AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM m)
    SELECT 'x' AS name, round(bx, 4) AS value FROM b UNION ALL SELECT 'z', round(bz, 4) FROM b UNION ALL SELECT 'constant', round(my - bx * mx - bz * mz, 3) FROM b""")
def triangle_fit(spark, sf_dir):
    """Prices on quantities and discounts, by the triangle of all rows."""
    d = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("z"), F.col("l_extendedprice").alias("y"))
    return elimination.fitted(d, ["x", "z"], "y").withColumn("value", F.when(F.col("name") == "constant", F.round("value", 3)).otherwise(F.round("value", 4)))


def _three(t: str, k: tuple, a: str, b: str, c: str) -> str:
    """SQL of the natural spline through three points, whose one bend has a closed form."""
    h, g = k[1] - k[0], k[2] - k[1]
    bend = f"(3 * ((({c}) - ({b})) / {g} - (({b}) - ({a})) / {h}) / {h + g})"
    p, q = f"(({k[1]} - {t}) / {h})", f"(({k[2]} - {t}) / {g})"
    first = f"{p} * ({a}) + (1 - {p}) * ({b}) + ((1 - {p}) ** 3 - (1 - {p})) * {bend} * {h * h / 6}"
    return f"(CASE WHEN {t} < {k[1]} THEN {first} ELSE {q} * ({b}) + (1 - {q}) * ({c}) + ({q} ** 3 - {q}) * {bend} * {g * g / 6} END)"


XS, YS, ZS = (0.0, 20.0, 51.0), (0.0, 4.0, 10.0), ((1.0, 5.0, 2.0), (4.0, 0.0, 7.0), (3.0, 8.0, 6.0))


@query(f"WITH v AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_partkey % 11 * 1.0::DOUBLE AS y FROM part), r AS (SELECT *, {', '.join(f'{_three(chr(121), YS, *map(str, z))} AS r{i}' for i, z in enumerate(ZS))} FROM v) SELECT p_partkey, round({_three('x', XS, 'r0', 'r1', 'r2')}, 6) AS z FROM r")
def bicubic_values(spark, sf_dir):
    z = algebra.bicubic(F.col("p_size").cast("double"), F.col("p_partkey") % 11 * F.lit(1.0), list(XS), list(YS), [list(r) for r in ZS])
    return table(spark, sf_dir, "part").select("p_partkey", F.round(z, 6).alias("z"))


@query("""WITH RECURSIVE e AS (SELECT c_nationkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i, count(*) OVER (PARTITION BY c_nationkey) AS n, c_custkey, (c_custkey % 7)::DOUBLE AS a, 20.0::DOUBLE AS b, (c_custkey % 5)::DOUBLE AS c, CAST(c_acctbal AS DOUBLE) AS d FROM customer),
    f AS (SELECT k, i, n, c / b AS u, d / b AS v FROM e WHERE i = 1 UNION ALL SELECT e.k, e.i, e.n, e.c / (e.b - e.a * f.u), (e.d - e.a * f.v) / (e.b - e.a * f.u) FROM f JOIN e ON e.k = f.k AND e.i = f.i + 1),
    x AS (SELECT k, i, v AS x FROM f WHERE i = n UNION ALL SELECT f.k, f.i, f.v - f.u * x.x FROM x JOIN f ON f.k = x.k AND f.i = x.i - 1) SELECT k AS c_nationkey, CAST(i AS BIGINT) AS i, round(x, 6) AS x FROM x""")
def tridiagonal_systems(spark, sf_dir):
    """A system for each nation, over its customers in order."""
    from pyspark.sql import Window

    c = table(spark, sf_dir, "customer").withColumn("i", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).cast("long"))
    c = c.select("c_nationkey", "i", (F.col("c_custkey") % 7).alias("a"), F.lit(20.0).alias("b"), (F.col("c_custkey") % 5).alias("c"), F.col("c_acctbal").alias("d"))
    return rounded(elimination.tridiagonal(c, ["c_nationkey"], "i", "a", "b", "c", "d"), "x")


GREEDY = f"""{MATRIX}, c0 AS (SELECT n AS count, count(*) AS n FROM m GROUP BY m.n), c AS (SELECT *, row_number() OVER (ORDER BY count) AS i FROM c0), w AS (SELECT count, n, i, CAST(0 AS BIGINT) AS bin, n AS held FROM c WHERE i = 1
    UNION ALL SELECT c.count, c.n, c.i, CASE WHEN w.held >= 40 THEN w.bin + 1 ELSE w.bin END, CASE WHEN w.held >= 40 THEN c.n ELSE w.held + c.n END FROM w JOIN c ON c.i = w.i + 1)"""


@query(f"WITH RECURSIVE {GREEDY} SELECT count, n, bin FROM w")
def count_bins(spark, sf_dir):
    return cells.count_bins(matrix(spark, sf_dir).select(F.col("n").alias("count")), "count", 40)


@query(f"""WITH RECURSIVE {GREEDY}, f AS (SELECT feature, avg(n) AS mean FROM m GROUP BY ALL), v AS (SELECT feature, cell, bin, mean FROM m JOIN w ON w.count = m.n JOIN f USING (feature)), k AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY feature, cell) - 1 AS k, count(*) OVER (PARTITION BY bin) AS size FROM v),
    d AS (SELECT a.feature, a.cell, t, b.mean AS x FROM k a, (SELECT unnest(range(1, 6)) AS t) JOIN k b ON b.bin = a.bin AND b.k = ('0x' || substr(md5('s|' || t || '|' || a.feature || '|' || a.cell), 1, 12))::BIGINT % a.size),
    p AS (SELECT a.feature AS first, b.feature AS second, a.t, count(*) AS n, sum(a.x) AS sx, sum(b.x) AS sy, sum(a.x * a.x) AS sxx, sum(b.x * b.x) AS syy, sum(a.x * b.x) AS sxy FROM d a JOIN d b ON a.cell = b.cell AND a.t = b.t AND b.feature = a.feature + 1 GROUP BY ALL),
    r AS (SELECT first, second, CASE WHEN (sxx - sx * sx / n) * (syy - sy * sy / n) > 1e-9 THEN (sxy - sx * sy / n) / sqrt((sxx - sx * sx / n) * (syy - sy * sy / n)) ELSE 0 END AS r FROM p) SELECT first, second, round(avg(r), 5) AS mean, round(var_samp(r), 5) AS variance FROM r GROUP BY ALL""")
def drawn_correlations(spark, sf_dir):
    m = matrix(spark, sf_dir)
    pairs = m.select(F.col("feature").alias("first"), (F.col("feature") + 1).alias("second")).distinct()
    d = cells.drawn_correlations(m, "feature", "cell", "n", pairs, 40, 5, "s")
    return d.select("first", "second", F.round("mean", 5).alias("mean"), F.round("variance", 5).alias("variance"))


@query(f"""WITH {MATRIX}, r AS (SELECT a.feature AS a, b.feature AS b, corr(a.n, b.n) AS r FROM m a JOIN m b ON a.cell = b.cell AND a.feature < b.feature GROUP BY ALL), k AS (SELECT CAST(least(floor(abs(r) * 20), 19) AS BIGINT) AS bin, a % 5 = b % 5 AS same FROM r WHERE r IS NOT NULL AND NOT isnan(r)),
    n AS (SELECT bin, count(*) FILTER (same) AS n, count(*) FILTER (NOT same) AS n_background FROM k GROUP BY ALL) SELECT bin, n, n_background, round(n / (SELECT sum(n) FROM n), 6) AS share, round(n_background / (SELECT sum(n_background) FROM n), 6) AS share_background FROM n""")
def class_correlations(spark, sf_dir):
    """Pairs of suppliers by the rest of their keys as classes; all pairs by definition."""
    return rounded(cells.correlation_classes(matrix(spark, sf_dir), "feature", "cell", "n", F.col("feature") % 5, 20), "share", "share_background")


@query("""WITH g AS (SELECT CAST(p_partkey % 40 AS BIGINT) AS x, CAST(p_partkey // 40 AS BIGINT) AS y, CAST(p_size AS BIGINT) AS v FROM part), h AS (SELECT x - 2 AS x, y + 1 AS y, v FROM g), f AS (SELECT x, y, v FROM g WHERE v >= 40), o AS (SELECT unnest(range(-3, 3)) AS dx),
    s AS (SELECT dx, dy, avg(f.v * h.v) AS score, count(*) AS n FROM f, o, (SELECT dx AS dy FROM o) JOIN h ON h.x = f.x - dx AND h.y = f.y - dy GROUP BY ALL) SELECT CAST(dx AS INTEGER) AS dx, CAST(dy AS INTEGER) AS dy, round(score, 6) AS score, n FROM s ORDER BY score DESC, dx, dy LIMIT 1""")
def aligned_grids(spark, sf_dir):
    """A grid and its own shifted copy, aligned at the places of great values."""
    g = table(spark, sf_dir, "part").select((F.col("p_partkey") % 40).alias("x"), F.expr("p_partkey div 40").alias("y"), F.col("p_size").cast("long").alias("value"))
    return rounded(cells.aligned_grids(g, g.select((F.col("x") - 2).alias("x"), (F.col("y") + 1).alias("y"), "value"), g.filter("value >= 40"), 3), "score")


@query(None)
def quality_clusters(spark, sf_dir):
    """Parts' brands by how the sizes and prices of their types correlate; no SQL."""
    p = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.avg("p_retailprice").alias("v"))
    a, b = p.select(F.col("p_brand").alias("first"), "p_type", F.col("v").alias("x")), p.select(F.col("p_brand").alias("second"), "p_type", F.col("v").alias("y"))
    r = a.join(b, "p_type").filter("first < second").groupBy("first", "second").agg(F.round(F.corr("x", "y"), 6).alias("r")).filter("r is not null")
    return qt.quality_clusters(qt.correlation_similarities(r, "r"), 0.55)


@query(None)
def assembled_words(spark, sf_dir):
    """The most frequent words of six letters of the parts' oligonucleotides, joined where they overlap; no SQL."""
    seq = oligos(spark, sf_dir).select("seq").filter("length(seq) >= 6")
    w = seq.select(F.explode(F.expr("transform(sequence(1, length(seq) - 5), i -> substr(seq, i, 6))")).alias("word"))
    top = w.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(60)
    return assembly.assembled(top, "word", "n")


@query(None)
def aligned_strings(spark, sf_dir):
    """Each part's oligonucleotide with its neighbour's reverse complement, letter by letter; no SQL."""
    d = oligos(spark, sf_dir)
    other = d.select((F.col("p_partkey") + 1).alias("p_partkey"), sequence.reverse_complement(F.col("seq")).alias("target"))
    return alignment.local_alignments(spread(d.join(other, "p_partkey")), "p_partkey", "seq", "target")
