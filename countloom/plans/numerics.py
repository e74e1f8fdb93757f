"""The queries of special functions, tests, matrix algebra and splines, as (function, DuckDB SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.functions import distance
from countloom.functions import distributions as dist
from countloom.operators import algebra, profiles

from .profiles import rounded, spread, table

QUERIES = []


def query(sql: str):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


@query("SELECT p_partkey, round(lgamma(p_size + p_partkey % 4 / 4 + 0.25), 6) AS ln_gamma, round(lgamma(p_size) + lgamma(p_partkey % 9 + 0.5) - lgamma(p_size + p_partkey % 9 + 0.5), 6) AS ln_beta FROM part")
def gamma_functions(spark, sf_dir):
    n, b = F.col("p_size").cast("double"), F.col("p_partkey") % 9 + 0.5
    x = n + F.col("p_partkey") % 4 / 4 + 0.25
    return table(spark, sf_dir, "part").select("p_partkey", F.round(dist.ln_gamma(x), 6).alias("ln_gamma"), F.round(dist.ln_beta(n, b), 6).alias("ln_beta"))


@query("SELECT p_partkey, CAST(round_even(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)), 0) AS DOUBLE) AS choose, CAST(round_even(exp(lgamma(n + 1) - lgamma(n - k + 1)), 0) AS DOUBLE) AS permute FROM (SELECT p_partkey, p_size % 20 + 5 AS n, p_partkey % 6 AS k FROM part) WHERE k <= n")
def combinations(spark, sf_dir):
    n, k = F.col("p_size") % 20 + 5, F.col("p_partkey") % 6
    return table(spark, sf_dir, "part").select("p_partkey", dist.choose(n, k).alias("choose"), dist.permutations(n, k).alias("permute"))


ERF = "2 / sqrt(pi()) * list_sum(list_transform(range(0, 60), lambda k: (-1) ** k * x ** (2 * k + 1) / exp(lgamma(k + 1)) / (2 * k + 1)))"


@query(f"WITH v AS (SELECT c_custkey, (c_custkey % 41 - 20) / 8.0::DOUBLE AS x FROM customer), e AS (SELECT c_custkey, x, {ERF} AS e FROM v) SELECT c_custkey, round(e, 6) AS erf, round(0.5 * (1 + e), 6) AS normal FROM e")
def error_function(spark, sf_dir):
    x = (F.col("c_custkey") % 41 - 20) / 8.0
    return spread(table(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", F.round(dist.erf(x), 6).alias("erf"), F.round(dist.normal_cdf(x * 2**0.5), 6).alias("normal"))


@query("""WITH v AS (SELECT p_partkey, (p_size - 25) / 5.0::DOUBLE AS t, CAST(p_size AS DOUBLE) AS x, p_partkey % 5 + 1 AS k FROM part)
    SELECT p_partkey, round(0.5 + atan(t) / pi(), 6) AS t1, round(0.5 + t / (2 * sqrt(2 + t * t)), 6) AS t2, round(1 - exp(-x / 2) * list_sum(list_transform(range(0, k), lambda j: (x / 2) ** j / exp(lgamma(j + 1)))), 6) AS chi2,
      round(1 - (k / (k + x)) ** k, 6) AS f, round(1 - exp(-x / 10) * list_sum(list_transform(range(0, k), lambda j: (x / 10) ** j / exp(lgamma(j + 1)))), 6) AS gamma, round(1 - exp(-0.05 * x), 6) AS expo, round(least(1.0, greatest(0.0, (x - 10) / 20)), 6) AS uniform FROM v""")
def continuous_cdfs(spark, sf_dir):
    t, x, k = (F.col("p_size") - 25) / 5.0, F.col("p_size").cast("double"), F.col("p_partkey") % 5 + 1
    d = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select(
        "p_partkey", dist.t_cdf(t, F.lit(1.0)).alias("t1"), dist.t_cdf(t, F.lit(2.0)).alias("t2"), dist.chi_square_cdf(x, 2.0 * k).alias("chi2"), dist.f_cdf(x, F.lit(2.0), 2.0 * k).alias("f"),
        dist.gamma_cdf(x, 1.0 * k, F.lit(10.0)).alias("gamma"), dist.exponential_cdf(x, F.lit(0.05)).alias("expo"), dist.uniform_cdf(x, 10.0, 30.0).alias("uniform"),
    )
    return rounded(d, "t1", "t2", "chi2", "f", "gamma", "expo", "uniform")


@query("""WITH v AS (SELECT p_partkey, p_size % 30 + 10 AS n, p_partkey % 12 AS k, (p_size + 1) / 60.0::DOUBLE AS p, (p_size + 1) / 4.0::DOUBLE AS m FROM part)
    SELECT p_partkey, round(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(p) + (n - k) * ln(1 - p)), 6) AS b_pdf, round(list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(p) + (n - j) * ln(1 - p)))), 6) AS b_cdf,
      round(exp(k * ln(m) - m - lgamma(k + 1)), 6) AS p_pdf, round(list_sum(list_transform(range(0, k + 1), lambda j: exp(j * ln(m) - m - lgamma(j + 1)))), 6) AS p_cdf FROM v""")
def discrete_distributions(spark, sf_dir):
    n, k, p, m = F.col("p_size") % 30 + 10, F.col("p_partkey") % 12, (F.col("p_size") + 1) / 60.0, (F.col("p_size") + 1) / 4.0
    d = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", dist.binomial_pdf(k, n, p).alias("b_pdf"), dist.binomial_cdf(k, n, p).alias("b_cdf"), dist.poisson_pdf(k, m).alias("p_pdf"), dist.poisson_cdf(k, m).alias("p_cdf"))
    return rounded(d, "b_pdf", "b_cdf", "p_pdf", "p_cdf")


#: The upper tail of t by Simpson's rule over 4000 steps from 0.
T_TAIL = "0.5 - {t} / 12000 * list_sum(list_transform(range(0, 4001), lambda i: CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt({v} * pi()) * (1 + ({t} * i / 4000) ** 2 / {v}) ** (-({v} + 1) / 2)))"


@query(f"""WITH m AS (SELECT o_orderpriority, o_orderstatus AS s, avg(o_totalprice) AS m, var_samp(o_totalprice) / count(*) AS v, count(*) AS n FROM orders GROUP BY ALL),
    w AS (SELECT o_orderpriority, (a.m - b.m) / sqrt(a.v + b.v) AS t, (a.v + b.v) ** 2 / (a.v ** 2 / (a.n - 1) + b.v ** 2 / (b.n - 1)) AS v FROM m a JOIN m b USING (o_orderpriority) WHERE a.s = 'F' AND b.s = 'O'),
    q AS (SELECT *, abs(t) AS u FROM w), r AS (SELECT *, {T_TAIL.format(t='u', v='v')} AS tail FROM q)
    SELECT o_orderpriority, round(t, 6) AS t, round(2 * tail, 5) AS p_two, round(CASE WHEN t > 0 THEN tail ELSE 1 - tail END, 5) AS p_right FROM r""")
def welch_p(spark, sf_dir):
    d = table(spark, sf_dir, "orders")
    w = profiles.welch(d, ["o_orderpriority"], "o_totalprice", F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O")
    p = lambda tails: F.round(dist.p_value(F.col("t"), F.col("df"), tails), 5)
    return w.select("o_orderpriority", F.round("t", 6).alias("t"), p("two").alias("p_two"), p("right").alias("p_right"))


@query(f"""WITH m AS (SELECT c_nationkey, (avg(c_acctbal) - 4500) / (stddev_samp(c_acctbal) / sqrt(count(*))) AS t, count(*) - 1 AS v FROM customer GROUP BY ALL HAVING count(*) > 2), q AS (SELECT *, abs(t) AS u, CAST(v AS DOUBLE) AS w FROM m)
    SELECT c_nationkey, round(t, 6) AS t, v AS df, round(2 * ({T_TAIL.format(t='u', v='w')}), 5) AS p FROM q""")
def one_sample_t(spark, sf_dir):
    d = profiles.one_sample(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal", 4500.0).filter("df > 1")
    return d.select("c_nationkey", F.round("t", 6).alias("t"), "df", F.round(dist.p_value(F.col("t"), F.col("df").cast("double")), 5).alias("p"))


@query("""WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL), e AS (SELECT n, sum(n) OVER (PARTITION BY o_orderstatus) * sum(n) OVER (PARTITION BY o_orderpriority) / (SELECT sum(n) FROM c) AS x FROM c), s AS (SELECT sum((n - x) ** 2 / x) AS q FROM e)
    SELECT round(q, 6) AS chi_square, round(1 - exp(-q / 2) * list_sum(list_transform(range(0, 4), lambda j: (q / 2) ** j / exp(lgamma(j + 1)))), 6) AS cdf FROM s""")
def chi_square_test(spark, sf_dir):
    cells = profiles.chi_square_cells(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")
    d = cells.agg(F.sum("chi_square").alias("chi_square"))
    return rounded(d.withColumn("cdf", dist.chi_square_cdf(F.col("chi_square"), F.lit(8.0))), "chi_square", "cdf")


MATRICES = "a AS (SELECT l_suppkey % 8 AS i, l_linenumber AS k, sum(l_quantity) AS v FROM lineitem GROUP BY ALL), b AS (SELECT l_linenumber AS k, l_partkey % 8 AS j, sum(l_discount) AS v FROM lineitem GROUP BY ALL)"


def _matrices(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem")
    a = d.groupBy((F.col("l_suppkey") % 8).alias("row"), F.col("l_linenumber").alias("column")).agg(F.sum("l_quantity").alias("value"))
    b = d.groupBy(F.col("l_linenumber").alias("row"), (F.col("l_partkey") % 8).alias("column")).agg(F.sum("l_discount").alias("value"))
    return a, b


@query(f'WITH {MATRICES} SELECT i AS "row", j AS "column", round(sum(a.v * b.v), 4) AS value FROM a JOIN b USING (k) GROUP BY ALL')
def matrix_product(spark, sf_dir):
    a, b = _matrices(spark, sf_dir)
    return algebra.product(a, b).withColumn("value", F.round("value", 4))


@query(f'WITH {MATRICES}, u AS (SELECT i AS r, k AS c, v FROM a UNION ALL SELECT k, j, -2 * v FROM b) SELECT r AS "row", c AS "column", round(sum(v), 4) AS value FROM u GROUP BY ALL')
def matrix_sum(spark, sf_dir):
    a, b = _matrices(spark, sf_dir)
    return algebra.combined(a, b, 1.0, -2.0).withColumn("value", F.round("value", 4))


@query(f"WITH {MATRICES}, p AS (SELECT i, j, sum(a.v * b.v) AS v FROM a JOIN b USING (k) GROUP BY ALL) SELECT round(sum(v), 4) AS trace FROM p WHERE i = j")
def matrix_trace(spark, sf_dir):
    return algebra.trace(algebra.product(*_matrices(spark, sf_dir))).select(F.round("trace", 4).alias("trace"))


@query(f"""WITH {MATRICES} SELECT a.i AS "row", a.k AS "column", round(a.v * b.v, 4) AS value FROM a JOIN b ON a.i = b.k AND a.k = b.j""")
def matrix_elementwise(spark, sf_dir):
    return algebra.elementwise(*_matrices(spark, sf_dir)).withColumn("value", F.round("value", 4))


@query("""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS a, list_reverse(CAST(embedding AS DOUBLE[])) AS b, list_transform(CAST(embedding AS DOUBLE[]), lambda x: round(x * 5)) AS s FROM embeddings), f AS (SELECT *, list_reverse(list_transform(s, lambda x: x + 1)) AS r FROM e)
    SELECT vec_id, round(sqrt(list_sum(list_transform(list_zip(a, b), lambda p: (p[1] - p[2]) ** 2))), 6) AS euclidean, round(list_sum(list_transform(list_zip(a, b), lambda p: abs(p[1] - p[2]) ** 3)) ** (1.0 / 3), 6) AS minkowski,
      round(list_sum(list_transform(list_zip(a, b), lambda p: (p[1] - p[2]) ** 2)) / 2, 6) AS ess, round(list_sum(list_transform(list_zip(a, b), lambda p: abs(p[1] - p[2]))) / list_sum(list_transform(list_zip(a, b), lambda p: abs(p[1] + p[2]))), 4) AS bray_curtis,
      round(sqrt(list_sum(list_transform(list_zip(a, b), lambda p: p[1] * p[1] + p[2] * p[2]))), 6) AS chi, round(1 / (len(list_intersect(s, r)) / len(list_distinct(list_concat(s, r))) + 1e-9), 4) AS jaccard FROM f""")
def more_distances(spark, sf_dir):
    a = F.col("embedding").cast("array<double>")
    b = F.reverse(a)
    s = F.transform(a, lambda x: F.round(x * 5))
    r = F.reverse(F.transform(s, lambda x: x + 1))
    square = lambda v: F.transform(v, lambda x: x * x)
    d = table(spark, sf_dir, "embeddings").select(
        "vec_id", distance.euclidean(a, b).alias("euclidean"), distance.minkowski(a, b).alias("minkowski"), distance.error_sum(a, b).alias("ess"),
        F.round(distance.bray_curtis(a, b), 4).alias("bray_curtis"), distance.chi_square(square(a), square(b)).alias("chi"), F.round(distance.jaccard(s, r), 4).alias("jaccard"),
    )
    return rounded(d, "euclidean", "minkowski", "ess", "chi")


@query("""WITH v AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x FROM part) SELECT p_partkey, round(2 * (x - 5) * (x - 9) / ((1 - 5) * (1 - 9)) + 7 * (x - 1) * (x - 9) / ((5 - 1) * (5 - 9)) + 4 * (x - 1) * (x - 5) / ((9 - 1) * (9 - 5)), 6) AS y FROM v""")
def lagrange_values(spark, sf_dir):
    y = algebra.lagrange(F.col("p_size").cast("double"), [1.0, 5.0, 9.0], [2.0, 7.0, 4.0])
    return table(spark, sf_dir, "part").select("p_partkey", F.round(y, 6).alias("y"))


#: The natural spline through (0, 0), (1, 1), (2, 0), (3, 1), solved by hand: second derivatives 0, -4, 4, 0.
@query("""WITH v AS (SELECT p_partkey, p_size % 31 / 10.0::DOUBLE AS x FROM part), s AS (SELECT p_partkey, x, least(floor(x), 2) AS k FROM v), h AS (SELECT *, x - k AS b, k + 1 - x AS a, [0.0, -4.0, 4.0, 0.0][CAST(k AS INTEGER) + 1] AS m0, [0.0, -4.0, 4.0, 0.0][CAST(k AS INTEGER) + 2] AS m1, [0, 1, 0, 1][CAST(k AS INTEGER) + 1] AS y0, [0, 1, 0, 1][CAST(k AS INTEGER) + 2] AS y1 FROM s)
    SELECT p_partkey, round(a * y0 + b * y1 + ((a ** 3 - a) * m0 + (b ** 3 - b) * m1) / 6, 6) AS y FROM h""")
def spline_values(spark, sf_dir):
    y = algebra.natural_spline(F.col("p_size") % 31 / 10.0, [0.0, 1.0, 2.0, 3.0], [0.0, 1.0, 0.0, 1.0])
    return table(spark, sf_dir, "part").select("p_partkey", F.round(y, 6).alias("y"))


def _dcov(x: str, y: str) -> str:
    """SQL for the doubly centred form."""
    each = "list_sum(list_transform(range(1, 17), lambda i: {}))"
    d = lambda v: f"abs({v}[i] - {v}[j])"
    row = lambda v, i: each.replace("lambda i", "lambda k").format(f"abs({v}[{i}] - {v}[k])") + " / 16"
    grand = lambda v: each.replace("lambda i", "lambda p").format(each.replace("lambda i", "lambda q").format(f"abs({v}[p] - {v}[q])")) + " / 256"
    centred = lambda v: f"({d(v)} - {row(v, 'i')} - {row(v, 'j')} + g{v})"
    return each.format(each.replace("lambda i", "lambda j").format(f"{centred(x)} * {centred(y)}")) + " / 256"


@query(f"""WITH e AS (SELECT vec_id, CAST(embedding[1:16] AS DOUBLE[]) AS a, CAST(embedding[17:32] AS DOUBLE[]) AS b FROM embeddings),
    g AS (SELECT *, list_sum(list_transform(range(1, 17), lambda p: list_sum(list_transform(range(1, 17), lambda q: abs(a[p] - a[q]))))) / 256 AS ga, list_sum(list_transform(range(1, 17), lambda p: list_sum(list_transform(range(1, 17), lambda q: abs(b[p] - b[q]))))) / 256 AS gb FROM e),
    c AS (SELECT vec_id, {_dcov("a", "b")} AS ab, {_dcov("a", "a")} AS aa, {_dcov("b", "b")} AS bb FROM g) SELECT vec_id, round(sqrt(greatest(ab, 0) / sqrt(aa * bb)), 6) AS dcor FROM c""")
def distance_correlation(spark, sf_dir):
    a, b = (F.slice(F.col("embedding").cast("array<double>"), k, 16) for k in (1, 17))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(distance.distance_correlation(a, b), 6).alias("dcor"))
