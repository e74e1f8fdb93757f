"""The queries of counts by position, calls, tests and fitted lines, as (function, DuckDB SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.operators import profiles, umi

QUERIES = []


def query(sql: str):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(d):
    """d dealt to all cores, for work that is heavy for each row: a table of few bytes is read by one task, however many rows it has."""
    return d.repartition(4 * d.sparkSession.sparkContext.defaultParallelism)


def _tags(spark, sf_dir):
    reads = table(spark, sf_dir, "events").select("user_id", "event_type", (F.col("event_id") % 16).alias("umi"))
    return umi.read_counts(reads, ["user_id", "event_type"], "umi")


TAGS = "WITH tags AS (SELECT user_id, event_type, event_id % 16 AS umi, count(*) AS n FROM events GROUP BY ALL)"


def rounded(d, *names):
    return d.withColumns({n: F.round(n, 6) for n in names})


@query("""WITH c AS (SELECT position, substr(p_brand, position, 1) AS letter, count(*) AS n FROM (SELECT p_brand, CAST(unnest(range(1, length(p_brand) + 1)) AS INTEGER) AS position FROM part) GROUP BY ALL),
    s AS (SELECT *, n / sum(n) OVER (PARTITION BY position) AS share FROM c)
    SELECT position, letter, n, round(share, 6) AS share, round(2 + sum(share * log2(share)) OVER (PARTITION BY position), 6) AS conservation FROM s""")
def motif_counts(spark, sf_dir):
    return rounded(profiles.letter_profile(table(spark, sf_dir, "part"), "p_brand"), "share", "conservation")


@query("SELECT position, count(*) AS n, round(avg(ascii(substr(p_name, position, 1)) - 33), 6) AS mean_code FROM (SELECT p_name, CAST(unnest(range(1, length(p_name) + 1)) AS INTEGER) AS position FROM part) GROUP BY ALL")
def quality_by_cycle(spark, sf_dir):
    return rounded(profiles.code_profile(table(spark, sf_dir, "part"), "p_name", 33), "mean_code")


@query("WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1")
def majority_call(spark, sf_dir):
    return profiles.majority(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_returnflag")


@query("""WITH c AS (SELECT l_suppkey, count(*) AS n_reads, count(*) FILTER (l_returnflag = 'R') AS n_alt FROM lineitem GROUP BY ALL)
    SELECT *, CASE WHEN n_alt / n_reads > 0.75 THEN 'ALT' WHEN n_alt / n_reads > 0.25 THEN 'HET' ELSE 'REF' END AS genotype FROM c WHERE n_reads >= 10 AND n_alt / n_reads >= 0.04 AND n_alt >= 2""")
def genotype_calls(spark, sf_dir):
    return profiles.genotypes(table(spark, sf_dir, "lineitem"), ["l_suppkey"], F.col("l_returnflag") == "R")


@query("SELECT event_type, lane, count(*) AS n_reads FROM (SELECT event_type, CAST(user_id % 4 AS VARCHAR) AS lane FROM events) GROUP BY CUBE (event_type, lane)")
def hit_marginals(spark, sf_dir):
    return profiles.marginals(table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 4).cast("string").alias("lane")), ["event_type", "lane"])


@query(f"{TAGS} SELECT user_id, CAST(sum(n) AS BIGINT) AS n_reads, count(*) AS n_unique, CAST(sum(n) - count(*) AS BIGINT) AS n_duplicate FROM tags GROUP BY ALL")
def unique_reads(spark, sf_dir):
    return profiles.unique_reads(_tags(spark, sf_dir), ["user_id"])


@query(f"{TAGS} SELECT least(n, 3) AS n_reads, count(*) AS n_molecules FROM tags GROUP BY ALL")
def reads_per_molecule(spark, sf_dir):
    return profiles.reads_per_molecule(_tags(spark, sf_dir), 3)


@query(f"{TAGS} SELECT user_id, event_type, count(*) AS n_codes FROM tags GROUP BY ALL HAVING count(*) > floor(0.4 * 16)")
def over_occupied(spark, sf_dir):
    return profiles.over_occupied(_tags(spark, sf_dir), ["user_id", "event_type"], 16, 0.4)


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '#' ORDER BY o_orderpriority) AS names FROM orders GROUP BY ALL")
def combined_features(spark, sf_dir):
    return profiles.joined_names(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority")


@query("""WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
    e AS (SELECT *, sum(n) OVER (PARTITION BY o_orderstatus) * sum(n) OVER (PARTITION BY o_orderpriority) / (SELECT sum(n) FROM c) AS expected FROM c)
    SELECT o_orderstatus, o_orderpriority, n, round(expected, 6) AS expected, round((n - expected) ** 2 / expected, 6) AS chi_square FROM e""")
def chi_square_cells(spark, sf_dir):
    return rounded(profiles.chi_square_cells(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority"), "expected", "chi_square")


@query("""WITH m AS (SELECT o_orderpriority, o_orderstatus AS s, avg(o_totalprice) AS m, var_samp(o_totalprice) / count(*) AS v, count(*) AS n FROM orders GROUP BY ALL)
    SELECT o_orderpriority, round((a.m - b.m) / sqrt(a.v + b.v), 6) AS t, round((a.v + b.v) ** 2 / (a.v ** 2 / (a.n - 1) + b.v ** 2 / (b.n - 1)), 6) AS df
    FROM m a JOIN m b USING (o_orderpriority) WHERE a.s = 'F' AND b.s = 'O'""")
def welch_t(spark, sf_dir):
    d = profiles.welch(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice", F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O")
    return rounded(d, "t", "df")


@query("""WITH m AS (SELECT l_returnflag, l_linenumber AS x, avg(l_extendedprice) AS y FROM lineitem GROUP BY ALL)
    SELECT l_returnflag, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept FROM m GROUP BY ALL""")
def least_squares(spark, sf_dir):
    return rounded(profiles.fitted_line(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linenumber", "l_extendedprice"), "slope", "intercept")


CORRELATIONS = "WITH r AS (SELECT l_suppkey, corr(l_quantity, l_extendedprice) AS v FROM lineitem GROUP BY ALL), c AS (SELECT l_suppkey, CASE WHEN v IS NULL OR isnan(v) THEN 0 ELSE v END AS r FROM r)"


def _correlations(spark, sf_dir):
    return profiles.correlations(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice")


@query(f"{CORRELATIONS} SELECT CAST(least(floor(abs(r) * 20), 19) AS BIGINT) AS bin, count(*) AS n FROM c GROUP BY ALL")
def correlation_bins(spark, sf_dir):
    return profiles.correlation_bins(_correlations(spark, sf_dir))


@query(f"{CORRELATIONS} SELECT l_suppkey, round(c.r, 6) AS r FROM c ORDER BY c.r DESC, l_suppkey LIMIT 5")
def top_correlations(spark, sf_dir):
    return rounded(profiles.top(_correlations(spark, sf_dir), "r", "l_suppkey", 5), "r")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 40")
def order_page(spark, sf_dir):
    return profiles.page(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 2, 20)


@query("SELECT c_custkey, coalesce(c2.c_mktsegment, '') AS segment FROM customer c1 LEFT JOIN (SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0) c2 USING (c_custkey)")
def annotation_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    notes = c.filter("c_acctbal > 0").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return profiles.annotated(c.select("c_custkey"), notes, "c_custkey", ["segment"])


@query("""WITH m AS (SELECT l_returnflag, count(*) AS n, sum(l_quantity * l_discount) / sum(l_quantity) AS a FROM lineitem GROUP BY ALL),
    c AS (SELECT l_returnflag, n, a, sum(l_quantity * (l_discount - a) ** 2) / sum(l_quantity) AS m2, sum(l_quantity * (l_discount - a) ** 3) / sum(l_quantity) AS m3, sum(l_quantity * (l_discount - a) ** 4) / sum(l_quantity) AS m4 FROM lineitem JOIN m USING (l_returnflag) GROUP BY ALL)
    SELECT l_returnflag, round(a, 6) AS mean, round(m2 * n / (n - 1), 6) AS variance, round(m3 / m2 ** 1.5, 5) AS skewness, round(m4 / (m2 * m2) - 3, 5) AS kurtosis FROM c""")
def weighted_moments(spark, sf_dir):
    d = rounded(profiles.weighted_moments(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_discount", "l_quantity"), "mean", "variance")
    return d.withColumns({c: F.round(c, 5) for c in ("skewness", "kurtosis")})


@query(f"""{TAGS}, m AS (SELECT user_id, event_type, count(*) AS n_molecules FROM tags GROUP BY ALL)
    SELECT *, CAST(round_even(ln(1 - least(n_molecules, 15) / 16) / ln(1 - 0.7 / 16), 0) AS BIGINT) AS n_true FROM m""")
def efficiency_compensated(spark, sf_dir):
    m = umi.molecule_counts(_tags(spark, sf_dir), ["user_id", "event_type"]).select("user_id", "event_type", "n_molecules")
    return m.withColumn("n_true", profiles.with_efficiency(F.col("n_molecules"), 16, 0.7))


@query("""WITH c AS (SELECT p_partkey, i, substr(p_name, i, 1) AS ch FROM (SELECT p_partkey, p_name, unnest(range(1, length(p_name) + 1)) AS i FROM part)),
    g AS (SELECT p_partkey, ch, i - row_number() OVER (PARTITION BY p_partkey, ch ORDER BY i) AS k FROM c), r AS (SELECT p_partkey, ch, k, count(*) AS n FROM g GROUP BY ALL)
    SELECT p_partkey, CAST(max(n) AS INTEGER) AS longest_run FROM r GROUP BY ALL""")
def longest_run(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", profiles.longest_run(F.col("p_name")).alias("longest_run"))


@query("""WITH f AS (SELECT p_partkey, CASE WHEN p_size BETWEEN 5 AND 14 THEN p_size - 5 WHEN p_size BETWEEN 20 AND 24 THEN p_size - 10 WHEN p_size = 40 THEN 15 ELSE -1 END AS h FROM part)
    SELECT p_partkey, CAST(CASE WHEN h < 0 OR p_partkey % 2 = 0 THEN h ELSE 15 - h END AS BIGINT) AS place FROM f""")
def transcript_places(spark, sf_dir):
    exons = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(e).alias("e")) for s, e in ((5, 14), (20, 24), (40, 40))])
    return table(spark, sf_dir, "part").select("p_partkey", profiles.transcript_position(exons, F.col("p_size"), F.col("p_partkey") % 2 == 0).alias("place"))
