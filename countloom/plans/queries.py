"""The registered queries over the driver's tables, each with the DuckDB SQL for the same rows.

Tables stand in for the domain's: events are reads (user_id the cell, event_type the feature,
event_id % 16 the molecular barcode), parts' key ranges are intervals, orders' dates are positions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countloom.functions import distance, sequence
from countloom.operators import intervals, matrix, relational, stats, umi
from countloom.plans import cells, counting, estimates, genes, groups, numerics, profiles, reports, variants
from countloom.plans import reads as extraction

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Register a query with the SQL for the same rows, where SQL can express them."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CELL = ["user_id", "event_type"]
#: The read counts of each cell, feature and barcode, in SQL.
TAGS = "tags AS (SELECT user_id, event_type, event_id % 16 AS umi, count(*) AS n FROM events GROUP BY ALL)"


def reads(spark, sf_dir):
    return table(spark, sf_dir, "events").select(*CELL, (F.col("event_id") % 16).alias("umi"), "event_id", "ts")


def tags(spark, sf_dir):
    return umi.read_counts(reads(spark, sf_dir), CELL, "umi")


def _molecules(rule: str, param: int, limit: str):
    sql = f"""WITH {TAGS}, l AS (SELECT user_id, event_type, {limit} AS lim FROM tags GROUP BY ALL)
      SELECT user_id, event_type, CAST(sum(n) AS BIGINT) AS n_reads, count(*) AS n_umis, count(*) FILTER (n > lim) AS n_molecules
      FROM tags JOIN l USING (user_id, event_type) GROUP BY ALL"""

    def run(spark, sf_dir):
        return umi.molecule_counts(tags(spark, sf_dir), CELL, rule, param)

    run.__name__ = f"umi_{rule}"
    query(sql)(run)


_molecules("none", 0, "0")
_molecules("lowpass", 1, "1")
_molecules("singleton", 1, "CASE WHEN max(n) > 1 THEN 1 ELSE 0 END")
_molecules("fraction_of_max", 3, "max(n) // 3")
_molecules("fraction_of_mean", 2, "round_even(avg(n) / 2, 0)")


@query(f"WITH {TAGS} SELECT user_id, event_type, CAST(sum(n) AS BIGINT) AS n_reads, count(*) AS n_umis, count(*) FILTER (n > 1) AS n_molecules FROM tags GROUP BY ALL")
def umi_dense(spark, sf_dir):
    return umi.dense_molecule_counts(reads(spark, sf_dir), CELL, "umi", "lowpass", 1)


@query(f"""WITH {TAGS} SELECT a.* FROM (SELECT user_id, event_type, umi, n AS n_reads FROM tags) a WHERE NOT (n_reads = 1 AND EXISTS (
    SELECT 1 FROM tags b WHERE b.user_id = a.user_id AND b.event_type = a.event_type AND b.umi <> a.umi AND (b.n > 1 OR b.umi < a.umi)
      AND (CASE WHEN (a.umi & 3) <> (b.umi & 3) THEN 1 ELSE 0 END + CASE WHEN (a.umi >> 2) <> (b.umi >> 2) THEN 1 ELSE 0 END) = 1))""")
def umi_hamming1(spark, sf_dir):
    return umi.drop_near_singletons(tags(spark, sf_dir), CELL, "umi", 2)


@query(f"""WITH {TAGS}, m AS (SELECT user_id, event_type, count(*) AS m FROM tags GROUP BY ALL)
    SELECT user_id, event_type, m AS n_molecules, CAST(round_even(ln(1 - least(m, 15) / 16) / ln(1 - 1.0 / 16), 0) AS BIGINT) AS n_true FROM m""")
def collision_compensated(spark, sf_dir):
    m = umi.molecule_counts(tags(spark, sf_dir), CELL).select(*CELL, "n_molecules")
    return m.withColumn("n_true", umi.compensated(F.col("n_molecules"), 16))


@query(f"""WITH {TAGS} SELECT CAST(bit_count(((xor(a.umi, b.umi)) | (xor(a.umi, b.umi) >> 1)) & 5) AS INTEGER) AS distance, count(*) AS n_pairs
    FROM tags a JOIN tags b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.umi < b.umi GROUP BY ALL""")
def umi_pair_distances(spark, sf_dir):
    return umi.code_pairs(tags(spark, sf_dir), CELL, "umi")


MOLECULES = f"{TAGS}, m AS (SELECT user_id, event_type, count(*) AS n_molecules FROM tags GROUP BY ALL)"


def molecules(spark, sf_dir):
    return umi.molecule_counts(tags(spark, sf_dir), CELL).select(*CELL, "n_molecules")


@query(f"WITH {MOLECULES} SELECT user_id, event_type, n_molecules, round(n_molecules * 1e6 / sum(n_molecules) OVER (PARTITION BY user_id), 4) AS rpm FROM m")
def rpm_matrix(spark, sf_dir):
    return matrix.rpm(molecules(spark, sf_dir), "user_id", "n_molecules").withColumn("rpm", F.round("rpm", 4)).select(*CELL, "n_molecules", "rpm")


@query(f"""WITH {MOLECULES}, s AS (SELECT user_id, sum(n_molecules) AS t, coalesce(sum(n_molecules) FILTER (event_type = 'click'), 0) AS k FROM m GROUP BY ALL)
    SELECT user_id, event_type, round(n_molecules * CASE WHEN k = 0 THEN 0 ELSE k / (2500 * t) END, 9) AS absolute FROM m JOIN s USING (user_id)""")
def absolute_matrix(spark, sf_dir):
    d = matrix.absolute(molecules(spark, sf_dir), "user_id", "n_molecules", F.col("event_type") == "click")
    return d.select(*CELL, F.round("absolute", 9).alias("absolute"))


@query(f"""WITH {MOLECULES}, s AS (SELECT user_id, CAST(sum(n_molecules) AS BIGINT) AS total FROM m GROUP BY ALL)
    SELECT user_id, total, round(CASE WHEN total <> 0 THEN (SELECT avg(total) FROM s WHERE total <> 0) / total ELSE 0 END, 6) AS factor FROM s""")
def size_factor_matrix(spark, sf_dir):
    return matrix.size_factors(molecules(spark, sf_dir), "user_id", "n_molecules").withColumn("factor", F.round("factor", 6))


@query("""WITH t AS (SELECT event_type, user_id, count(*) AS n, count(DISTINCT event_id * 37 % 256) AS m FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS k FROM t)
    SELECT event_type, max(user_id) FILTER (k = 1) AS top, max(n) FILTER (k = 1) AS n_top, max(n) FILTER (k = 2) AS n_second, round(max(n / m) FILTER (k = 1), 6) AS per_molecule_top, round(max(n / m) FILTER (k = 2), 6) AS per_molecule_second
    FROM r WHERE k <= 2 GROUP BY ALL HAVING max(n) FILTER (k = 1) > 1.01 * max(n) FILTER (k = 2)""")
def leakage_top2(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy("event_type", "user_id", (F.col("event_id") * 37 % 256).alias("umi")).agg(F.count("*").alias("n"))
    d = d.groupBy("event_type", "user_id").agg(F.sum("n").alias("n_reads"), F.count("*").alias("n_mols"))
    out = umi.leakage(d, ["event_type"], "user_id", 1.01)
    return out.withColumns({c: F.round(c, 6) for c in ("per_molecule_top", "per_molecule_second")})


@query("""WITH t AS (SELECT event_type, event_id % 16 AS umi, user_id, count(*) AS n_reads FROM events GROUP BY ALL)
    SELECT * FROM t QUALIFY n_reads >= 0.5 * max(n_reads) OVER (PARTITION BY event_type, umi)""")
def cross_barcode_filter(spark, sf_dir):
    return umi.cross_barcode_filter(umi.read_counts(reads(spark, sf_dir), ["event_type", "umi"], "user_id"), ["event_type", "umi"], 0.5)


def _parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").alias("i_start"), (F.col("p_partkey") + F.col("p_size")).alias("i_end"), "p_type")


def _points(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("pos"))


PARTS = "p AS (SELECT p_partkey, p_partkey AS i_start, p_partkey + p_size AS i_end, p_type FROM part)"


@query(f"WITH {PARTS} SELECT i_start, i_end, p_partkey, count(*) AS n_hits FROM p JOIN lineitem ON l_partkey BETWEEN i_start AND i_end GROUP BY ALL")
def interval_stab(spark, sf_dir):
    hits = intervals.stab_join(_points(spark, sf_dir), _parts(spark, sf_dir), "pos", "i_start", "i_end", bin_width=50)
    return hits.groupBy("i_start", "i_end", "p_partkey").agg(F.count("*").alias("n_hits"))


@query(f"WITH {PARTS} SELECT l_orderkey, l_linenumber, l_partkey AS pos FROM lineitem WHERE EXISTS (SELECT 1 FROM p WHERE p_type LIKE 'PROMO%' AND l_partkey BETWEEN i_start AND i_end)")
def interval_semi(spark, sf_dir):
    return intervals.stab_join(_points(spark, sf_dir), _parts(spark, sf_dir).filter("p_type like 'PROMO%'"), "pos", "i_start", "i_end", "left_semi", 50)


@query(f"WITH {PARTS} SELECT l_orderkey, l_linenumber, l_partkey AS pos FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM p WHERE p_type LIKE 'PROMO%' AND l_partkey BETWEEN i_start AND i_end)")
def interval_anti(spark, sf_dir):
    return intervals.stab_join(_points(spark, sf_dir), _parts(spark, sf_dir).filter("p_type like 'PROMO%'"), "pos", "i_start", "i_end", "left_anti", 50)


@query(f"""WITH {PARTS}, h AS (SELECT s_suppkey, count(*) FILTER (p_type LIKE 'PROMO%') AS a, count(*) FILTER (p_type LIKE 'SMALL%') AS b FROM supplier LEFT JOIN p ON s_suppkey BETWEEN i_start AND i_end GROUP BY ALL)
    SELECT s_suppkey, CASE WHEN a > 0 THEN 'promo' WHEN b > 0 THEN 'small' END AS layer, CASE WHEN a > 0 THEN a ELSE b END AS n_hits FROM h""")
def interval_cascade(spark, sf_dir):
    p = _parts(spark, sf_dir)
    layers = [("promo", p.filter("p_type like 'PROMO%'")), ("small", p.filter("p_type like 'SMALL%'"))]
    return intervals.cascade(table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").alias("pos")), layers, "s_suppkey", "pos", "i_start", "i_end", 50).select("s_suppkey", "layer", "n_hits")


@query("""WITH e AS (SELECT user_id, ts, max(event_id) AS event_id FROM events GROUP BY ALL),
    o AS (SELECT o_custkey AS user_id, o_orderkey, TIMESTAMP '2024-01-15' + to_days(CAST(o_orderkey % 14 AS INTEGER)) AS moment FROM orders)
    SELECT o_orderkey, o.user_id, moment, e.ts AS since, e.event_id AS last_event FROM o ASOF LEFT JOIN e ON o.user_id = e.user_id AND e.ts <= o.moment""")
def nearest_start_asof(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id", F.col("ts").cast("timestamp").alias("since")).agg(F.max("event_id").alias("last_event"))
    at = F.expr("timestamp'2024-01-15' + make_dt_interval(cast(o_orderkey % 14 as int))")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), at.alias("moment"))
    return intervals.as_of(o, e, ["user_id"], "moment", "since", "last_event").withColumnRenamed("value", "last_event")


ORDER_DAYS = "d AS (SELECT o_orderpriority, datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS s, datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) + o_custkey % 3 AS e FROM orders)"


def _order_days(spark, sf_dir):
    s = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderpriority", s.alias("s"), (s + F.col("o_custkey") % 3).alias("e"))


ISLANDS = f"""WITH {ORDER_DAYS}, n AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY o_orderpriority ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS f FROM d),
    g AS (SELECT *, sum(f) OVER (PARTITION BY o_orderpriority ORDER BY s, e RANGE UNBOUNDED PRECEDING) AS k FROM n),
    i AS (SELECT o_orderpriority, k, min(s) AS s, max(e) AS e FROM g GROUP BY ALL)"""


@query(f"{ISLANDS} SELECT o_orderpriority, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM i")
def merge_intervals(spark, sf_dir):
    return intervals.merged(_order_days(spark, sf_dir), ["o_orderpriority"], "s", "e", 50)


@query(f"{ISLANDS} SELECT o_orderpriority, CAST(b + 1 AS BIGINT) AS gap_start, CAST(s - 1 AS BIGINT) AS gap_end FROM (SELECT *, lag(e) OVER (PARTITION BY o_orderpriority ORDER BY s) AS b FROM i) WHERE b IS NOT NULL")
def interval_gaps(spark, sf_dir):
    return intervals.gaps(_order_days(spark, sf_dir), ["o_orderpriority"], "s", "e", 50)


@query(f"""WITH {ORDER_DAYS}, x AS (SELECT o_orderpriority, s AS pos, 1 AS w FROM d UNION ALL SELECT o_orderpriority, e + 1, -1 FROM d), y AS (SELECT o_orderpriority, pos, sum(w) AS w FROM x GROUP BY ALL),
    z AS (SELECT o_orderpriority, pos, sum(w) OVER (PARTITION BY o_orderpriority ORDER BY pos) AS depth, lead(pos) OVER (PARTITION BY o_orderpriority ORDER BY pos) - 1 AS run_end FROM y)
    SELECT o_orderpriority, CAST(pos AS BIGINT) AS run_start, CAST(run_end AS BIGINT) AS run_end, CAST(depth AS BIGINT) AS depth FROM z WHERE depth > 0""")
def coverage(spark, sf_dir):
    return intervals.coverage(_order_days(spark, sf_dir), ["o_orderpriority"], "s", "e")


@query("""SELECT l_returnflag, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 6) AS variance, round(stddev_samp(l_quantity), 6) AS sd,
    round(stddev_samp(l_quantity) / sqrt(count(l_quantity)), 6) AS sem, round(stddev_samp(l_quantity) / avg(l_quantity), 6) AS cv, median(l_quantity) AS median,
    round(skewness(l_quantity), 6) AS skewness, round(kurtosis(l_quantity), 6) AS kurtosis FROM lineitem GROUP BY ALL""")
def describe_groups(spark, sf_dir):
    d = stats.describe(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity")
    return d.select("l_returnflag", "n", "median", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "sd", "sem", "cv", "skewness", "kurtosis")])


@query("""WITH m AS (SELECT l_returnflag, median(l_quantity) AS m FROM lineitem GROUP BY ALL), a AS (SELECT l_returnflag, l_quantity AS x, m FROM lineitem JOIN m USING (l_returnflag)),
    d AS (SELECT l_returnflag, median(abs(x - m)) AS mad FROM a GROUP BY ALL), w AS (SELECT l_returnflag, x, (x - m) / (5.0 * mad + 1e-4) AS u FROM a JOIN d USING (l_returnflag))
    SELECT l_returnflag, round(sum(x * CASE WHEN abs(u) < 1 THEN (1 - u * u) * (1 - u * u) ELSE 0 END) / sum(CASE WHEN abs(u) < 1 THEN (1 - u * u) * (1 - u * u) ELSE 0 END), 6) AS robust_mean FROM w GROUP BY ALL""")
def robust_mean(spark, sf_dir):
    return stats.robust_mean(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity").withColumn("robust_mean", F.round("robust_mean", 6))


@query("SELECT CAST(floor(l_extendedprice / 5000) AS BIGINT) AS bin, count(*) AS n FROM lineitem WHERE l_extendedprice >= 0 AND l_extendedprice < 100000 GROUP BY ALL")
def hist_fixed(spark, sf_dir):
    return stats.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.0, 5000.0, 20)


@query("""WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2 AS x,
      rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2 AS y FROM lineitem)
    SELECT l_returnflag, round(corr(x, y), 6) AS rho FROM r GROUP BY ALL""")
def spearman_groups(spark, sf_dir):
    return stats.spearman(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice").withColumn("rho", F.round("rho", 6))


@query("SELECT l_returnflag, l_linestatus, round(coalesce(corr(l_quantity, l_extendedprice), 0), 6) AS r FROM lineitem GROUP BY ALL")
def pearson_groups(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(stats.correlation("l_quantity", "l_extendedprice"), 6).alias("r"))


@query("""SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER w) / stddev_samp(o_totalprice) OVER w, 6) AS z FROM orders WINDOW w AS (PARTITION BY o_orderpriority)""")
def zscore(spark, sf_dir):
    return stats.z_scores(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice").select("o_orderkey", F.round("z", 6).alias("z"))


@query("""WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
    s AS (SELECT *, row_number() OVER w AS k, CASE WHEN count(*) OVER v = 7 THEN avg(n) OVER v END AS f FROM d
      WINDOW w AS (PARTITION BY event_type ORDER BY day), v AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    e AS (SELECT event_type, arg_min(f, day) FILTER (f IS NOT NULL) AS a, arg_max(f, day) FILTER (f IS NOT NULL) AS b FROM s GROUP BY ALL)
    SELECT event_type, CAST(day AS VARCHAR) AS day, n, round(coalesce(f, CASE WHEN k <= 3 THEN a ELSE b END), 6) AS smoothed FROM s JOIN e USING (event_type)""")
def moving_average_edge(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return stats.moving_average(d, ["event_type"], "day", "n", 3).withColumn("smoothed", F.round("smoothed", 6)).withColumn("day", F.col("day").cast("string"))


@query("""SELECT vec_id, round(list_sum(list_transform(list_zip(e, f), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS sq_euclidean, round(list_sum(list_transform(list_zip(e, f), lambda p: abs(p[1] - p[2]))), 6) AS manhattan,
      round(list_max(list_transform(list_zip(e, f), lambda p: abs(p[1] - p[2]))), 6) AS chebyshev,
      round(list_sum(list_transform(list_zip(e, f), lambda p: abs(p[1] - p[2]))) / list_sum(list_transform(list_zip(e, f), lambda p: abs(p[1]) + abs(p[2]))), 6) AS canberra
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, list_reverse(CAST(embedding AS DOUBLE[])) AS f FROM embeddings)""")
def distances_to_reverse(spark, sf_dir):
    a = F.col("embedding").cast("array<double>")
    b = F.reverse(a)
    names = ("sq_euclidean", "manhattan", "chebyshev", "canberra")
    return table(spark, sf_dir, "embeddings").select("vec_id", *[F.round(distance.METRICS[n](a, b), 6).alias(n) for n in names])


@query("""WITH d AS (SELECT DISTINCT doc_id, substring(lower(text), i, 4) AS kmer FROM documents, unnest(range(1, CAST(length(text) - 2 AS BIGINT))) AS t(i)) SELECT kmer, count(*) AS n_docs FROM d GROUP BY ALL""")
def kmer_doc_freq(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.explode(sequence.kmers(F.lower("text"), 4)).alias("kmer"))
    return d.groupBy("kmer").agg(F.count("*").alias("n_docs"))


@query("""SELECT lang, round(100 * sum(length(regexp_replace(lower(text), '[^gc]', '', 'g'))) / sum(length(regexp_replace(lower(text), '[^acgt]', '', 'g'))), 6) AS gc_percent FROM documents GROUP BY ALL""")
def gc_percent(spark, sf_dir):
    n = lambda p: F.sum(F.length(F.regexp_replace(F.lower("text"), p, "")))
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.round(100 * n("[^gc]") / n("[^acgt]"), 6).alias("gc_percent"))


@query("""SELECT event_id, list_aggregate(list_transform(range(0, 8), lambda i: ['A','C','G','T'][CAST(1 + ((event_id >> CAST(14 - 2 * i AS BIGINT)) & 3) AS BIGINT)]), 'string_agg', '') AS umi, event_id % 65536 AS code FROM events""")
def umi_codec(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("event_id", sequence.umi_text(F.col("event_id") % 65536, 8).alias("umi"))
    return d.withColumn("code", sequence.umi_code(F.col("umi")))


@query("""WITH r AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n_read, row_number() OVER (PARTITION BY user_id, event_type, event_id % 16 ORDER BY event_id) AS k, event_id FROM events),
    s AS (SELECT user_id, n_read, CAST(sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS n_distinct FROM r) SELECT * FROM s WHERE n_read % 10 = 0""")
def saturation_curve(spark, sf_dir):
    return matrix.running_first_seen(reads(spark, sf_dir), "user_id", ["event_id"], ["event_type", "umi"], 10)


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 20")
def read_limiter(spark, sf_dir):
    return matrix.first_reads(reads(spark, sf_dir), "user_id", ["event_id"], 20).select("user_id", "event_id")


@query("""WITH f AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 500)
    SELECT event_type, round(count(DISTINCT user_id) / count(*), 6) AS complexity FROM f GROUP BY ALL""")
def complexity_per_lane(spark, sf_dir):
    d = matrix.first_reads(reads(spark, sf_dir), "event_type", ["event_id"], 500)
    return d.groupBy("event_type").agg(F.round(F.countDistinct("user_id") / F.count("*"), 6).alias("complexity"))


@query("SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) = 1")
def barcode_unique_positions(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("l_suppkey"), F.max("l_suppkey").alias("top"))
    return d.filter("l_suppkey = top").drop("top")


@query("""WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY ALL), b AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY ALL)
    SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.n, 0) AS click, coalesce(b.n, 0) AS view FROM a FULL JOIN b ON a.user_id = b.user_id""")
def table_merge_union_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    tables = {k: e.filter(F.col("event_type") == k).groupBy("user_id").agg(F.count("*").alias("n")) for k in ("click", "view")}
    return matrix.merged_tables(tables, "user_id", "n")


@query("SELECT user_id % 96 % 8 AS plate_row, " + ", ".join(f"round(max(r) FILTER (user_id % 96 // 8 = {k}), 6) AS c{k}" for k in range(12)) + " FROM (SELECT user_id % 96 AS user_id, sum(n) / avg(sum(n)) OVER () AS r FROM (SELECT user_id, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1) GROUP BY ALL")
def plate_pivot(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 96).alias("well")).agg(F.count("*").alias("n"))
    return matrix.plate(d, "well", "n")


@query("SELECT l_suppkey, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity) / avg(l_quantity), 6) AS cv FROM lineitem GROUP BY ALL")
def cv_by_feature(spark, sf_dir):
    return matrix.cv_by_feature(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity").select("l_suppkey", F.round("mean", 6).alias("mean"), F.round("cv", 6).alias("cv"))


for _f, _sql in [*relational.QUERIES, *profiles.QUERIES, *groups.QUERIES, *extraction.QUERIES, *genes.QUERIES, *cells.QUERIES, *variants.QUERIES, *numerics.QUERIES, *counting.QUERIES, *reports.QUERIES, *estimates.QUERIES]:
    query(_sql)(_f)
