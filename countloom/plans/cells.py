"""The queries of matrix filters, totals, summaries and pairs, as (function, DuckDB SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.operators import cells

from .profiles import _tags, rounded, table

QUERIES = []


def query(sql: str):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


#: lineitem as a matrix: suppliers are features, part numbers mod 50 are cells.
MATRIX = "m AS (SELECT l_suppkey AS feature, l_partkey % 50 AS cell, CAST(sum(CAST(l_quantity AS BIGINT) * CASE WHEN l_partkey % 50 < 5 THEN 0 ELSE 1 END) AS BIGINT) AS n FROM lineitem GROUP BY ALL)"


def matrix(spark, sf_dir):
    n = F.sum(F.when(F.col("l_partkey") % 50 < 5, 0).otherwise(F.col("l_quantity").cast("long")))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("feature"), (F.col("l_partkey") % 50).alias("cell")).agg(n.alias("n"))


@query(f"WITH {MATRIX}, s AS (SELECT cell, sum(n) AS t FROM m GROUP BY ALL) SELECT m.* FROM m JOIN s USING (cell) WHERE t >= (SELECT avg(t) FROM s) / 100")
def low_cells_dropped(spark, sf_dir):
    return cells.kept_cells(matrix(spark, sf_dir), "cell", "n")


@query(f"WITH {MATRIX}, s AS (SELECT feature, sum(n) / 50 AS a FROM m GROUP BY ALL) SELECT m.* FROM m JOIN s USING (feature) WHERE a >= 150")
def low_features_dropped(spark, sf_dir):
    return cells.kept_features(matrix(spark, sf_dir), "feature", "n", 150, 50)


@query("""WITH d AS (SELECT event_type AS c, CASE WHEN event_type = 'view' THEN 'x' ELSE CAST(event_id % 10 AS VARCHAR) END AS v, event_id FROM events), s AS (SELECT c, sum(TRY_CAST(v AS DOUBLE)) AS t FROM d GROUP BY ALL)
    SELECT d.* FROM d JOIN s USING (c) WHERE (t IS NULL OR t >= (SELECT median(t) FROM s))""")
def low_columns_dropped(spark, sf_dir):
    v = F.when(F.col("event_type") == "view", "x").otherwise((F.col("event_id") % 10).cast("string"))
    d = table(spark, sf_dir, "events").select(F.col("event_type").alias("c"), v.alias("v"), "event_id")
    middle = d.groupBy("c").agg(F.sum(F.expr("try_cast(v as double)")).alias("t")).agg(F.median("t")).first()[0]
    return cells.kept_columns(d, "c", "v", middle)


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS a, list_reverse(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS b FROM embeddings)
    SELECT vec_id, len(list_filter(list_zip(a, b), lambda z: z[1] >= 0.1 AND z[2] >= 0.1)) AS n_both, len(list_filter(list_zip(a, b), lambda z: z[1] >= 0.1 OR z[2] >= 0.1)) AS n_either FROM e""")
def threshold_pairs(spark, sf_dir):
    a = F.col("embedding").cast("array<double>")
    n = lambda how: F.size(cells.both_at_least(a, F.reverse(a), 0.1, how)[0]).cast("long").alias(f"n_{how}")
    return table(spark, sf_dir, "embeddings").select("vec_id", n("both"), n("either"))


ADDED = "a AS (SELECT s_suppkey AS feature, 1000 + s_suppkey AS n_added FROM supplier WHERE s_suppkey % 5 = 0)"


def _added(spark, sf_dir):
    return table(spark, sf_dir, "supplier").filter("s_suppkey % 5 = 0").select(F.col("s_suppkey").alias("feature"), (F.col("s_suppkey") + 1000).alias("n_added"))


@query(f"WITH {MATRIX}, {ADDED} SELECT cell, round(sum(n) / (SELECT sum(n_added) FROM a), 9) AS efficiency FROM m JOIN a USING (feature) GROUP BY ALL")
def spike_efficiency(spark, sf_dir):
    d = cells.spike_efficiency(matrix(spark, sf_dir), "cell", "feature", "n", _added(spark, sf_dir))
    return d.withColumn("efficiency", F.round("efficiency", 9))


@query(f"WITH {MATRIX}, {ADDED} SELECT feature, round(coalesce(sum(n), 0) / (any_value(n_added) * 50), 9) AS efficiency FROM a LEFT JOIN m USING (feature) GROUP BY ALL")
def spike_efficiency_by_spike(spark, sf_dir):
    d = cells.spike_efficiency_by_spike(matrix(spark, sf_dir), "feature", "n", _added(spark, sf_dir), 50)
    return d.withColumn("efficiency", F.round("efficiency", 9))


@query(f"WITH {MATRIX} SELECT cell, count(DISTINCT feature) FILTER (n > 0) AS n_all, count(DISTINCT feature) FILTER (n > 0 AND feature % 5 = 0) AS n_spikes FROM m GROUP BY ALL")
def expressed_features(spark, sf_dir):
    return cells.expressed(matrix(spark, sf_dir), "feature", "n", {"n_all": F.lit(True), "n_spikes": F.col("feature") % 5 == 0}, ["cell"])


@query(f"WITH {MATRIX} SELECT cell, CAST(sum(CASE WHEN feature % 2 = 0 THEN n ELSE n // 3 END) AS BIGINT) AS total FROM m GROUP BY ALL")
def totals_by_cell(spark, sf_dir):
    d = matrix(spark, sf_dir).withColumn("unique", F.expr("n div 3"))
    return cells.totals_by_cell(d, "cell", "n", "unique", F.col("feature") % 2 == 0)


@query(f"WITH {MATRIX}, s AS (SELECT cell, sum(n) AS t FROM m GROUP BY ALL) SELECT feature, cell, n, round(CASE WHEN t > 0 THEN n * 1e9 / (t * (500 + feature)) ELSE 0 END, 4) AS rpkm FROM m JOIN s USING (cell)")
def rpkm_matrix(spark, sf_dir):
    lengths = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("feature"), (F.col("s_suppkey") + 500).alias("length"))
    return cells.rpkm(matrix(spark, sf_dir), "cell", "feature", "n", lengths).withColumn("rpkm", F.round("rpkm", 4))


@query("""WITH u AS (SELECT l_partkey AS tag FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_suppkey % 7) = 1)
    SELECT l_suppkey % 7 AS gene, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS most, CAST(sum(CASE WHEN l_partkey IN (SELECT tag FROM u) THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS least FROM lineitem GROUP BY ALL""")
def gene_max_min(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 7).alias("gene"), F.col("l_partkey").alias("tag"), F.col("l_quantity").cast("long").alias("n"))
    return cells.gene_summary(d, "gene", "tag", "n")


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS n_places FROM lineitem GROUP BY ALL")
def distinct_mappings(spark, sf_dir):
    return cells.distinct_mappings(table(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_partkey"])


@query("SELECT l_suppkey, count(DISTINCT (l_partkey, l_linenumber)) AS n_places FROM lineitem GROUP BY ALL")
def positions_by_barcode(spark, sf_dir):
    return cells.distinct_mappings(table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_partkey", "l_linenumber"])


TAGS = "tags AS (SELECT user_id, event_type, event_id % 16 AS umi, count(*) AS n FROM events GROUP BY ALL)"


@query(f"WITH {TAGS}, p AS (SELECT count(*) AS n_umis, sum(n) AS a, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS k FROM tags GROUP BY user_id, event_type) SELECT n_umis, count(*) AS n_cases, CAST(sum(a) AS BIGINT) AS n_reads, CAST(sum(k) AS BIGINT) AS n_kept FROM p GROUP BY ALL")
def cases_per_umi_count(spark, sf_dir):
    return cells.totals_and_cases(_tags(spark, sf_dir), F.lit(1), ["user_id", "event_type"])


@query("""WITH t AS (SELECT event_type, CASE user_id % 2 WHEN 0 THEN '+' ELSE '-' END AS strand, event_id % 40 + CASE user_id % 2 WHEN 0 THEN 0 ELSE 9 + user_id % 3 END AS pos, event_id * 37 // 40 % 256 AS umi, count(*) AS n FROM events GROUP BY ALL),
    m AS (SELECT a.event_type, a.strand, a.pos, a.umi FROM t a JOIN t b ON a.event_type = b.event_type AND a.strand = b.strand AND a.pos = b.pos AND bit_count(((xor(a.umi, b.umi)) | (xor(a.umi, b.umi) >> 1)) & 85) = 1 WHERE a.n = 1 AND (b.n > 1 OR b.umi < a.umi) GROUP BY ALL)
    SELECT t.event_type, t.strand, t.pos, CAST(sum(n) AS BIGINT) AS n_reads, count(*) AS n_mols, count(*) FILTER (n > 1) AS n_multi, count(*) FILTER (m.umi IS NULL) AS n_unmutated FROM t LEFT JOIN m ON t.event_type = m.event_type AND t.strand = m.strand AND t.pos = m.pos AND t.umi = m.umi GROUP BY ALL""")
def position_clusters(spark, sf_dir):
    strand, length = F.when(F.col("user_id") % 2 == 0, "+").otherwise("-"), 10 + F.col("user_id") % 3
    pos = cells.five_prime(F.col("event_id") % 40, strand, length)
    d = table(spark, sf_dir, "events").groupBy("event_type", strand.alias("strand"), pos.alias("pos"), F.expr("event_id * 37 div 40 % 256").alias("umi")).agg(F.count("*").alias("n_reads"))
    return cells.position_clusters(d, ["event_type", "strand", "pos"], "umi", 4)


@query("""WITH n AS (SELECT l_suppkey, count(*) FILTER (l_linestatus = 'F') AS n_sense, count(*) FILTER (l_linestatus <> 'F') AS n_anti, max(l_suppkey % 4 * 250) AS len FROM lineitem GROUP BY ALL), k AS (SELECT *, CASE WHEN len > 0 THEN n_sense * 1000 / len ELSE 0 END AS s, CASE WHEN len > 0 THEN n_anti * 1000 / len ELSE 0 END AS a FROM n)
    SELECT l_suppkey, n_sense, n_anti, round(s, 6) AS sense_kb, round(a, 6) AS anti_kb, round(CASE WHEN a > 0 THEN s / a END, 6) AS ratio FROM k""")
def sense_ratio(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumn("length", F.col("l_suppkey") % 4 * 250)
    return rounded(cells.sense_ratio(d, ["l_suppkey"], F.col("l_linestatus") == "F", "length"), "sense_kb", "anti_kb", "ratio")


@query(f"""WITH {MATRIX}, s AS (SELECT cell, sum(n) AS t FROM m GROUP BY ALL), g AS (SELECT cell FROM s WHERE t > (SELECT avg(t) FROM s) / 20), k AS (SELECT count(*) AS k FROM g),
    f AS (SELECT feature, sum(CAST(n AS DOUBLE)) AS s, sum(CAST(n AS DOUBLE) * n) AS q FROM m WHERE cell IN (SELECT cell FROM g) GROUP BY ALL ORDER BY s DESC, feature LIMIT 60),
    c AS (SELECT sqrt(greatest((q - s * s / k) / (k - 1), 0)) / (s / k) AS cv FROM f, k WHERE s > 0), e AS (SELECT min(cv) AS lo, max(cv) AS hi FROM c)
    SELECT CAST(least(floor((cv - lo) * 40 / (hi - lo)), 39) AS BIGINT) AS bin, count(*) AS n FROM c, e GROUP BY ALL""")
def cv_histogram(spark, sf_dir):
    return cells.cv_histogram(matrix(spark, sf_dir), "feature", "cell", "n", 60)


@query(f"WITH {MATRIX}, s AS (SELECT cell, sum(n) AS t FROM m GROUP BY ALL) SELECT feature, round(avg(n * 1e6 / t), 4) AS mean, round(stddev_samp(n * 1e6 / t), 4) AS sd FROM m JOIN s USING (cell) WHERE t > 0 AND feature % 5 = 0 GROUP BY ALL")
def spike_mean_sd(spark, sf_dir):
    from countloom.operators import matrix as wide

    d = wide.rpm(matrix(spark, sf_dir), "cell", "n").filter("cell >= 5 and feature % 5 = 0")
    return d.groupBy("feature").agg(F.round(F.avg("rpm"), 4).alias("mean"), F.round(F.stddev_samp("rpm"), 4).alias("sd"))


@query("SELECT a.n_nationkey AS first, b.n_nationkey AS second FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey")
def feature_pairs(spark, sf_dir):
    return cells.pairs(table(spark, sf_dir, "nation"), "n_nationkey")


@query("SELECT a.n_regionkey, a.n_nationkey AS first, b.n_nationkey AS second FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey = b.n_regionkey")
def class_pairs(spark, sf_dir):
    return cells.pairs(table(spark, sf_dir, "nation"), "n_nationkey", "n_regionkey")


GRID = "g AS (SELECT p_partkey AS id, CAST(p_partkey % 23 AS BIGINT) AS x, CAST(p_partkey // 23 AS BIGINT) AS y FROM part WHERE p_size % 3 > 0)"


def _grid(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_size % 3 > 0").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 23).alias("x"), F.expr("p_partkey div 23").alias("y"))


@query(f"WITH {GRID} SELECT a.id AS first, b.id AS second FROM g a JOIN g b ON a.id < b.id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1")
def queen_neighbours(spark, sf_dir):
    return cells.neighbours(_grid(spark, sf_dir), "id", "x", "y", False)


@query(f"WITH {GRID} SELECT a.id AS first, b.id AS second FROM g a JOIN g b ON a.id < b.id AND (abs(a.x - b.x) <= 1 AND a.y = b.y OR abs(a.y - b.y) <= 1 AND a.x = b.x)")
def rook_neighbours(spark, sf_dir):
    return cells.neighbours(_grid(spark, sf_dir), "id", "x", "y", True)


@query(f"""WITH {MATRIX}, f AS (SELECT feature, avg(n) AS mean FROM m GROUP BY ALL), k AS (SELECT *, row_number() OVER (ORDER BY mean, feature) - 1 AS k, count(*) OVER () AS c FROM f)
    SELECT feature, round(mean, 6) AS mean, CAST(least(k // 3, greatest(c // 3 - 1, 0)) AS BIGINT) AS bin FROM k""")
def level_bins(spark, sf_dir):
    f = matrix(spark, sf_dir).groupBy("feature").agg(F.avg("n").alias("mean"))
    return rounded(cells.level_bins(f, "feature", "mean", 3), "mean")


@query(f"""WITH {MATRIX}, a AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY feature) AS k FROM m), b AS (SELECT cell, n AS shuffled, row_number() OVER (PARTITION BY cell ORDER BY md5('s|' || feature), feature) AS k FROM m)
    SELECT feature, cell, n, shuffled FROM a JOIN b USING (cell, k)""")
def shuffled_cells(spark, sf_dir):
    return cells.shuffled_within(matrix(spark, sf_dir), ["cell"], "n", ["feature"], "s").select("feature", "cell", "n", "shuffled")


@query(f"WITH {TAGS}, m AS (SELECT user_id, event_type, count(*) AS n FROM tags GROUP BY ALL) SELECT user_id, event_type, round(ln(1 - n / 20) / ln(1 - 0.8 / 20), 6) AS n_true FROM m")
def saturated_labels(spark, sf_dir):
    m = _tags(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return m.select("user_id", "event_type", F.round(cells.saturated_labels(F.col("n"), 20, 0.8), 6).alias("n_true"))


@query(f"WITH {TAGS} SELECT user_id, event_type, CAST(sum(n) AS BIGINT) AS n_molecules FROM tags GROUP BY ALL")
def without_umis(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n_molecules"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, max(value) AS high FROM events WHERE value > 1 GROUP BY ALL")
def column_fold(spark, sf_dir):
    return table(spark, sf_dir, "events").filter("value > 1").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max("value").alias("high"))
