"""The queries of further counts, as (function, DuckDB SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.operators import counting, suffixes

from .profiles import _tags, rounded, spread, table
from .reads import BARCODES, BASES, HEX, READS, barcodes, raw

QUERIES = []


def query(sql: str):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


TAGS = "tags AS (SELECT user_id, event_type, event_id % 16 AS umi, count(*) AS n FROM events GROUP BY ALL)"


@query(f"""WITH {TAGS}, p AS (SELECT CAST(bit_count(((xor(a.umi, b.umi)) | (xor(a.umi, b.umi) >> 1)) & 5) AS INTEGER) AS distance, count(*) AS n_pairs FROM tags a JOIN tags b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.umi < b.umi GROUP BY ALL),
    b AS (SELECT base, count(*) AS n FROM (SELECT umi & 3 AS base FROM tags UNION ALL SELECT (umi >> 2) & 3 FROM tags) GROUP BY ALL), s AS (SELECT sum(n * n) / (sum(n) * sum(n)) AS s FROM b), t AS (SELECT sum(n_pairs) AS a FROM p)
    SELECT distance, n_pairs, round(a * (2 / (CASE distance WHEN 2 THEN 2 ELSE 1 END * CASE distance WHEN 0 THEN 2 ELSE 1 END)) * (1 - s) ** distance * s ** (2 - distance), 4) AS expected FROM p, s, t""")
def code_distances_expected(spark, sf_dir):
    return counting.code_distances(_tags(spark, sf_dir), ["user_id", "event_type"], "umi", 2).withColumn("expected", F.round("expected", 4))


@query("""WITH e AS (SELECT user_id, event_type, event_id, event_id * 37 % 256 AS umi FROM events), f AS (SELECT user_id, event_type, umi, min(event_id) AS t FROM e GROUP BY ALL),
    o AS (SELECT a.user_id, a.t, count(*) FILTER (bit_count(((xor(a.umi, b.umi)) | (xor(a.umi, b.umi) >> 1)) & 85) = 1) AS one, count(*) FILTER (bit_count(((xor(a.umi, b.umi)) | (xor(a.umi, b.umi) >> 1)) & 85) <= 2) AS two FROM f a JOIN f b ON a.user_id = b.user_id AND a.event_type = b.event_type AND b.t < a.t GROUP BY ALL),
    r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n_read, row_number() OVER (PARTITION BY user_id, event_type, umi ORDER BY event_id) AS k, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS f FROM e),
    s AS (SELECT r.user_id, n_read, CAST(sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_molecules, CAST(sum(CASE WHEN f = 1 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_places, CAST(sum(CASE k WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END) OVER w AS BIGINT) AS n_singletons,
      CAST(sum(CASE WHEN k = 1 AND coalesce(one, 0) = 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_not_one_off, CAST(sum(CASE WHEN k = 1 AND coalesce(two, 0) = 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_not_two_off
      FROM r LEFT JOIN o ON o.user_id = r.user_id AND o.t = r.event_id WINDOW w AS (PARTITION BY r.user_id ORDER BY event_id))
    SELECT * FROM s WHERE n_read % 10 = 0""")
def depth_curves(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", (F.col("event_id") * 37 % 256).alias("umi"))
    return counting.depth_curves(d, "user_id", ["event_id"], ["event_type"], "umi", 10, 4)


@query("SELECT p_type AS name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, count(*) AS n_hits FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL")
def repeat_totals(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("name"))
    hits = table(spark, sf_dir, "lineitem").join(names, "l_partkey").select("name", F.col("l_quantity").cast("long").alias("n"))
    return counting.repeat_totals(hits, "name", "n")


@query(f"WITH {READS}, c AS (SELECT position, substr(seq, position, 1) AS base, count(*) AS n FROM (SELECT seq, CAST(unnest(range(1, length(seq) + 1)) AS INTEGER) AS position FROM reads) GROUP BY ALL) SELECT position, base, round(n / sum(n) OVER (PARTITION BY position), 6) AS share FROM c")
def colour_balance(spark, sf_dir):
    return rounded(counting.base_balance(raw(spark, sf_dir), "seq"), "share")


@query(f"WITH {READS} SELECT CAST(length(seq) AS INTEGER) AS length, count(*) AS n FROM reads GROUP BY ALL")
def length_distribution(spark, sf_dir):
    return counting.lengths(raw(spark, sf_dir), "seq")


#: Contigs of 64 bases; the reads are 16 bases of them, of which two may be changed.
CONTIGS = f"c AS (SELECT p_partkey AS contig, translate(md5(cast(p_partkey as varchar(20))) || md5(p_name || cast(p_partkey as varchar(20))), '{HEX}', '{BASES}') AS text FROM part)"
SHORT = "r AS (SELECT contig AS read, overlay_at || '' AS seq FROM (SELECT contig, substr(text, CAST(1 + contig % 40 AS INTEGER), 5) || CASE WHEN contig % 3 = 0 THEN 'A' ELSE substr(text, CAST(6 + contig % 40 AS INTEGER), 1) END || substr(text, CAST(7 + contig % 40 AS INTEGER), 9) || CASE WHEN contig % 2 = 0 THEN 'C' ELSE substr(text, CAST(16 + contig % 40 AS INTEGER), 1) END AS overlay_at FROM c))"


def _contigs(spark, sf_dir):
    t = f"translate(md5(cast(p_partkey as string)) || md5(p_name || cast(p_partkey as string)), '{HEX}', '{BASES}')"
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_name")).select(F.col("p_partkey").alias("contig"), F.expr(t).alias("text"))


@query(f"""WITH {CONTIGS}, {SHORT}, w AS (SELECT contig, CAST(i - 1 AS INTEGER) AS pos, substr(text, i, 16) AS s FROM (SELECT contig, text, CAST(unnest(range(1, 50)) AS INTEGER) AS i FROM c)),
    k AS (SELECT read, contig, pos, CAST(hamming(seq, s) AS INTEGER) AS n_mismatches FROM r JOIN w ON (substr(seq, 1, 5) = substr(s, 1, 5) OR substr(seq, 6, 5) = substr(s, 6, 5) OR substr(seq, 11, 5) = substr(s, 11, 5)))
    SELECT * FROM k WHERE n_mismatches <= 2 QUALIFY n_mismatches = min(n_mismatches) OVER (PARTITION BY read)""")
def mismatch_search(spark, sf_dir):
    c = _contigs(spark, sf_dir)
    part = lambda a, n: F.expr(f"substr(text, cast({a} + contig % 40 as int), {n})")
    seq = F.concat(part(1, 5), F.when(F.col("contig") % 3 == 0, "A").otherwise(part(6, 1)), part(7, 9), F.when(F.col("contig") % 2 == 0, "C").otherwise(part(16, 1)))
    reads = c.select(F.col("contig").alias("id"), seq.alias("seq"))
    return suffixes.mismatch_hits(reads, c, "id", "seq", "contig", "text", 2)


@query(f"WITH {CONTIGS}, s AS (SELECT contig, CAST(i - 1 AS INTEGER) AS pos, substr(text, i) AS t FROM (SELECT contig, text, unnest(range(1, 65)) AS i FROM c)) SELECT contig, pos, rank() OVER (ORDER BY t) - 1 AS rank FROM s")
def suffix_ranks(spark, sf_dir):
    return suffixes.suffix_order(_contigs(spark, sf_dir), "contig", "text")


@query("""WITH b AS (SELECT CAST(greatest(0, least(9, floor((l_quantity - 5) * 10 / 40))) AS BIGINT) AS bin, count(*) FILTER (l_returnflag = 'R') AS p, count(*) FILTER (l_returnflag <> 'R') AS q FROM lineitem GROUP BY ALL)
    SELECT bin, round(log10(greatest(p / (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'), 0.001) / greatest(q / (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R'), 0.001)), 6) AS log_odds FROM b""")
def histogram_log_odds(spark, sf_dir):
    d = counting.log_odds(table(spark, sf_dir, "lineitem"), "l_quantity", F.col("l_returnflag") == "R", 5.0, 45.0, 10, 0.001)
    return rounded(d, "log_odds")


@query("""WITH g AS (SELECT CAST(p_partkey % 40 AS BIGINT) AS x, CAST(p_partkey // 40 AS BIGINT) AS y, p_size AS v FROM part)
    SELECT * FROM g a WHERE NOT EXISTS (SELECT 1 FROM g b WHERE b.x - a.x BETWEEN -2 AND 1 AND b.y - a.y BETWEEN -2 AND 1 AND (b.x <> a.x OR b.y <> a.y) AND b.v >= a.v)""")
def local_maxima(spark, sf_dir):
    g = table(spark, sf_dir, "part").select((F.col("p_partkey") % 40).alias("x"), F.expr("p_partkey div 40").alias("y"), F.col("p_size").alias("v"))
    return counting.local_maxima(g, "x", "y", "v", 2)


@query(f"WITH {TAGS} SELECT user_id, event_type, count(*) AS n_codes, string_agg(CAST(umi AS VARCHAR), ',' ORDER BY umi) AS codes FROM tags GROUP BY ALL HAVING count(*) > 6")
def over_occupied_codes(spark, sf_dir):
    return counting.over_occupied_codes(_tags(spark, sf_dir), ["user_id", "event_type"], "umi", 16, 0.4)


@query(f"""WITH {CONTIGS}, {BARCODES}, h AS (SELECT l_partkey AS contig, l_orderkey % 60 AS pos, l_suppkey % 5 AS barcode FROM lineitem), d AS (SELECT barcode, substr(text, CAST(pos - 3 AS INTEGER), 4) AS w FROM h JOIN c USING (contig) WHERE pos >= 4),
    t AS (SELECT barcode, count(*) AS n_tests FROM d GROUP BY ALL) SELECT barcode, index AS matched, count(*) AS n, any_value(n_tests) AS n_tests FROM d JOIN bc ON code = w JOIN t USING (barcode) GROUP BY ALL""")
def upstream_barcodes(spark, sf_dir):
    hits = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("contig"), (F.col("l_orderkey") % 60).alias("pos"), (F.col("l_suppkey") % 5).alias("barcode"))
    return counting.upstream_matches(hits, _contigs(spark, sf_dir), barcodes(spark, sf_dir).withColumnRenamed("code", "match"), 4)


_POISSON = [sum(2.718281828459045**-1 / f for f in [1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800][:k]) for k in range(1, 12)]


@query(f"""WITH p AS (SELECT l_returnflag, l_quantity AS x, l_extendedprice AS y, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS k FROM lineitem), r AS (SELECT l_returnflag, t, x, y, (('0x' || substr(md5('s|' || t || '|' || k), 1, 8))::BIGINT + 0.5) / 2.0 ** 32 AS u FROM p, (SELECT unnest(range(1, 6)) AS t)),
    w AS (SELECT *, {" + ".join(f"CASE WHEN u > {c!r}::DOUBLE THEN 1 ELSE 0 END" for c in _POISSON)} AS w FROM r), m AS (SELECT l_returnflag, t, sum(w) AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * y * y) AS syy, sum(w * x * y) AS sxy FROM w GROUP BY ALL),
    c AS (SELECT l_returnflag, (sxy - sx * sy / n) / sqrt((sxx - sx * sx / n) * (syy - sy * sy / n)) AS r FROM m) SELECT l_returnflag, round(avg(r), 5) AS mean, round(var_samp(r), 7) AS variance FROM c GROUP BY ALL""")
def resampled_correlation(spark, sf_dir):
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    d = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice", key.alias("_key"))
    r = counting.resampled_correlation(d, ["l_returnflag"], "l_quantity", "l_extendedprice", 5, "s")
    return r.select("l_returnflag", F.round("mean", 5).alias("mean"), F.round("variance", 7).alias("variance"))
