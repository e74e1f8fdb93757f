"""The queries of smaller report and bookkeeping operators, as (function, DuckDB SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.operators import genes as models
from countloom.operators import intervals, profiles, reports

from .genes import EACH, GENES, HITS, hits
from .genes import models as gene_models
from .profiles import _tags, rounded, table

QUERIES = []


def query(sql: str):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


@query("SELECT p_partkey, p_type FROM part WHERE list_has_any([p_type, p_brand], ['PROMO', 'Brand#2'])")
def effect_filter(spark, sf_dir):
    d = table(spark, sf_dir, "part").withColumn("effects", F.array("p_type", "p_brand"))
    return reports.effect_filter(d, "effects", ["PROMO", "Brand#2"]).select("p_partkey", "p_type")


@query("WITH n AS (SELECT p_partkey, 'Gene' || p_size || ['', 'p1', '-ps', '-ps2'][1 + p_partkey % 4] AS name FROM part) SELECT p_partkey, p_partkey % 4 > 0 AS pseudo, p_partkey % 5 = 0 AS spike FROM n")
def gene_kinds(spark, sf_dir):
    tail = F.element_at(F.array(F.lit(""), F.lit("p1"), F.lit("-ps"), F.lit("-ps2")), (F.col("p_partkey") % 4 + 1).cast("int"))
    name = F.concat(F.when(F.col("p_partkey") % 5 == 0, "RNA_SPIKE_").otherwise(""), F.lit("Gene"), F.col("p_size").cast("string"), tail)
    return table(spark, sf_dir, "part").select("p_partkey", reports.is_pseudogene(name).alias("pseudo"), name.startswith("RNA_SPIKE_").alias("spike"))


@query("SELECT p_partkey AS id, p_size, row_number() OVER (ORDER BY p_size, p_retailprice DESC, p_partkey) AS place FROM part WHERE p_brand = 'Brand#2'")
def ordered_chains(spark, sf_dir):
    d = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("target"), "p_size", "p_retailprice")
    return reports.chains(d, "Brand#2", "p_retailprice", "p_size").select("id", "p_size", "place")


@query(f"""WITH {GENES}, {HITS}, {EACH}, n AS (SELECT gene, CAST(list_sum([x.e - x.s + 1 for x in exons]) AS BIGINT) AS len FROM g), o AS (SELECT gene, s, e, coalesce(sum(e - s + 1) OVER (PARTITION BY gene ORDER BY exon ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, strand FROM x),
    t AS (SELECT h.gene, CASE WHEN strand = '+' THEN before + pos - s ELSE len - 1 - (before + pos - s) END AS place, len FROM h JOIN o ON o.gene = h.gene AND pos BETWEEN s AND e JOIN n ON n.gene = h.gene),
    k AS (SELECT gene, CASE WHEN len >= 23 THEN 2 WHEN len >= 21 THEN 1 ELSE 0 END AS bin, least(floor(place * 5 / len), 4) AS section, count(*) AS n FROM t GROUP BY ALL), a AS (SELECT gene, bin, sum(n) AS a FROM k GROUP BY ALL)
    SELECT k.bin, CAST(section AS BIGINT) AS section, round(sum(n / a) / any_value((SELECT count(*) FROM a b WHERE b.bin = k.bin)), 6) AS share FROM k JOIN a USING (gene, bin) GROUP BY ALL""")
def length_sections(spark, sf_dir):
    d = hits(spark, sf_dir).join(gene_models(spark, sf_dir), "gene")
    place = profiles.transcript_position(F.col("exons"), F.col("pos"), F.col("strand") == "+")
    d = d.select(F.col("gene").alias("transcript"), place.alias("place"), models.transcript_length(F.col("exons")).alias("length")).filter("place >= 0")
    return rounded(reports.length_sections(d, [21, 23], 5), "share")


@query("""WITH g AS (SELECT l_partkey AS gene, count(*) AS level, count(*) FILTER (l_returnflag = 'A') / count(*) AS density FROM lineitem GROUP BY ALL), b AS (SELECT (row_number() OVER (ORDER BY level, gene) - 1) // 30 AS bin, density FROM g)
    SELECT CAST(bin AS BIGINT) AS bin, count(*) AS n, round(median(density), 6) AS median FROM b GROUP BY ALL""")
def antisense_density(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("gene")).agg(F.count("*").alias("level"), (F.count_if(F.col("l_returnflag") == "A") / F.count("*")).alias("density"))
    return rounded(reports.density_by_level(g, "gene", "level", "density", 30), "median")


@query("SELECT coalesce(c_custkey, s_suppkey) AS key, coalesce(s_name, c_name) AS name, coalesce(nb, c_acctbal) AS balance FROM customer FULL JOIN (SELECT s_suppkey * 20 AS s_suppkey, s_name, CASE WHEN s_acctbal > 3000 THEN s_acctbal END AS nb FROM supplier) ON c_custkey = s_suppkey")
def upsert_by_key(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf_dir, "supplier")
    new = s.select((F.col("s_suppkey") * 20).alias("key"), F.col("s_name").alias("name"), F.when(F.col("s_acctbal") > 3000, F.col("s_acctbal")).alias("balance"))
    return reports.upserted(old, new, "key", ["name", "balance"])


@query("WITH c AS (SELECT o_orderkey % 1000 AS k, min(o_custkey) AS f FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL) SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND f IS NOT NULL THEN 'claimed' ELSE o_orderstatus END AS status, CASE WHEN o_orderstatus = 'O' THEN f END AS owner FROM orders LEFT JOIN c ON o_orderkey = k")
def queue_claims(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    claims = o.filter("o_orderkey % 3 = 0").select((F.col("o_orderkey") % 1000).alias("o_orderkey"), F.col("o_custkey").alias("claimant"))
    return reports.claimed(o.select("o_orderkey", F.col("o_orderstatus").alias("status")), claims, "o_orderkey", "status", "O")


@query("WITH c AS (SELECT l_suppkey, l_linenumber AS p, CAST(sum(l_quantity) AS BIGINT) * 1000 AS v FROM lineitem GROUP BY ALL) SELECT l_suppkey, string_agg(lpad(hex(v), 8, '0'), '' ORDER BY p) AS blob FROM c GROUP BY ALL")
def expression_blobs(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.col("l_linenumber").alias("p")).agg((F.sum("l_quantity").cast("long") * 1000).alias("v"))
    return reports.blobs(c, "l_suppkey", "p", "v")


@query("WITH c AS (SELECT l_suppkey, l_linenumber AS p, CAST(sum(l_quantity) AS BIGINT) * 1000 AS v FROM lineitem GROUP BY ALL) SELECT l_suppkey, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY p) - 1 AS INTEGER) AS place, CAST(v AS INTEGER) AS value FROM c")
def blob_values(spark, sf_dir):
    return reports.unblobbed(expression_blobs(spark, sf_dir), "l_suppkey", "blob")


@query("SELECT o_orderkey, md5('x|' || o_orderkey) AS place FROM orders")
def shuffled_rows(spark, sf_dir):
    return reports.hash_shuffled(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "x")


@query("SELECT p_partkey, p_name, c_custkey AS place FROM part JOIN customer ON p_partkey = (c_custkey * 7) % 1500")
def permuted_rows(spark, sf_dir):
    order = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 7 % 1500).alias("p_partkey"), F.col("c_custkey").alias("place"))
    return reports.permuted(table(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_partkey"], order, "place")


@query("SELECT l_returnflag, l_linestatus, min(l_quantity) AS low, arg_min(l_orderkey, (l_quantity, l_orderkey)) AS low_item, max(l_quantity) AS high, arg_min(l_orderkey, (-l_quantity, l_orderkey)) AS high_item FROM lineitem GROUP BY ALL")
def extremes_with_items(spark, sf_dir):
    return reports.extremes(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "l_orderkey")


@query("SELECT l_suppkey, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 6) AS variance FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL HAVING count(*) > 1")
def moments_after_removal(spark, sf_dir):
    m = lambda d: d.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("s"), F.sum(F.col("l_quantity") * F.col("l_quantity")).alias("q"))
    d = table(spark, sf_dir, "lineitem")
    return rounded(reports.without_rows(m(d), m(d.filter("l_returnflag = 'A'")), ["l_suppkey"]), "mean", "variance")


@query("""WITH b AS (SELECT n_regionkey * 10 AS low, list_sort(list(n_nationkey)) AS items FROM nation GROUP BY ALL), d AS (SELECT p_partkey, p_size - 2 AS v, ('0x' || substr(md5('d|' || p_partkey), 1, 8))::BIGINT AS h FROM part)
    SELECT p_partkey, items[CAST(h % len(items) AS INTEGER) + 1] AS drawn FROM d ASOF LEFT JOIN b ON v >= low""")
def drawn_from_bins(spark, sf_dir):
    bins = table(spark, sf_dir, "nation").groupBy((F.col("n_regionkey") * 10).alias("low")).agg(F.array_sort(F.collect_list("n_nationkey")).alias("items"))
    d = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") - 2).alias("v"))
    return reports.drawn_from_bins(d, bins, "v", "p_partkey", "d").select("p_partkey", "drawn")


@query(f"""WITH RECURSIVE {GENES}, x AS (SELECT gene, i, exons[i].e - exons[i].s + 1 AS n FROM g, (SELECT unnest([1, 2, 3]) AS i)), k(gene, last, chosen, length) AS (SELECT gene, i, CAST(i AS VARCHAR), n FROM x WHERE n <= 20
    UNION ALL SELECT k.gene, i, chosen || '-' || i, length + n FROM k JOIN x ON x.gene = k.gene AND i > last AND i <= last + 2 WHERE length + n <= 20) SELECT gene, chosen, length FROM k WHERE length >= 6""")
def exon_choices(spark, sf_dir):
    return reports.exon_choices(gene_models(spark, sf_dir), "gene", "exons", 1, 3, 6, 20)


@query("""WITH a AS (SELECT l_partkey AS k, min(CAST(l_quantity AS BIGINT)) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL), b AS (SELECT l_partkey AS k, min(CAST(l_quantity AS BIGINT)) AS v FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
    SELECT coalesce(a.k, b.k) AS k, coalesce(CAST(a.v * 1000000 // (SELECT sum(v) FROM a) AS BIGINT), 0) AS a, coalesce(CAST(b.v * 1000000 // (SELECT sum(v) FROM b) AS BIGINT), 0) AS r FROM a FULL JOIN b ON a.k = b.k""")
def merged_rpm_tables(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_quantity").cast("long").alias("v"), "l_returnflag")
    return reports.merged_rpm({"a": d.filter("l_returnflag = 'A'").drop("l_returnflag"), "r": d.filter("l_returnflag = 'R'").drop("l_returnflag")}, "k", "v", 10)


@query("""WITH c AS (SELECT CASE WHEN n_nationkey % 6 = 0 THEN 'ACGT' WHEN n_nationkey % 7 = 0 THEN 'ACG' ELSE substr(translate(md5(n_name), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 4) END AS code FROM nation), n AS (SELECT code, count(*) AS n FROM c GROUP BY ALL)
    SELECT code, CASE WHEN n > 1 THEN 'duplicate' ELSE 'length' END AS problem FROM n WHERE n > 1 OR length(code) <> 4""")
def barcode_problems(spark, sf_dir):
    own = F.expr("substr(translate(md5(n_name), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 4)")
    d = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 6 == 0, "ACGT").when(F.col("n_nationkey") % 7 == 0, "ACG").otherwise(own).alias("code"))
    return reports.bad_barcodes(d, "code")


@query("""WITH tags AS (SELECT user_id, event_type, event_id % 16 AS umi, count(*) AS n_reads FROM events GROUP BY ALL) SELECT a.* FROM tags a WHERE NOT EXISTS (SELECT 1 FROM tags b WHERE a.user_id = b.user_id AND a.event_type = b.event_type AND a.umi <> b.umi
    AND bit_count(((xor(a.umi, b.umi)) | (xor(a.umi, b.umi) >> 1)) & 5) < 2 AND (b.n_reads > a.n_reads OR b.n_reads = a.n_reads AND b.umi < a.umi))""")
def code_profiles(spark, sf_dir):
    return reports.variant_profiles(_tags(spark, sf_dir), ["user_id", "event_type"], "umi", 2, 2)


@query("WITH r AS (SELECT p_partkey AS region, p_partkey * 3 AS s, p_partkey * 3 + p_size AS e FROM part) SELECT region, count(*) AS n_fragments FROM r JOIN (SELECT l_partkey * 3 AS a, l_partkey * 3 + 4 AS b FROM lineitem) ON a >= s AND b <= e GROUP BY ALL")
def fragments_per_region(spark, sf_dir):
    r = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("region"), (F.col("p_partkey") * 3).alias("s"), (F.col("p_partkey") * 3 + F.col("p_size")).alias("e"))
    f = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 3).alias("a"), (F.col("l_partkey") * 3 + 4).alias("b"))
    inside = intervals.stab_join(f, r, "a", "s", "e", bin_width=100).filter(F.col("b") <= F.col("e"))
    return inside.groupBy("region").agg(F.count("*").alias("n_fragments"))


@query("SELECT o_custkey, max(o_orderkey) FILTER (o_orderstatus = 'F') AS f, max(o_orderkey) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY ALL")
def eav_values(spark, sf_dir):
    return reports.pivoted(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "o_orderkey", {"F": "f", "O": "o"})


@query("""WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 1), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 2)
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'second' WHEN b.k IS NULL THEN 'first' ELSE 'both' END AS found FROM a FULL JOIN b ON a.k = b.k""")
def set_members(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "k")
    return reports.set_members(d.filter("l_returnflag = 'A' and l_linenumber = 1"), d.filter("l_returnflag = 'R' and l_linenumber = 2"), "k")


@query("""SELECT p_partkey, concat_ws('-', p_brand, p_type) AS joined, coalesce(nullif(p_type, 'PROMO'), 'none') AS kind, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS size, split_part(p_name, ' ', 1) AS first, left(p_brand, 5) AS start, reverse(p_name) AS back, CAST(floor(p_retailprice) AS BIGINT) AS price FROM part""")
def sql_scalars(spark, sf_dir):
    t = table(spark, sf_dir, "part")
    return t.selectExpr("p_partkey", "concat_ws('-', p_brand, p_type) as joined", "ifnull(nullif(p_type, 'PROMO'), 'none') as kind", "if(p_size > 25, 'big', 'small') as size", "substring_index(p_name, ' ', 1) as first", "left(p_brand, 5) as start", "reverse(p_name) as back", "floor(p_retailprice) as price")


@query("SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 200")
def total_limiter(spark, sf_dir):
    return reports.limited(table(spark, sf_dir, "events").select("event_id", "user_id"), ["event_id"], 200)


@query("SELECT event_id, event_type FROM events WHERE event_id <= (SELECT max(event_id) FROM (SELECT event_id FROM events WHERE event_type = 'click' ORDER BY event_id LIMIT 50))")
def valid_limiter(spark, sf_dir):
    return reports.limited(table(spark, sf_dir, "events").select("event_id", "event_type"), ["event_id"], 50, F.col("event_type") == "click")


@query("WITH n AS (SELECT p_brand AS chr, count(*) AS n FROM part GROUP BY ALL) SELECT chr, n, CAST(coalesce(sum(n) OVER (ORDER BY chr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first FROM n")
def block_index(spark, sf_dir):
    return reports.block_index(table(spark, sf_dir, "part").withColumnRenamed("p_brand", "chr"), "chr")
