"""The queries of variants, ordered values, names and the reporting tools, as (function, DuckDB SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.functions import text
from countloom.operators import matrix, series, variants
from countloom.operators import relational as rel

from .profiles import rounded, table

QUERIES = []


def query(sql: str):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


HEX, BASES = "0123456789abcdef", "ACGTACGTACGTACGT"
BASE = lambda k: f"substr(translate(md5(cast(event_id as varchar(20))), '{HEX}', '{BASES}'), {k}, 1)"
#: Events as single reads of 30 bases with two mismatches each.
READS = f"r AS (SELECT event_id, event_type AS chr, event_id * 7 % 300 AS start, CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END AS n_mappings, event_id % 30 AS r1, event_id * 3 % 30 AS r2, {BASE(1)} AS a1, {BASE(2)} AS a2 FROM events)"
SITES = "s AS (SELECT chr, start + r1 AS pos, a1 AS alt FROM r WHERE n_mappings = 1 AND r1 >= 2 AND r1 < 28 UNION ALL SELECT chr, start + r2, a2 FROM r WHERE n_mappings = 1 AND r2 >= 2 AND r2 < 28), k AS (SELECT chr, pos, count(*) AS n_snps, " + ", ".join(f"count(*) FILTER (alt = '{b}') AS n_{b.lower()}" for b in "ACGT") + " FROM s GROUP BY ALL HAVING count(*) >= 3)"


def single_reads(spark, sf_dir):
    base = lambda k: F.expr(BASE(k).replace("varchar(20)", "string"))
    e = table(spark, sf_dir, "events")
    mm = lambda rel_, k: F.struct(rel_.alias("rel"), F.lit("N").alias("ref"), base(k).alias("alt"))
    return e.select(
        F.col("event_id").alias("read_id"), F.col("event_type").alias("chr"), (F.col("event_id") * 7 % 300).alias("start"), F.lit(30).alias("length"),
        F.when(F.col("event_id") % 5 == 0, 2).otherwise(1).alias("n_mappings"), F.array(mm(F.col("event_id") % 30, 1), mm(F.col("event_id") * 3 % 30, 2)).alias("mismatches"),
    )


@query(f"WITH {READS}, {SITES} SELECT * FROM k")
def snp_sites(spark, sf_dir):
    return variants.mismatch_sites(single_reads(spark, sf_dir), 2, 3)


@query(f"WITH {READS}, {SITES} SELECT k.chr, k.pos, n_snps, count(r.event_id) AS n_total FROM k LEFT JOIN r ON r.chr = k.chr AND n_mappings = 1 AND start BETWEEN pos - 30 + 1 + 2 AND pos - 2 GROUP BY ALL")
def snp_coverage(spark, sf_dir):
    d = single_reads(spark, sf_dir)
    sites = variants.mismatch_sites(d, 2, 3).select("chr", "pos", "n_snps")
    return variants.site_coverage(sites, d.filter("n_mappings = 1").select("chr", "start"), 30, 2, 100)


@query("""WITH n AS (SELECT l_suppkey AS site, l_linenumber AS cell, l_partkey % 8 AS umi, l_returnflag AS base, count(*) AS n FROM lineitem GROUP BY ALL),
    t AS (SELECT *, row_number() OVER w AS k, coalesce(lead(n) OVER w, 0) AS nx FROM n WINDOW w AS (PARTITION BY site, cell, umi ORDER BY n DESC, base))
    SELECT site, cell, string_agg(DISTINCT base, '' ORDER BY base) AS bases, count(*) AS n_umis, count(DISTINCT base) > 1 AS heterozygous FROM t WHERE k = 1 AND n >= 2 AND n > nx * 1.5 GROUP BY ALL""")
def snp_by_umi(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("site"), F.col("l_linenumber").alias("cell"), (F.col("l_partkey") % 8).alias("umi"), F.col("l_returnflag").alias("base"))
    return variants.valid_bases(d, ["site"], "cell", "umi", "base", 1.5, 2)


@query("SELECT o_custkey, string_agg(CAST(o_orderkey % 1000 AS VARCHAR), '+' ORDER BY CAST(o_orderkey % 1000 AS VARCHAR)) AS rows, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS symbols FROM orders GROUP BY ALL")
def collapsed_rows(spark, sf_dir):
    d = table(spark, sf_dir, "orders").withColumn("row", (F.col("o_orderkey") % 1000).cast("string"))
    return variants.collapsed(d, "o_custkey", "row", "o_orderstatus")


REGIONS = "g AS (SELECT p_partkey AS o, p_partkey AS s, p_partkey + p_size AS e, p_brand AS name FROM part)"


def _regions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size")).alias("end"), F.col("p_brand").alias("name"), F.col("p_partkey").alias("order"))


@query(f"WITH {REGIONS} SELECT s_suppkey, coalesce((SELECT arg_max(name, o) FROM g WHERE s_suppkey BETWEEN s AND e), 'off') AS region FROM supplier")
def region_lookup(spark, sf_dir):
    d = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").alias("pos"))
    return variants.region_tags(d, _regions(spark, sf_dir), "pos", "s_suppkey", "off", 50).select("s_suppkey", "region")


SAMPLES = "c AS (SELECT l_partkey AS site, l_linenumber AS sample, CAST(sum(l_quantity) AS BIGINT) AS cov FROM lineitem GROUP BY ALL)"


def _samples(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("site"), F.col("l_linenumber").alias("sample")).agg(F.sum("l_quantity").cast("long").alias("cov"))


@query(f"WITH {SAMPLES} SELECT site, count(*) AS n_samples FROM c GROUP BY ALL HAVING bool_and(cov >= 40 OR sample = 7)")
def coverage_gate(spark, sf_dir):
    return variants.covered(_samples(spark, sf_dir), ["site"], "sample", "cov", 40, 7)


@query(f"WITH {SAMPLES}, n AS (SELECT site, count(DISTINCT sample) AS n_projects FROM c GROUP BY ALL) SELECT n_projects, count(*) AS n_sites FROM n GROUP BY ALL")
def presence_counts(spark, sf_dir):
    return variants.presence(_samples(spark, sf_dir), ["site"], "sample")


CALLS = "c AS (SELECT l_partkey AS site, (l_linenumber - 1) % 3 AS project, min(l_returnflag) || max(l_returnflag) AS call, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL)"


def _calls(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("site"), ((F.col("l_linenumber") - 1) % 3).alias("project"))
    return d.agg(F.concat(F.min("l_returnflag"), F.max("l_returnflag")).alias("call"), F.sum("l_quantity").cast("long").alias("q"))


@query(f"""WITH {CALLS}, t AS (SELECT site, {", ".join(f"max(call) FILTER (project = {k}) AS p{k}" for k in range(3))}, count(DISTINCT project) AS n_projects, bool_or(call[1] <> call[2]) AS any_het FROM c GROUP BY ALL)
    SELECT *, site IN (SELECT p_partkey FROM part WHERE p_size < 10) AS is_known FROM t""")
def project_site_table(spark, sf_dir):
    known = table(spark, sf_dir, "part").filter("p_size < 10").select(F.col("p_partkey").alias("site"))
    het = F.substring("call", 1, 1) != F.substring("call", 2, 1)
    return variants.site_table(_calls(spark, sf_dir), ["site"], "project", 3, "call", het, known)


BANDS = [("high", 1.01, 1e9), ("same", 0.99, 1.01), ("near", 0.9, 0.99), ("low", 0.001, 0.9), ("other", -0.01, 0.001)]


@query(f"""WITH {CALLS}, e AS (SELECT site FROM c GROUP BY ALL HAVING count(DISTINCT project) = 3), f AS (SELECT * FROM c WHERE project = 0 AND call[1] = call[2]),
    r AS (SELECT c.project, CASE WHEN c.call = f.call THEN c.q / f.q ELSE 0 END AS r FROM c JOIN f USING (site) WHERE c.project > 0 AND site IN (SELECT site FROM e))
    SELECT CASE {" ".join(f"WHEN r > {a} AND r <= {b} THEN '{n}'" for n, a, b in BANDS)} END AS band, project, count(*) AS n FROM r GROUP BY ALL""")
def quality_bands(spark, sf_dir):
    return variants.quality_bands(_calls(spark, sf_dir), "site", "project", "call", "q", BANDS, 3)


@query("""WITH g AS (SELECT l_partkey AS site, CAST(sum(l_linenumber) AS BIGINT) AS total, count(*) FILTER (l_linenumber = 1) AS n_missing, count(*) FILTER (l_linenumber < 3) AS n_low, min(l_returnflag) AS ref FROM (SELECT *, l_linenumber - 1 AS x FROM lineitem) GROUP BY ALL)
    SELECT site, CAST(total - cnt AS BIGINT) AS total, n_missing, n_low, ref, p_name FROM (SELECT *, (SELECT count(*) FROM lineitem WHERE l_partkey = site) AS cnt FROM g) LEFT JOIN (SELECT p_partkey AS site, p_name FROM part WHERE p_size < 25) USING (site) WHERE total - cnt >= 49 AND n_missing < 8 AND n_low < 15""")
def filtered_variants(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("site"), (F.col("l_linenumber") - 1).alias("cov"), F.col("l_returnflag").alias("ref"))
    known = table(spark, sf_dir, "part").filter("p_size < 25").select(F.col("p_partkey").alias("site"), "p_name")
    return variants.filtered_variants(d, ["site"], "cov", "ref", 50, 8, 15, 2, known)


@query("""WITH n AS (SELECT o_custkey AS k, o_orderstatus AS effect, 'GENE=' || o_orderpriority[1:1] || ';X=1' AS extra FROM orders),
    g AS (SELECT k, count(*) AS n_notes, string_agg(effect, ':' ORDER BY effect) AS effect, string_agg(DISTINCT extra[6:6], ':' ORDER BY extra[6:6]) AS gene FROM n GROUP BY ALL)
    SELECT c_custkey AS k, coalesce(n_notes, 0) AS n_notes, coalesce(effect, '') AS effect, coalesce(gene, 'no gene') AS "GENE" FROM customer LEFT JOIN g ON c_custkey = k""")
def variant_consequences(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    notes = o.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("effect"), F.concat(F.lit("GENE="), F.substring("o_orderpriority", 1, 1), F.lit(";X=1")).alias("extra"))
    return variants.consequences(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), notes, "k", ["effect"], "extra", "GENE")


@query("""WITH c AS (SELECT l_partkey AS t, l_linenumber AS cell, min(l_returnflag) AS call FROM lineitem GROUP BY ALL)
    SELECT a.cell AS first, b.cell AS second, round(10 * avg(CASE WHEN a.call <> b.call THEN 1 ELSE 0 END), 6) AS distance, count(*) AS n_targets FROM c a JOIN c b USING (t) WHERE a.cell < b.cell GROUP BY ALL""")
def call_distances(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("t"), F.col("l_linenumber").alias("cell")).agg(F.min("l_returnflag").alias("call"))
    return rounded(variants.call_distances(d, "t", "cell", "call"), "distance")


@query("""WITH n AS (SELECT source, substr(text, 1, 3) AS word, count(*) AS n FROM documents GROUP BY ALL)
    SELECT source, arg_min(word, (-n, word)) AS word, max(n) AS n_word, CAST(sum(n) AS BIGINT) AS n_reads FROM n GROUP BY ALL""")
def block_consensus(spark, sf_dir):
    return variants.block_consensus(table(spark, sf_dir, "documents"), "source", "text", 3)


@query("""WITH l AS (SELECT p_brand, i, substr(p_name, i, 1) AS c, count(*) AS n FROM part, (SELECT unnest(range(1, 7)) AS i) GROUP BY ALL), k AS (SELECT p_brand, i, arg_min(c, (-n, c)) AS c FROM l GROUP BY ALL), w AS (SELECT p_brand, string_agg(c, '' ORDER BY i) AS consensus FROM k GROUP BY ALL),
    d AS (SELECT p_partkey, p_brand, substr(p_name, 1, 6) AS word, consensus, CAST(hamming(substr(p_name, 1, 6), consensus) AS INTEGER) AS n_changed FROM part JOIN w USING (p_brand)) SELECT p_partkey, p_brand, CASE WHEN n_changed <= 4 THEN consensus ELSE word END AS word, CASE WHEN n_changed <= 4 THEN n_changed ELSE 0 END AS n_changed FROM d""")
def block_corrections(spark, sf_dir):
    return variants.block_corrected(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name"), "p_brand", "p_name", 6, 4).select("p_partkey", "p_brand", "word", "n_changed")


DAYS = "d AS (SELECT event_type, CAST(ts AS DATE) AS t, count(*) AS n FROM events GROUP BY ALL)"
HOURS = "d AS (SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS t, count(*) AS n FROM events GROUP BY ALL)"


def _hours(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("t")).agg(F.count("*").alias("n"))


@query(f"WITH {HOURS} SELECT event_type, t, n, lead(n) OVER (PARTITION BY event_type ORDER BY t) - n AS slope FROM d QUALIFY slope IS NOT NULL")
def derivative(spark, sf_dir):
    return series.derivative(_hours(spark, sf_dir), ["event_type"], "t", "n")


@query(f"""WITH {HOURS}, s AS (SELECT *, lead(n) OVER w - n AS slope FROM d WINDOW w AS (PARTITION BY event_type ORDER BY t)), z AS (SELECT *, lead(slope) OVER w AS nx, lag(slope) OVER w AS pv, lag(t) OVER w AS lt, lag(n) OVER w AS ln FROM s WHERE slope IS NOT NULL WINDOW w AS (PARTITION BY event_type ORDER BY t)),
    m AS (SELECT *, coalesce(last_value(CASE WHEN slope < 0 AND nx < 0 THEN -1 WHEN slope >= 0 AND nx >= 0 THEN 1 END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY t), 1) AS sg FROM z WHERE nx IS NOT NULL),
    c AS (SELECT *, CASE WHEN lag(sg) OVER (PARTITION BY event_type ORDER BY t) <> sg THEN 1 ELSE 0 END AS f FROM m), r AS (SELECT *, sum(f) OVER (PARTITION BY event_type ORDER BY t) AS run FROM c),
    g AS (SELECT event_type, run, any_value(sg) AS sg, count(*) AS steps, arg_min(CASE WHEN pv < 0 THEN lt ELSE t END, t) AS at_t, arg_min(CASE WHEN pv < 0 THEN ln ELSE n END, t) AS at_n FROM r GROUP BY ALL),
    h AS (SELECT *, lag(steps) OVER (PARTITION BY event_type ORDER BY run) AS rise FROM g) SELECT event_type, at_t AS t, at_n AS n FROM h WHERE sg = -1 AND rise >= 2 AND steps >= 2""")
def peak_maxima(spark, sf_dir):
    return series.peaks(_hours(spark, sf_dir), ["event_type"], "t", "n", 2)


@query(f"""WITH {HOURS}, d2 AS (SELECT * FROM (SELECT event_type, t, lead(n) OVER (PARTITION BY event_type ORDER BY t) - n AS n FROM d) WHERE n IS NOT NULL), s AS (SELECT *, lead(n) OVER w - n AS slope FROM d2 WINDOW w AS (PARTITION BY event_type ORDER BY t)), z AS (SELECT *, lead(slope) OVER w AS nx, lag(slope) OVER w AS pv, lag(t) OVER w AS lt, lag(n) OVER w AS ln FROM s WHERE slope IS NOT NULL WINDOW w AS (PARTITION BY event_type ORDER BY t)),
    m AS (SELECT *, coalesce(last_value(CASE WHEN slope < 0 AND nx < 0 THEN -1 WHEN slope >= 0 AND nx >= 0 THEN 1 END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY t), 1) AS sg FROM z WHERE nx IS NOT NULL),
    c AS (SELECT *, CASE WHEN lag(sg) OVER (PARTITION BY event_type ORDER BY t) <> sg THEN 1 ELSE 0 END AS f FROM m), r AS (SELECT *, sum(f) OVER (PARTITION BY event_type ORDER BY t) AS run FROM c),
    g AS (SELECT event_type, run, any_value(sg) AS sg, count(*) AS steps, arg_min(CASE WHEN pv < 0 THEN lt ELSE t END, t) AS at_t, arg_min(CASE WHEN pv < 0 THEN ln ELSE n END, t) AS at_n FROM r GROUP BY ALL),
    h AS (SELECT *, lag(steps) OVER (PARTITION BY event_type ORDER BY run) AS rise FROM g) SELECT event_type, at_t AS t, at_n AS slope FROM h WHERE sg = -1 AND rise >= 2 AND steps >= 2""")
def inflection_points(spark, sf_dir):
    return series.inflections(_hours(spark, sf_dir), ["event_type"], "t", "n", 2)


@query(f"""WITH {HOURS}, s AS (SELECT * FROM (SELECT *, lead(n) OVER (PARTITION BY event_type ORDER BY t) - n AS slope FROM d) WHERE slope IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY t) - row_number() OVER (PARTITION BY event_type, slope < 0 ORDER BY t) AS g FROM s),
    k AS (SELECT event_type, slope < 0 AS down, min(t) AS t, arg_min(n, t) AS n, count(*) AS steps FROM r GROUP BY event_type, slope < 0, g), l AS (SELECT *, lag(steps) OVER (PARTITION BY event_type ORDER BY t) AS rise FROM k) SELECT event_type, t, n FROM l WHERE down AND rise >= 2 AND steps >= 2""")
def run_peaks(spark, sf_dir):
    return series.run_peaks(_hours(spark, sf_dir), ["event_type"], "t", "n", 2)


@query("""WITH RECURSIVE d AS (SELECT event_type, user_id AS pos, count(*) AS n FROM events GROUP BY ALL), t AS (SELECT event_type, min(pos) AS pos FROM d GROUP BY ALL UNION ALL SELECT * FROM (SELECT t.event_type, min(d.pos) AS pos FROM t JOIN d ON d.event_type = t.event_type AND d.pos >= t.pos + 3 GROUP BY t.event_type, t.pos))
    SELECT event_type, pos, n FROM t JOIN d USING (event_type, pos) QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY n DESC, pos) <= 10""")
def top_hotspots(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy("event_type", F.col("user_id").alias("pos")).agg(F.count("*").alias("n"))
    return series.spaced_top(d, ["event_type"], "pos", "n", 10, 3)


@query("SELECT CAST(floor(ln(l_extendedprice) / ln(2) + 1e-12) AS BIGINT) AS bin, count(*) AS n FROM lineitem WHERE l_extendedprice > 0 GROUP BY ALL")
def hist_log(spark, sf_dir):
    return series.log_histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query("""WITH c AS (SELECT l_quantity AS x, count(*) AS n FROM lineitem GROUP BY ALL), b AS (SELECT x, n, sum(n) OVER (ORDER BY x) - n AS before, sum(n) OVER () AS a FROM c)
    SELECT CAST(before * 10 // a AS BIGINT) AS bin, CAST(sum(n) AS BIGINT) AS n, min(x) AS low, max(x) AS high FROM b GROUP BY ALL""")
def hist_equal_count(spark, sf_dir):
    return series.equal_count_histogram(table(spark, sf_dir, "lineitem"), "l_quantity", 10)


@query("""WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, row_number() OVER (PARTITION BY user_id, event_type, event_id % 16 ORDER BY event_id) AS f FROM events),
    s AS (SELECT user_id, k, CAST(sum(CASE WHEN f = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS n_distinct FROM r) SELECT user_id, n_distinct FROM s WHERE k = 20""")
def fixed_depth_sample(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", (F.col("event_id") % 16).alias("umi"))
    return matrix.running_first_seen(d, "user_id", ["event_id"], ["event_type", "umi"], 20).filter("n_read = 20").select("user_id", "n_distinct")


OLIGO = f"translate(substr(md5(p_name || cast(p_partkey as varchar(20))), 1, cast(4 + p_size % 25 as int)), '{HEX}', '{BASES}')"


def oligos(spark, sf_dir, expr=OLIGO):
    return table(spark, sf_dir, "part").select("p_partkey", F.expr(expr.replace("varchar(20)", "string")).alias("seq"))


_H = "CASE d " + " ".join(f"WHEN '{k}' THEN {h}" for k, (h, _) in text.NEIGHBOURS.items()) + " END"
_S = "CASE d " + " ".join(f"WHEN '{k}' THEN {s}" for k, (_, s) in text.NEIGHBOURS.items()) + " END"


@query(f"""WITH o AS (SELECT p_partkey, {OLIGO} AS seq FROM part), p AS (SELECT p_partkey, substr(seq, i, 2) AS d FROM (SELECT p_partkey, seq, unnest(range(1, length(seq))) AS i FROM o))
    SELECT p_partkey, round(1000 * sum({_H}) / (-10.8 + sum({_S}) + 1.987 * ln(0.00000025 / 4)) - 273.15 + 16.6 * log10(0.05), 4) AS tm FROM p GROUP BY ALL""")
def melting_temperature(spark, sf_dir):
    return oligos(spark, sf_dir).select("p_partkey", F.round(text.melting_temperature(F.col("seq"), 2.5e-7, 0.0, 0.05), 4).alias("tm"))


@query("""WITH n AS (SELECT p_partkey, ['Sept', 'March', 'Dec', 'Gene', 'May'][1 + p_partkey % 5] || CAST(p_size AS VARCHAR) AS name FROM part)
    SELECT p_partkey, CASE WHEN regexp_matches(lower(name), '^(dec|sept|march)[0-9]+$') THEN '''' || name || '''' ELSE name END AS name FROM n""")
def spreadsheet_names(spark, sf_dir):
    name = F.concat(F.element_at(F.array(*map(F.lit, ["Sept", "March", "Dec", "Gene", "May"])), (F.col("p_partkey") % 5 + 1).cast("int")), F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", text.spreadsheet_safe(name).alias("name"))


@query("""WITH x AS (SELECT o_orderkey, o_totalprice * 10 ** (o_orderkey % 7 - 1) AS v FROM orders)
    SELECT o_orderkey, CASE WHEN v >= 1e9 THEN CAST(CAST(round_even(v / 1e9, 0) AS BIGINT) AS VARCHAR) || 'G' WHEN v >= 1e6 THEN CAST(CAST(round_even(v / 1e6, 0) AS BIGINT) AS VARCHAR) || 'M' WHEN v >= 1000 THEN CAST(CAST(round_even(v / 1000, 0) AS BIGINT) AS VARCHAR) || 'k' ELSE 'plain' END AS si FROM x""")
def si_units(spark, sf_dir):
    v = F.col("o_totalprice") * F.pow(F.lit(10.0), F.col("o_orderkey") % 7 - 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(v < 1000, "plain").otherwise(text.si_unit(v)).alias("si"))


@query(f"WITH o AS (SELECT p_partkey, {OLIGO} AS seq FROM part) SELECT p_partkey, CAST(CASE WHEN regexp_matches(seq, 'G[AG][ACGT]C') THEN length(regexp_extract(seq, '^(.*?)G[AG][ACGT]C', 1)) ELSE -1 END AS INTEGER) AS place FROM o")
def motif_places(spark, sf_dir):
    return oligos(spark, sf_dir).select("p_partkey", text.motif_at(F.col("seq"), "GRNC").alias("place"))


@query(f"WITH o AS (SELECT p_partkey, {OLIGO} AS seq FROM part) SELECT p_partkey, len(regexp_extract_all(seq, 'G[CT]')) + 1 AS n_pieces FROM o")
def cut_pieces(spark, sf_dir):
    return oligos(spark, sf_dir).select("p_partkey", F.size(text.cut_at(F.col("seq"), "GY")).cast("long").alias("n_pieces"))


@query(f"""WITH o AS (SELECT p_partkey, {OLIGO} AS seq FROM part), e AS (SELECT * FROM (VALUES ('one', '^[GC][CT][AG]$', '^[CT][AG][GC]$', 3, 1), ('two', '^GC$', '^GC$', 2, 1)) AS v(enzyme, fwd, rev, n, cut)),
    p AS (SELECT p_partkey, enzyme, seq, list_sort(list_distinct(list_concat([i - 1 + cut for i in range(1, length(seq) - n + 2) if regexp_matches(substr(seq, i, n), fwd)], [i - 1 + n - cut for i in range(1, length(seq) - n + 2) if regexp_matches(substr(seq, i, n), rev)]))) AS cuts FROM o, e),
    b AS (SELECT p_partkey, enzyme, seq, list_concat([0], [c for c in cuts if c > 0 AND c < length(seq)]) AS s, list_concat([c for c in cuts if c > 0 AND c < length(seq)], [length(seq)]) AS t FROM p)
    SELECT p_partkey, enzyme, CAST(s[k] AS INTEGER) AS start, substr(seq, CAST(s[k] + 1 AS BIGINT), CAST(t[k] - s[k] AS BIGINT)) AS piece FROM (SELECT *, unnest(range(1, len(s) + 1)) AS k FROM b)""")
def digested_pieces(spark, sf_dir):
    return oligos(spark, sf_dir).select("p_partkey", F.explode(text.digested(F.col("seq"), {"one": "S^YR", "two": "G^C"})).alias("x")).select("p_partkey", "x.*")


@query(f"""WITH o AS (SELECT p_partkey, substr({OLIGO}, 1, 4) AS w FROM part) SELECT DISTINCT p_partkey, substr(w, 1, i) || b || substr(w, i + 2, 4) AS word FROM o, (SELECT unnest(range(0, 4)) AS i), (SELECT unnest(['A', 'C', 'G', 'T']) AS b) WHERE substr(w, i + 1, 1) <> b""")
def single_substitutions(spark, sf_dir):
    return oligos(spark, sf_dir).select("p_partkey", F.explode(text.substitutions(F.substring("seq", 1, 4), 4)).alias("word"))


@query(f"WITH o AS (SELECT p_partkey, {OLIGO} AS seq FROM part), w AS (SELECT substr(seq, i, 3) AS word FROM (SELECT seq, unnest(range(1, length(seq) - 1)) AS i FROM o)) SELECT word, count(*) AS n FROM w GROUP BY ALL ORDER BY n DESC, word LIMIT 20")
def top_words(spark, sf_dir):
    d = oligos(spark, sf_dir).select(F.explode(text.subsequences(F.col("seq"), 3)).alias("word"))
    return d.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(20)


@query(f"""WITH o AS (SELECT p_partkey, {OLIGO} AS seq FROM part), s AS (SELECT p_partkey, seq, i, 6 - length(replace(substr(seq, i, 6), 'A', '')) AS n FROM (SELECT *, unnest(range(1, greatest(length(seq) - 4, 2))) AS i FROM o))
    SELECT p_partkey, CAST(coalesce(min(i - 1) FILTER (n >= 3 AND length(seq) >= 6), -1) AS INTEGER) AS rich, CAST(any_value(instr(seq, 'AA') - 1) AS INTEGER) AS run FROM s GROUP BY ALL""")
def stretches(spark, sf_dir):
    s = F.col("seq")
    return oligos(spark, sf_dir).select("p_partkey", text.rich_stretch(s, "A", 6, 3).alias("rich"), text.first_run(s, "A", 2).alias("run"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') AS name FROM orders")
def path_safe_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", text.path_safe(F.col("o_orderdate")).alias("name"))


@query("SELECT l_orderkey, l_linenumber, l_discount, CAST(trunc(-10 * log10(l_discount + 0.0011)) AS INTEGER) AS q, round(10 ** (-trunc(-10 * log10(l_discount + 0.0011)) / 10), 6) AS p FROM lineitem")
def phred_scores(spark, sf_dir):
    from countloom.functions import sequence

    d = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", text.phred(F.col("l_discount") + 0.0011).alias("q"))
    return d.withColumn("p", F.round(sequence.phred_probability(F.col("q")), 6))


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > (SELECT avg(s_acctbal) FROM supplier) AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey % 2 = 0")
def filter_list(spark, sf_dir):
    """Filters one after another: a scalar subquery, one of several values, and a predicate."""
    mean = table(spark, sf_dir, "supplier").agg(F.avg("s_acctbal")).scalar()
    d = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > mean)
    return rel.filtered(d, [F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_nationkey") % 2 == 0]).select("c_custkey", "c_name")


@query("SELECT n_name, r_name FROM nation, region WHERE n_regionkey = r_regionkey")
def comma_join(spark, sf_dir):
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("""SELECT a.s_suppkey AS first, b.s_suppkey AS second, a.s_nationkey AS "group" FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey WHERE a.s_suppkey % 2 = 0 AND b.s_suppkey % 2 = 1""")
def ortholog_pairs(spark, sf_dir):
    d = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("group"), (F.col("s_suppkey") % 2).alias("taxon"), F.col("s_suppkey").alias("gene"))
    return rel.group_mapping(d, "group", "taxon", "gene", 0, 1)


@query("""WITH f AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'x;' || CAST(s_nationkey AS VARCHAR) ELSE 'y;z' END AS names, CAST(s_suppkey % 25 AS VARCHAR) AS gene, CASE WHEN s_suppkey % 4 = 0 THEN 'set' ELSE '' END AS note FROM supplier),
    k AS (SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name FROM nation WHERE n_nationkey % 2 = 0)
    SELECT s_suppkey, coalesce(nullif(note, ''), (SELECT n_name FROM k WHERE key = split_part(names, ';', 2)), (SELECT n_name FROM k WHERE key = gene), '') AS note FROM f""")
def fallback_lookup(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    names = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("x;"), F.col("s_nationkey").cast("string"))).otherwise("y;z")
    d = s.select("s_suppkey", names.alias("names"), (F.col("s_suppkey") % 25).cast("string").alias("gene"), F.when(F.col("s_suppkey") % 4 == 0, "set").otherwise("").alias("note"))
    notes = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value"))
    return rel.fallback_lookup(d, "s_suppkey", "names", "gene", "note", notes).select("s_suppkey", "note")


@query("""SELECT p_partkey, p_brand, p_size, row_number() OVER (ORDER BY CASE WHEN p_brand = 'Brand#2' THEN 0 ELSE 1 END, p_brand, p_size, p_retailprice DESC, p_partkey) AS place FROM part QUALIFY place <= 100""")
def genomic_order(spark, sf_dir):
    d = rel.genomic_order(table(spark, sf_dir, "part"), "p_brand", ["Brand#2"], "p_size", "p_retailprice", "p_partkey").limit(100).select("p_partkey", "p_brand", "p_size")
    return rel.numbered(d, "p_brand", ["Brand#2"], "p_size", "p_partkey", table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"))


@query("""WITH c AS (SELECT DISTINCT CASE WHEN p_size % 5 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS chr FROM part) SELECT chr, row_number() OVER (ORDER BY TRY_CAST(chr AS INTEGER) NULLS LAST, chr) AS place FROM c""")
def chromosome_order(spark, sf_dir):
    d = table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 5 == 0, F.col("p_brand")).otherwise(F.col("p_size").cast("string")).alias("chr")).distinct()
    return rel.chromosome_places(d, "chr")


@query("SELECT n_regionkey, max(CASE WHEN regexp_matches(n_name, '^NATION_1[0-9]') THEN 1 ELSE 0 END) AS any_match FROM nation GROUP BY ALL")
def regexp_under_max(spark, sf_dir):
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.max(F.when(F.col("n_name").rlike("^NATION_1[0-9]"), 1).otherwise(0)).alias("any_match"))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey // 2 > 0), a(child, ancestor) AS (SELECT child, parent FROM e UNION SELECT a.child, e.parent FROM a JOIN e ON a.ancestor = e.child)
    SELECT s_suppkey FROM supplier WHERE s_suppkey IN (SELECT child FROM a WHERE ancestor IN (5, 6)) OR s_suppkey IN (5, 6) OR s_suppkey + 1 IN (SELECT child FROM a WHERE ancestor IN (5, 6)) OR s_suppkey + 1 IN (5, 6)""")
def ontology_filter(spark, sf_dir):
    e = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 2).alias("parent")).filter("parent > 0")
    d = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat_ws(";", F.col("s_suppkey").cast("string"), (F.col("s_suppkey") + 1).cast("string")).alias("terms"))
    return rel.term_filter(d, "s_suppkey", "terms", rel.closure(e, "child", "parent"), [5, 6]).select("s_suppkey")


@query("""WITH e AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL) SELECT user_id AS "row", event_type AS "column", n FROM e""")
def transposed(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("row"), F.col("user_id").alias("column")).agg(F.count("*").alias("n"))
    return rel.transposed(d, "row", "column").select("row", "column", "n")


@query("""WITH g AS (SELECT user_id, ts AS s, ts + INTERVAL 6 HOUR AS e, event_id FROM events), x AS (SELECT user_id, s, max(event_id) AS event_id FROM g GROUP BY ALL),
    o AS (SELECT o_orderkey, o_custkey AS user_id, TIMESTAMP '2024-01-01' + to_hours(CAST(o_orderkey % 700 AS INTEGER)) AS moment FROM orders)
    SELECT o_orderkey, CASE WHEN moment <= x.s + INTERVAL 6 HOUR THEN x.event_id END AS inside FROM o ASOF LEFT JOIN x ON o.user_id = x.user_id AND x.s <= o.moment""")
def as_of_within(spark, sf_dir):
    from countloom.operators import intervals

    e = table(spark, sf_dir, "events").groupBy("user_id", F.col("ts").cast("timestamp").alias("since")).agg(F.max("event_id").alias("inside"))
    at = F.expr("timestamp'2024-01-01' + make_dt_interval(0, cast(o_orderkey % 700 as int))")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), at.alias("moment"))
    d = intervals.as_of(o, e, ["user_id"], "moment", "since", "inside")
    return d.select("o_orderkey", F.when(F.col("moment") <= F.expr("since + interval 6 hours"), F.col("inside")).alias("inside"))
