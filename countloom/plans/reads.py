"""The queries of read extraction and of multi-mapping reads, as (function, DuckDB SQL).

Reads are made from event numbers: the hexadecimal digits of their MD5 stand for bases and qualities.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from countloom.operators import mappings, reads

from .profiles import table

QUERIES = []


def query(sql: str):
    def add(f):
        QUERIES.append((f, sql))
        return f

    return add


HEX, BASES, QUALITIES = "0123456789abcdef", "ACGTACGTACGTACGT", "!5;AEFGHIIIIBBBB"
PRIMER, PREFIX = "CTGTCTCTTATACACATC", "GTCT"
LAYOUT = {"umi_at": 4, "umi_length": 4, "switch_at": 8, "switch": "G", "extra": 3, "least_quality": "5", "shortest_primer": 6, "least_bases": 8}
LEAST = 40
#: seq, qual of an event; every 7th read ends in A, every 11th in the start of the primer, every 13th in N, every 17th repeats a pair.
SEQ = f"""translate(md5(cast(event_id as varchar(20))), '{HEX}', '{BASES}') || CASE WHEN event_id % 17 = 0 THEN repeat('AC', 16) ELSE translate(md5(concat('b', cast(event_id as varchar(20)))), '{HEX}', '{BASES}') END
    || CASE WHEN event_id % 7 = 0 THEN repeat('A', 30) WHEN event_id % 11 = 0 THEN '{PRIMER[:11]}' WHEN event_id % 13 = 0 THEN 'ACGTNNNN' ELSE '' END"""
QUAL = f"translate(md5(concat('q', cast(event_id as varchar(20)))), '{HEX}', '{QUALITIES}') || translate(md5(concat('r', cast(event_id as varchar(20)))), '{HEX}', 'IIIIIIIIIIIIIIBB')"
#: The barcodes: 25 of four bases, numbered from 0; the last three are not in use.
CODE = f"substr(translate(md5(n_name), '{HEX}', '{BASES}'), 1, 4)"
BARCODES = f"bc AS (SELECT code, min(n_nationkey) AS index FROM (SELECT n_nationkey, {CODE} AS code FROM nation) GROUP BY ALL)"
READS = f"raw AS (SELECT event_id, user_id, event_type, {SEQ} AS seq, {QUAL} AS q FROM events), reads AS (SELECT event_id, user_id, event_type, seq, q || repeat('I', length(seq) - length(q)) AS qual, substr(seq, 1, 4) AS code FROM raw)"
MUTANTS = """pos AS (SELECT unnest(range(0, 4)) AS i), mut AS (SELECT DISTINCT index, substr(code, 1, i) || b || substr(code, i + 2, 4) AS match FROM bc, pos, (SELECT unnest(['A', 'C', 'G', 'T']) AS b)),
    t AS (SELECT code AS match, index FROM bc UNION ALL SELECT match, min(index) FROM mut WHERE match NOT IN (SELECT code FROM bc) GROUP BY match HAVING count(*) = 1)"""


def raw(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    seq, qual = (F.expr(x.replace("varchar(20)", "string")) for x in (SEQ, QUAL))
    d = e.select("event_id", "user_id", "event_type", seq.alias("seq"), qual.alias("q"))
    pad = F.repeat(F.lit("I"), F.length("seq") - F.length("q"))
    return d.select("event_id", "user_id", "event_type", "seq", F.concat("q", pad).alias("qual"), F.substring("seq", 1, 4).alias("code"))


def barcodes(spark, sf_dir):
    d = table(spark, sf_dir, "nation").select("n_nationkey", F.expr(CODE).alias("code"))
    return d.groupBy("code").agg(F.min("n_nationkey").alias("index"))


@query(f"WITH {READS} SELECT event_id, CAST(length(rtrim(qual, 'B')) AS INTEGER) AS trimmed, CASE WHEN length(rtrim(qual, 'B')) <= 60 THEN 'SEQ_QUALITY_ERROR' ELSE 'VALID' END AS status FROM reads")
def quality_tail(spark, sf_dir):
    d = raw(spark, sf_dir).select("event_id", reads.quality_trimmed(F.col("qual")).alias("trimmed"))
    return d.withColumn("status", F.when(F.col("trimmed") <= 60, "SEQ_QUALITY_ERROR").otherwise("VALID"))


@query(f"WITH {READS} SELECT event_id, CAST(CASE WHEN substr(seq, 9, 1) = 'G' THEN 9 + length(regexp_extract(substr(seq, 10, 3), '^G*')) END AS INTEGER) AS insert_at FROM reads")
def switch_and_extra(spark, sf_dir):
    return raw(spark, sf_dir).select("event_id", reads.insert_start(F.col("seq"), 8, "G", 3).alias("insert_at"))


_UMI = " ".join(f"WHEN substr(qual, {i}, 1) < '5' THEN 'LOW_QUALITY_IN_UMI' WHEN substr(seq, {i}, 1) = 'N' THEN 'N_IN_UMI'" for i in range(5, 9))


@query(f"WITH {READS} SELECT event_id, substr(seq, 5, 4) AS umi, CASE {_UMI} ELSE 'VALID' END AS status FROM reads")
def umi_quality(spark, sf_dir):
    d = raw(spark, sf_dir)
    return d.select("event_id", F.substring("seq", 5, 4).alias("umi"), reads.umi_status(F.col("seq"), F.col("qual"), 4, 4, "5").alias("status"))


_TAIL = f"""n AS (SELECT *, greatest(length(rtrim(substr(seq, 1, length(rtrim(qual, 'B'))), 'N')), {LEAST - 1}) AS n_len FROM reads),
    a AS (SELECT *, greatest(length(rtrim(substr(seq, 1, n_len), 'A')), {LEAST - 1}) AS a_len, length(seq) - instr(reverse(seq), reverse('{PRIMER[:6]}')) + 1 - 6 AS head FROM n),
    p AS (SELECT *, contains(seq, '{PRIMER[:6]}') AND starts_with('{PRIMER[6:]}', substr(seq, head + 7)) AS hit FROM a),
    tail AS (SELECT * EXCLUDE (n_len, a_len, head, hit), CASE WHEN a_len < {LEAST} THEN a_len WHEN hit THEN head ELSE n_len END AS tail_len,
      CASE WHEN a_len < {LEAST} THEN 'TOO_LONG_TRAILING_pApN' WHEN hit AND head < {LEAST} THEN 'TOO_LONG_TRAILING_PRIMER_SEQ' ELSE 'VALID' END AS tail_status FROM p)"""


@query(f"WITH {READS}, {_TAIL} SELECT event_id, CAST(tail_len AS INTEGER) AS length, tail_status AS status FROM tail")
def tail_trim(spark, sf_dir):
    d = raw(spark, sf_dir)
    length, status = reads.without_tail(F.col("seq"), reads.quality_trimmed(F.col("qual")), LEAST, [PRIMER], 6)
    return d.select("event_id", length.alias("length"), status.alias("status"))


_PAIR = " OR ".join(f"contains(i, repeat('{p}', CAST((length(i) - 6) // 2 AS INTEGER)))" for p in reads.PAIRS)


@query(f"WITH {READS} SELECT event_id, length(regexp_replace(i, '[AaNn]', '', 'g')) >= 18 AS complex_enough, {_PAIR} AS pair_repeat FROM (SELECT event_id, substr(seq, 33, 32) AS i FROM reads)")
def insert_complexity(spark, sf_dir):
    i = F.substring("seq", 33, 32)
    return raw(spark, sf_dir).select("event_id", reads.complex_enough(i, 18).alias("complex_enough"), reads.pair_repeat(i).alias("pair_repeat"))


def _artefact(prefix: str, s: str, tests=reads.ARTEFACTS) -> str:
    start = f"instr({s}, '{reads.TN5[:12]}')"
    first = f"WHEN {start} > 0 AND starts_with('{reads.TN5}', substr({s}, {start}, {len(reads.TN5)})) THEN '{prefix}_TN5'"
    tests = " ".join(f"WHEN contains({s}, '{x}') THEN '{prefix}_{n}'" for n, x in tests)
    many = " ".join(f"WHEN length({s}) - length(replace({s}, '{b}', '')) > length({s}) // 2 OR contains({s}, repeat('{b}', 20)) THEN '{prefix}_MANY_{b}'" for b in "ACGT")
    return f"CASE {first} {tests} {many} ELSE '{prefix}_OTHER' END"


@query(f"""WITH {READS}, x AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN seq || 'AATGATACGGCGACC' WHEN 1 THEN 'TAGTCACACAGTCCTTGACG' || seq WHEN 2 THEN repeat('T', 20) || seq WHEN 3 THEN repeat('CG', 30) || 'C' WHEN 4 THEN seq || 'CTGTCTCTTATAC' WHEN 5 THEN 'CTGTCTCTTATAGGG' || seq ELSE seq END AS s FROM reads)
    SELECT event_id, {_artefact('NO_BC', 's')} AS status FROM x""")
def artefact_class(spark, sf_dir):
    s = F.expr("case event_id % 9 when 0 then seq || 'AATGATACGGCGACC' when 1 then 'TAGTCACACAGTCCTTGACG' || seq when 2 then repeat('T', 20) || seq when 3 then repeat('CG', 30) || 'C' when 4 then seq || 'CTGTCTCTTATAC' when 5 then 'CTGTCTCTTATAGGG' || seq else seq end")
    return raw(spark, sf_dir).select("event_id", reads.artefact(s, "NO_BC").alias("status"))


@query(f"WITH {READS}, {BARCODES} SELECT event_id, coalesce(index, -1) AS index FROM reads LEFT JOIN bc USING (code)")
def barcode_exact(spark, sf_dir):
    codes = barcodes(spark, sf_dir).withColumnRenamed("code", "match")
    return reads.with_barcode(raw(spark, sf_dir), "code", codes, "index").select("event_id", "index")


@query(f"WITH {READS}, {BARCODES}, {MUTANTS} SELECT event_id, coalesce(index, -1) AS index FROM reads LEFT JOIN t ON code = match")
def barcode_one_mismatch(spark, sf_dir):
    codes = reads.barcode_index(barcodes(spark, sf_dir), "code", "index", 4)
    return reads.with_barcode(raw(spark, sf_dir), "code", codes, "index").select("event_id", "index")


@query(f"""WITH {READS}, {BARCODES} SELECT event_id, CASE WHEN index IS NULL THEN CASE WHEN code IN (SELECT substr(translate(md5(r_name), '{HEX}', '{BASES}'), 1, 4) FROM region) THEN 'MIXIN_SAMPLE_BC' ELSE 'UNKNOWN_BC' END
    WHEN index >= 22 THEN 'MIXIN_SAMPLE_BC' ELSE 'VALID' END AS status FROM reads LEFT JOIN bc USING (code)""")
def barcode_class(spark, sf_dir):
    codes = barcodes(spark, sf_dir).withColumnRenamed("code", "match")
    others = table(spark, sf_dir, "region").select(F.expr(CODE.replace("n_name", "r_name")).alias("code"))
    d = reads.with_barcode(raw(spark, sf_dir), "code", codes, "index")
    return reads.index_status(d, "code", "index", others, F.col("index") >= 22).select("event_id", "status")


@query(f"WITH {READS} SELECT event_id, substr(seq, 33, 8) AS second FROM reads WHERE regexp_matches(substr(seq, 33), '^(GT|A)C')")
def second_read_prefix(spark, sf_dir):
    d = raw(spark, sf_dir)
    return d.filter(F.substring("seq", 33, 100).rlike("^(GT|A)C")).select("event_id", F.substring("seq", 33, 8).alias("second"))


EXTRACTED = f"""{READS}, {BARCODES}, {MUTANTS}, {_TAIL}, j AS (SELECT tail.*, coalesce(index, -1) AS index, CASE WHEN substr(seq, 9, 1) = 'G' THEN 9 + length(regexp_extract(substr(seq, 10, 3), '^G*')) END AS ins FROM tail LEFT JOIN t ON code = match),
    k AS (SELECT *, substr(seq, ins + 1, tail_len - ins) AS i FROM j),
    x AS (SELECT *, CASE WHEN length(rtrim(qual, 'B')) <= {LEAST} THEN 'SEQ_QUALITY_ERROR' WHEN index = -1 THEN {_artefact('NO_BC', 'seq')} WHEN ins IS NULL THEN {_artefact('NO_TSSEQ', 'seq', reads.ARTEFACTS[:1])}
      WHEN tail_status <> 'VALID' THEN tail_status WHEN contains(seq, 'TTTTTT') THEN 'FORBIDDEN_INTERNAL_SEQ' {_UMI} WHEN length(regexp_replace(i, '[AaNn]', '', 'g')) < 8 THEN 'COMPLEXITY_ERROR' WHEN contains(seq, 'AATGATACGGCGACC') THEN 'P1_IN_READ'
      WHEN {_PAIR} THEN 'COMPLEXITY_ERROR' ELSE 'VALID' END AS status FROM k)"""


def extracted(spark, sf_dir):
    d = reads.with_barcode(raw(spark, sf_dir), "code", reads.barcode_index(barcodes(spark, sf_dir), "code", "index", 4), "index")
    return reads.extracted(d, "seq", "qual", LAYOUT, LEAST, [PRIMER], ["TTTTTT"])


@query(f"WITH {EXTRACTED} SELECT event_id, index, status, CASE WHEN status = 'VALID' THEN substr(seq, 5, 4) END AS umi, CASE WHEN status = 'VALID' THEN i END AS insert FROM x")
def read_extraction(spark, sf_dir):
    return extracted(spark, sf_dir).select("event_id", "index", "status", "umi", "insert")


@query(f"WITH {EXTRACTED} SELECT index, status, count(*) AS n_reads, count(*) FILTER (event_id % 5 <> 0) AS n_pf FROM x GROUP BY ALL")
def status_counts(spark, sf_dir):
    return reads.status_counts(extracted(spark, sf_dir).withColumn("pf", F.col("event_id") % 5 != 0), ["index"])


@query(f"WITH {READS} SELECT event_id AS place, seq, reverse(translate(seq, 'ACGT', 'TGCA')) AS seq_2 FROM reads")
def mate_zip(spark, sf_dir):
    d = raw(spark, sf_dir)
    first = d.select(F.col("event_id").alias("place"), F.concat(F.lit("r"), "event_id", F.lit(" 1:N")).alias("header"), "seq")
    second = d.select(F.col("event_id").alias("place"), F.concat(F.lit("r"), "event_id", F.lit(" 2:N")).alias("header"), F.reverse(F.translate("seq", "ACGT", "TGCA")).alias("seq"))
    return reads.zipped(first, second, "place", "header").select("place", "seq", "seq_2")


MAPPINGS = "m AS (SELECT l_orderkey AS read_id, l_linenumber AS k, min(l_partkey) AS pos, CASE WHEN min(l_returnflag) = 'A' THEN '-' ELSE '+' END AS strand FROM lineitem GROUP BY ALL)"
#: Exons of two blocks with an intron whose length depends on the gene: s and e of each, b the transcript's length before it, and len that of all.
GENES = """g0 AS (SELECT p_partkey AS gene, p_partkey AS s1, p_partkey + 1 + p_partkey % 2 AS e1, p_partkey + 4 + p_partkey % 3 * 40 AS s2, p_partkey + 4 + p_partkey % 3 * 40 + p_size % 7 AS e2, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS gs FROM part WHERE p_type IN ('PROMO', 'SMALL', 'LARGE')),
    g AS (SELECT gene, gs, s1 AS s, e1 AS e, 0 AS b, e1 - s1 + e2 - s2 + 2 AS len FROM g0 UNION ALL SELECT gene, gs, s2, e2, e1 - s1 + 1, e1 - s1 + e2 - s2 + 2 FROM g0)"""
REPEATS = "r AS (SELECT p_partkey AS s, p_partkey + 2 AS e FROM part WHERE p_size < 8)"


def _mappings(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    parts = max(lines.count() // mappings.ROWS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").repartition(parts, "l_orderkey").groupBy(F.col("l_orderkey").alias("read_id"), F.col("l_linenumber").alias("k"))
    return d.agg(F.min("l_partkey").alias("pos"), F.when(F.min("l_returnflag") == "A", "-").otherwise("+").alias("strand"))


def _genes(spark, sf_dir):
    p, gene = table(spark, sf_dir, "part").filter("p_type in ('PROMO', 'SMALL', 'LARGE')"), F.col("p_partkey")
    second = gene + 4 + gene % 3 * 40
    exons = F.array(F.struct(gene.alias("s"), (gene + 1 + gene % 2).alias("e")), F.struct(second.alias("s"), (second + F.col("p_size") % 7).alias("e")))
    return p.select(gene.alias("gene"), F.when(gene % 2 == 0, "+").otherwise("-").alias("strand"), exons.alias("exons"))


def _repeats(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_size < 8").select(F.col("p_partkey").alias("start"), (F.col("p_partkey") + 2).alias("end"))


DISTANCE = "CASE WHEN gs = '+' THEN b + pos - s ELSE len - 1 - b - pos + s END"
FLAGGED = f"""{MAPPINGS}, {GENES}, {REPEATS}, h AS (SELECT read_id, k, pos, strand, gene, {DISTANCE} AS dist FROM m JOIN g ON pos BETWEEN s AND e AND strand = gs),
    f AS (SELECT m.*, EXISTS (SELECT 1 FROM g WHERE pos BETWEEN s AND e AND strand = gs) AS tr, EXISTS (SELECT 1 FROM r WHERE pos BETWEEN s AND e) AS rep, count(*) OVER (PARTITION BY read_id) AS n FROM m),
    b AS (SELECT read_id, min(k) FILTER (rep AND NOT tr AND n > 1) AS bad, min(k) AS first, bool_or(tr) AS any_tr FROM f GROUP BY ALL)"""


@query(f"WITH {MAPPINGS}, {GENES} SELECT read_id, k, arg_min(gene, (d, gene)) AS gene, min(d) AS distance, count(*) > 1 AS has_variants FROM (SELECT *, {DISTANCE} AS d FROM m JOIN g ON pos BETWEEN s AND e AND strand = gs) GROUP BY ALL")
def nearest_match(spark, sf_dir):
    return mappings.nearest_match(_mappings(spark, sf_dir), _genes(spark, sf_dir), ["read_id", "k"], 50)


@query(f"WITH {FLAGGED} SELECT read_id, k, gene, count(*) OVER (PARTITION BY read_id, k) > 1 AS has_variants FROM h")
def all_matches(spark, sf_dir):
    return mappings.all_matches(_mappings(spark, sf_dir), _genes(spark, sf_dir), ["read_id", "k"], 50).select("read_id", "k", "gene", "has_variants")


@query(f"WITH {FLAGGED} SELECT read_id, CASE WHEN bad IS NOT NULL THEN bad WHEN any_tr THEN k ELSE first END AS k, bad IS NULL AND any_tr AS in_transcript FROM f JOIN b USING (read_id) WHERE CASE WHEN bad IS NOT NULL THEN k = bad WHEN any_tr THEN tr ELSE k = first END")
def multiread_all(spark, sf_dir):
    return mappings.resolved(_mappings(spark, sf_dir), _genes(spark, sf_dir), _repeats(spark, sf_dir), "read_id", "k", "all", 50).select("read_id", "k", "in_transcript")


@query(f"WITH {FLAGGED}, n AS (SELECT read_id, arg_min(k, (dist, k)) AS near FROM h GROUP BY ALL) SELECT read_id, CASE WHEN bad IS NOT NULL THEN bad ELSE coalesce(near, first) END AS k, bad IS NULL AND near IS NOT NULL AS in_transcript FROM b LEFT JOIN n USING (read_id)")
def multiread_nearest(spark, sf_dir):
    return mappings.resolved(_mappings(spark, sf_dir), _genes(spark, sf_dir), _repeats(spark, sf_dir), "read_id", "k", "nearest", 50).select("read_id", "k", "in_transcript")


@query(f"""WITH {FLAGGED}, n AS (SELECT read_id, arg_min(k, (md5(concat(cast(read_id as varchar), ':', cast(k as varchar))), k)) AS pick FROM f WHERE tr GROUP BY ALL)
    SELECT read_id, CASE WHEN bad IS NOT NULL THEN bad ELSE coalesce(pick, first) END AS k, bad IS NULL AND pick IS NOT NULL AS in_transcript FROM b LEFT JOIN n USING (read_id)""")
def multiread_random(spark, sf_dir):
    return mappings.resolved(_mappings(spark, sf_dir), _genes(spark, sf_dir), _repeats(spark, sf_dir), "read_id", "k", "random", 50).select("read_id", "k", "in_transcript")


@query(f"""WITH {FLAGGED}, s AS (SELECT DISTINCT read_id, gene FROM h JOIN b USING (read_id) WHERE bad IS NULL)
    SELECT x.gene AS gene, y.gene AS other, count(*) AS n_reads FROM s x JOIN s y ON x.read_id = y.read_id AND x.gene <> y.gene GROUP BY ALL""")
def shared_genes(spark, sf_dir):
    return mappings.shared_genes(_mappings(spark, sf_dir), _genes(spark, sf_dir), _repeats(spark, sf_dir), "read_id", "k", 50)


@query(f"WITH {MAPPINGS}, n AS (SELECT read_id FROM m GROUP BY ALL HAVING count(*) <= 3) SELECT m.* FROM m JOIN n USING (read_id)")
def few_mappings(spark, sf_dir):
    return reads.max_mappings(_mappings(spark, sf_dir), "read_id", 3)


@query(f"""WITH {MAPPINGS}, {GENES}, {REPEATS}, s AS (SELECT read_id, k, pos FROM m WHERE NOT EXISTS (SELECT 1 FROM g WHERE pos BETWEEN s AND e AND strand = gs)),
    c AS (SELECT s.read_id, s.k, 'antisense' AS layer FROM s JOIN m USING (read_id, k) WHERE EXISTS (SELECT 1 FROM g WHERE m.pos BETWEEN g.s AND g.e AND m.strand <> gs))
    SELECT read_id, k, CASE WHEN c.layer IS NOT NULL THEN 'antisense' WHEN EXISTS (SELECT 1 FROM r WHERE s.pos BETWEEN r.s AND r.e) THEN 'repeat' END AS layer FROM s LEFT JOIN c USING (read_id, k)""")
def other_features(spark, sf_dir):
    return mappings.other_features(_mappings(spark, sf_dir), _genes(spark, sf_dir), {"repeat": _repeats(spark, sf_dir)}, ["read_id", "k"], 50)
