"""URL filters: a sort-merge range join of URLs with nested rules, in DataFrame functions only.

A rule (host, path) holds for its host and all subdomains when the URL's path starts with the rule's.
Hosts are canonicalised by reversing their labels (www.example.com is com.example.www), so each
host suffix of a URL is a prefix of its key; within one reversed host a path prefix p is the interval
[p, p + 0xFF) of path bytes, since 0xFF never occurs in UTF-8. Intervals of prefixes nest. A sweep over the sorted
interval ends follows the stack of open rules and leaves segments that carry the innermost rule; URLs
and segments are then sorted together by (reversed host, path) and each URL takes the last
segment before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import UPPER, written

#: The rules of the registered query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: between the first :// and /, ?, # or the end, A-Z lower-cased; path: from there to ?, # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_segments(rules: DataFrame) -> DataFrame:
    """The sweep over the rules: rows (rhost, at, best) where best is the innermost rule from at on, or null.

    Where a rule's interval opens, it is the top of the stack of open rules; where it closes, the rule below it is, and as the intervals nest, that is
    the rule with the longest proper prefix of its path. Each rule looks its prefixes up among the rules of its host, so the stack needs no task that
    holds a host. Equal rules collapse, and then block wins over allow. Rules with a null field are left out.
    """
    rules = rules.dropna(subset=["host", "path", "verdict"]).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    best = F.struct(F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"))
    rules = rules.select(reversed_host(F.col("host")).alias("rhost"), "path", best.alias("best"))
    prefix = F.explode(F.transform(F.sequence(F.lit(0), F.length("path") - 1), lambda k: F.substring("path", F.lit(1), k)))
    below = rules.filter("path != ''").select("rhost", F.col("path").alias("inner"), prefix.alias("path")).join(rules, ["rhost", "path"])
    below = below.groupBy("rhost", "inner").agg(F.max_by("best", F.length("path")).alias("below")).withColumnRenamed("inner", "path")
    opened = rules.select("rhost", F.encode("path", "UTF-8").alias("at"), "best")
    closed = rules.select("rhost", "path").join(below, ["rhost", "path"], "left").select("rhost", F.concat(F.encode("path", "UTF-8"), F.unhex(F.lit("FF"))).alias("at"), F.col("below").alias("best"))
    return opened.unionByName(closed)


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int = 32, run: int = 200_000) -> DataFrame:
    """page_id, host, path, rule and verdict of each page.

    The longest fitting rule wins, the longer host among equally long ones. Without a fitting rule,
    rule is null and the verdict is ``default``. A null URL or one without :// has an empty host
    and path and fits no rule. Equal URLs are judged once, and repeated rows each get a row; very long URLs are taken whole; an empty table gives an empty
    result, and without rules every page has the default. A frequent
    host is dealt over at least ``salts`` sorted runs, and one for every ``run`` different URLs, each with its own copy of the host's segments.
    Columns other than page_id and url are not read.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    segments = rule_segments(rules)
    depth = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"] or 0
    keys = written(urls.filter("host != ''").select("host", "path").distinct(), "url-keys")
    salts = max(salts, -(-keys.count() // run))
    labels = F.split("host", r"\.")
    level = F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(depth))))
    points = keys.withColumn("labels", labels).select("*", level.alias("level")) if depth else keys.withColumn("labels", labels).withColumn("level", F.lit(1))
    rhost = F.array_join(F.reverse(F.expr("slice(labels, size(labels) - level + 1, level)")), ".")
    points = points.select(rhost.alias("rhost"), F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int").alias("salt"), F.encode("path", "UTF-8").alias("at"), F.lit(1).alias("is_url"), "host", "path")
    points = points.join(segments.select("rhost").distinct(), "rhost", "left_semi")
    opened = segments.select("rhost", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "at", F.lit(0).alias("is_url"), F.struct("best").alias("seg"))
    both = points.select("rhost", "salt", "at", "is_url", F.lit(None).cast(opened.schema["seg"].dataType).alias("seg"), "host", "path").unionByName(opened, allowMissingColumns=True)
    sweep = Window.partitionBy("rhost", "salt").orderBy("at", "is_url").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("seg", F.last("seg", ignorenulls=True).over(sweep)).filter("is_url = 1 and seg.best is not null")
    best = found.groupBy("host", "path").agg(F.max(F.struct(F.length("seg.best.rule").alias("n"), F.col("seg.best.host_length").alias("h"), F.col("seg.best.rule").alias("rule"), F.col("seg.best.verdict").alias("verdict"))).alias("b"))
    out = urls.join(best, ["host", "path"], "left")
    return out.select("page_id", "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))


#: DuckDB SQL for filter_urls(pages, RULES).
ORACLE = r"""
WITH r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                           ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS k FROM a),
m AS (SELECT k, arg_max({'rule': h || p, 'verdict': v}, (length(h || p), length(h))) AS best
      FROM b JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY k)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM b LEFT JOIN m USING (k)
"""
