"""The bookkeeping queries: chains of joins, aggregates joined back, latest of a group, queues, closures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import kept


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest(d: DataFrame, keys: list[str], value: str, by: str) -> DataFrame:
    """The value with the greatest ``by`` of each key."""
    return d.groupBy(*keys).agg(F.max_by(value, by).alias(value))


def concatenated(d: DataFrame, keys: list[str], value: str, sep: str = ",") -> DataFrame:
    """The distinct values of each key in order, as one string."""
    return d.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), sep).alias(value))


def spread(d: DataFrame, keys: list[str], name: str, columns: dict[str, str]) -> DataFrame:
    """Counts of the named values of an attribute, one column for each."""
    return d.groupBy(*keys).agg(*[F.count_if(F.col(name) == value).alias(c) for value, c in columns.items()])


def closure(edges: DataFrame, child: str, parent: str, depth: int = 64) -> DataFrame:
    """Strict ancestors (child, ancestor) over edges, until a pass finds nothing new; cycles end too.

    Only the pairs of the last pass join with the edges, and each pass is a checkpoint, so that neither its plan nor its work grows. The joins are shuffled: broadcasts would bring
    a part of every pass to the driver.
    """
    up = kept(edges.select(F.col(child).alias("ancestor"), F.col(parent).alias("above")).distinct())
    known = new = up.select(F.col("ancestor").alias("child"), F.col("above").alias("ancestor"))
    for _ in range(depth):
        found = new.hint("merge").join(up.hint("merge"), "ancestor").select("child", F.col("above").alias("ancestor")).distinct()
        new = kept(found.hint("merge").join(known.hint("merge"), ["child", "ancestor"], "left_anti"))
        if new.isEmpty():
            break
        known = kept(known.unionByName(new))
    return known


def first_write(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Upsert that keeps a value once it is set and takes new ones only if they are not negative."""
    n = new.select(key, F.when(F.col(value) >= 0, F.col(value)).alias("_new"))
    return old.join(n, key, "full").select(key, F.coalesce(value, "_new").alias(value))


def not_in(d: DataFrame, key: str, other: DataFrame) -> DataFrame:
    """Rows whose key is NOT IN the one column of other, as in SQL: none if that holds a null; a null key stays only if other is empty.

    A flag of one row stands for the nulls, so the join itself is a plain anti join by equality.
    """
    o = other.select(F.col(other.columns[0]).alias("_o"))
    flag = F.broadcast(o.agg(F.count("*").alias("_rows"), F.count_if(F.col("_o").isNull()).alias("_nulls")))
    e = d.join(flag).filter((F.col("_nulls") == 0) & (F.col(key).isNotNull() | (F.col("_rows") == 0)))
    return e.join(o.distinct(), F.col(key) == F.col("_o"), "left_anti").drop("_rows", "_nulls")


def filtered(d: DataFrame, tests: list) -> DataFrame:
    """Rows that pass all tests, each applied to what the ones before it left."""
    for t in tests:
        d = d.filter(t)
    return d


def transposed(d: DataFrame, row: str, column: str) -> DataFrame:
    """A matrix in long form with its axes swapped."""
    swap = {row: column, column: row}
    return d.select(*[F.col(c).alias(swap.get(c, c)) for c in d.columns])


def group_mapping(d: DataFrame, group: str, taxon: str, gene: str, first: int, second: int) -> DataFrame:
    """first, second and group: the genes of two taxa in the same group."""
    of = lambda t, name: d.filter(F.col(taxon) == t).select(group, F.col(gene).alias(name))
    return of(first, "first").join(of(second, "second"), group).select("first", "second", group)


def fallback_lookup(d: DataFrame, key: str, names: str, gene: str, note: str, notes: DataFrame) -> DataFrame:
    """d with empty notes filled: from the first of the ;-separated names that has one, else by the gene. notes: key, value; keys are unique."""
    n = d.select(key, F.posexplode(F.split(names, ";")).alias("_k", "key")).join(notes, "key").groupBy(key).agg(F.min_by("value", "_k").alias("_by_name"))
    g = notes.select(F.col("key").alias(gene), F.col("value").alias("_by_gene"))
    out = d.join(n, key, "left").join(g, gene, "left")
    filled = F.coalesce(F.when(F.col(note) != "", F.col(note)), "_by_name", "_by_gene", F.lit(""))
    return out.withColumn(note, filled).drop("_by_name", "_by_gene")


def genomic_order(d: DataFrame, chromosome: str, first: list[str], start: str, length: str, tie: str) -> DataFrame:
    """Rows by chromosome (those of first before the others), start, and the longer ones first."""
    return d.orderBy(F.when(F.col(chromosome).isin(first), 0).otherwise(1), chromosome, start, F.desc(length), tie)


def numbered(d: DataFrame, chromosome: str, first: list[str], start: str, tie: str, lengths: DataFrame) -> DataFrame:
    """A page of rows in genomic order with their place (from 1). The window runs over the page."""
    w = Window.orderBy(F.when(F.col(chromosome).isin(first), 0).otherwise(1), chromosome, start, F.desc(lengths.columns[1]), tie)
    return d.join(lengths, tie).withColumn("place", F.row_number().over(w)).drop(lengths.columns[1])


def chromosome_places(names: DataFrame, name: str) -> DataFrame:
    """Distinct names with their place: numbers by value, then the rest by text. There are as many rows as chromosomes."""
    return names.withColumn("place", F.row_number().over(Window.orderBy(F.expr(f"try_cast({name} as int)").asc_nulls_last(), name)))


def term_filter(d: DataFrame, key: str, terms: str, ancestors: DataFrame, listed: list) -> DataFrame:
    """Rows of which any ;-separated term is a listed one or a descendant of one."""
    below = ancestors.filter(F.col("ancestor").isin(listed)).select(F.col("child").cast("string").alias("_t")).distinct()
    own = d.sparkSession.createDataFrame([(str(x),) for x in listed], "_t string")
    hits = d.select(key, F.explode(F.split(terms, ";")).alias("_t")).join(below.unionByName(own).distinct(), "_t").select(key).distinct()
    return d.join(hits, key, "left_semi")


def lims_rollup_list(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    c = _t(spark, sf_dir, "customer").join(_t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "n_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "total")


def having_expr(spark, sf_dir):
    listed = _t(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("_listed"))
    n = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return n.join(listed, "o_custkey", "left").filter("10 - n > 0 or _listed").drop("_listed")


def latest_by_group(spark, sf_dir):
    return latest(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus", "o_orderkey")


def group_concat(spark, sf_dir):
    return concatenated(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority")


def not_in_queue(spark, sf_dir):
    queued = _t(spark, sf_dir, "orders").filter("o_orderkey % 4 = 0").select("o_custkey")
    return not_in(_t(spark, sf_dir, "customer"), "c_custkey", queued).select("c_custkey", "c_name")


def in_subquery(spark, sf_dir):
    urgent = _t(spark, sf_dir, "orders").filter("o_orderpriority like '1%'")
    return _t(spark, sf_dir, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


def right_join(spark, sf_dir):
    big = _t(spark, sf_dir, "customer").filter("c_acctbal > 9000").select("c_custkey", "c_nationkey")
    return big.join(_t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "right").select("n_name", "c_custkey")


def eav_pivot(spark, sf_dir):
    return spread(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus", {"F": "n_f", "O": "n_o", "P": "n_p"})


def ontology_closure(spark, sf_dir):
    e = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 2).alias("parent")).filter("parent > 0")
    return closure(e, "child", "parent")


def upsert_first_write(spark, sf_dir):
    old = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("v"))
    new = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("v"))
    return first_write(old, new, "key", "v")


QUERIES = [
    (lims_rollup_list, "SELECT c_custkey, n_name, coalesce(n_orders, 0) AS n_orders, total FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL) ON c_custkey = o_custkey"),
    (having_expr, "SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL HAVING 10 - count(*) > 0 OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"),
    (latest_by_group, "SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY ALL"),
    (group_concat, "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS o_orderpriority FROM orders GROUP BY ALL"),
    (not_in_queue, "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 4 = 0)"),
    (in_subquery, "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')"),
    (right_join, "SELECT n_name, c_custkey FROM (SELECT * FROM customer WHERE c_acctbal > 9000) RIGHT JOIN nation ON c_nationkey = n_nationkey"),
    (eav_pivot, "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p FROM orders GROUP BY ALL"),
    (ontology_closure, "WITH RECURSIVE e AS (SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey // 2 > 0), a(child, ancestor) AS (SELECT child, parent FROM e UNION SELECT a.child, e.parent FROM a JOIN e ON a.ancestor = e.child) SELECT child, CAST(ancestor AS BIGINT) AS ancestor FROM a"),
    (upsert_first_write, "SELECT coalesce(o.key, n.key) AS key, coalesce(o.v, n.v) AS v FROM (SELECT c_custkey AS key, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS v FROM customer) o FULL JOIN (SELECT s_suppkey AS key, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS v FROM supplier) n ON o.key = n.key"),
]
