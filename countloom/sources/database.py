"""Tables of a database by JDBC: a partitioned scan with pushed predicates, and a batched write that can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scanned(spark: SparkSession, url: str, table: str, column: str | None = None, partitions: int = 8, predicate: str | None = None, **options: str) -> DataFrame:
    """A table's rows that fit a predicate, which the database evaluates. With a numeric or date column the scan is dealt to ranges of its values between the least and greatest that fit."""
    read = spark.read.format("jdbc").option("url", url).options(**options)
    d = read.option("dbtable", table).load()
    fit = d.filter(predicate) if predicate else d
    if column:
        low, high = fit.agg(F.min(column), F.max(column)).first()  # aggregates are pushed down too
        if low is not None:
            d = read.option("dbtable", table).option("partitionColumn", column).option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", str(partitions)).load()
            fit = d.filter(predicate) if predicate else d
    return fit


def _connection(spark: SparkSession, url: str, options: dict[str, str]):
    p = spark._jvm.java.util.Properties()
    for k, v in options.items():
        p.setProperty(k, v)
    if "driver" in options:
        spark._jvm.java.lang.Class.forName(options["driver"], True, spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
    return spark._jvm.java.sql.DriverManager.getConnection(url, p)


def _run(connection, *statements: str) -> None:
    s = connection.createStatement()
    try:
        for x in statements:
            s.execute(x)
    finally:
        s.close()


def _has(connection, table: str) -> bool:
    schema, _, name = table.rpartition(".")
    found = connection.getMetaData().getTables(None, schema.upper() or None, name.upper(), None)
    try:
        return found.next()
    finally:
        found.close()


def written_batch(d: DataFrame, url: str, table: str, keys: list[str], batch: str, batch_rows: int = 1000, empty_copy: str = "CREATE TABLE {new} AS SELECT {columns} FROM {table} WITH NO DATA", **options: str) -> bool:
    """Put d's rows into a table, in place of rows with the same keys, all or none; False if the batch had been written before.

    The tasks insert in batches of rows into a table of the batch's own, where a task that is run again may leave rows twice. One transaction then records the batch, deletes what it replaces and inserts its
    distinct rows, so a batch that broke off or is sent again changes nothing more. Keys name a row of d and are not null; d has all columns of the table by name. ``empty_copy`` is the
    database's way to copy a table without rows.
    """
    if not batch.isidentifier():
        raise ValueError("a batch is named like an identifier")
    spark, stage, log = d.sparkSession, f"{table}_{batch}_stage", f"{table}_batches"
    columns, list_of = d.columns, ", ".join(d.columns)
    c = _connection(spark, url, options)
    try:
        if not _has(c, log):
            _run(c, f"CREATE TABLE {log} (batch VARCHAR(128) NOT NULL PRIMARY KEY)")
        s = c.createStatement()
        known = s.executeQuery(f"SELECT batch FROM {log} WHERE batch = '{batch}'").next()
        s.close()
        if known:
            return False
        if _has(c, stage):
            _run(c, f"DROP TABLE {stage}")
        _run(c, empty_copy.format(new=stage, columns=list_of, table=table))
        d.select(*columns).write.format("jdbc").mode("append").option("url", url).option("dbtable", stage).option("batchsize", str(batch_rows)).options(**options).save()
        same = " AND ".join(f"s.{k} = t.{k}" for k in keys)
        c.setAutoCommit(False)
        try:
            _run(c, f"INSERT INTO {log} VALUES ('{batch}')", f"DELETE FROM {table} t WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {same})", f"INSERT INTO {table} ({list_of}) SELECT DISTINCT {list_of} FROM {stage}")
            c.commit()
        except Exception:
            c.rollback()
            raise
        c.setAutoCommit(True)
        _run(c, f"DROP TABLE {stage}")
        return True
    finally:
        c.close()
