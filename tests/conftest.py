import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def same_rows(spark_df, duck_df):
    """Column names equal, and rows equal in any order, doubles within 2e-6."""
    a, b = spark_df.toPandas(), duck_df
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    tidy = lambda v: None if pd.isna(v) else f'{float(v):.5f}' if isinstance(v, (int, float)) else str(v)
    rows = lambda d: sorted(map(str, ([tidy(x.item() if hasattr(x, "item") else x) for x in r] for r in d[cols].astype(object).values.tolist())))
    x, y = rows(a), rows(b)
    assert len(x) == len(y)
    assert [(p, q) for p, q in zip(x, y, strict=True) if p != q][:3] == []
