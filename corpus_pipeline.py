"""A corpus pipeline of five operators: quality rules, near copies, personal data, mixing, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from countloom.llm import queries
from countloom.llm.common import written

#: (name, function) in order; each function takes (spark, docs, sf_dir) and works on all that the one before it kept.
STAGES = [
    ("quality", queries.stage_quality),
    ("near_copies", queries.stage_near_copies),
    ("personal_data", queries.stage_personal_data),
    ("mix", queries.stage_mix),
    ("pieces", queries.stage_pieces),
]
#: Near copies and pieces are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each one's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
