"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html, lexical, minhash, mixing, pieces, pii, quality, rollup, spelling, substrings, urls, vectors, warc
from .common import shared_folder, short_batches, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_documents(_table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(_table(spark, sf_dir, "pages"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op4_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-rollup-{uuid.uuid4().hex}"
    return rollup.corpus_rollup(_table(spark, sf_dir, "documents"), folder)


def op6_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents"))


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, sf_dir, "documents"))


def op12_page_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_archive(_table(spark, sf_dir, "pages"), f"{shared_folder(spark)}/page-archive-{uuid.uuid4().hex}")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.impact_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, as they are. Null and empty texts have no words and go; repeated rows are judged alike, very long texts as a whole; an empty table stays empty."""
    return quality.keep_good(docs)


def stage_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id (of equal rows one), as it is. Texts without words are near nothing and all stay; an empty table stays empty."""
    return minhash.drop_near_copies(docs)


def stage_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with masked texts, and n_chars counted again where there is such a column. A null text stays null and counts no characters; repeated rows are masked alike, very long texts as a whole; an empty table stays empty."""
    masked = pii.mask_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each time that it takes them, the one at a source's cut whole. Texts without words are in no mix; the null source is a source of its own; an empty table stays empty."""
    return mixing.mixed(docs)


def stage_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and lang with the pieces' ids of each document. A null or empty text has none; repeated rows each get theirs; very long texts are encoded whole; an empty table stays empty."""
    with short_batches(spark):
        return written(pieces.encode(docs, keep=["doc_id", "source", "lang"]), "pieces")


QUERIES = {
    f.__name__: f
    for f in (op1_near_documents, op2_main_text, op3_mix_sources, op4_filter_urls, op5_token_rollup, op6_without_repeats, op7_near_vectors, op8_pieces, op9_quality, op10_personal_data, op11_spelling_groups, op12_page_archive, op13_ranked_search, pipeline)
}
ORACLES = {"op3_mix_sources": mixing.ORACLE, "op4_filter_urls": urls.ORACLE, "op11_spelling_groups": spelling.ORACLE, "op12_page_archive": warc.ORACLE, "op13_ranked_search": lexical.ORACLE}
