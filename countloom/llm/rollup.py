"""Token counts kept as rollups that signed deltas maintain.

A delta row adds or takes away a document's counts: an insert is +1, a delete -1, a revision takes the old counts
away and adds the new ones. A batch of deltas is added up by source, language and tokenizer version and written under an
attempt of its own; a commit record then names batch and attempt. Totals are the sums over the least attempt that each batch id has a
record of. So a batch that broke off before its record doesn't count, a replayed batch is not written again, and of two writers
that commit one id at once only one counts.
"""

from __future__ import annotations

import base64
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
COUNTS = ["n_docs", "n_tokens", "n_chars"]
RECORD = "batch_id string, attempt string"
DATA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long, batch_id string, attempt string"
#: Fixed value: how the vocabulary's text is cut before its merges.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def with_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """docs' doc_id, source, lang and text with n_tokens and tokenizer (the vocabulary's file name). Each executor reads the vocabulary from its own installation."""
    name = vocabulary.rsplit("/", 1)[-1]

    def run(batches):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding(name, pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for b in batches:
            n = [len(encode(x.as_py() or "")) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], [*b.schema.names[:-1], "n_tokens"])

    d = docs.select("doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), F.md5("text").alias("text_md5"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), "text")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema if f.name != "text")
    return d.mapInArrow(run, f"{kinds}, n_tokens long").withColumn("tokenizer", F.lit(name))


def signed(counts: DataFrame, sign: int | Column) -> DataFrame:
    """Delta rows: the counts of documents with a sign, +1 for an insert and -1 for a delete."""
    s = sign if isinstance(sign, Column) else F.lit(sign)
    return counts.select(*KEYS, s.cast("long").alias("n_docs"), (s * F.col("n_tokens")).alias("n_tokens"), (s * F.col("n_chars")).alias("n_chars"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Delta rows that put new counts in the place of old ones, of the same documents."""
    return signed(old, -1).unionByName(signed(new, 1))


class Rollups:
    """The batches under a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.data, self.records = spark, f"{folder.rstrip('/')}/data", f"{folder.rstrip('/')}/commits"
        # Empty tables, so that there is something to read before the first batch.
        spark.createDataFrame([], DATA).coalesce(1).write.mode("ignore").parquet(f"{self.data}/none")
        spark.createDataFrame([], RECORD).coalesce(1).write.mode("ignore").parquet(f"{self.records}/none")

    def _records(self) -> DataFrame:
        return self.spark.read.schema(RECORD).parquet(f"{self.records}/*").groupBy("batch_id").agg(F.min("attempt").alias("attempt"))

    def committed(self, batch_id: str) -> bool:
        return not self._records().filter(F.col("batch_id") == batch_id).isEmpty()

    def add(self, batch_id: str, deltas: DataFrame) -> str:
        """Add up and write a batch without its record; returns its attempt."""
        attempt = uuid.uuid4().hex
        sums = deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS]).select("*", F.lit(batch_id).alias("batch_id"), F.lit(attempt).alias("attempt"))
        sums.coalesce(1).write.parquet(f"{self.data}/{attempt}")  # a row for each group of the batch
        return attempt

    def record(self, batch_id: str, attempt: str) -> None:
        self.spark.createDataFrame([(batch_id, attempt)], RECORD).coalesce(1).write.parquet(f"{self.records}/{attempt}")

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Add up, write and record a batch unless its id (any text) is committed already; whether this call's batch is the one that counts."""
        if self.committed(batch_id):
            return False
        attempt = self.add(batch_id, deltas)
        self.record(batch_id, attempt)
        return self._records().filter(F.col("batch_id") == batch_id).first()["attempt"] == attempt

    def totals(self) -> DataFrame:
        """The sums over all committed batches, none before the first; groups that came to nothing are left out."""
        rows = self.spark.read.schema(DATA).parquet(f"{self.data}/*").join(self._records(), ["batch_id", "attempt"], "left_semi")
        sums = rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])
        return sums.filter("n_docs != 0 or n_tokens != 0 or n_chars != 0")


def corpus_rollup(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """state, source, lang, tokenizer, n_docs, n_tokens and n_chars: totals of all documents (state ``all``) and of distinct texts (``distinct``).

    Four batches make them. All documents come in with an estimate of their tokens (a quarter of their characters, rounded up), the revision
    puts the counted tokens in its place, and the revision is sent again and counts once: that is ``all``. Then all but one row of each text
    within a group are taken out, which leaves ``distinct``. A null or empty text has no tokens; null sources and languages
    are groups of their own; repeated rows count each time in ``all``; texts of any length are taken whole; columns other than doc_id, text, source and lang
    are not read; an empty table gives no groups.
    """
    from .common import written

    counts = written(with_tokens(docs, vocabulary), "token-counts")
    state = Rollups(docs.sparkSession, folder)
    guess = counts.withColumn("n_tokens", F.ceil(F.col("n_chars") / 4).cast("long"))
    state.commit("load", signed(guess, 1))
    for _ in range(2):
        state.commit("counted", revised(guess, counts))
    everything = written(state.totals(), "token-totals")
    copies = counts.groupBy(*KEYS, "text_md5").agg(F.count("*").alias("copies"), F.first("n_tokens").alias("n_tokens"), F.first("n_chars").alias("n_chars"))
    extra = copies.filter("copies > 1").withColumn("sign", 1 - F.col("copies"))
    extra = extra.select(*KEYS, F.col("sign").alias("n_docs"), (F.col("sign") * F.col("n_tokens")).alias("n_tokens"), (F.col("sign") * F.col("n_chars")).alias("n_chars"))
    state.commit("copies", extra)
    return everything.select(F.lit("all").alias("state"), "*").unionByName(state.totals().select(F.lit("distinct").alias("state"), "*"))
