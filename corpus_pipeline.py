"""From documents to packed training sequences, in five stages.

``STAGES`` lists them in order; each works on all that the one before kept,
which is written as Parquet and read again in between, so a lost executor or
a failed stage never costs the stages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import exact_dedup, mixing, packing, simhash, toxicity
from orderflow.llm.common import stored
from orderflow.llm.queries import MAX_BITS, SHINGLE_WORDS, table, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Characters of words that a packing worker remembers here, where the
#: executors are full of other stages' memory.
MEMO_CHARS = 1_000_000
#: The stages' work (scores, fingerprints, draws) has no SQL form.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more."""
    labels = toxicity.learn_rows(table(spark, sf_dir, "labels"))
    return toxicity.rejected(spark, docs, labels).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, one."""
    return exact_dedup.drop_exact_copies(docs).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one."""
    return simhash.keep_one_per_group(docs, words=SHINGLE_WORDS, max_bits=MAX_BITS).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as far, as the mix takes them; a document
    of which a part is taken has that part's n_chars."""
    mixed = mixing.take_mix(docs.withColumn("__chars", F.length("text")))
    chars = F.when(F.length("text") == F.col("__chars"), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    return mixed.withColumn("n_chars", chars).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, a row per piece."""
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"), memo_chars=MEMO_CHARS)
    return pieces.select(F.col("id").alias("doc_id"), "row", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash", drop_near_copies), ("mixing", mix_sources),
          ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
