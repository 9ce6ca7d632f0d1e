"""Corpus pipeline: five stages applied to ``documents`` one after the other.

Each stage takes the Parquet files that its predecessor wrote, all of them, and all but the last
return the columns of documents. Columns of other names are left behind at the start.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwise.llm import jaccard_join, language, mixing, packing, suffix_dedup
from ringwise.llm.common import Scratch, ship, small_batches, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A language must have more than this share of a document's hits: an even share among four says nothing.
LEAST_SCORE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the language that was found as their ``lang``.

    Those without text or letters go, and those whose best language has no more than ``LEAST_SCORE`` of the hits.
    """
    ship(spark)
    small_batches(spark)
    found = language.identify(docs).where((F.col("lang_pred") != "und") & (F.col("score") > LEAST_SCORE))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id."""
    ship(spark)
    small_batches(spark)
    return jaccard_join.representatives(docs).select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of over 50 words that are found elsewhere too; a document may end up empty, and stays."""
    ship(spark)
    small_batches(spark)
    cut = suffix_dedup.without_passages(docs, n_words=51)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by target weights: a row for each copy taken."""
    return mixing.materialised(mixing.mix(docs), list(COLUMNS))


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    ship(spark)
    small_batches(spark)
    return packing.digest(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mixing_sources", mixing_sources),
    ("packing", packing_sequences),
]

#: Language ID and tokens can't be said in SQL; tests hold the run against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
