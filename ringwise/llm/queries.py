"""The registered queries of this package: thin digests of the operators' results."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwise.llm import ball_tree, chat, fingerprints, hard_negatives, html_text, jaccard_join, language, mixing, oracles, packing, quality, secrets, sharding, suffix_dedup
from ringwise.llm.common import ship, table

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(build: Build) -> Build:
    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.dedup(docs, keep_text=True, words=suffix_dedup.passage_words(docs))


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).select("doc_id", *sharding.ADDED)


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chat.raw_lines(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    turns = chat.parse(lines, chat.learn(lines))
    sha = F.sha2("rendered", 256).alias("rendered_sha256")
    return turns.select(F.col("conv").alias("conv_id"), "turn", "role", "n_lines", F.char_length("body").cast("long").alias("n_chars"), "rendered", sha)


@query
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.digest(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.learn(pages), separator="\n\n")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    held = language.held_out(F.col("doc_id"))
    return language.predict(docs.select("doc_id", "text"), filters).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs).select("doc_id", *quality.BASE, "kept", "distance")


@query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


ORACLES["op11_secret_scans"] = oracles.secret_scan()


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


ORACLES["op12_hard_negatives"] = oracles.HARD_NEGATIVES


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ball_tree.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLES["op13_ranked_search"] = oracles.RANKED_SEARCH
