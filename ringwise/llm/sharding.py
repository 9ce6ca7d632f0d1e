"""Sharding: a two-pass external shuffle.

Pass 1 scatters the records over buckets by a seeded hash; the number of buckets follows from
the bytes of the input, so that one bucket fits in a task's memory. Pass 2 puts each bucket in
hash order and permutes it with Spark's seeded ``shuffle``, a Fisher-Yates shuffle. The buckets
one after the other are a random order of all records; dealing it out in turn gives shards whose
row counts are at most one apart (law ``rows``) and slots without gaps.

Only DataFrame functions run. A record's hash takes its place in the input besides its key, so
that repeated rows and hot keys scatter as evenly as others. Places are evaluated once, as the
permuted records are written before their buckets are counted.

Defined cases: a null text has size 1 and the checksum of the empty text; a null or repeated key
scatters like any other; an empty table gives no rows; input columns named like those that the
operator adds are replaced by them, all others are kept. Columns of a map type can't be ordered
and are not supported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise.llm.common import Scratch, others

LAW = "rows"
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def shard(
    docs: DataFrame,
    n_shards: int = 16,
    key: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = 4 << 20,
    seed: int = 20_240,
) -> DataFrame:
    """The records in random order over ``n_shards`` shards: input columns and ``ADDED``."""
    scratch = Scratch(docs.sparkSession, "shard")
    body = F.coalesce(F.col(text), F.lit(""))
    size = (F.octet_length(body) + 1).cast("long")
    total = docs.agg(F.sum(size)).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    kept = others(docs, *ADDED)
    placed = docs.select(
        *kept, size.alias("size"), F.crc32(body).alias("text_crc32"), F.monotonically_increasing_id().alias("__place")
    ).withColumn("__hash", F.xxhash64(F.lit(seed), F.col(key), F.col("__place")))
    record = F.struct("__hash", "__place", *kept, "size", "text_crc32")
    buckets = (
        placed.withColumn("__bucket", F.pmod(F.col("__hash"), F.lit(n_buckets)))
        .repartition("__bucket")
        .groupBy("__bucket")
        .agg(F.sort_array(F.collect_list(record)).alias("__records"))
        .sortWithinPartitions("__bucket")
    )
    permuted = buckets.select(
        "__bucket", F.posexplode(F.shuffle("__records", seed=seed)).alias("__at", "__record")
    ).select("__bucket", "__at", *[F.col("__record")[c].alias(c) for c in (*kept, "size", "text_crc32")])
    permuted = scratch.save(permuted, "permuted")
    return _deal(permuted, n_shards, kept)


def _deal(permuted: DataFrame, n_shards: int, kept: list[str]) -> DataFrame:
    """Deals the records out in turn, bucket after bucket."""
    from pyspark.sql import Window

    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket: its count is the input's bytes over the bucket's, not its rows
    starts = (
        permuted.groupBy("__bucket").agg(F.count("*").alias("__n"))
        .select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    at = F.col("__start") + F.col("__at")
    return permuted.join(starts, "__bucket").select(
        *kept,
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        (at % n_shards).cast("int").alias("shard"),
        F.floor(at / n_shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write(shards: DataFrame, path: str) -> None:
    """One folder of Parquet files a shard, records in the order of their slots within each file."""
    shards.repartition("shard", F.floor(F.col("slot") / 1_000_000)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
