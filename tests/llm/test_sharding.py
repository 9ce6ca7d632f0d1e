import zlib

from ringwise.llm import sharding
from tests.llm.conftest import odd_rows


def test_law_rows_and_whole_records(odd):
    rows = sharding.shard(odd, bucket_bytes=4_000).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows))) == sorted(map(str, odd_rows()))
    by_shard = {}
    for r in rows:
        body = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 1, zlib.crc32(body), "rows", None)
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert set(by_shard) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    counts = [len(by_shard.get(s, [])) for s in range(16)]
    assert max(counts) - min(counts) <= 1


def test_order_is_random_and_a_rerun_agrees(spark):
    df = spark.range(4_000).selectExpr("id as doc_id", "cast(id as string) as text", "9 as shard")
    first = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(df, bucket_bytes=2_000).collect()}
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(df, bucket_bytes=2_000).collect()}
    assert first == again and len(first) == 4_000
    order = [slot * 16 + shard for _, (shard, slot) in sorted(first.items())]
    mean = sum(order) / len(order)
    covariance = sum((i - 1999.5) * (o - mean) for i, o in enumerate(order)) / len(order)
    assert abs(covariance) / (4_000**2 / 12) < 0.06


def test_one_hot_key_scatters(spark):
    df = spark.range(3_000).selectExpr("1L as doc_id", "'same' as text").repartition(3)
    rows = sharding.shard(df, bucket_bytes=500)
    assert rows.groupBy("shard").count().agg({"count": "max"}).first()[0] <= 188


def test_empty_and_files(none, odd, scratch_dir):
    assert sharding.shard(none).collect() == []
    sharding.write(sharding.shard(odd), f"{scratch_dir}/shards")
    assert odd.sparkSession.read.parquet(f"{scratch_dir}/shards").count() == odd.count()
