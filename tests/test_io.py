"""Sinks, namespaces, the spark.range generator and the streaming monitor."""

import os

from conftest import SF0001
from pyspark.sql import functions as F

from ringwise.plans.context import context
from ringwise.sources.generator import PRESETS, generate_tables
from ringwise.sources.sinks import drop_tables, use_namespace, write_table
from ringwise.streaming.monitor import alerts_for, monitor_new_claims, watchlist


def test_write_modes_drop_and_namespace(spark, scratch_dir):
    use_namespace(spark, "ringwise_test")
    df = spark.range(3).withColumnRenamed("id", "x")
    write_table(df, "rw_table", mode="overwrite")
    write_table(df, "rw_table", mode="append")
    assert spark.table("rw_table").count() == 6
    write_table(df, "rw_table", mode="overwrite")
    assert spark.table("rw_table").count() == 3
    write_table(df, path=os.path.join(scratch_dir, "t"), mode="overwrite")
    assert spark.read.parquet(os.path.join(scratch_dir, "t")).count() == 3
    errors = drop_tables(spark, ["rw_table", "does_not_exist"])
    assert errors == {"rw_table": None, "does_not_exist": None}
    spark.sql("USE default")


def test_generator_presets(spark):
    t = generate_tables(spark, "small")
    n_ph, n_claims, n_sp, n_adj = PRESETS["small"]
    assert t.policyholders.count() == n_ph
    assert t.claims.count() == n_claims
    assert t.service_providers.count() == n_sp
    assert t.adjusters.count() == n_adj == 50
    stats = t.claims.agg(F.min("score_milli"), F.max("score_milli")).first()
    assert 0 <= stats[0] <= stats[1] <= 1000
    usual, high, low, top = t.claims.agg(
        F.avg((F.col("claim_amount") <= 20_000).cast("int")), F.max("claim_amount"), F.min("claim_amount"), F.countDistinct("claim_amount")
    ).first()
    assert 0.82 < usual < 0.88 and 95_000 < high <= 100_000 and 1_000 <= low < 1_100 and top > 4_500
    assert t.claims.join(t.adjusters, "adjuster_id", "left_anti").count() == 0
    # the boost for high amounts fires: 200 more on average, for a fair share of the claims
    plain = t.claims.where("policyholder_id >= 'PH00000015' AND adjuster_id >= 'ADJ000005' AND service_provider_id >= 'SP000008' AND claim_type <> '1-URGENT'")
    high, n_high, usual = plain.agg(
        F.avg(F.when(F.col("claim_amount") > 50_000, F.col("score_milli"))), F.count_if(F.col("claim_amount") > 50_000),
        F.avg(F.when(F.col("claim_amount") <= 50_000, F.col("score_milli"))),
    ).first()
    assert n_high > 50 and 120 < high - usual < 260
    # claim keys point at existing entities
    assert t.claims.join(t.policyholders, "policyholder_id", "left_anti").count() == 0
    assert t.claims.join(t.service_providers, "service_provider_id", "left_anti").count() == 0


def test_stream_monitor_equals_batch_alerts(spark, scratch_dir):
    ctx = context(spark, SF0001)
    claims = ctx.tables.claims
    src = os.path.join(scratch_dir, "incoming")
    # three arriving files
    for i in range(3):
        claims.where(F.abs(F.hash("claim_id")) % 3 == i).write.mode("overwrite").parquet(os.path.join(src, f"batch={i}"))
    watch = watchlist(ctx)
    sink = os.path.join(scratch_dir, "alerts")
    q = monitor_new_claims(spark, os.path.join(src, "*"), claims.schema, watch, sink, os.path.join(scratch_dir, "ckpt"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(sink)
    batch = alerts_for(claims, watch)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_saved_rings_serve_drill_down_and_monitor(spark, scratch_dir):
    from ringwise.plans.registry import load_all
    from ringwise.plans.rings import read_rings, ring_detail, save_rings

    ctx = context(spark, SF0001)
    path = os.path.join(scratch_dir, "saved")
    save_rings(ctx, path)
    rings, members = read_rings(spark, path)
    want = load_all()["suspected_rings"].build(spark, SF0001)
    assert rings.count() == want.count() > 0 and rings.select(*want.columns).exceptAll(want).count() == 0
    first = rings.orderBy(F.desc("claim_count"), "component").first()
    assert ring_detail(members, ctx.stored.claims, first["component"]).count() == first["claim_count"]
    saved, computed = watchlist(ctx, members), watchlist(ctx)
    assert saved.count() == computed.count() and saved.exceptAll(computed).count() == 0


def test_versions_are_seen_when_finished(spark, scratch_dir):
    from ringwise.sources.versions import drop_before, read_version, versions, write_version

    path = os.path.join(scratch_dir, "versions")
    assert versions(spark, path) == [] and read_version(spark, path, "x long").count() == 0
    assert write_version(spark.range(3).toDF("x"), path) == 1 and write_version(spark.range(5).toDF("x"), path) == 2
    os.makedirs(os.path.join(path, "v=3"))  # a write that was cut off
    assert versions(spark, path) == [1, 2] and read_version(spark, path, "x long").count() == 5
    assert read_version(spark, path, "x long", 1).count() == 3
    assert write_version(spark.range(7).toDF("x"), path) == 4
    drop_before(spark, path, 4)
    assert versions(spark, path) == [4] and os.listdir(path) == ["v=4"]


def test_a_ring_saved_while_the_stream_runs_is_watched_from_the_next_batch(spark, scratch_dir):
    from ringwise.sources.versions import write_version
    from ringwise.streaming.monitor import WATCH_SCHEMA, monitor_with_versions

    claims = context(spark, SF0001).tables.claims
    one, two = [r["policyholder_id"] for r in claims.select("policyholder_id").distinct().orderBy("policyholder_id").limit(2).collect()]
    src, watch, sink = (os.path.join(scratch_dir, d) for d in ("claims", "watch", "alerts"))
    ours = claims.where(F.col("policyholder_id").isin(one, two)).coalesce(1)
    listed = lambda *ids: spark.createDataFrame([(i, "ring", i) for i in ids], WATCH_SCHEMA)
    write_version(listed(one), watch)
    ours.write.parquet(os.path.join(src, "part=1"))
    checkpoint = os.path.join(scratch_dir, "ckpt")
    q = monitor_with_versions(spark, os.path.join(src, "*"), claims.schema, watch, sink, checkpoint, available_now=False)
    try:
        q.processAllAvailable()
        assert {r["entity_id"] for r in spark.read.parquet(sink).collect()} == {one}
        write_version(listed(one, two), watch)  # the stream goes on running
        ours.write.parquet(os.path.join(src, "part=2"))
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.read.parquet(sink).groupBy("version").agg(F.collect_set("entity_id").alias("ids")).collect()
    assert {r["version"]: set(r["ids"]) for r in rows} == {1: {one}, 2: {one, two}}
    n = {i: claims.where(F.col("policyholder_id") == i).count() for i in (one, two)}
    assert spark.read.parquet(sink).count() == 2 * n[one] + n[two]
