"""Monitor new claims against the discovered rings and hubs (X1).

``watchlist`` is a static table: (entity_id, reason, ring) for policyholders in
suspected rings and for adjuster / provider hubs. ``alerts_for`` fans each claim
out to its three entities (one ``inline``) and inner-joins the watchlist -- the
same transformation serves a batch table and a stream (stream-static join,
append mode, no state, so no watermark is needed).

``monitor_new_claims`` keeps the watch list that it started with. ``monitor_with_versions`` reads the newest
version of a saved one (``sources.versions``) for each micro-batch, so a ring that is saved while the stream
runs is watched from the next batch on. Each batch's alerts are a folder named by the batch, overwritten when
a batch is run again after a failure, so alerts come once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ringwise.plans.context import Context
from ringwise.operators.iterate import materialize
from ringwise.plans.relational import hub_pattern
from ringwise.plans.rings import components_df, component_stats_df, ring_rule
from ringwise.sources.versions import read_version, versions

WATCH_SCHEMA = "entity_id string, reason string, ring string"


def watchlist(ctx: Context, members: DataFrame | None = None) -> DataFrame:
    """Watched entities, written once: a stream reads them in every micro-batch.

    ``members`` are saved ring members (``rings.read_rings``); without them the
    rings are computed.
    """
    if members is None:
        comps, _ = materialize(components_df(ctx), "watch-components")
        rings = ring_rule(component_stats_df(comps, ctx.cfg.threshold_milli), ctx.cfg).select("component")
        members = comps.join(rings, "component", "left_semi")
    ring_ph = members.where(F.col("type") == "policyholder").select(
        F.col("id").alias("entity_id"), F.lit("ring").alias("reason"), F.col("component").alias("ring")
    )
    claims = ctx.stored.claims
    adj = hub_pattern(claims, "adjuster_id", ctx.cfg.threshold_milli).select(
        F.col("adjuster_id").alias("entity_id"), F.lit("adjuster_hub").alias("reason"), F.lit(None).cast("string").alias("ring")
    )
    prov = hub_pattern(claims, "service_provider_id", ctx.cfg.threshold_milli).select(
        F.col("service_provider_id").alias("entity_id"), F.lit("provider_hub").alias("reason"), F.lit(None).cast("string").alias("ring")
    )
    return materialize(ring_ph.unionByName(adj).unionByName(prov), "watch-list")[0]


def alerts_for(claims: DataFrame, watch: DataFrame) -> DataFrame:
    """(claim_id, fraud_score, role, entity_id, reason, ring) for claims touching a watched entity."""
    fanned = claims.selectExpr(
        "claim_id",
        "fraud_score",
        """inline(array(
              struct('policyholder' AS role, policyholder_id AS entity_id),
              struct('adjuster' AS role, adjuster_id AS entity_id),
              struct('provider' AS role, service_provider_id AS entity_id)))""",
    )
    return fanned.join(watch, "entity_id").select("claim_id", "fraud_score", "role", "entity_id", "reason", "ring")


def monitor_new_claims(
    spark: SparkSession,
    source_dir: str,
    schema,
    watch: DataFrame,
    sink_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Stream parquet claim files from ``source_dir``; append alerts as parquet at ``sink_path``."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = (
        alerts_for(stream, watch)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def monitor_with_versions(
    spark: SparkSession,
    source_dir: str,
    schema,
    watch_path: str,
    sink_path: str,
    checkpoint: str,
    available_now: bool = True,
    files_a_batch: int | None = None,
) -> StreamingQuery:
    """Like ``monitor_new_claims``, with the watch list of ``watch_path`` as it is when a batch begins.

    Alerts carry the ``version`` of the list. Which version a batch took is settled by its first alert files: a batch that is run
    again reads the newest list anew and replaces what the failed run left.
    """

    def alert(claims: DataFrame, batch: int) -> None:
        newest = next(reversed(versions(claims.sparkSession, watch_path)), None)
        watch = read_version(claims.sparkSession, watch_path, WATCH_SCHEMA, newest)
        found = alerts_for(claims, watch).withColumn("version", F.lit(newest).cast("int"))
        found.write.mode("overwrite").parquet(f"{sink_path}/batch={batch}")

    stream = spark.readStream.schema(schema)
    if files_a_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_a_batch)
    writer = stream.parquet(source_dir).writeStream.foreachBatch(alert).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
