"""Run summary (Q36) and the numbered top rings (Q37)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ringwise import config as C
from ringwise.functions.exact import half_up_ratio, pct_one_decimal
from ringwise.plans import rings as R
from ringwise.plans import sql_base as S
from ringwise.plans import structure as ST
from ringwise.plans.context import context
from ringwise.plans.registry import register

T = C.RiskConfig().threshold_milli


@register(
    "run_summary",
    S.with_base(
        *R.cc_sql(),
        R.STATS_SQL,
        R.RINGS_SQL,
        ST.MOTIF_HF,
        ST.MOTIF2_SQL,
        select=f"""
SELECT 'total_claims' AS metric, CAST(count(*) AS DOUBLE) AS value FROM claims
UNION ALL SELECT 'high_fraud_claims', CAST(count(*) FILTER (WHERE score_milli >= {T}) AS DOUBLE) FROM claims
UNION ALL SELECT 'high_fraud_pct', {S.pct_one_decimal(f'count(*) FILTER (WHERE score_milli >= {T})', 'count(*)')} FROM claims
UNION ALL SELECT 'fraud_rings', CAST(count(*) AS DOUBLE) FROM rings
UNION ALL SELECT 'claims_in_rings', CAST(coalesce(sum(claim_count), 0) AS DOUBLE) FROM rings
UNION ALL SELECT 'policyholders_in_rings', CAST(coalesce(sum(policyholder_count), 0) AS DOUBLE) FROM rings
UNION ALL SELECT 'avg_ring_fraud_score', {S.half_up_mean_milli('sum(CAST(round(avg_fraud_score * 1000) AS BIGINT))', 'count(*)')} FROM rings
UNION ALL SELECT 'avg_ring_concentration',
  CASE WHEN count(*) > 0 THEN CAST((2 * sum(CAST(round(fraud_concentration * 10) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 10.0 END FROM rings
UNION ALL SELECT 'repeat_claimant_policyholders', CAST(count(*) AS DOUBLE) FROM (
  SELECT policyholder_id FROM hf GROUP BY policyholder_id HAVING count(*) >= 2)
UNION ALL SELECT 'connected_claim_pairs', CAST(count(*) AS DOUBLE) FROM m2
UNION ALL SELECT 'adjuster_hubs', CAST(count(*) AS DOUBLE) FROM (
  SELECT adjuster_id FROM claims WHERE score_milli >= {T} GROUP BY adjuster_id HAVING count(*) >= 3)
UNION ALL SELECT 'provider_hubs', CAST(count(*) AS DOUBLE) FROM (
  SELECT service_provider_id FROM claims WHERE score_milli >= {T} GROUP BY service_provider_id HAVING count(*) >= 3)""",
    ),
)
def run_summary(spark, sf_dir):
    """One (metric, value) row per headline figure, from three aggregates: claims, rings, connected pairs."""
    ctx = context(spark, sf_dir)
    claims = ctx.stored.claims
    t = ctx.cfg.threshold_milli
    n = F.count(F.lit(1))
    # claims once: fanned out to who holds, processes and serves them, counted per entity, then per kind of entity
    fanned = claims.selectExpr(
        f"score_milli >= {t} AS high",
        "inline(array(struct('p' AS kind, policyholder_id AS id), struct('a' AS kind, adjuster_id AS id), struct('s' AS kind, service_provider_id AS id)))",
    )
    per = fanned.groupBy("kind", "id").agg(n.alias("n"), F.count_if("high").alias("h"))
    kind = lambda k: F.col("kind") == k
    all_claims, high = F.sum(F.when(kind("p"), F.col("n"))), F.sum(F.when(kind("p"), F.col("h")))
    of_claims = per.agg(
        F.coalesce(all_claims, F.lit(0)).cast("double").alias("total_claims"),
        F.coalesce(high, F.lit(0)).cast("double").alias("high_fraud_claims"),
        F.coalesce(pct_one_decimal(high, all_claims), F.lit(0.0)).alias("high_fraud_pct"),
        F.count_if(kind("p") & (F.col("h") >= 2)).cast("double").alias("repeat_claimant_policyholders"),
        F.count_if(kind("a") & (F.col("h") >= 3)).cast("double").alias("adjuster_hubs"),
        F.count_if(kind("s") & (F.col("h") >= 3)).cast("double").alias("provider_hubs"),
    )
    avg_k = F.round(F.col("avg_fraud_score") * 1000).cast("long")
    conc_k = F.round(F.col("fraud_concentration") * 10).cast("long")
    of_rings = R.suspected_rings_df(ctx).agg(
        n.cast("double").alias("fraud_rings"),
        F.coalesce(F.sum("claim_count"), F.lit(0)).cast("double").alias("claims_in_rings"),
        F.coalesce(F.sum("policyholder_count"), F.lit(0)).cast("double").alias("policyholders_in_rings"),
        (half_up_ratio(F.sum(avg_k), n, 1) / 1000.0).alias("avg_ring_fraud_score"),
        (half_up_ratio(F.sum(conc_k), n, 1) / 10.0).alias("avg_ring_concentration"),
    )
    of_pairs = ST.connected_pairs_total(ctx).select(F.col("claim_pairs").cast("double").alias("connected_claim_pairs"))
    parts = []
    for df in (of_claims, of_rings, of_pairs):
        pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in df.columns]
        parts.append(df.select(F.inline(F.array(*pairs))))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "top_rings",
    R.ring_sql(
        """
SELECT row_number() OVER (ORDER BY fraud_concentration DESC, avg_fraud_score DESC, component) AS rank,
       component, claim_count, policyholder_count, avg_fraud_score, fraud_concentration
FROM (SELECT * FROM rings ORDER BY fraud_concentration DESC, avg_fraud_score DESC, component LIMIT 3)"""
    ),
)
def top_rings(spark, sf_dir):
    top3 = R.suspected_rings_df(context(spark, sf_dir)).limit(3)
    # the window runs after the limit: three rows in one task
    w = Window.orderBy(F.desc("fraud_concentration"), F.desc("avg_fraud_score"), "component")
    return top3.select(
        F.row_number().over(w).cast("long").alias("rank"),
        "component",
        "claim_count",
        "policyholder_count",
        "avg_fraud_score",
        "fraud_concentration",
    )


ALERT_SQL = f"""
watch AS (
  SELECT c.id AS entity_id, 'ring' AS reason, c.component AS ring FROM comps c
  WHERE c.type = 'policyholder' AND c.component IN (SELECT component FROM rings)
  UNION ALL
  SELECT adjuster_id, 'adjuster_hub', NULL FROM claims WHERE score_milli >= {T} GROUP BY adjuster_id HAVING count(*) >= 3
  UNION ALL
  SELECT service_provider_id, 'provider_hub', NULL FROM claims WHERE score_milli >= {T} GROUP BY service_provider_id HAVING count(*) >= 3
),
fanned AS (
  SELECT claim_id, fraud_score, 'policyholder' AS role, policyholder_id AS entity_id FROM claims
  UNION ALL SELECT claim_id, fraud_score, 'adjuster', adjuster_id FROM claims
  UNION ALL SELECT claim_id, fraud_score, 'provider', service_provider_id FROM claims
)"""


@register(
    "claim_alerts",
    R.ring_sql(
        "SELECT f.claim_id, f.fraud_score, f.role, f.entity_id, w.reason, w.ring FROM fanned f JOIN watch w USING (entity_id)",
        extra=(ALERT_SQL,),
    ),
)
def claim_alerts(spark, sf_dir):
    """Batch form of the stream monitor: every claim touching a watched entity."""
    from ringwise.streaming.monitor import alerts_for, watchlist

    ctx = context(spark, sf_dir)
    return alerts_for(ctx.stored.claims, watchlist(ctx))
