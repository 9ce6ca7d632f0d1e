"""Influence and communities: PageRank (Q22-Q23) and label propagation (Q24-Q25)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise import config as C
from ringwise.functions.exact import half_up_mean_milli, pct_one_decimal
from ringwise.operators.groups import signed_contacts
from ringwise.operators.labels import label_propagation
from ringwise.operators.pagerank import pagerank
from ringwise.plans import rings as R
from ringwise.plans import sql_base as S
from ringwise.plans.context import Context, context
from ringwise.plans.registry import register

T = C.RiskConfig().threshold_milli


def pagerank_df(ctx: Context) -> DataFrame:
    """PageRank of the whole graph; shared contacts go in as groups."""
    g = ctx.view(C.NOT_CONTACT)
    groups = signed_contacts(ctx.stored.policyholders)
    pr = pagerank(g.vertices, g.edges, ctx.cfg.pagerank_reset, ctx.cfg.pagerank_rounds, groups=groups)
    return g.vertices.select("id", "type", "fraud_score").join(pr, "id").withColumn(
        "pagerank", F.round("pagerank", 4)
    )


def _pr_sql(rounds: int = C.PAGERANK_ROUNDS, reset: float = C.PAGERANK_RESET) -> list[str]:
    ctes = [
        "\npr_w AS MATERIALIZED (SELECT src, dst, 1.0 / CAST(count(*) OVER (PARTITION BY src) AS DOUBLE) AS w FROM edges)",
        "\npr0 AS MATERIALIZED (SELECT id, CAST(1.0 AS DOUBLE) AS rank FROM vertices)",
    ]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""
pr{i} AS MATERIALIZED (
  SELECT v.id, {reset} + {1 - reset} * coalesce(s.s, 0.0) AS rank
  FROM pr{i - 1} v LEFT JOIN (
    SELECT w.dst AS id, sum(p.rank * w.w) AS s FROM pr_w w JOIN pr{i - 1} p ON p.id = w.src GROUP BY w.dst
  ) s USING (id)
)"""
        )
    ctes.append(
        f"""
pr AS (
  SELECT v.id, v.type, v.fraud_score,
         round(p.rank * (SELECT CAST(count(*) AS DOUBLE) FROM pr{rounds}) / (SELECT sum(rank) FROM pr{rounds}), 4) AS pagerank
  FROM pr{rounds} p JOIN vertices v USING (id)
)"""
    )
    return ctes


@register("pagerank_top", S.with_base(*_pr_sql(), select="SELECT * FROM pr ORDER BY pagerank DESC, id LIMIT 20"))
def pagerank_top(spark, sf_dir):
    return pagerank_df(context(spark, sf_dir)).orderBy(F.desc("pagerank"), "id").limit(20)


@register(
    "ring_leaders",
    S.with_base(
        *R.cc_sql(),
        R.STATS_SQL,
        R.RINGS_SQL,
        *_pr_sql(),
        select="""
SELECT p.id, p.type, p.fraud_score, p.pagerank, c.component
FROM pr p JOIN comps c USING (id) JOIN rings r ON r.component = c.component
WHERE p.type IN ('claim', 'policyholder')
ORDER BY p.pagerank DESC, p.id LIMIT 20""",
    ),
)
def ring_leaders(spark, sf_dir):
    ctx = context(spark, sf_dir)
    comps = R.components_df(ctx)
    rings = R.ring_rule(R.component_stats_df(comps, ctx.cfg.threshold_milli), ctx.cfg).select("component")
    pr = pagerank_df(ctx).where(F.col("type").isin("claim", "policyholder"))
    # suspected rings: one row per ring, far fewer than vertices; the planner decides on broadcast
    return (
        pr.join(comps.select("id", "component"), "id")
        .join(rings, "component", "left_semi")
        .select("id", "type", "fraud_score", "pagerank", "component")
        .orderBy(F.desc("pagerank"), "id")
        .limit(20)
    )


# ---------------------------------------------------------------- communities


def communities_df(ctx: Context, view: str = "full") -> DataFrame:
    """Communities of a named view of the graph; shared contacts go in as groups."""
    wanted = set(C.VIEWS[view])
    g = ctx.view(sorted(wanted - {C.SHARED_CONTACT}))
    groups = signed_contacts(ctx.stored.policyholders) if C.SHARED_CONTACT in wanted else None
    lp = label_propagation(g.vertices, g.edges, ctx.cfg.label_rounds, groups)
    return g.vertices.select("id", "type", "fraud_score", "score_milli").join(lp, "id")


def community_stats_df(comms: DataFrame, threshold_milli: int) -> DataFrame:
    is_claim = F.col("type") == "claim"
    return (
        comms.groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.count_if(is_claim).alias("claim_count"),
            F.count_if(F.col("type") == "policyholder").alias("policyholder_count"),
            F.sum(F.when(is_claim, F.col("score_milli"))).alias("_sum"),
            F.count_if(is_claim & (F.col("score_milli") >= threshold_milli)).alias("high_fraud_claims"),
        )
        .where(F.col("claim_count") >= 2)
        .select(
            "label",
            "size",
            "claim_count",
            "policyholder_count",
            half_up_mean_milli(F.col("_sum"), F.col("claim_count")).alias("avg_fraud_score"),
            "high_fraud_claims",
            pct_one_decimal(F.col("high_fraud_claims"), F.col("claim_count")).alias("fraud_concentration"),
        )
    )


def _lp_sql(relationships=None, rounds: int = C.LABEL_ROUNDS) -> list[str]:
    where = ""
    if relationships:
        where = " WHERE relationship IN (" + ", ".join(f"'{r}'" for r in relationships) + ")"
    ctes = [
        f"\nlp_msg AS MATERIALIZED (SELECT src AS u, dst AS v FROM edges{where} UNION ALL SELECT dst, src FROM edges{where})",
        "\nlp0 AS MATERIALIZED (SELECT id, id AS label FROM vertices)",
    ]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""
lp{i} AS MATERIALIZED (
  SELECT l.id, coalesce(w.label, l.label) AS label
  FROM lp{i - 1} l LEFT JOIN (
    SELECT v, label FROM (
      SELECT m.v, p.label, row_number() OVER (PARTITION BY m.v ORDER BY count(*) DESC, p.label) AS rn
      FROM lp_msg m JOIN lp{i - 1} p ON p.id = m.u GROUP BY m.v, p.label
    ) WHERE rn = 1
  ) w ON w.v = l.id
)"""
        )
    ctes.append(
        f"\ncomm AS (SELECT v.id, v.type, v.fraud_score, v.score_milli, l.label FROM vertices v JOIN lp{rounds} l USING (id))"
    )
    ctes.append(
        f"""
comm_stats AS (
  SELECT label, count(*) AS size,
         count(*) FILTER (WHERE type = 'claim') AS claim_count,
         count(*) FILTER (WHERE type = 'policyholder') AS policyholder_count,
         {S.half_up_mean_milli("sum(score_milli) FILTER (WHERE type = 'claim')", "count(*) FILTER (WHERE type = 'claim')")} AS avg_fraud_score,
         count(*) FILTER (WHERE type = 'claim' AND score_milli >= {T}) AS high_fraud_claims,
         {S.pct_one_decimal(f"count(*) FILTER (WHERE type = 'claim' AND score_milli >= {T})", "count(*) FILTER (WHERE type = 'claim')")} AS fraud_concentration
  FROM comm GROUP BY label HAVING count(*) FILTER (WHERE type = 'claim') >= 2
)"""
    )
    return ctes


@register("communities", S.with_base(*_lp_sql(), select="SELECT id, type, label FROM comm"))
def communities(spark, sf_dir):
    return communities_df(context(spark, sf_dir)).select("id", "type", "label")


@register("community_stats", S.with_base(*_lp_sql(), select="SELECT * FROM comm_stats"))
def community_stats(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return community_stats_df(communities_df(ctx), ctx.cfg.threshold_milli).orderBy(F.desc("avg_fraud_score"), "label")


@register(
    "community_stats_ring",
    S.with_base(*_lp_sql(C.VIEWS["ring"]), select="SELECT * FROM comm_stats"),
)
def community_stats_ring(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return community_stats_df(communities_df(ctx, "ring"), ctx.cfg.threshold_milli).orderBy(
        F.desc("avg_fraud_score"), "label"
    )


def high_risk(stats: DataFrame, cfg: C.RiskConfig) -> DataFrame:
    return stats.where(
        (F.col("avg_fraud_score") >= F.lit(cfg.ring_avg_milli / 1000.0)) | (F.col("fraud_concentration") >= cfg.ring_concentration)
    ).orderBy(F.desc("fraud_concentration"), "label")


@register(
    "high_risk_communities",
    S.with_base(*_lp_sql(), select="SELECT * FROM comm_stats WHERE avg_fraud_score >= 0.6 OR fraud_concentration >= 40"),
)
def high_risk_communities(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return high_risk(community_stats_df(communities_df(ctx), ctx.cfg.threshold_milli), ctx.cfg)


@register(
    "high_risk_communities_ring",
    S.with_base(
        *_lp_sql(C.VIEWS["ring"]),
        select="SELECT * FROM comm_stats WHERE avg_fraud_score >= 0.6 OR fraud_concentration >= 40",
    ),
)
def high_risk_communities_ring(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return high_risk(community_stats_df(communities_df(ctx, "ring"), ctx.cfg.threshold_milli), ctx.cfg)
