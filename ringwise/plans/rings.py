"""Fraud-ring discovery: components of a relationship view and their statistics.

Ring queries run on the ``ring`` view (filed_by + shared_contact) by default;
on the full graph shared adjusters fuse everything into one component
(``component_stats_full`` shows that). Every vertex of the graph takes part;
vertices without a view edge are their own component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise import config as C
from ringwise.functions.exact import half_up_mean_milli, pct_one_decimal
from ringwise.operators.components import connected_components
from ringwise.operators.graph import connectivity_edges
from ringwise.operators.iterate import materialize
from ringwise.plans import sql_base as S
from ringwise.plans.context import Context, context
from ringwise.plans.registry import register
from ringwise.sources.sinks import write_table

T = C.RiskConfig().threshold_milli
RING_RELS = C.VIEWS["ring"]


def components_df(ctx: Context, relationships=RING_RELS) -> DataFrame:
    v = ctx.vertices.select("id", "type", "fraud_score", "score_milli")
    return connected_components(v, connectivity_edges(ctx.stored, relationships, ctx.cfg.as_of))


def component_stats_df(comps: DataFrame, threshold_milli: int) -> DataFrame:
    is_claim = F.col("type") == "claim"
    return (
        comps.groupBy("component")
        .agg(
            F.count(F.lit(1)).alias("total_entities"),
            F.count_if(is_claim).alias("claim_count"),
            F.count_if(F.col("type") == "policyholder").alias("policyholder_count"),
            F.count_if(F.col("type") == "adjuster").alias("adjuster_count"),
            F.count_if(F.col("type") == "provider").alias("provider_count"),
            F.sum(F.when(is_claim, F.col("score_milli"))).alias("_sum"),
            F.max(F.when(is_claim, F.col("score_milli"))).alias("_max"),
            F.count_if(is_claim & (F.col("score_milli") >= threshold_milli)).alias("high_fraud_claims"),
        )
        .select(
            "component",
            "total_entities",
            "claim_count",
            "policyholder_count",
            "adjuster_count",
            "provider_count",
            half_up_mean_milli(F.col("_sum"), F.col("claim_count")).alias("avg_fraud_score"),
            (F.col("_max") / F.lit(1000.0)).alias("max_fraud_score"),
            "high_fraud_claims",
            pct_one_decimal(F.col("high_fraud_claims"), F.col("claim_count")).alias("fraud_concentration"),
        )
    )


def ring_rule(stats: DataFrame, cfg: C.RiskConfig) -> DataFrame:
    """claims >= min AND (avg >= 0.6 OR concentration >= 40), most concentrated first."""
    return stats.where(
        (F.col("claim_count") >= cfg.min_ring_claims)
        & ((F.col("avg_fraud_score") >= F.lit(cfg.ring_avg_milli / 1000.0)) | (F.col("fraud_concentration") >= cfg.ring_concentration))
    ).orderBy(F.desc("fraud_concentration"), F.desc("avg_fraud_score"), "component")


def suspected_rings_df(ctx: Context, relationships=RING_RELS) -> DataFrame:
    return ring_rule(component_stats_df(components_df(ctx, relationships), ctx.cfg.threshold_milli), ctx.cfg)


# ---------------------------------------------------------------- SQL oracle


def cc_sql(relationships=RING_RELS) -> list[str]:
    rels = ", ".join(f"'{r}'" for r in relationships)
    return [
        f"\ncc_sym AS (SELECT src AS a, dst AS b FROM edges WHERE relationship IN ({rels}) "
        f"UNION SELECT dst, src FROM edges WHERE relationship IN ({rels}))",
        """
cc(id, component) USING KEY (id) AS (
  SELECT id, id FROM vertices
  UNION
  SELECT s.b AS id, min(w.component) AS component
  FROM cc w JOIN cc_sym s ON s.a = w.id JOIN recurring.cc r ON r.id = s.b
  GROUP BY s.b, r.component
  HAVING min(w.component) < r.component
)""",
        "\ncomps AS (SELECT v.id, v.type, v.fraud_score, v.score_milli, cc.component FROM vertices v JOIN cc USING (id))",
    ]


STATS_SQL = f"""
comp_stats AS (
  SELECT component, count(*) AS total_entities,
         count(*) FILTER (WHERE type = 'claim') AS claim_count,
         count(*) FILTER (WHERE type = 'policyholder') AS policyholder_count,
         count(*) FILTER (WHERE type = 'adjuster') AS adjuster_count,
         count(*) FILTER (WHERE type = 'provider') AS provider_count,
         {S.half_up_mean_milli("sum(score_milli) FILTER (WHERE type = 'claim')", "count(*) FILTER (WHERE type = 'claim')")} AS avg_fraud_score,
         CAST(max(score_milli) FILTER (WHERE type = 'claim') AS DOUBLE) / 1000.0 AS max_fraud_score,
         count(*) FILTER (WHERE type = 'claim' AND score_milli >= {T}) AS high_fraud_claims,
         {S.pct_one_decimal(f"count(*) FILTER (WHERE type = 'claim' AND score_milli >= {T})", "count(*) FILTER (WHERE type = 'claim')")} AS fraud_concentration
  FROM comps GROUP BY component
)"""

RINGS_SQL = """
rings AS (
  SELECT * FROM comp_stats
  WHERE claim_count >= 3 AND (avg_fraud_score >= 0.6 OR fraud_concentration >= 40)
)"""

TOP_RING_SQL = """
top_ring AS (SELECT component FROM rings ORDER BY fraud_concentration DESC, avg_fraud_score DESC, component LIMIT 1)"""


def ring_sql(select: str, relationships=RING_RELS, extra=()) -> str:
    return S.with_base(*cc_sql(relationships), STATS_SQL, RINGS_SQL, TOP_RING_SQL, *extra, select=select)


# ---------------------------------------------------------------- queries


@register("components", ring_sql("SELECT id, type, component FROM comps"))
def components_q(spark, sf_dir):
    return components_df(context(spark, sf_dir)).select("id", "type", "component")


@register("component_stats", ring_sql("SELECT * FROM comp_stats"))
def component_stats_q(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return component_stats_df(components_df(ctx), ctx.cfg.threshold_milli).orderBy(F.desc("claim_count"), "component")


@register("component_stats_full", ring_sql("SELECT * FROM comp_stats", C.ALL_RELATIONSHIPS))
def component_stats_full_q(spark, sf_dir):
    ctx = context(spark, sf_dir)
    comps = components_df(ctx, C.ALL_RELATIONSHIPS)
    return component_stats_df(comps, ctx.cfg.threshold_milli).orderBy(F.desc("claim_count"), "component")


@register("suspected_rings", ring_sql("SELECT * FROM rings"))
def suspected_rings_q(spark, sf_dir):
    return suspected_rings_df(context(spark, sf_dir))


@register(
    "mid_size_components",
    ring_sql(
        """
SELECT * FROM comp_stats WHERE claim_count BETWEEN 3 AND 100 AND avg_fraud_score >= 0.5
ORDER BY avg_fraud_score DESC, component LIMIT 3"""
    ),
)
def mid_size_components_q(spark, sf_dir):
    ctx = context(spark, sf_dir)
    stats = component_stats_df(components_df(ctx), ctx.cfg.threshold_milli)
    return (
        stats.where(F.col("claim_count").between(3, 100) & (F.col("avg_fraud_score") >= 0.5))
        .orderBy(F.desc("avg_fraud_score"), "component")
        .limit(3)
    )


def top_ring_members(ctx: Context) -> DataFrame:
    """Members of the most suspicious ring: components ⋈ its one-row id (broadcast, 1 row)."""
    comps = components_df(ctx)
    stats = component_stats_df(comps, ctx.cfg.threshold_milli)
    top = ring_rule(stats, ctx.cfg).limit(1).select("component")
    return comps.join(F.broadcast(top), "component")


@register(
    "top_ring_entities",
    ring_sql("SELECT type, count(*) AS count FROM comps JOIN top_ring USING (component) GROUP BY type"),
)
def top_ring_entities_q(spark, sf_dir):
    members = top_ring_members(context(spark, sf_dir))
    return members.groupBy("type").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "type")


@register(
    "top_ring_claims",
    ring_sql(
        """
SELECT c.claim_id, c.policyholder_id, c.claim_amount, c.fraud_score, c.claim_type, c.incident_date
FROM claims c JOIN comps m ON c.claim_id = m.id JOIN top_ring t ON m.component = t.component
WHERE m.type = 'claim'"""
    ),
)
def top_ring_claims_q(spark, sf_dir):
    ctx = context(spark, sf_dir)
    ids = top_ring_members(ctx).where(F.col("type") == "claim").select(F.col("id").alias("claim_id"))
    return (
        ctx.stored.claims.join(ids, "claim_id", "left_semi")
        .select("claim_id", "policyholder_id", "claim_amount", "fraud_score", "claim_type", "incident_date")
        .orderBy(F.desc("fraud_score"), "claim_id")
    )


def _ring_policyholders(ctx: Context) -> DataFrame:
    ids = top_ring_members(ctx).where(F.col("type") == "policyholder").select(F.col("id").alias("policyholder_id"))
    return ctx.stored.policyholders.join(ids, "policyholder_id", "left_semi").select(
        "policyholder_id", "name", "address", "phone", "city", "state"
    )


RING_PH_SQL = """
ring_ph AS (
  SELECT p.policyholder_id, p.name, p.address, p.phone, p.city, p.state
  FROM policyholders p JOIN comps m ON p.policyholder_id = m.id JOIN top_ring t ON m.component = t.component
  WHERE m.type = 'policyholder'
)"""


@register("top_ring_policyholders", ring_sql("SELECT * FROM ring_ph", extra=(RING_PH_SQL,)))
def top_ring_policyholders_q(spark, sf_dir):
    return _ring_policyholders(context(spark, sf_dir)).orderBy("policyholder_id")


def save_rings(ctx: Context, path: str) -> tuple[DataFrame, DataFrame]:
    """Writes the suspected rings and which vertex is in which ring; returns both as re-read.

    Components are computed once; drill-down and the monitor read the two tables.
    """
    comps, _ = materialize(components_df(ctx), "ring-components")
    rings = ring_rule(component_stats_df(comps, ctx.cfg.threshold_milli), ctx.cfg)
    write_table(rings, path=f"{path}/rings")
    rings = ctx.spark.read.parquet(f"{path}/rings")
    write_table(comps.join(rings.select("component"), "component", "left_semi").select("id", "type", "component"), path=f"{path}/members")
    return read_rings(ctx.spark, path)


def read_rings(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(rings, members) as ``save_rings`` wrote them."""
    return spark.read.parquet(f"{path}/rings"), spark.read.parquet(f"{path}/members")


def ring_detail(members: DataFrame, claims: DataFrame, component) -> DataFrame:
    """Claims of one saved ring, most suspicious first."""
    ids = members.where((F.col("component") == component) & (F.col("type") == "claim")).select(F.col("id").alias("claim_id"))
    return claims.join(ids, "claim_id", "left_semi").orderBy(F.desc("fraud_score"), "claim_id")


@register(
    "rings_shared_contacts",
    ring_sql(
        """
SELECT m.component, k.kind, k.value, count(*) AS count
FROM comps m JOIN rings USING (component)
JOIN (SELECT policyholder_id, 'address' AS kind, address AS value FROM policyholders
      UNION ALL SELECT policyholder_id, 'phone', phone FROM policyholders) k ON k.policyholder_id = m.id
WHERE m.type = 'policyholder' AND k.value IS NOT NULL
GROUP BY m.component, k.kind, k.value HAVING count(*) > 1"""
    ),
)
def rings_shared_contacts_q(spark, sf_dir):
    """Contact values that members of one suspected ring share, over all rings."""
    ctx = context(spark, sf_dir)
    comps, _ = materialize(components_df(ctx), "ring-components")
    rings = ring_rule(component_stats_df(comps, ctx.cfg.threshold_milli), ctx.cfg).select("component")
    members = comps.where(F.col("type") == "policyholder").join(rings, "component", "left_semi")
    contacts = ctx.stored.policyholders.selectExpr(
        "policyholder_id AS id", "inline(array(struct('address' AS kind, address AS value), struct('phone' AS kind, phone AS value)))"
    ).where(F.col("value").isNotNull())
    return (
        members.select("id", "component")
        .join(contacts, "id")
        .groupBy("component", "kind", "value")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
    )


@register(
    "ring_shared_contacts",
    ring_sql(
        """
SELECT 'address' AS kind, address AS value, count(*) AS count FROM ring_ph GROUP BY address HAVING count(*) > 1
UNION ALL
SELECT 'phone', phone, count(*) FROM ring_ph GROUP BY phone HAVING count(*) > 1""",
        extra=(RING_PH_SQL,),
    ),
)
def ring_shared_contacts_q(spark, sf_dir):
    ph = _ring_policyholders(context(spark, sf_dir))
    parts = [
        ph.groupBy(F.col(k).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
        .select(F.lit(k).alias("kind"), "value", "count")
        for k in ("address", "phone")
    ]
    return parts[0].unionByName(parts[1]).orderBy("kind", F.desc("count"), "value")
