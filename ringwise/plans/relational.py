"""Entity tables, score statistics, graph construction and hub queries.

Everything here is a projection or a single (partially pre-aggregated) group-by.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise import config as C
from ringwise.functions.exact import half_up_mean_milli, pct_one_decimal, risk_bucket
from ringwise.operators.graph import (
    build_edges_without_contacts,
    build_vertices,
    collaboration_pairs,
    contact_degrees,
    contact_pair_count,
    shared_contact_pairs,
)
from ringwise.plans import sql_base as S
from ringwise.plans.context import context
from ringwise.plans.registry import register

T = C.RiskConfig().threshold_milli


@register("gen_policyholders", S.with_base(select="SELECT * FROM policyholders"))
def gen_policyholders(spark, sf_dir):
    return context(spark, sf_dir).tables.policyholders


@register("gen_adjusters", S.with_base(select="SELECT * FROM adjusters"))
def gen_adjusters(spark, sf_dir):
    return context(spark, sf_dir).tables.adjusters


@register("gen_providers", S.with_base(select="SELECT * FROM service_providers"))
def gen_providers(spark, sf_dir):
    return context(spark, sf_dir).tables.service_providers


@register("gen_claims", S.with_base(select="SELECT * FROM claims"))
def gen_claims(spark, sf_dir):
    return context(spark, sf_dir).tables.claims


def fraud_score_stats_df(claims, threshold_milli: int):
    n = F.count(F.lit(1))
    high = F.count_if(F.col("score_milli") >= threshold_milli)
    return claims.agg(
        n.alias("total_claims"),
        (F.sum("score_milli").cast("double") / (n * 1000).cast("double")).alias("avg_fraud_score"),
        (F.min("score_milli") / F.lit(1000.0)).alias("min_fraud_score"),
        (F.max("score_milli") / F.lit(1000.0)).alias("max_fraud_score"),
        high.alias("high_fraud_count"),
        pct_one_decimal(high, n).alias("high_fraud_pct"),
        (F.sum("amount_cents").cast("double") / (n * 100).cast("double")).alias("avg_claim_amount"),
    )


@register(
    "fraud_score_stats",
    S.with_base(
        select=f"""
SELECT count(*) AS total_claims,
       CAST(sum(score_milli) AS DOUBLE) / CAST(count(*) * 1000 AS DOUBLE) AS avg_fraud_score,
       CAST(min(score_milli) AS DOUBLE) / 1000.0 AS min_fraud_score,
       CAST(max(score_milli) AS DOUBLE) / 1000.0 AS max_fraud_score,
       count(*) FILTER (WHERE score_milli >= {T}) AS high_fraud_count,
       {S.pct_one_decimal(f'count(*) FILTER (WHERE score_milli >= {T})', 'count(*)')} AS high_fraud_pct,
       CAST(sum(amount_cents) AS DOUBLE) / CAST(count(*) * 100 AS DOUBLE) AS avg_claim_amount
FROM claims""",
    ),
)
def fraud_score_stats(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return fraud_score_stats_df(ctx.tables.claims, ctx.cfg.threshold_milli)


@register(
    "score_buckets",
    S.with_base(
        select="""
SELECT CASE WHEN score_milli < 300 THEN 'Low (0.0-0.3)' WHEN score_milli < 600 THEN 'Medium (0.3-0.6)'
            ELSE 'High (0.6-1.0)' END AS fraud_score_category,
       count(*) AS count
FROM claims GROUP BY 1""",
    ),
)
def score_buckets(spark, sf_dir):
    claims = context(spark, sf_dir).tables.claims
    return (
        claims.groupBy(risk_bucket(F.col("score_milli")).alias("fraud_score_category"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("fraud_score_category")
    )


@register(
    "shared_address_share",
    S.with_base(
        select=f"""
SELECT count(*) AS policyholders,
       count(*) FILTER (WHERE starts_with(address, 'SHARED-')) AS shared_address_count,
       {S.pct_one_decimal("count(*) FILTER (WHERE starts_with(address, 'SHARED-'))", 'count(*)')} AS shared_address_pct
FROM policyholders""",
    ),
)
def shared_address_share(spark, sf_dir):
    ph = context(spark, sf_dir).tables.policyholders
    n = F.count(F.lit(1))
    shared = F.count_if(F.col("address").startswith("SHARED-"))
    return ph.agg(
        n.alias("policyholders"),
        shared.alias("shared_address_count"),
        pct_one_decimal(shared, n).alias("shared_address_pct"),
    )


@register(
    "multi_claim_policyholders",
    S.with_base(
        select="SELECT policyholder_id, count(*) AS claim_count FROM claims GROUP BY policyholder_id HAVING count(*) > 1"
    ),
)
def multi_claim_policyholders(spark, sf_dir):
    claims = context(spark, sf_dir).tables.claims
    return (
        claims.groupBy("policyholder_id")
        .agg(F.count(F.lit(1)).alias("claim_count"))
        .where(F.col("claim_count") > 1)
    )


@register(
    "top_claim_types",
    S.with_base(
        select=f"""
SELECT claim_type, count(*) AS count, {S.half_up_mean_milli('sum(score_milli)', 'count(*)')} AS avg_fraud_score
FROM claims GROUP BY claim_type ORDER BY count DESC, claim_type LIMIT 10""",
    ),
)
def top_claim_types(spark, sf_dir):
    claims = context(spark, sf_dir).tables.claims
    return (
        claims.groupBy("claim_type")
        .agg(F.count(F.lit(1)).alias("count"), F.sum("score_milli").alias("s"))
        .select("claim_type", "count", half_up_mean_milli(F.col("s"), F.col("count")).alias("avg_fraud_score"))
        .orderBy(F.desc("count"), "claim_type")
        .limit(10)
    )


@register("vertices", S.with_base(select="SELECT * EXCLUDE (score_milli) FROM vertices"))
def vertices(spark, sf_dir):
    return context(spark, sf_dir).direct_graph.vertices.drop("score_milli")


@register("vertex_type_counts", S.with_base(select="SELECT type, count(*) AS count FROM vertices GROUP BY type"))
def vertex_type_counts(spark, sf_dir):
    g = context(spark, sf_dir).direct_graph
    return g.vertices.groupBy("type").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "type")


@register("edges", S.with_base(select="SELECT * EXCLUDE (claim_count) FROM edges"))
def edges(spark, sf_dir):
    """Claims and holders are derived where they are read: two scans of a few columns cost less than writing all of them."""
    return context(spark, sf_dir).direct_graph.edges.drop("claim_count")


@register(
    "edge_relationship_counts",
    S.with_base(select="SELECT relationship, count(*) AS count FROM edges GROUP BY relationship"),
)
def edge_relationship_counts(spark, sf_dir):
    """Edges per relationship; shared contacts are counted from group sizes, without their pairs."""
    ctx = context(spark, sf_dir)
    rest = build_edges_without_contacts(ctx.stored, ctx.cfg.as_of).groupBy("relationship").agg(F.count(F.lit(1)).alias("count"))
    shared = contact_pair_count(ctx.stored.policyholders).select(F.lit(C.SHARED_CONTACT).alias("relationship"), "count")
    return rest.unionByName(shared.where("count > 0")).orderBy(F.desc("count"), "relationship")


@register("shared_contact_pairs", S.with_base(select="SELECT src, dst FROM shared_pairs"))
def shared_contact_pairs_q(spark, sf_dir):
    return shared_contact_pairs(context(spark, sf_dir).tables.policyholders)


def _collab_query(name, cte, left, right, min_claims):
    @register(name, S.with_base(select=f"SELECT src, dst, claim_count, fraud_score AS avg_fraud_score FROM {cte}"))
    def q(spark, sf_dir):
        claims = context(spark, sf_dir).tables.claims
        return collaboration_pairs(claims, left, right, min_claims).select(
            "src", "dst", "claim_count", F.col("fraud_score").alias("avg_fraud_score")
        )

    return q


_collab_query("collab_pairs_ph_adj", "pairs_ph_adj", "policyholder_id", "adjuster_id", 2)
_collab_query("collab_pairs_ph_prov", "pairs_ph_prov", "policyholder_id", "service_provider_id", 2)
_collab_query("collab_pairs_adj_prov", "pairs_adj_prov", "adjuster_id", "service_provider_id", 3)


def hub_pattern(claims, key: str, threshold_milli: int, min_claims: int = 3):
    """Entities on at least ``min_claims`` high-fraud claims: count, mean score, total amount."""
    return (
        claims.where(F.col("score_milli") >= threshold_milli)
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("high_fraud_claim_count"),
            F.sum("score_milli").alias("s"),
            F.sum("amount_cents").alias("cents"),
        )
        .where(F.col("high_fraud_claim_count") >= min_claims)
        .select(
            key,
            "high_fraud_claim_count",
            half_up_mean_milli(F.col("s"), F.col("high_fraud_claim_count")).alias("avg_fraud_score"),
            (F.col("cents").cast("double") / F.lit(100.0)).alias("total_amount"),
        )
    )


def _hub_sql(key: str) -> str:
    return S.with_base(
        select=f"""
SELECT {key}, count(*) AS high_fraud_claim_count,
       {S.half_up_mean_milli('sum(score_milli)', 'count(*)')} AS avg_fraud_score,
       CAST(sum(amount_cents) AS DOUBLE) / 100.0 AS total_amount
FROM claims WHERE score_milli >= {T} GROUP BY {key} HAVING count(*) >= 3"""
    )


@register("adjuster_hubs", _hub_sql("adjuster_id"))
def adjuster_hubs(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return hub_pattern(ctx.tables.claims, "adjuster_id", ctx.cfg.threshold_milli).orderBy(
        F.desc("high_fraud_claim_count"), "adjuster_id"
    )


@register("provider_hubs", _hub_sql("service_provider_id"))
def provider_hubs(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return hub_pattern(ctx.tables.claims, "service_provider_id", ctx.cfg.threshold_milli).orderBy(
        F.desc("high_fraud_claim_count"), "service_provider_id"
    )


def landmarks_df(claims, threshold_milli: int, n: int):
    """Top-``n`` high-fraud claims by score, ties broken by claim id (a bounded top-k)."""
    return (
        claims.where(F.col("score_milli") >= threshold_milli)
        .select("claim_id", "fraud_score", "score_milli")
        .orderBy(F.desc("score_milli"), "claim_id")
        .limit(n)
    )


@register(
    "landmarks",
    S.with_base(
        select=f"""
SELECT claim_id, fraud_score FROM claims WHERE score_milli >= {T}
ORDER BY score_milli DESC, claim_id LIMIT {C.LANDMARK_COUNT}"""
    ),
)
def landmarks(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return landmarks_df(ctx.tables.claims, ctx.cfg.threshold_milli, ctx.cfg.landmarks).select("claim_id", "fraud_score")


@register(
    "table_counts",
    S.with_base(
        select="""
SELECT 'policyholders' AS table_name, count(*) AS row_count FROM policyholders
UNION ALL SELECT 'adjusters', count(*) FROM adjusters
UNION ALL SELECT 'service_providers', count(*) FROM service_providers
UNION ALL SELECT 'claims', count(*) FROM claims"""
    ),
)
def table_counts(spark, sf_dir):
    """Row counts of the derived tables as one query (one job, not one per table)."""
    t = context(spark, sf_dir).tables
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in (
            ("policyholders", t.policyholders),
            ("adjusters", t.adjusters),
            ("service_providers", t.service_providers),
            ("claims", t.claims),
        )
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("claims_preview", S.with_base(select="SELECT * FROM claims ORDER BY claim_id LIMIT 10"))
def claims_preview(spark, sf_dir):
    """First ten claims under a total order (a preview is a top-k, not an arbitrary limit)."""
    return context(spark, sf_dir).tables.claims.orderBy("claim_id").limit(10)


@register(
    "degrees",
    S.with_base(
        select="""
SELECT v.id, v.type,
       CAST(coalesce(o.n, 0) AS BIGINT) AS out_degree,
       CAST(coalesce(i.n, 0) AS BIGINT) AS in_degree,
       CAST(coalesce(o.n, 0) + coalesce(i.n, 0) AS BIGINT) AS degree
FROM vertices v
LEFT JOIN (SELECT src AS id, count(*) AS n FROM edges GROUP BY src) o USING (id)
LEFT JOIN (SELECT dst AS id, count(*) AS n FROM edges GROUP BY dst) i USING (id)"""
    ),
)
def degrees(spark, sf_dir):
    """Out-, in- and total degree of every vertex (partial aggregation per endpoint)."""
    ctx = context(spark, sf_dir)
    edges = build_edges_without_contacts(ctx.stored, ctx.cfg.as_of)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    parts = [
        build_vertices(ctx.stored).select("id", "type", zero.alias("o"), zero.alias("i")),
        edges.select(F.col("src").alias("id"), F.lit(None).cast("string").alias("type"), one.alias("o"), zero.alias("i")),
        edges.select(F.col("dst").alias("id"), F.lit(None).cast("string").alias("type"), zero.alias("o"), one.alias("i")),
        contact_degrees(ctx.stored.policyholders).select(
            "id", F.lit(None).cast("string").alias("type"), F.col("out_degree").alias("o"), F.col("in_degree").alias("i")
        ),
    ]
    summed = reduce(DataFrame.unionByName, parts).groupBy("id").agg(
        F.max("type").alias("type"), F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree")
    )
    return summed.where(F.col("type").isNotNull()).withColumn("degree", F.col("out_degree") + F.col("in_degree"))
