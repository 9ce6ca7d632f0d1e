"""Bounded samples behind the reference's network drawings (Q40-Q46).

The reference pulled these to the driver and drew them; here they stay
DataFrames. Each sample is a top-k under a total order (the limit is the
feature), taken with ``orderBy(...).limit(k)`` so Spark keeps k rows per task
before merging, and set filters are semi-joins rather than collected id lists.
Of shared contacts, only the pairs that a sample can hold are made, from the sorted heads of the groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise import config as C
from ringwise.operators.graph import contact_members
from ringwise.operators.groups import first_pairs, pairs_inside, pairs_touching
from ringwise.operators.iterate import materialize
from ringwise.plans import centrality as CE
from ringwise.plans import rings as R
from ringwise.plans import sql_base as S
from ringwise.plans import structure as ST
from ringwise.plans.context import Context, context
from ringwise.plans.registry import register

T = C.RiskConfig().threshold_milli
EDGE_COLS = ("src", "dst", "relationship")


def touching(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with src or dst in ``ids`` (F6): two semi-joins, union, distinct."""
    by_src = edges.join(ids.select(F.col("id").alias("src")), "src", "left_semi")
    by_dst = edges.join(ids.select(F.col("id").alias("dst")), "dst", "left_semi")
    return by_src.unionByName(by_dst).distinct()


def inside(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with both endpoints in ``ids`` (F7): two chained semi-joins."""
    return edges.join(ids.select(F.col("id").alias("src")), "src", "left_semi").join(
        ids.select(F.col("id").alias("dst")), "dst", "left_semi"
    )


def endpoints(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()


def _listed(ctx: Context) -> DataFrame:
    """The edges but for shared contacts, whose pairs are made where they are wanted only."""
    return ctx.view(C.NOT_CONTACT).edges.select(*EDGE_COLS)


def _as_edges(pairs: DataFrame) -> DataFrame:
    return pairs.select("src", "dst", F.lit(C.SHARED_CONTACT).alias("relationship"))


def inside_with_contacts(ctx: Context, ids: DataFrame) -> DataFrame:
    """All edges with both ends among a few ids, which are written as they are read several times."""
    ids, _ = materialize(ids.select("id"), "sample-ids")
    return inside(_listed(ctx), ids).unionByName(_as_edges(pairs_inside(contact_members(ctx.stored.policyholders), ids)))


def high_fraud_network(ctx: Context) -> DataFrame:
    e = _listed(ctx)
    hf5 = (
        ctx.vertices.where((F.col("type") == "claim") & (F.col("score_milli") >= ctx.cfg.threshold_milli))
        .select("id")
        .orderBy("id")
        .limit(5)
    )
    shared5 = _as_edges(first_pairs(contact_members(ctx.stored.policyholders), 5))
    return touching(e, hf5).unionByName(shared5).distinct()


S40 = f"""
hf5 AS (SELECT id FROM vertices WHERE type = 'claim' AND score_milli >= {T} ORDER BY id LIMIT 5),
s40 AS (
  SELECT src, dst, relationship FROM edges WHERE src IN (SELECT id FROM hf5) OR dst IN (SELECT id FROM hf5)
  UNION
  SELECT src, dst, relationship FROM (SELECT src, dst, relationship FROM edges WHERE relationship = 'shared_contact' ORDER BY src, dst LIMIT 5)
)"""


@register("sample_high_fraud_network", S.with_base(S40, select="SELECT * FROM s40"))
def sample_high_fraud_network(spark, sf_dir):
    return high_fraud_network(context(spark, sf_dir))


@register(
    "sample_high_fraud_vertices",
    S.with_base(
        S40,
        select="""
SELECT id, type, fraud_score,
       coalesce(fraud_score, 0.0) AS display_score,
       CASE WHEN length(id) > 8 THEN substr(id, 1, 8) || '...' ELSE id END AS label
FROM vertices
WHERE id IN (SELECT src FROM s40) OR id IN (SELECT dst FROM s40)""",
    ),
)
def sample_high_fraud_vertices(spark, sf_dir):
    """Endpoints of the sample with the drawing attributes: score (NULL shown as 0) and short label."""
    ctx = context(spark, sf_dir)
    ids = endpoints(high_fraud_network(ctx))
    return ctx.vertices.join(ids, "id", "left_semi").selectExpr(
        "id",
        "type",
        "fraud_score",
        "coalesce(fraud_score, 0.0D) AS display_score",
        "CASE WHEN length(id) > 8 THEN concat(substring(id, 1, 8), '...') ELSE id END AS label",
    )


@register(
    "edge_styles",
    S.with_base(
        S40,
        select="""
SELECT 'relationship' AS kind, relationship AS value, count(*) AS count FROM s40 GROUP BY relationship
UNION ALL
SELECT 'type', type, count(*) FROM vertices WHERE id IN (SELECT src FROM s40) OR id IN (SELECT dst FROM s40) GROUP BY type""",
    ),
)
def edge_styles(spark, sf_dir):
    ctx = context(spark, sf_dir)
    sample = high_fraud_network(ctx)
    rel = sample.groupBy(F.col("relationship").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    typ = (
        ctx.vertices.join(endpoints(sample), "id", "left_semi")
        .groupBy(F.col("type").alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return rel.select(F.lit("relationship").alias("kind"), "value", "count").unionByName(
        typ.select(F.lit("type").alias("kind"), "value", "count")
    )


REL_SAMPLE = ((C.FILED_BY, 8), (C.PROCESSED_BY, 8), (C.SERVICED_BY, 8), (C.SHARED_CONTACT, 6))


@register(
    "sample_by_relationship",
    S.with_base(
        select="\nUNION ALL\n".join(
            f"SELECT * FROM (SELECT src, dst, relationship FROM edges WHERE relationship = '{r}' ORDER BY src, dst LIMIT {k})"
            for r, k in REL_SAMPLE
        )
    ),
)
def sample_by_relationship(spark, sf_dir):
    ctx = context(spark, sf_dir)
    parts = [
        _as_edges(first_pairs(contact_members(ctx.stored.policyholders), k))
        if r == C.SHARED_CONTACT
        else ctx.view([r]).edges.select(*EDGE_COLS).orderBy("src", "dst").limit(k)
        for r, k in REL_SAMPLE
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- components


def _mid3_members(ctx: Context) -> DataFrame:
    comps = R.components_df(ctx)
    stats = R.component_stats_df(comps, ctx.cfg.threshold_milli)
    mid3 = (
        stats.where(F.col("claim_count").between(3, 100) & (F.col("avg_fraud_score") >= 0.5))
        .orderBy(F.desc("avg_fraud_score"), "component")
        .limit(3)
        .select("component")
    )
    return comps.join(mid3, "component", "left_semi")


MID3 = """
mid3 AS (SELECT component FROM comp_stats WHERE claim_count BETWEEN 3 AND 100 AND avg_fraud_score >= 0.5
         ORDER BY avg_fraud_score DESC, component LIMIT 3),
mid3_members AS (SELECT * FROM comps WHERE component IN (SELECT component FROM mid3))"""


@register(
    "sample_component_members",
    R.ring_sql("SELECT id, type, fraud_score, component FROM mid3_members", extra=(MID3,)),
)
def sample_component_members(spark, sf_dir):
    return _mid3_members(context(spark, sf_dir)).select("id", "type", "fraud_score", "component")


@register(
    "sample_components",
    R.ring_sql(
        f"""
SELECT src, dst, relationship FROM edges
WHERE src IN (SELECT id FROM mid3_members) AND dst IN (SELECT id FROM mid3_members)
UNION ALL
SELECT * FROM (
  SELECT src, dst, relationship FROM edges
  WHERE (src IN (SELECT id FROM hf10) OR dst IN (SELECT id FROM hf10)) AND NOT EXISTS (SELECT 1 FROM mid3)
  ORDER BY src, dst, relationship LIMIT 40)""",
        extra=(MID3, f"\nhf10 AS (SELECT id FROM comps WHERE type = 'claim' AND score_milli >= {T} ORDER BY id LIMIT 10)"),
    ),
)
def sample_components(spark, sf_dir):
    """Inner edges of the three mid-size suspicious components; without any, the
    edges (at most 40) touching ten high-fraud claims."""
    ctx = context(spark, sf_dir)
    members, _ = materialize(_mid3_members(ctx).select("id"), "sample-members")
    # whether any component qualifies decides the branch
    if not members.isEmpty():
        return inside_with_contacts(ctx, members)
    hf10 = (
        ctx.vertices.where((F.col("type") == "claim") & (F.col("score_milli") >= ctx.cfg.threshold_milli))
        .select("id")
        .orderBy("id")
        .limit(10)
    )
    # claims share no contacts
    return touching(_listed(ctx), hf10).orderBy("src", "dst", "relationship").limit(40)


# ---------------------------------------------------------------- pagerank / communities / triangles


@register(
    "sample_pagerank",
    S.with_base(
        *CE._pr_sql(),
        "\ntop50 AS (SELECT id FROM pr ORDER BY pagerank DESC, id LIMIT 50)",
        select="""
SELECT src, dst, relationship FROM edges
WHERE src IN (SELECT id FROM top50) OR dst IN (SELECT id FROM top50)
ORDER BY src, dst, relationship LIMIT 200""",
    ),
)
def sample_pagerank(spark, sf_dir):
    ctx = context(spark, sf_dir)
    top50 = CE.pagerank_df(ctx).orderBy(F.desc("pagerank"), "id").limit(50).select("id")
    top50, _ = materialize(top50, "sample-ids")
    pairs = _as_edges(pairs_touching(contact_members(ctx.stored.policyholders), top50, 200))
    return touching(_listed(ctx), top50).unionByName(pairs).orderBy("src", "dst", "relationship").limit(200)


COMM5 = """
top_comm AS (SELECT label FROM comm_stats WHERE avg_fraud_score >= 0.6 OR fraud_concentration >= 40
             ORDER BY fraud_concentration DESC, label LIMIT 5),
comm_members AS (SELECT id FROM comm WHERE label IN (SELECT label FROM top_comm) ORDER BY id LIMIT 150)"""


@register(
    "sample_communities",
    S.with_base(
        *CE._lp_sql(),
        COMM5,
        select="""
SELECT src, dst, relationship FROM edges
WHERE src IN (SELECT id FROM comm_members) AND dst IN (SELECT id FROM comm_members)
ORDER BY src, dst, relationship LIMIT 200""",
    ),
)
def sample_communities(spark, sf_dir):
    ctx = context(spark, sf_dir)
    comms = CE.communities_df(ctx)
    top = CE.high_risk(CE.community_stats_df(comms, ctx.cfg.threshold_milli), ctx.cfg).limit(5).select("label")
    members = comms.join(top, "label", "left_semi").select("id").orderBy("id").limit(150)
    return inside_with_contacts(ctx, members).orderBy("src", "dst", "relationship").limit(200)


@register(
    "sample_triangles",
    S.with_base(
        *ST.TRI_SQL,
        "\ntri100 AS (SELECT id FROM tc WHERE count > 0 ORDER BY count DESC, id LIMIT 100)",
        select="""
SELECT src, dst, relationship FROM edges
WHERE src IN (SELECT id FROM tri100) AND dst IN (SELECT id FROM tri100)
ORDER BY src, dst, relationship LIMIT 200""",
    ),
)
def sample_triangles(spark, sf_dir):
    ctx = context(spark, sf_dir)
    top = ST.triangle_df(ctx).where(F.col("count") > 0).orderBy(F.desc("count"), "id").limit(100).select("id")
    return inside_with_contacts(ctx, top).orderBy("src", "dst", "relationship").limit(200)


@register(
    "sample_pagerank_vertices",
    S.with_base(*CE._pr_sql(), select="SELECT id, pagerank FROM pr ORDER BY pagerank DESC, id LIMIT 50"),
)
def sample_pagerank_vertices(spark, sf_dir):
    """Vertices of the PageRank drawing with their rank."""
    return CE.pagerank_df(context(spark, sf_dir)).select("id", "pagerank").orderBy(F.desc("pagerank"), "id").limit(50)


@register(
    "sample_communities_members",
    S.with_base(
        *CE._lp_sql(),
        COMM5,
        select="SELECT id, type, label FROM comm WHERE id IN (SELECT id FROM comm_members)",
    ),
)
def sample_communities_members(spark, sf_dir):
    """Members of the community drawing with their label."""
    ctx = context(spark, sf_dir)
    comms = CE.communities_df(ctx)
    top = CE.high_risk(CE.community_stats_df(comms, ctx.cfg.threshold_milli), ctx.cfg).limit(5).select("label")
    return comms.join(top, "label", "left_semi").select("id", "type", "label").orderBy("id").limit(150)


@register(
    "sample_triangles_vertices",
    S.with_base(*ST.TRI_SQL, select="SELECT id, type, count FROM tc WHERE count > 0 ORDER BY count DESC, id LIMIT 100"),
)
def sample_triangles_vertices(spark, sf_dir):
    """Vertices of the triangle drawing with their count."""
    tc = ST.triangle_df(context(spark, sf_dir))
    return tc.where(F.col("count") > 0).select("id", "type", "count").orderBy(F.desc("count"), "id").limit(100)
