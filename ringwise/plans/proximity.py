"""Proximity to known high-fraud claims (Q33-Q35, Q38) and circular patterns (Q39)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise import config as C
from ringwise.operators.graph import contact_members
from ringwise.operators.paths import bfs, bfs_levels, shortest_paths
from ringwise.operators.scc import strongly_connected_components
from ringwise.plans import sql_base as S
from ringwise.plans.context import Context, context
from ringwise.plans.registry import register
from ringwise.plans.relational import landmarks_df
from ringwise.sources.tables import read_table

T = C.RiskConfig().threshold_milli
LM_SQL = f"""
lm AS (SELECT claim_id FROM claims WHERE score_milli >= {T} ORDER BY score_milli DESC, claim_id LIMIT {C.LANDMARK_COUNT})"""


def _landmark_ids(ctx: Context) -> DataFrame:
    return landmarks_df(ctx.stored.claims, ctx.cfg.threshold_milli, ctx.cfg.landmarks).select(F.col("claim_id").alias("id"))


def distances_df(ctx: Context, direction: str) -> DataFrame:
    """Distances walk contact groups by their values, in either direction or in both."""
    g = ctx.view(C.NOT_CONTACT)
    return shortest_paths(g.edges, _landmark_ids(ctx), direction, vertices=g.vertices, groups=contact_members(ctx.stored.policyholders))


def _adj_sql(name: str, direction: str, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    if direction == "out":
        body = f"SELECT DISTINCT dst AS a, src AS b FROM edges{w}"
    elif direction == "in":
        body = f"SELECT DISTINCT src AS a, dst AS b FROM edges{w}"
    else:
        body = f"SELECT src AS a, dst AS b FROM edges{w} UNION SELECT dst, src FROM edges{w}"
    return f"\n{name} AS MATERIALIZED ({body})"


def _sp_sql(direction: str) -> list[str]:
    return [
        LM_SQL,
        _adj_sql("sp_adj", direction),
        """
sp(id, landmark, distance) USING KEY (id, landmark) AS (
  SELECT claim_id, claim_id, 0 FROM lm
  UNION
  SELECT s.b, w.landmark, min(w.distance) + 1
  FROM sp w JOIN sp_adj s ON s.a = w.id
  LEFT JOIN recurring.sp r ON r.id = s.b AND r.landmark = w.landmark
  WHERE r.id IS NULL
  GROUP BY s.b, w.landmark
)""",
    ]


CLOSE_SELECT = """
SELECT v.id, v.type, v.fraud_score, count(*) AS num_connections, min(sp.distance) AS min_distance
FROM sp JOIN vertices v USING (id)
GROUP BY v.id, v.type, v.fraud_score
HAVING count(*) >= 2 AND min(sp.distance) <= 3"""


def close_to_fraud_df(ctx: Context, direction: str) -> DataFrame:
    d = distances_df(ctx, direction)
    per = d.groupBy("id").agg(F.count(F.lit(1)).alias("num_connections"), F.min("distance").alias("min_distance"))
    return (
        ctx.vertices.select("id", "type", "fraud_score")
        .join(per.where((F.col("num_connections") >= 2) & (F.col("min_distance") <= 3)), "id")
        .orderBy(F.desc("num_connections"), "min_distance", "id")
    )


@register("shortest_paths", S.with_base(*_sp_sql("both"), select="SELECT id, landmark, distance FROM sp"))
def shortest_paths_q(spark, sf_dir):
    return distances_df(context(spark, sf_dir), "both")


@register("shortest_paths_directed", S.with_base(*_sp_sql("out"), select="SELECT id, landmark, distance FROM sp"))
def shortest_paths_directed_q(spark, sf_dir):
    return distances_df(context(spark, sf_dir), "out")


@register("close_to_fraud", S.with_base(*_sp_sql("both"), select=CLOSE_SELECT))
def close_to_fraud_q(spark, sf_dir):
    return close_to_fraud_df(context(spark, sf_dir), "both")


@register("close_to_fraud_directed", S.with_base(*_sp_sql("out"), select=CLOSE_SELECT))
def close_to_fraud_directed_q(spark, sf_dir):
    return close_to_fraud_df(context(spark, sf_dir), "out")


# ---------------------------------------------------------------- BFS

# the first landmark: highest score, then lowest id
TOP1_SQL = f"""
src1 AS (SELECT claim_id AS id FROM claims WHERE score_milli >= {T} ORDER BY score_milli DESC, claim_id LIMIT 1)"""


def _top_claim(ctx: Context) -> DataFrame:
    return landmarks_df(ctx.stored.claims, ctx.cfg.threshold_milli, 1).select(F.col("claim_id").alias("id"))


@register(
    "bfs_from_claim",
    S.with_base(
        TOP1_SQL,
        _adj_sql("bfs_adj", "both"),
        """
lv(id, depth) USING KEY (id) AS (
  SELECT id, 0 FROM src1
  UNION
  SELECT s.b, min(w.depth) + 1 FROM lv w JOIN bfs_adj s ON s.a = w.id
  LEFT JOIN recurring.lv r ON r.id = s.b WHERE r.id IS NULL GROUP BY s.b
)""",
        select="SELECT v.id, v.type, lv.depth FROM lv JOIN vertices v USING (id)",
    ),
)
def bfs_from_claim(spark, sf_dir):
    """Everything that the top high-fraud claim reaches (edges in either direction), with its hops."""
    ctx = context(spark, sf_dir)
    g = ctx.view(C.NOT_CONTACT)
    levels = bfs_levels(g.edges, _top_claim(ctx), "both", vertices=g.vertices, groups=contact_members(ctx.stored.policyholders))
    return g.vertices.select("id", "type").join(levels, "id").orderBy("depth", "id")


@register(
    "bfs_paths",
    S.with_base(
        TOP1_SQL,
        _adj_sql("bfs_adj", "both", "relationship IN ('filed_by', 'shared_contact')"),
        f"\ntgt AS (SELECT claim_id AS id FROM claims WHERE score_milli >= {T} AND claim_id <> (SELECT id FROM src1))",
        """
lv(id, depth) USING KEY (id) AS (
  SELECT id, 0 FROM src1
  UNION
  SELECT s.b, min(w.depth) + 1 FROM lv w JOIN bfs_adj s ON s.a = w.id
  LEFT JOIN recurring.lv r ON r.id = s.b WHERE r.id IS NULL GROUP BY s.b
)""",
        "\nhit AS (SELECT min(depth) AS d FROM lv JOIN tgt USING (id) WHERE depth <= 10)",
        """
bp(head, to_id, path, depth) AS (
  SELECT l.id, l.id, l.id, l.depth FROM lv l JOIN tgt USING (id) WHERE l.depth = (SELECT d FROM hit)
  UNION ALL
  SELECT s.a, bp.to_id, s.a || '>' || bp.path, bp.depth - 1
  FROM bp JOIN bfs_adj s ON s.b = bp.head JOIN lv p ON p.id = s.a AND p.depth = bp.depth - 1
  WHERE bp.depth > 0
)""",
        select="SELECT head AS from_id, to_id, (SELECT d FROM hit) AS length, path FROM bp WHERE depth = 0",
    ),
)
def bfs_paths(spark, sf_dir):
    """All shortest filed_by/shared_contact paths from the top claim to other high-fraud claims."""
    ctx = context(spark, sf_dir)
    top = _top_claim(ctx)
    tgt = ctx.stored.claims.where(F.col("score_milli") >= ctx.cfg.threshold_milli).select(F.col("claim_id").alias("id"))
    g = ctx.view([C.FILED_BY])
    # from/to sets as semi-joins against one-row and claim-sized frames, no driver round trip
    froms = g.vertices.join(top, "id", "left_semi").withColumn("_from", F.lit(True))
    marked = (
        g.vertices.join(froms.select("id", "_from"), "id", "left")
        .join(tgt.withColumn("_to", F.lit(True)), "id", "left")
        .select("id", F.coalesce("_from", F.lit(False)).alias("_from"), F.coalesce("_to", F.lit(False)).alias("_to"))
    )
    return bfs(
        marked,
        g.edges,
        from_expr=F.col("_from"),
        to_expr=F.col("_to") & ~F.col("_from"),
        max_path_length=ctx.cfg.max_path_length,
        direction="both",
        groups=contact_members(ctx.stored.policyholders),
    ).drop("steps")


# ---------------------------------------------------------------- SCC


def event_graph(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Cyclic user graph from all events: user -> (user * 7 + event_id) mod users."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id")
    users = ev.agg(F.max("user_id")).first()[0]
    if users is None:
        empty = ev.select(F.col("user_id").alias("src"), F.col("user_id").alias("dst")).limit(0)
        return empty.select(F.col("src").alias("id")), empty
    n = users + 1
    e = (
        ev.select(F.col("user_id").alias("src"), ((F.col("user_id") * 7 + F.col("event_id")) % F.lit(n)).alias("dst"))
        .where(F.col("src") != F.col("dst"))
        .distinct()
    )
    v = e.select(F.col("src").alias("id")).unionByName(e.select(F.col("dst").alias("id"))).distinct()
    return v, e


SCC_SQL = [
    """
f2 AS MATERIALIZED (
  SELECT DISTINCT user_id AS src, (user_id * 7 + event_id) % (SELECT max(user_id) + 1 FROM events) AS dst
  FROM events WHERE user_id <> (user_id * 7 + event_id) % (SELECT max(user_id) + 1 FROM events)
)""",
    "\nf2v AS (SELECT src AS id FROM f2 UNION SELECT dst FROM f2)",
    "\nreach(a, b) AS (SELECT src, dst FROM f2 UNION SELECT r.a, e.dst FROM reach r JOIN f2 e ON e.src = r.b)",
    "\nmutual AS (SELECT r.a, r.b FROM reach r JOIN reach q ON q.a = r.b AND q.b = r.a)",
    "\nscc AS (SELECT v.id, least(v.id, coalesce(min(m.b), v.id)) AS scc FROM f2v v LEFT JOIN mutual m ON m.a = v.id GROUP BY v.id)",
]


@register("scc_cycles", S.with_base(*SCC_SQL, select="SELECT id, scc FROM scc"))
def scc_cycles(spark, sf_dir):
    v, e = event_graph(spark, sf_dir)
    return strongly_connected_components(v, e)


@register(
    "scc_sizes",
    S.with_base(*SCC_SQL, select="SELECT scc, count(*) AS size FROM scc GROUP BY scc HAVING count(*) > 1"),
)
def scc_sizes(spark, sf_dir):
    v, e = event_graph(spark, sf_dir)
    return (
        strongly_connected_components(v, e)
        .groupBy("scc")
        .agg(F.count(F.lit(1)).alias("size"))
        .where(F.col("size") > 1)
        .orderBy(F.desc("size"), "scc")
    )
