"""PageRank with a fixed number of synchronous rounds.

rank_0 = 1 for every vertex; rank_{t+1}(v) = reset + (1 - reset) * sum over
edges u -> v of rank_t(u) / outdeg(u) (parallel edges count, dangling mass is
dropped); after the last round ranks are scaled so they sum to |V|. With
``tol`` the loop also stops once no rank moves by more than ``tol``.

A vertex without in-edges has the rank ``reset`` from the first round on, so what it sends is the same in each later round:
these sums are made once (``base``), and the rounds see the vertices with in-edges and the edges between them only.

Per round: ranks over out-degrees are joined to the edges on src, contributions summed by dst
(partial aggregation first, so a hub with a third of all in-edges receives one
row per map task), and the vertices are joined back so that those that only receive ``base`` keep their rank.
The rank table is written each round.

``groups`` (``groups.signed_contacts``) stand for edges from each member of a group to the members of larger
id. Their inflow is a prefix sum over the group in order of ids, so a round's work is linear in the members,
however large a group is, and no pair is listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise.operators.groups import SortedMembers, encode_groups, shared_only, sorted_members, sums_before
from ringwise.operators.ids import decode, encode_edges, index_ids
from ringwise.operators.iterate import Rounds, materialize


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    reset: float = 0.15,
    rounds: int = 10,
    tol: float | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """(id, pagerank) for every vertex.

    The rounds join and aggregate on bigint vertex ids (``ids.index_ids``);
    edges whose ends are not vertices are ignored, and so are members that aren't.
    """
    index = index_ids(vertices.select("id"))
    members = None
    if groups is not None:
        members = sorted_members(shared_only(encode_groups(groups, index)))
    encoded = encode_edges(edges.select("src", "dst"), index)
    ranks = _pagerank(index.select(F.col("vid").alias("id")), encoded, reset, rounds, tol, members)
    return decode(ranks.withColumnRenamed("id", "vid"), index, "vid", "id").select("id", "pagerank")


def _pagerank(ids: DataFrame, edges: DataFrame, reset: float, rounds: int, tol: float | None, members: SortedMembers | None) -> DataFrame:
    e, _ = materialize(edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst"), "pr-edges")
    degrees = e.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    if members is not None:
        degrees = degrees.unionByName(sums_before(members, None, later=True).select(F.col("vid").alias("id"), F.col("s").alias("n")))
        degrees = degrees.groupBy("id").agg(F.sum("n").alias("n"))
    fed = e.select(F.col("dst").alias("id")).distinct()
    if members is not None:
        before = sums_before(members, None).groupBy(F.col("vid").alias("id")).agg(F.sum("s").alias("s"))
        fed = fed.unionByName(before.where("s > 0").select("id")).distinct()

    def received(wires: DataFrame, sent: DataFrame) -> DataFrame:
        """(id, s): what ``sent`` (vid, x) brings along the wires and within the groups."""
        inflow = wires.join(sent, wires.src == sent.vid).select(F.col("dst").alias("id"), "x")
        if members is not None:
            inflow = inflow.unionByName(sums_before(members, sent).select(F.col("vid").alias("id"), F.col("s").alias("x")))
        return inflow.groupBy("id").agg(F.sum("x").alias("s"))

    # written: a join with an aggregate on its own key can't be split where a key is hot
    share = F.when(F.col("n") > 0, F.lit(1.0) / F.col("n")).alias("share")
    start = ids.join(degrees, "id", "left").join(fed.withColumn("fed", F.lit(True)), "id", "left").select("id", share, F.coalesce("fed", F.lit(False)).alias("fed"))
    start, known = materialize(start, "pr-start", {"sources": F.count_if(~F.col("fed"))})
    sources = start.where("NOT fed").select(F.col("id").alias("vid"), F.col("share").alias("x")).where("x IS NOT NULL")
    base = received(e, sources).withColumnRenamed("s", "base")
    store = Rounds(ids.sparkSession, "pr")
    first = start.where("fed").join(base, "id", "left").select("id", F.lit(1.0).alias("rank"), "share", F.coalesce("base", F.lit(0.0)).alias("base"))
    ranks, _ = store.write(first, 0)
    e, _ = materialize(e.join(start.where("fed").select(F.col("id").alias("src")), "src", "left_semi").select("src", "dst"), "pr-inner")
    of_sources = 1.0
    for rnd in range(1, rounds + 1):
        contrib = received(e, ranks.where("share IS NOT NULL").select(F.col("id").alias("vid"), (F.col("rank") * F.col("share")).alias("x")))
        new = F.lit(reset) + F.lit(1.0 - reset) * (F.coalesce(F.col("s"), F.lit(0.0)) + F.lit(of_sources) * F.col("base"))
        nxt = ranks.join(contrib, "id", "left").select("id", new.alias("rank"), "share", "base", F.abs(new - F.col("rank")).alias("delta"))
        ranks, m = store.write(nxt, rnd, {"delta": F.max("delta")} if tol is not None else None)
        moved = max(abs(reset - of_sources) if known["sources"] else 0.0, (m.get("delta") or 0.0))
        of_sources = reset
        if tol is not None and moved <= tol:
            break
    ranks = ranks.select("id", "rank").unionByName(start.where("NOT fed").select("id", F.lit(of_sources).alias("rank")))
    # scale so ranks sum to |V|
    total = ranks.agg(F.sum("rank").alias("total"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return ranks.select("id", F.col("rank").alias("pagerank"))
    return ranks.select("id", (F.col("rank") * F.lit(float(total["n"])) / F.lit(float(total["total"]))).alias("pagerank"))
