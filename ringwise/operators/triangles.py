"""Triangle count per vertex (edge direction ignored, loops and duplicates dropped).

Vertices are numbered by (degree, id), and each undirected edge runs from the lower number to the
higher one. Every vertex then has at most sqrt(2m) out-neighbours, so the wedge join (two
out-edges of the same vertex) is O(m^1.5) even when a hub holds a third of all edges: the
hub's edges point *into* it and it spawns no wedges. Each wedge (u -> v, u -> w) is closed by a
semi-join on the same edges, as v < w.

``groups`` (``groups.signed_contacts``) stand for edges between all members of a group: a cover by cliques,
which is counted as it is. With the groups of two kinds and of both together, and s their signs:

* triangles of three members share one value, as three pairs that share values of two kinds can't do otherwise; a member of
  a group of n lies in C(n - 1, 2) of them, summed over its groups by sign;
* a vertex outside with k neighbours in a group closes C(k, 2) triangles there, each of those neighbours k - 1;
* what is left are triangles of the listed edges.

So nothing grows faster than the members and the edges at them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise.operators.groups import encode_groups, shared_only
from ringwise.operators.ids import decode, encode_edges
from ringwise.operators.iterate import materialize


def undirected_simple(edges: DataFrame) -> DataFrame:
    return (
        edges.select("src", "dst")
        .where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
        .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .distinct()
    )


def _by_degree(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, vid): numbers in order of (degree, id). Parallel edges count, which changes the order only."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    known = vertices.select("id").where(F.col("id").isNotNull()).distinct().join(ends, "id", "left")
    ordered = known.orderBy(F.coalesce(F.col("n"), F.lit(0)), "id").select("id", F.monotonically_increasing_id().alias("vid"))
    return materialize(ordered, "tri-index")[0]


def _closed(und: DataFrame) -> DataFrame:
    """(u, v, w), u < v < w, of every triangle of the numbered edges (a, b), a < b."""
    one, other, closing = und.alias("one"), und.alias("other"), und.alias("closing")
    wedges = one.join(other, (F.col("one.a") == F.col("other.a")) & (F.col("one.b") < F.col("other.b"))).select(
        F.col("one.a").alias("u"), F.col("one.b").alias("v"), F.col("other.b").alias("w")
    )
    return wedges.join(closing, (F.col("v") == F.col("closing.a")) & (F.col("w") == F.col("closing.b")), "left_semi")


def triangles(edges: DataFrame) -> DataFrame:
    """One row (x, y, z) per triangle of the listed edges, x < y < z."""
    ends = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id")))
    index = _by_degree(ends, edges)
    und, _ = materialize(undirected_simple(encode_edges(edges.select("src", "dst"), index)), "tri-edges")
    named = _closed(und)
    for n, c in enumerate("uvw"):
        named = decode(named, index, c, f"_{n}")
    corners = F.array_sort(F.array("_0", "_1", "_2"))
    return named.select(corners[0].alias("x"), corners[1].alias("y"), corners[2].alias("z"))


def _in_groups(members: DataFrame) -> DataFrame:
    """(vid, n): signed numbers of triangles of three members."""
    return members.select("vid", (F.col("sign") * F.expr("(size - 1) * (size - 2) div 2")).alias("n"))


def _with_one_outside(members: DataFrame, und: DataFrame) -> DataFrame:
    """(vid, n): signed numbers of triangles of two members and a vertex without groups, for all three.

    An edge between two members is an error: it could be one that the groups imply already.
    """
    ids, _ = materialize(members.select("vid").distinct(), "tri-members")
    a, b = ids.select(F.col("vid").alias("a"), F.lit(1).alias("at_a")), ids.select(F.col("vid").alias("b"), F.lit(1).alias("at_b"))
    marked = und.join(a, "a", "left").join(b, "b", "left").where("at_a IS NOT NULL OR at_b IS NOT NULL")
    ends = marked.select(
        F.when(F.col("at_a").isNotNull(), F.col("a")).otherwise(F.col("b")).alias("vid"),
        F.when(F.col("at_a").isNotNull(), F.col("b")).otherwise(F.col("a")).alias("x"),
        (F.col("at_a").isNotNull() & F.col("at_b").isNotNull()).alias("inside"),
    )
    ends, m = materialize(ends, "tri-ends", {"inside": F.count_if("inside")})
    if m["inside"]:
        raise ValueError(f"{m['inside']} listed edges run between members of groups")
    several, _ = materialize(ends.groupBy("x").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("x"), "tri-outside")
    met, _ = materialize(ends.join(several, "x", "left_semi").join(members, "vid").select("x", "value", "sign", "vid"), "tri-met")
    counted, _ = materialize(met.groupBy("x", "value", "sign").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "tri-counted")
    outside = counted.select(F.col("x").alias("vid"), (F.col("sign") * F.expr("k * (k - 1) div 2")).alias("n"))
    inside = met.drop("sign").join(counted, ["x", "value"]).select("vid", (F.col("sign") * (F.col("k") - 1)).alias("n"))
    return outside.unionByName(inside)


def triangle_count(vertices: DataFrame, edges: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """``vertices`` plus ``count``: number of triangles through each vertex (0 if none).

    Runs on bigint vertex numbers: the wedge join is the heaviest step and
    shuffles three longs per wedge instead of three strings.
    """
    index = _by_degree(vertices, edges)
    und, _ = materialize(undirected_simple(encode_edges(edges.select("src", "dst"), index)), "tri-edges")
    found = _closed(und).select(F.explode(F.array("u", "v", "w")).alias("vid"), F.lit(1).cast("long").alias("n"))
    if groups is not None:
        members, _ = materialize(shared_only(encode_groups(groups, index)), "tri-groups")
        found = found.unionByName(_in_groups(members)).unionByName(_with_one_outside(members, und))
    per_vertex = found.groupBy("vid").agg(F.sum("n").alias("count"))
    named = decode(per_vertex, index, "vid", "id")
    return vertices.join(named, "id", "left").withColumn("count", F.coalesce(F.col("count"), F.lit(0).cast("long")))
