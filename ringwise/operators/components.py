"""Connected components (undirected, weak) by alternating large-star / small-star.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014).
State: edges (c, p) oriented child > parent. Each round:

* large-star: per node u, m(u) = min(u, neighbours); every child c of u is
  re-attached to m(u).
* small-star: per node c, m' = min(parents); every parent and c itself are
  attached to m'.

Both steps are group-by aggregates (partial aggregation before the shuffle, so a
hub holding a third of all edges costs one row per map task), joined
back to the edge list. A round writes twice: the edges after the large star, and those after the
small star. An aggregate that is joined on its own key would keep the partitioning of that key, and adaptive execution
could not split a hub's edges on the other side; the join therefore asks for one more column (``_apart``), so that both
sides are shuffled for it and a hot partition is read in pieces.

The large star tells how many edges it moved, the small star how many parents it joined; a round
that does neither had a star forest -- every node has at most one parent and no node is both parent and child --
and the loop stops. The component id of a vertex
is the smallest vertex id in its component; isolated vertices keep their own id.

Before the rounds, vertices with a single neighbour (*tips*) are taken off: a tip is in its neighbour's component, and may name
it. Rounds see the edges between the others only; in a graph of many entities that each hang on one other, these are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise.operators.ids import decode, encode_edges, index_ids
from ringwise.operators.iterate import NoConvergence, Rounds, materialize


def _oriented(edges: DataFrame) -> DataFrame:
    e = edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    )
    return e.select(F.greatest("a", "b").alias("c"), F.least("a", "b").alias("p")).distinct()


def _apart(edges: DataFrame, key: str, minima: DataFrame) -> DataFrame:
    """``edges`` joined with ``minima`` (u, least) on their key, both sides shuffled for the join: see the module."""
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(7))
    left, right = edges.withColumn("_apart", at(key)), minima.withColumn("_apart_u", at("u"))
    return left.join(right, (F.col(key) == F.col("u")) & (F.col("_apart") == F.col("_apart_u"))).drop("_apart", "_apart_u", "u")


def _large_star(state: DataFrame) -> DataFrame:
    """(c, m, moved): every child moves to the smallest neighbour of its parent, or the parent itself."""
    sym = state.select(F.col("p").alias("u"), F.col("c").alias("v")).unionByName(
        state.select(F.col("c").alias("u"), F.col("p").alias("v"))
    )
    minima = sym.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("least"))
    return _apart(state, "p", minima).select("c", F.col("least").alias("m"), (F.col("least") != F.col("p")).alias("moved"))


def _small_star(large: DataFrame) -> DataFrame:
    """(c, p, joined): a node's parents, and the node itself, move to the smallest parent."""
    best = large.groupBy(F.col("c").alias("u")).agg(F.min("m").alias("least"))
    others = _apart(large, "c", best).where(F.col("m") != F.col("least"))
    return (
        others.select(F.col("m").alias("c"), F.col("least").alias("p"), F.lit(True).alias("joined"))
        .unionByName(best.select(F.col("u").alias("c"), F.col("least").alias("p"), F.lit(False).alias("joined")))
        .groupBy("c", "p")
        .agg(F.max("joined").alias("joined"))
    )


def component_labels(edges: DataFrame, max_rounds: int = 200, oriented: bool = False) -> tuple[DataFrame, int]:
    """(id, component) for every vertex touched by ``edges``; also the number of rounds.

    ``oriented=True`` means ``edges`` already has columns (c, p), c > p, distinct.
    """
    spark = edges.sparkSession
    rounds, stars = (Rounds(spark, f"cc-{name}") for name in ("state", "large"))
    state, _ = rounds.write(edges if oriented else _oriented(edges), 0)
    for rnd in range(1, max_rounds + 1):
        large, m = stars.write(_large_star(state), rnd, {"moved": F.count_if(F.col("moved"))})
        state, joined = rounds.write(_small_star(large), rnd, {"joined": F.count_if(F.col("joined"))})
        if not m["moved"] and not joined["joined"]:
            return _labels(state), rnd
    raise NoConvergence(f"connected components did not converge in {max_rounds} rounds")


def _labels(state: DataFrame) -> DataFrame:
    return (
        state.select(F.col("c").alias("id"), F.col("p").alias("component"))
        .unionByName(state.select(F.col("p").alias("id"), F.col("p").alias("component")))
        .distinct()
    )


def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``vertices`` plus a ``component`` column (min vertex id of the component).

    The loop runs on order-preserving bigint ids indexed from ``vertices``
    (``ids.index_ids``); edges whose ends are not vertices are ignored. Vertices
    without edges are their own component.
    """
    index = index_ids(vertices.select("id"))
    encoded = encode_edges(edges.select("src", "dst"), index).where("src <> dst")
    encoded, _ = materialize(encoded, "cc-edges")
    inner, tips = _taken_off(encoded)
    inner = decode(_named(inner, encoded, max_rounds), index, "component", "name")
    inner, _ = materialize(inner, "cc-inner")
    ends = tips.join(inner.withColumnRenamed("id", "next"), "next", "left").select("id", "name", F.least("id", "next").alias("component"))
    ends, _ = materialize(ends, "cc-ends")
    # two tips of one edge are a component
    pairs = decode(ends.where("name IS NULL").select("id", "component"), index, "component", "name")
    named = inner.select("id", "name").unionByName(ends.where("name IS NOT NULL").select("id", "name")).unionByName(pairs)
    named = decode(named.withColumnRenamed("id", "vid"), index, "vid", "id").select("id", F.col("name").alias("component"))
    return vertices.join(named, "id", "left").withColumn("component", F.coalesce(F.col("component"), F.col("id")))


def _taken_off(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, least) of vertices with several neighbours and the least of them and itself; (id, next) of the others and their neighbour."""
    ends = edges.select(F.col("src").alias("id"), F.col("dst").alias("next")).unionByName(edges.select(F.col("dst").alias("id"), F.col("src").alias("next")))
    around, _ = materialize(ends.groupBy("id").agg(F.min("next").alias("low"), F.max("next").alias("high")), "cc-around")
    return around.where("low < high").select("id", F.least("id", "low").alias("least")), around.where("low = high").select("id", F.col("low").alias("next"))


def _named(inner: DataFrame, edges: DataFrame, max_rounds: int) -> DataFrame:
    """(id, component) of the vertices that are no tips."""
    ours = edges.join(inner.select(F.col("id").alias("src")), "src", "left_semi").join(inner.select(F.col("id").alias("dst")), "dst", "left_semi")
    labels, _ = component_labels(ours, max_rounds)
    labels = inner.join(labels, "id", "left").select("id", "least", F.coalesce("component", "id").alias("core"))
    labels, _ = materialize(labels, "cc-core")
    names, _ = materialize(labels.groupBy("core").agg(F.min("least").alias("component")), "cc-names")
    return labels.join(names, "core").select("id", "component")


def merge_components(labels: DataFrame, new_edges: DataFrame, max_rounds: int = 200) -> tuple[DataFrame, DataFrame]:
    """What new edges change in saved labels (id, component): (moved, fresh).

    ``moved`` (component, merged) names the old components that join others, ``fresh`` (id, component) the vertices
    that had no label. Each new edge is contracted to the old components of its ends, and the components of
    these few edges are found: beside one look-up of the ends in the labels, the work is that of the new
    edges alone. A component is still named by its smallest vertex, as the old names are.
    """
    e = new_edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    ends = e.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    # an inner join, so that the planner can send the few ends to the labels rather than shuffle these
    held = labels.select("id", F.col("component").alias("old")).join(ends, "id")
    known, _ = materialize(ends.join(held, "id", "left"), "merge-ends")
    place = known.select("id", F.coalesce("old", "id").alias("node"))
    contracted = e.join(place.select(F.col("id").alias("src"), F.col("node").alias("a")), "src").join(
        place.select(F.col("id").alias("dst"), F.col("node").alias("b")), "dst"
    )
    nodes = place.select(F.col("node").alias("id")).distinct()
    found = connected_components(nodes, contracted.select(F.col("a").alias("src"), F.col("b").alias("dst")), max_rounds)
    found, _ = materialize(found, "merge-found")
    moved = found.where(F.col("id") != F.col("component")).select(F.col("id").alias("component"), F.col("component").alias("merged"))
    moved = moved.join(known.where("old IS NOT NULL").select(F.col("old").alias("component")).distinct(), "component", "left_semi")
    fresh = known.where("old IS NULL").select("id").join(found, "id")
    # a new vertex may be smaller than all old ones: its component is named by it then, and the old ones move
    return moved, fresh


def apply_merge(labels: DataFrame, moved: DataFrame, fresh: DataFrame) -> DataFrame:
    """The labels after ``merge_components``: members of moved components get the new name, new vertices are added."""
    renamed = labels.join(moved, "component", "left").select("id", F.coalesce("merged", "component").alias("component"))
    return renamed.unionByName(fresh.select("id", "component"))
