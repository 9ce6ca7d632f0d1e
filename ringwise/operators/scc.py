"""Strongly connected components by shrinking and by colours, in rounds that follow the logarithm of paths.

Each phase over the still-active subgraph:

1. It is shrunk until nothing changes. Vertices without an edge in or without one out are components of
   their own and go. Runs of vertices with one edge in and one out are put together to one edge from what lies before the run to
   what lies after it, by pointer jumping: each step doubles how far a vertex sees. A run that closes on itself is
   a component. The vertices of other runs are answered at the end: they are in the component of both ends of their run if
   that is one component, and alone otherwise.
2. colour(v) = smallest id that reaches v. Besides the colours of its predecessors a vertex looks at the colour of its
   own colour, which reaches it too, so that colours travel in jumps that grow.
3. Edges between two colours are in no component and go. In each colour, the vertices that its smallest id reaches back from
   (the same search against the edges) are a component, which leaves the active set.

Runs are put back in reverse order of their contraction, and a component is named by its smallest vertex in the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise.operators.iterate import NoConvergence, Rounds, materialize

def _counted() -> dict:
    return {"n": F.count(F.lit(1))}


def _least_reaching(ids: DataFrame, edges: DataFrame, label: str, max_rounds: int) -> DataFrame:
    """(id, least): the smallest id from which the edges lead to it, itself included."""
    slots = Rounds(ids.sparkSession, label)
    state, _ = slots.write(ids.select("id", F.col("id").alias("least")), 0)
    for rnd in range(1, max_rounds + 1):
        sent = edges.join(state.select(F.col("id").alias("src"), "least"), "src").select(F.col("dst").alias("id"), "least")
        jumped = state.select("id", F.col("least").alias("at")).join(state.select(F.col("id").alias("at"), "least"), "at").select("id", "least")
        best = sent.unionByName(jumped).groupBy("id").agg(F.min("least").alias("new"))
        # everyone jumps, so none is missing
        nxt = state.join(best, "id").select("id", F.least("least", "new").alias("least"), (F.col("new") < F.col("least")).alias("moved"))
        state, m = slots.write(nxt, rnd, {"moved": F.count_if(F.col("moved"))})
        state = state.drop("moved")
        if not m["moved"]:
            return state
    raise NoConvergence(f"{label} did not converge")


def _without(df: DataFrame, gone: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.join(gone.select(F.col("id").alias(c)), c, "left_anti")
    return df


def _trim(active: DataFrame, live: DataFrame, label: str) -> tuple[DataFrame, int]:
    """(id, scc) of the vertices without an edge in or without one out."""
    both = live.select(F.col("src").alias("id")).distinct().join(live.select(F.col("dst").alias("id")).distinct(), "id")
    gone, m = materialize(active.join(both, "id", "left_anti").select("id", F.col("id").alias("scc")), f"{label}-trim", _counted())
    return gone, m["n"]


def _runs(live: DataFrame, label: str, max_rounds: int):
    """Pointer jumping over the vertices of one edge in and one out.

    Returns (cycles (id, scc), inside (id, last), ends (last, head, tail), number of vertices): ``last`` is the last
    vertex of a run, which names it.
    """
    into = live.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("i"))
    out = live.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("o"), F.max("dst").alias("to"))
    inner, m = materialize(into.where("i = 1").join(out.where("o = 1"), "id").select("id", "to"), f"{label}-inner", _counted())
    if not m["n"]:
        return None, None, None, 0
    slots = Rounds(live.sparkSession, f"{label}-jump")
    # last: the farthest vertex of the run seen so far, to: what follows it, low: the smallest id on the way
    marked = inner.join(inner.select(F.col("id").alias("to"), F.lit(True).alias("on")), "to", "left")
    state = marked.select("id", F.col("id").alias("last"), "to", F.col("id").alias("low"), F.coalesce("on", F.lit(False)).alias("on"))
    state, c = slots.write(state, 0, {"on": F.count_if("on")})
    seen, rnd, before = 1, 0, None
    while c["on"] and seen < 2 * m["n"]:
        rnd, seen, before = rnd + 1, 2 * seen, c["on"]
        ahead = state.select(F.col("id").alias("to"), F.col("last").alias("last2"), F.col("to").alias("to2"), F.col("low").alias("low2"), F.col("on").alias("on2"))
        step = state.where("on").join(ahead, "to").select("id", F.col("last2").alias("last"), F.col("to2").alias("to"), F.least("low", "low2").alias("low"), F.col("on2").alias("on"))
        state, c = slots.write(step.unionByName(state.where("NOT on")), rnd, {"on": F.count_if("on")})
        if rnd > max_rounds:
            raise NoConvergence("runs did not settle")
    # who still sees a run ahead after as many steps as there are vertices goes round
    cycles, _ = materialize(state.where("on").select("id", F.col("low").alias("scc")), f"{label}-cycles")
    inside, _ = materialize(state.where("NOT on").select("id", "last", F.col("to").alias("tail")), f"{label}-inside")
    before_run = live.join(inside.select(F.col("id").alias("dst"), "last", "tail"), "dst")
    heads = before_run.join(inner.select(F.col("id").alias("src")), "src", "left_anti").select("last", F.col("src").alias("head"), "tail")
    ends, _ = materialize(heads, f"{label}-ends")
    return cycles, inside.select("id", "last"), ends, m["n"]


def strongly_connected_components(vertices: DataFrame, edges: DataFrame, max_phases: int = 1000, max_rounds: int = 10000) -> DataFrame:
    """(id, scc) for every vertex of ``vertices``."""
    spark = vertices.sparkSession
    actives, lives, results = (Rounds(spark, name) for name in ("scc-active", "scc-live", "scc-found"))
    active, a = actives.write(vertices.select("id").distinct(), 0, _counted())
    live, _ = lives.write(edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct(), 0)
    found, _ = results.write(active.select("id", F.col("id").alias("scc")).limit(0), 0)
    put_back: list[tuple[DataFrame, DataFrame]] = []
    n = 0

    def settle(more: DataFrame, gone: DataFrame, edges_left: DataFrame) -> None:
        """Adds to the result, and goes on without the vertices that are gone."""
        nonlocal n, found, active, live, a
        n += 1
        found, _ = results.write(found.unionByName(more), n)
        active, a = actives.write(_without(active, gone, "id"), n, _counted())
        live, _ = lives.write(edges_left, n)

    for phase in range(max_phases):
        for shrink in range(max_rounds):
            label = f"scc-{phase}-{shrink}"
            trimmed, n_trimmed = _trim(active, live, label)
            if n_trimmed:
                settle(trimmed, trimmed, _without(live, trimmed, "src", "dst"))
            cycles, inside, ends, n_inside = _runs(live, label, max_rounds) if a["n"] else (None, None, None, 0)
            if n_inside:
                put_back.append((inside, ends))
                gone = cycles.select("id").unionByName(inside.select("id"))
                joined = ends.where("head <> tail").select(F.col("head").alias("src"), F.col("tail").alias("dst"))
                settle(cycles, gone, _without(live, gone, "src", "dst").unionByName(joined).distinct())
            if not n_trimmed and not n_inside:
                break
        if not a["n"]:
            break
        colour = _least_reaching(active, live, f"scc-{phase}-colour", max_rounds)
        of = lambda end, name: colour.select(F.col("id").alias(end), F.col("least").alias(name))
        inner = live.join(of("src", "cs"), "src").join(of("dst", "cd"), "dst").where("cs = cd")
        inner, _ = materialize(inner.select("src", "dst"), f"scc-{phase}-inner")
        back = _least_reaching(active, inner.select(F.col("dst").alias("src"), F.col("src").alias("dst")), f"scc-{phase}-back", max_rounds)
        # a vertex that leads to its colour's smallest id, which leads to it
        members = colour.join(back.withColumnRenamed("least", "to"), "id").where("least = to").select("id", F.col("least").alias("scc"))
        members, _ = materialize(members, f"scc-{phase}-members")
        settle(members, members, _without(inner, members, "src", "dst"))
        if not a["n"]:
            break
    else:
        raise NoConvergence("scc did not finish")
    for inside, ends in reversed(put_back):
        at = lambda end: found.select(F.col("id").alias(end), F.col("scc").alias(f"scc_{end}"))
        closed = ends.join(at("head"), "head").join(at("tail"), "tail").where("scc_head = scc_tail").select("last", F.col("scc_head").alias("whole"))
        n += 1
        run = inside.join(closed, "last", "left").select("id", F.coalesce("whole", "id").alias("scc"))
        found, _ = results.write(found.unionByName(run), n)
    least, _ = materialize(found.groupBy("scc").agg(F.min("id").alias("name")), "scc-names")
    return found.join(least, "scc").select("id", F.col("name").alias("scc"))
