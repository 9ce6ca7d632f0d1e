"""Frontier searches: hop distances to landmarks and breadth-first search.

Both expand one level per round. The frontier has a row a vertex, with a bit for each landmark that reached it: all
landmarks walk together. What a level's edges lead to is grouped with the levels before it, and the bits that are new to a
vertex are written as the next level, in one step.

``direction``: "out" follows edges (distance from v *to* a landmark, as the
reference library defines it), "in" goes against them, "both" ignores them.

Groups (id, value) stand for edges between all ids of a value, the smaller one first, and no pair is listed. A level
goes to its values, summed up there, and on to their members: ignoring direction, a value has the bits of all its
members in the level; following it, a member is reached by a bit if the greatest (or least) id of the level with that bit
lies beyond its own. A value's members lie at most a hop apart, so it is walked in two levels at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwise.operators.ids import decode, encode_edges, index_ids
from ringwise.operators.iterate import materialize

#: Landmarks that walk together, one bit of a long each.
BITS = 62


def adjacency(edges: DataFrame, direction: str, dedupe: bool = True) -> DataFrame:
    """(frm, nb): one step of the search starts at ``frm`` and reaches ``nb``.

    ``dedupe=False`` keeps parallel edges: harmless (and a shuffle cheaper) when
    every level is de-duplicated after the join, as distances are.
    """
    e = edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    fwd = e.select(F.col("src").alias("frm"), F.col("dst").alias("nb"))
    rev = e.select(F.col("dst").alias("frm"), F.col("src").alias("nb"))
    if direction == "out":  # walk backwards from the landmark
        adj = rev
    elif direction == "in":
        adj = fwd
    elif direction == "both":
        adj = fwd.unionByName(rev)
    else:
        raise ValueError(f"direction must be out, in or both, not {direction!r}")
    return adj.distinct() if dedupe else adj


def encode_members(groups: DataFrame, index: DataFrame) -> DataFrame:
    """(id, value) with ids replaced by their vids."""
    return groups.join(index, "id").select(F.col("vid").alias("id"), "value")


def _through_groups(level: DataFrame, members: DataFrame, direction: str, n_bits: int) -> DataFrame:
    """(id, bits) of who shares a value with the level (id, bits), on the side that the direction asks for."""
    at = level.join(members, "id")
    if direction == "both":
        walked = at.groupBy("value").agg(F.bit_or("bits").alias("bits"))
        return walked.join(members, "value").select("id", "bits")
    # against the edges the smaller ids of a group are reached, along them the larger ones
    utmost, beyond = (F.max, lambda i, m: i < m) if direction == "out" else (F.min, lambda i, m: i > m)
    has = [F.col("bits").bitwiseAND(F.lit(1 << b).cast("long")) != 0 for b in range(n_bits)]
    walked = at.groupBy("value").agg(*[utmost(F.when(has[b], F.col("id"))).alias(f"m{b}") for b in range(n_bits)])
    bits = [F.when(beyond(F.col("id"), F.col(f"m{b}")), F.lit(1 << b).cast("long")).otherwise(F.lit(0).cast("long")) for b in range(n_bits)]
    reached = bits[0]
    for more in bits[1:]:
        reached = reached.bitwiseOR(more)
    return walked.join(members, "value").select("id", reached.alias("bits")).where("bits <> 0")


def _levels(adj: DataFrame, start: DataFrame, members: DataFrame | None, direction: str, n_bits: int, max_depth: int | None, label: str) -> DataFrame:
    """(id, bits, distance): the bits that reach a vertex first at that distance from the start (id, bits)."""
    level, _ = materialize(start.groupBy("id").agg(F.bit_or("bits").alias("bits")), f"{label}-0")
    walked = level.withColumn("distance", F.lit(0))
    depth = 0
    while max_depth is None or depth < max_depth:
        depth += 1
        step = level.join(adj, level.id == adj.frm).select(adj.nb.alias("id"), "bits")
        if members is not None:
            step = step.unionByName(_through_groups(level, members, direction, n_bits))
        none = F.lit(0).cast("long")
        both = step.select("id", "bits", none.alias("old")).unionByName(walked.select("id", none.alias("bits"), F.col("bits").alias("old")))
        merged = both.groupBy("id").agg(F.bit_or("bits").alias("new"), F.bit_or("old").alias("old"))
        fresh = merged.select("id", F.col("new").bitwiseAND(F.bitwise_not("old")).alias("bits")).where("bits <> 0")
        level, m = materialize(fresh, f"{label}-{depth}", {"rows": F.count(F.lit(1))})
        if not m["rows"]:
            break
        walked = walked.unionByName(level.withColumn("distance", F.lit(depth)))
    return walked


def _prepared(edges: DataFrame, direction: str, groups: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    adj, _ = materialize(adjacency(edges, direction, dedupe=False), "sp-adj")
    return adj, None if groups is None else materialize(groups, "sp-members")[0]


def shortest_paths(
    edges: DataFrame,
    landmarks: DataFrame,
    direction: str = "out",
    max_depth: int | None = None,
    vertices: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """(id, landmark, distance) for every vertex that can reach a landmark.

    ``landmarks`` has an ``id`` column; they are few, as the result has a row for each of them and each vertex. ``BITS`` of
    them advance together. With ``vertices`` the levels are
    computed on bigint vertex ids (narrower join and distinct keys) and decoded
    at the end; edges whose ends are not vertices are then ignored.

    ``groups`` (id, value) stands for edges from each id of a value to its larger ones, see the module.
    """
    marks, index = landmarks.select("id", F.col("id").alias("name")), None
    if vertices is not None:
        index = index_ids(vertices.select("id"))
        marks = landmarks.select("id").join(index, "id").select(F.col("vid").alias("id"), F.col("id").alias("name"))
        groups = None if groups is None else encode_members(groups, index)
        edges = encode_edges(edges.select("src", "dst"), index)
    adj, members = _prepared(edges, direction, groups)
    # a row a landmark
    numbered = marks.distinct().withColumn("nth", F.row_number().over(Window.orderBy("id")) - 1)
    numbered, m = materialize(numbered, "sp-landmarks", {"n": F.count(F.lit(1))})
    found = None
    for at in range(0, max(m["n"], 1), BITS):
        n_bits = max(1, min(BITS, m["n"] - at))
        ours = numbered.where((F.col("nth") >= at) & (F.col("nth") < at + BITS)).withColumn("bit", F.expr(f"shiftleft(1L, nth - {at})"))
        walked = _levels(adj, ours.select("id", F.col("bit").alias("bits")), members, direction, n_bits, max_depth, f"sp-{at}")
        if index is not None:
            # before there is a row a landmark, whose few names would be a join's few keys
            walked = decode(walked, index, "id", "_id").withColumnRenamed("_id", "id")
        # a row a bit; at most BITS landmarks to join
        nth = F.expr(f"explode(filter(sequence({at}, {at + n_bits - 1}), n -> shiftright(bits, n - {at}) & 1 = 1))")
        named = F.broadcast(ours.select("nth", F.col("name").alias("landmark")))
        each = walked.select("id", "distance", nth.alias("nth")).join(named, "nth").select("id", "landmark", "distance")
        found = each if found is None else found.unionByName(each)
    return found


def as_maps(distances: DataFrame) -> DataFrame:
    """(id, distances): one map landmark -> distance a vertex, of rows (id, landmark, distance) with few landmarks."""
    entry = F.struct("landmark", "distance")
    return distances.groupBy("id").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("distances"))


def bfs_levels(
    edges: DataFrame,
    sources: DataFrame,
    direction: str = "in",
    max_depth: int | None = None,
    vertices: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """(id, depth): hop count from the nearest source (``direction`` "in" follows edges); all sources walk as one."""
    if vertices is not None:
        index = index_ids(vertices.select("id"))
        enc_sources = sources.select("id").join(index, "id").select(F.col("vid").alias("id"))
        enc_groups = None if groups is None else encode_members(groups, index)
        found = bfs_levels(encode_edges(edges.select("src", "dst"), index), enc_sources, direction, max_depth, groups=enc_groups)
        return decode(found, index, "id", "_id").select(F.col("_id").alias("id"), "depth")
    adj, members = _prepared(edges, direction, groups)
    start = sources.select("id", F.lit(1).cast("long").alias("bits"))
    return _levels(adj, start, members, direction, 1, max_depth, "bfs").select("id", F.col("distance").alias("depth"))


def bfs(
    vertices: DataFrame,
    edges: DataFrame,
    from_expr: Column | str,
    to_expr: Column | str,
    edge_filter: Column | str | None = None,
    max_path_length: int = 10,
    direction: str = "in",
    groups: DataFrame | None = None,
) -> DataFrame:
    """All shortest paths from a ``from`` vertex to a ``to`` vertex.

    Expands levels from the ``from`` set (default: along edge direction) until
    a level contains a ``to`` vertex, then walks the level graph back from the
    hits. Levels are bigint vertex ids and say which of them are hits. Returns
    (from_id, to_id, length, path) with ``path`` the ids joined by '>' (length 0
    when a vertex matches both expressions), and ``steps``, an array with one
    struct (position, id) a vertex. Empty when nothing is reached within
    ``max_path_length``. ``groups`` as in ``shortest_paths``.
    """

    def cond(x):
        return F.expr(x) if isinstance(x, str) else x

    if groups is not None and direction != "both":
        raise ValueError("groups are undirected: use direction both")
    spark = vertices.sparkSession
    index = index_ids(vertices.select("id"))
    ends = vertices.select("id", cond(from_expr).alias("is_from"), cond(to_expr).alias("is_to")).where("is_from or is_to")
    ends, _ = materialize(ends.join(index, "id").select(F.col("vid").alias("id"), "is_from", "is_to"), "bfs-ends")
    targets = ends.where("is_to").select("id", F.lit(True).alias("hit")).distinct()
    if edge_filter is not None:
        edges = edges.where(cond(edge_filter))
    adj, _ = materialize(adjacency(encode_edges(edges.select("src", "dst"), index), direction), "bfs-adj")
    members = None if groups is None else materialize(encode_members(groups, index), "bfs-members")[0]
    metrics = {"rows": F.count(F.lit(1)), "hits": F.count_if(F.col("hit"))}

    def written(ids: DataFrame, depth: int):
        marked = ids.join(targets, "id", "left").select("id", F.coalesce("hit", F.lit(False)).alias("hit"))
        return materialize(marked, f"bfs-{depth}", metrics)

    level, m = written(ends.where("is_from").select("id").distinct(), 0)
    levels, visited, depth = [level], level, 0
    while not m["hits"] and m["rows"] and depth < max_path_length:
        depth += 1
        step = level.join(adj, level.id == adj.frm).select(adj.nb.alias("id"))
        if members is not None:
            ones = level.select("id", F.lit(1).cast("long").alias("bits"))
            step = step.unionByName(_through_groups(ones, members, direction, 1).select("id"))
        level, m = written(step.distinct().join(visited.select("id"), "id", "left_anti"), depth)
        levels.append(level)
        visited = visited.unionByName(level)
    if not m["hits"]:
        return spark.createDataFrame(
            [], "from_id string, to_id string, length int, path string, steps array<struct<position: int, id: string>>"
        )
    # walk back: columns v<d> .. v<depth>, extended to v<d-1>
    paths = level.where("hit").select(F.col("id").alias(f"v{depth}"))
    for d in range(depth, 0, -1):
        prev = levels[d - 1].select("id")
        heads = paths.select(F.col(f"v{d}").alias("c")).distinct()
        step = adj.join(prev, adj.frm == prev.id, "left_semi").join(heads, F.col("nb") == F.col("c")).select(F.col("frm").alias("p"), "c")
        if members is not None:
            ours = prev.join(members, "id").select(F.col("id").alias("p"), "value")
            theirs = heads.join(members, heads.c == members.id).select("c", "value")
            step = step.unionByName(ours.join(theirs, "value").select("p", "c")).distinct()
        paths = paths.join(step, F.col(f"v{d}") == F.col("c")).drop("c").withColumnRenamed("p", f"v{d - 1}")
        paths, _ = materialize(paths, f"bfs-back-{d}")
    for d in range(depth + 1):
        paths = decode(paths, index, f"v{d}", f"s{d}")
    names = [F.col(f"s{d}") for d in range(depth + 1)]
    steps = F.array(*[F.struct(F.lit(d).alias("position"), n.alias("id")) for d, n in enumerate(names)])
    return paths.select(
        F.col("s0").alias("from_id"),
        F.col(f"s{depth}").alias("to_id"),
        F.lit(depth).alias("length"),
        F.concat_ws(">", *names).alias("path"),
        steps.alias("steps"),
    )


def bfs_structs(vertices: DataFrame, edges: DataFrame, paths: DataFrame, length: int) -> DataFrame:
    """Paths of one length as columns from, e0, v1, e1, .. , to: one struct of vertex or edge attributes each.

    An edge struct is any edge between the two vertices, whichever way it runs;
    parallel edges give a row each.
    """
    out = paths.where(F.col("length") == length).select(*[F.col("steps")[d]["id"].alias(f"_{d}") for d in range(length + 1)])
    names = ["from", *[f"v{d}" for d in range(1, length)], "to"] if length else ["from"]
    for d, name in enumerate(names):
        attributes = vertices.select(F.col("id").alias("_id"), F.struct(*vertices.columns).alias(name))
        out = out.join(attributes, F.col(f"_{d}") == F.col("_id")).drop("_id")
    whole = F.struct(*edges.columns)
    both = edges.select(F.col("src").alias("_a"), F.col("dst").alias("_b"), whole.alias("_e")).unionByName(
        edges.where("src <> dst").select(F.col("dst").alias("_a"), F.col("src").alias("_b"), whole.alias("_e"))
    )
    for d in range(length):
        step = both.withColumnRenamed("_e", f"e{d}")
        out = out.join(step, (F.col(f"_{d}") == F.col("_a")) & (F.col(f"_{d + 1}") == F.col("_b"))).drop("_a", "_b")
    order = [c for d, n in enumerate(names) for c in ([n] if d == length else [n, f"e{d}"])]
    return out.select(*order)
