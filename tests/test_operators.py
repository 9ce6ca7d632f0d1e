"""Hand graphs with answers known by inspection (FIXTURES F3)."""

import pytest
from graphs import cc_brute, frames, scc_brute, triangles_brute

from ringwise.operators.components import connected_components
from ringwise.operators.graph import PropertyGraph
from ringwise.operators.labels import label_propagation
from ringwise.operators.motif import find
from ringwise.operators.pagerank import pagerank
from ringwise.operators.paths import bfs, shortest_paths
from ringwise.operators.scc import strongly_connected_components
from ringwise.operators.triangles import triangle_count

TRI_TAIL = (list("abcd"), [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")])
CYCLE_TAIL = (list("abcd"), [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")])
CLIQUES = (
    list("abcdefgh"),
    [(x, y) for i, x in enumerate("abcd") for y in "abcd"[i + 1 :]]
    + [(x, y) for i, x in enumerate("efgh") for y in "efgh"[i + 1 :]]
    + [("d", "e")],
)


def _dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_empty_graph(spark):
    v, e = frames(spark, [], [])
    assert connected_components(v, e).count() == 0
    assert triangle_count(v, e).count() == 0
    assert strongly_connected_components(v, e).count() == 0
    assert label_propagation(v, e).count() == 0


def test_isolated_vertices(spark):
    v, e = frames(spark, ["a", "b"], [])
    assert _dict(connected_components(v, e), "id", "component") == {"a": "a", "b": "b"}
    assert _dict(strongly_connected_components(v, e), "id", "scc") == {"a": "a", "b": "b"}
    assert _dict(label_propagation(v, e), "id", "label") == {"a": "a", "b": "b"}
    assert _dict(triangle_count(v, e), "id", "count") == {"a": 0, "b": 0}
    ranks = _dict(pagerank(v, e), "id", "pagerank")
    assert ranks["a"] == pytest.approx(1.0) and ranks["b"] == pytest.approx(1.0)


@pytest.mark.parametrize("graph", [TRI_TAIL, CYCLE_TAIL, CLIQUES])
def test_components_and_triangles_match_brute_force(spark, graph):
    vs, es = graph
    v, e = frames(spark, vs, es)
    assert _dict(connected_components(v, e), "id", "component") == cc_brute(vs, es)
    assert _dict(triangle_count(v, e), "id", "count") == triangles_brute(vs, es)


def test_triangle_tail_and_cliques_values(spark):
    v, e = frames(spark, *TRI_TAIL)
    assert _dict(triangle_count(v, e), "id", "count") == {"a": 1, "b": 1, "c": 1, "d": 0}
    v, e = frames(spark, *CLIQUES)
    assert set(_dict(triangle_count(v, e), "id", "count").values()) == {3}


def test_scc_cycle_and_tail(spark):
    v, e = frames(spark, *CYCLE_TAIL)
    got = _dict(strongly_connected_components(v, e), "id", "scc")
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d"} == scc_brute(*CYCLE_TAIL)
    v, e = frames(spark, *TRI_TAIL)
    assert _dict(strongly_connected_components(v, e), "id", "scc") == {x: x for x in "abcd"}


def test_shortest_paths_directions(spark):
    v, e = frames(spark, *CYCLE_TAIL)
    lm = spark.createDataFrame([("a",)], "id string")
    out = {(r["id"], r["landmark"]): r["distance"] for r in shortest_paths(e, lm, "out").collect()}
    assert out == {("a", "a"): 0, ("c", "a"): 1, ("b", "a"): 2}
    both = {r["id"]: r["distance"] for r in shortest_paths(e, lm, "both").collect()}
    assert both == {"a": 0, "b": 1, "c": 1, "d": 2}
    # same answers on bigint ids (vertices given)
    out_v = {(r["id"], r["landmark"]): r["distance"] for r in shortest_paths(e, lm, "out", vertices=v).collect()}
    assert out_v == out
    both_v = {r["id"]: r["distance"] for r in shortest_paths(e, lm, "both", vertices=v).collect()}
    assert both_v == both


def test_pagerank_parallel_edges_and_sum(spark):
    v, e = frames(spark, ["a", "b"], [("a", "b"), ("a", "b"), ("b", "a"), ("a", "a")])
    ranks = _dict(pagerank(v, e), "id", "pagerank")
    assert sum(ranks.values()) == pytest.approx(2.0)
    # a sends 2/3 of its rank to b (two parallel edges of three), b all of its rank to a
    assert ranks["b"] != pytest.approx(ranks["a"])
    v, e = frames(spark, *CLIQUES)
    assert sum(_dict(pagerank(v, e), "id", "pagerank").values()) == pytest.approx(8.0)


def test_bfs_diamond_all_shortest_paths(spark):
    v, e = frames(spark, list("abcd"), [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")])
    paths = bfs(v, e, "id = 'a'", "id = 'd'").collect()
    assert sorted(r["path"] for r in paths) == ["a>b>d", "a>c>d"]
    assert {r["length"] for r in paths} == {2}
    same = bfs(v, e, "id = 'a'", "id = 'a'").collect()
    assert [(r["path"], r["length"]) for r in same] == [("a", 0)]
    none = bfs(v, e, "id = 'd'", "id = 'a'").collect()
    assert none == []


def test_label_propagation_ties_go_to_smallest_label(spark):
    # two disjoint edges: each vertex hears only the other, labels swap once per round
    v, e = frames(spark, list("abcd"), [("a", "b"), ("c", "d")])
    labels = _dict(label_propagation(v, e, rounds=1), "id", "label")
    assert labels == {"a": "b", "b": "a", "c": "d", "d": "c"}
    # a star: leaves hear only the centre
    v, e = frames(spark, list("xyz"), [("x", "y"), ("x", "z")])
    labels = _dict(label_propagation(v, e, rounds=1), "id", "label")
    assert labels["y"] == "x" and labels["z"] == "x" and labels["x"] == "y"


def test_motif_pairs_and_negation(spark):
    verts = spark.createDataFrame(
        [("c1", "claim", 0.9), ("c2", "claim", 0.8), ("c3", "claim", 0.1), ("p", "policyholder", None)],
        "id string, type string, fraud_score double",
    )
    edges = spark.createDataFrame(
        [("c1", "p", "filed_by"), ("c2", "p", "filed_by"), ("c3", "p", "filed_by")], "src string, dst string, relationship string"
    )
    g = PropertyGraph(verts, edges)
    m = find(g, [("a", "e1", "p"), ("b", "e2", "p")], where="a.id < b.id AND a.fraud_score >= 0.7 AND b.fraud_score >= 0.7")
    assert [(r["a"]["id"], r["b"]["id"]) for r in m.collect()] == [("c1", "c2")]
    # negated edge: pairs (a, b) with no edge a -> b
    m2 = find(g, [("a", None, "p")], negate=[("p", "a")])
    assert m2.count() == 3
    with pytest.raises(ValueError):
        find(g, [("a", None, "b"), ("x", None, "y")])


def test_later_in_group_splits_a_hot_group(spark):
    from ringwise.operators.ranking import later_in_group

    rows = [("hot", f"k{i:04d}", i % 2) for i in range(600)] + [("cold", f"k{i:04d}", 1) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, k string, w int").repartition(4)
    got = {(r["g"], r["k"]): r["later"] for r in later_in_group(df, ["g"], "k").collect()}
    assert got[("hot", "k0000")] == 599 and got[("hot", "k0599")] == 0 and got[("cold", "k0000")] == 4
    assert all(got[("hot", f"k{i:04d}")] == 599 - i for i in range(600))
    weighted = {(r["g"], r["k"]): r["later"] for r in later_in_group(df, ["g"], "k", weight="w").collect()}
    # odd keys carry weight 1: later odd keys after k0000 are k0001, k0003, ..., k0599 -> 300
    assert weighted[("hot", "k0000")] == 300 and weighted[("hot", "k0599")] == 0


def test_ids_keep_all_digits(spark):
    from ringwise.functions.keys import key_sql

    rows = {"SP": (6, [100_000, 1_000_000, 7]), "PH": (8, [15_000_000, 150_000_000, 7]), "CLM": (10, [1_234_567_890, 12_345_678_901, 7])}
    for prefix, (width, keys) in rows.items():
        df = spark.createDataFrame([(k,) for k in keys], "k long").selectExpr(f"{key_sql(prefix, 'k', width)} AS id")
        assert [r["id"] for r in df.collect()] == [prefix + str(k).zfill(width) for k in keys]


def test_anonymous_vertices_leave_no_column(spark):
    verts = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "x")], "src string, dst string")
    g = PropertyGraph(verts, edges)
    out = find(g, [("a", "e", None)])
    assert set(out.columns) == {"a", "e"} and sorted(r["e"]["dst"] for r in out.collect()) == ["b", "c"]
    assert [r["m"]["id"] for r in find(g, [(None, None, "m"), ("m", None, None)]).collect()] == ["b"]
    # no edge out of c at all
    assert [r["n"]["id"] for r in find(g, [(None, None, "n")], negate=[("n", None)]).collect()] == ["c"]


def test_motifs_match_plain_enumeration(spark):
    """Chains, a triangle, a four-ring, a loop and filters, against all bindings tried one by one."""
    import random
    from itertools import product

    r = random.Random(3)
    ids = [f"v{i}" for i in range(9)]
    kind = {v: r.choice("ab") for v in ids}
    rows = [(r.choice(ids), r.choice(ids), r.choice("xy")) for _ in range(40)]
    verts = spark.createDataFrame([(v, kind[v]) for v in ids], "id string, _v0a string")
    g = PropertyGraph(verts, spark.createDataFrame(rows, "src string, dst string, rel string").repartition(3))
    patterns = [
        [("a", "e", "b"), ("b", "f", "c")],
        [("a", "e", "b"), ("b", "f", "c"), ("c", "g", "a")],
        [("a", None, "b"), ("c", None, "b"), ("c", None, "d"), ("a", None, "d")],
        [("a", "e", "a"), ("a", "f", "b")],
        [("_v1a", "e", None), ("_v1a", "f", "b"), (None, None, "b")],
    ]
    for pattern in patterns:
        names = list(dict.fromkeys(x for a, _, b in pattern for x in (a, b) if x))
        filters = {"a": "_v0a = 'a'"} if "a" in names else {"e": "rel = 'x'"}
        want = []
        for chosen in product(range(len(rows)), repeat=len(pattern)):
            bound, fits = {}, True
            for (a, e, b), n in zip(pattern, chosen, strict=True):
                for x, v in ((a, rows[n][0]), (b, rows[n][1])):
                    fits = fits and (x is None or bound.setdefault(x, v) == v)
                fits = fits and not (e in filters and rows[n][2] != "x")
            if fits and not ("a" in filters and kind[bound["a"]] != "a"):
                want.append(str([bound[x] for x in names]))
            if len(pattern) > 3 and len(want) > 400:
                break
        found = find(g, pattern, filters=filters)
        assert set(found.columns) == {x for t in pattern for x in t if x}
        got = sorted(str([m[x]["id"] for x in names]) for m in found.collect())
        assert (got == sorted(want)) if len(pattern) <= 3 else set(want) <= set(got)
    with pytest.raises(ValueError):
        find(g, [("a", "e", "b")], filters={"z": "true"})


def test_motif_joins_numbers_until_the_end(spark):
    """A hub's edges that lie in no match are gone before the joins, and structs are attached to matches only."""
    from ringwise.operators import motif

    rows = [(f"x{i}", "hub") for i in range(400)] + [("hub", "end"), ("end", "last")]
    verts = spark.createDataFrame([(v,) for v in {x for p in rows for x in p}], "id string")
    g = PropertyGraph(verts, spark.createDataFrame(rows, "src string, dst string"))
    counts = {}
    keep = motif.materialize

    def counted(df, label, metrics=None, path=None):
        out = keep(df, label, metrics, path)
        counts[label] = out[1].get("n", counts.get(label))
        return out

    with pytest.MonkeyPatch.context() as m:
        m.setattr(motif, "materialize", counted)
        out = motif.find(g, [("a", None, "b"), ("b", None, "c"), ("c", "e", "d")], filters={"a": "id = 'x7'"})
        assert [(r["a"]["id"], r["d"]["id"], r["e"]["src"]) for r in out.collect()] == [("x7", "last", "end")]
    assert [counts[f"motif-{n}"] for n in range(3)] == [1, 1, 1]


def test_bfs_steps_and_structs(spark):
    from ringwise.operators.paths import bfs, bfs_structs

    verts = spark.createDataFrame([(x, x.upper()) for x in "abcd"], "id string, name string")
    edges = spark.createDataFrame([("a", "b", "r1"), ("a", "c", "r2"), ("b", "d", "r3"), ("c", "d", "r4")], "src string, dst string, rel string")
    paths = bfs(verts, edges, "id = 'a'", "id = 'd'")
    assert sorted(r["path"] for r in paths.collect()) == ["a>b>d", "a>c>d"]
    assert {tuple((s["position"], s["id"]) for s in r["steps"]) for r in paths.collect()} == {((0, "a"), (1, "b"), (2, "d")), ((0, "a"), (1, "c"), (2, "d"))}
    out = bfs_structs(verts, edges, paths, 2)
    assert out.columns == ["from", "e0", "v1", "e1", "to"]
    assert sorted((r["from"]["name"], r["e0"]["rel"], r["v1"]["id"], r["e1"]["rel"], r["to"]["id"]) for r in out.collect()) == [
        ("A", "r1", "b", "r3", "d"),
        ("A", "r2", "c", "r4", "d"),
    ]
    assert [r["path"] for r in bfs(verts, edges, "id = 'a'", "id in ('a', 'd')").collect()] == ["a"]
    assert bfs(verts, edges, "id = 'd'", "id = 'a'").collect() == []


def test_groups_stand_for_their_pairs(spark):
    """Distances and paths through contact values equal those over the listed pairs."""
    from itertools import combinations

    from ringwise.operators.paths import bfs, shortest_paths

    groups = {"g1": "abcde", "g2": "ef", "g3": "fgh", "g4": "z"}
    verts = spark.createDataFrame([(x,) for x in "abcdefghxyz"], "id string")
    plain = [("x", "a"), ("h", "y")]
    pairs = spark.createDataFrame(plain + [p for m in groups.values() for p in combinations(m, 2)], "src string, dst string")
    members = spark.createDataFrame([(x, g) for g, m in groups.items() for x in m], "id string, value string")
    edges = spark.createDataFrame(plain, "src string, dst string")
    marks = spark.createDataFrame([("x",), ("c",)], "id string")
    listed = {tuple(r) for r in shortest_paths(pairs, marks, "both", vertices=verts).collect()}
    assert listed == {tuple(r) for r in shortest_paths(edges, marks, "both", vertices=verts, groups=members).collect()}
    over_pairs = sorted(r["path"] for r in bfs(verts, pairs, "id = 'x'", "id = 'y'", direction="both").collect())
    assert over_pairs == sorted(r["path"] for r in bfs(verts, edges, "id = 'x'", "id = 'y'", direction="both", groups=members).collect()) != []


def test_contact_degrees_and_counts_without_pairs(spark):
    from ringwise.operators.graph import contact_degrees, contact_pair_count, shared_contact_pairs

    rows = [(f"p{i:02d}", None if i % 7 == 0 else f"a{i % 4}", None if i % 5 == 0 else f"t{i % 3}") for i in range(40)]
    df = spark.createDataFrame(rows, "policyholder_id string, address string, phone string")
    pairs = [tuple(r) for r in shared_contact_pairs(df).collect()]
    assert contact_pair_count(df).first()["count"] == len(pairs)
    for r in contact_degrees(df).collect():
        assert r["out_degree"] == sum(p[0] == r["id"] for p in pairs) and r["in_degree"] == sum(p[1] == r["id"] for p in pairs)


def test_pagerank_stops_at_the_tolerance(spark):
    from ringwise.operators.pagerank import pagerank

    verts = spark.createDataFrame([(x,) for x in "abc"], "id string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    ring = {r["id"]: r["pagerank"] for r in pagerank(verts, edges, rounds=50, tol=1e-9).collect()}
    assert all(abs(v - 1) < 1e-9 for v in ring.values())
    chain = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    exact = {r["id"]: r["pagerank"] for r in pagerank(verts, chain, rounds=40).collect()}
    early = {r["id"]: r["pagerank"] for r in pagerank(verts, chain, rounds=40, tol=1e-6).collect()}
    assert all(abs(exact[k] - early[k]) < 1e-5 for k in exact)


def test_a_long_path_settles_in_few_rounds(spark, monkeypatch):
    """10,000 vertices in shuffled order with a cycle at the end, a tree of paths beside it, and a closed ring."""
    import random

    from ringwise.operators import iterate, scc

    ids = list(range(10_400))
    random.Random(5).shuffle(ids)
    path, ring, side = ids[:10_000], ids[10_000:10_200], ids[10_200:]
    edges = list(zip(path, path[1:], strict=False)) + [(path[-1], path[-50])] + list(zip(ring, ring[1:] + ring[:1], strict=True))
    edges += list(zip(side, side[1:], strict=False)) + [(path[5_000], side[0])]
    rounds = []
    write = iterate.Rounds.write

    def counted(self, df, rnd, metrics=None):
        rounds.append(self.label)
        return write(self, df, rnd, metrics)

    monkeypatch.setattr(iterate.Rounds, "write", counted)
    v = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r["id"]: r["scc"] for r in scc.strongly_connected_components(v, spark.createDataFrame(edges, "src long, dst long")).collect()}
    want = {i: i for i in ids} | {i: min(path[-50:]) for i in path[-50:]} | {i: min(ring) for i in ring}
    assert got == want
    assert sum("jump" in r or "colour" in r or "back" in r for r in rounds) < 40


def test_a_hub_is_split_where_minima_join(spark):
    """The joins of components with a hub that holds half of all edges: adaptive execution reads it in pieces."""
    from ringwise.operators.components import _large_star, _small_star
    from ringwise.operators.iterate import materialize

    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # a hub as a parent, then as a child
        edges = spark.range(60_000).selectExpr("id + 10 as c", "case when id % 2 = 0 then 1 else id div 7 + 2 end as p").repartition(8)
        up = spark.range(60_000).selectExpr("case when id % 2 = 0 then 99999 else id div 7 + 70000 end as c", "id as m").repartition(8)
        for joined in (_large_star(materialize(edges, "t-state")[0]), _small_star(materialize(up, "t-large")[0])):
            joined.write.format("noop").mode("overwrite").save()
            joined.collect()
            assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_matches_of_a_hub_meet_by_blocks_and_are_not_shuffled(spark, monkeypatch):
    from ringwise.operators import motif

    monkeypatch.setattr(motif, "BLOCK", 5, raising=False)
    verts = spark.createDataFrame([(f"c{i:02d}",) for i in range(40)] + [("h",), ("p",), ("q",)], "id string")
    edges = [(f"c{i:02d}", "h") for i in range(23)] + [(f"c{i:02d}", "p") for i in range(20, 40)] + [("c01", "q")]
    links = [("h", "p"), ("h", "q")]
    g = PropertyGraph(verts, spark.createDataFrame([(a, b, "f") for a, b in edges] + [(a, b, "l") for a, b in links], "src string, dst string, kind string"))
    out = motif.find(
        g, [("x", "l", "y"), ("a", "e", "x"), ("b", "f", "y")], where="a.id < b.id", filters={"l": "kind = 'l'", "e": "kind = 'f'", "f": "kind = 'f'"}
    ).select("a.id", "x.id", "b.id", "y.id")
    want = sorted((a, x, b, y) for x, y in links for a, s in edges for b, t in edges if s == x and t == y and a < b)
    assert sorted(tuple(r) for r in out.collect()) == want
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert "__block" in joins[0] and "id" in joins[0]


def test_later_in_group_with_the_largest(spark):
    from ringwise.operators.ranking import later_in_group

    values = [(i * 37) % 101 for i in range(300)]
    df = spark.createDataFrame([("hot", i, v) for i, v in enumerate(values)], "g string, k int, w int").repartition(4)
    got = {r["k"]: r["later"] for r in later_in_group(df, ["g"], "k", weight="w", largest=True).collect()}
    assert got == {i: max(values[i + 1 :], default=0) for i in range(300)}


def test_components_take_tips_off_before_the_rounds(spark, monkeypatch):
    import random

    from ringwise.operators import components

    seen = []
    keep = components.component_labels
    monkeypatch.setattr(components, "component_labels", lambda edges, *a: seen.append(edges.count()) or keep(edges, *a))
    v, e = frames(spark, ["m", "n", "o", "z", *[f"a{i:03d}" for i in range(100)], "x", "y"], [(f"a{i:03d}", "m") for i in range(100)] + [("m", "n"), ("n", "o"), ("o", "m"), ("y", "x"), ("x", "y"), ("z", "z")])
    got = _dict(connected_components(v, e), "id", "component")
    assert seen == [3] and set(got.values()) == {"a000", "x", "z"} and got["o"] == "a000" and got["y"] == "x" and got["z"] == "z"
    for seed in range(3):
        r = random.Random(seed)
        vs = [f"v{i:02d}" for i in range(40)]
        es = [(r.choice(vs), r.choice(vs)) for _ in range(28)]
        assert _dict(connected_components(*frames(spark, vs, es + es[:4])), "id", "component") == cc_brute(vs, es)


def test_pagerank_rounds_see_vertices_with_in_edges_only(spark, monkeypatch):
    import random

    from ringwise.operators import pagerank as module

    rows = []
    keep = module.Rounds.write
    monkeypatch.setattr(module.Rounds, "write", lambda self, df, rnd, metrics=None: rows.append(df.count()) or keep(self, df, rnd, metrics))
    r = random.Random(3)
    hubs, many = list("pqrs"), [f"c{i:03d}" for i in range(60)]
    es = [(c, r.choice(hubs)) for c in many for _ in range(2)] + [("p", "q"), ("q", "p"), ("r", "p")]
    got = _dict(pagerank(*frames(spark, hubs + many, es), rounds=4), "id", "pagerank")
    assert set(rows) == {4}
    ranks = dict.fromkeys(hubs + many, 1.0)
    out = {v: sum(a == v for a, _ in es) for v in ranks}
    for _ in range(4):
        ranks = {v: 0.15 + 0.85 * sum(ranks[a] / out[a] for a, b in es if b == v) for v in ranks}
    scale = len(ranks) / sum(ranks.values())
    assert got == pytest.approx({v: x * scale for v, x in ranks.items()})
