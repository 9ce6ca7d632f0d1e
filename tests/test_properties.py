"""Randomised properties against brute force (few examples: each is a Spark run)."""

from graphs import bfs_brute, cc_brute, frames, scc_brute, triangles_brute
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ringwise.operators.components import apply_merge, connected_components, merge_components
from ringwise.operators.paths import shortest_paths
from ringwise.operators.scc import strongly_connected_components
from ringwise.operators.triangles import triangle_count

NAMES = [f"v{i:02d}" for i in range(12)]
graphs = st.lists(st.tuples(st.sampled_from(NAMES), st.sampled_from(NAMES)), min_size=0, max_size=24)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(edges=graphs)
def test_components_equal_union_find(spark, edges):
    v, e = frames(spark, NAMES, edges)
    got = {r["id"]: r["component"] for r in connected_components(v, e).collect()}
    assert got == cc_brute(NAMES, edges)


@SETTINGS
@given(edges=graphs)
def test_scc_refines_cc_and_matches_reachability(spark, edges):
    v, e = frames(spark, NAMES, edges)
    got = {r["id"]: r["scc"] for r in strongly_connected_components(v, e).collect()}
    assert got == scc_brute(NAMES, edges)
    cc = cc_brute(NAMES, edges)
    for a in NAMES:
        for b in NAMES:
            if got[a] == got[b]:
                assert cc[a] == cc[b]


@SETTINGS
@given(edges=graphs)
def test_triangles_match_and_sum_divisible_by_three(spark, edges):
    v, e = frames(spark, NAMES, edges)
    got = {r["id"]: r["count"] for r in triangle_count(v, e).collect()}
    assert got == triangles_brute(NAMES, edges)
    assert sum(got.values()) % 3 == 0


@SETTINGS
@given(edges=graphs)
def test_bfs_depth_is_shortest_path(spark, edges):
    v, e = frames(spark, NAMES, edges)
    lm = spark.createDataFrame([(NAMES[0],)], "id string")
    got = {r["id"]: r["distance"] for r in shortest_paths(e, lm, "in").collect()}
    assert got == bfs_brute(NAMES, edges, [NAMES[0]])


@SETTINGS
@given(old=graphs, new=graphs)
def test_merged_labels_equal_a_full_run(spark, old, new):
    """Old labels are saved for half of the vertices; the delta brings edges and the other vertices."""
    names = NAMES[3:9]
    old = [p for p in old if set(p) <= set(names)]
    v, e = frames(spark, names, old or [(names[0], names[0])])
    labels = connected_components(v, e)
    delta = spark.createDataFrame([(a, b) for a, b in new] or [(names[0], names[1])], "src string, dst string")
    moved, fresh = merge_components(labels, delta)
    got = {r["id"]: r["component"] for r in apply_merge(labels, moved, fresh).collect()}
    pairs = [tuple(r) for r in delta.collect()]
    reached = sorted({*names, *[x for p in pairs for x in p]})
    assert got == cc_brute(reached, old + pairs)


def test_merging_works_on_the_delta_alone(spark, monkeypatch):
    """A delta of three edges on a chain of 3,000 vertices: what is written follows the delta."""
    from ringwise.operators import components as C

    labels = spark.range(3_000).selectExpr("printf('v%05d', id) AS id", "printf('v%05d', id - id % 10) AS component")
    written = []
    keep = C.materialize

    def counted(df, label, metrics=None, path=None):
        out = keep(df, label, metrics, path)
        written.append((label, out[0].count()))
        return out

    monkeypatch.setattr(C, "materialize", counted)
    delta = spark.createDataFrame([("v00005", "v00999"), ("v00999", "v02000"), ("v02001", "new")], "src string, dst string")
    moved, fresh = merge_components(labels, delta)
    assert {tuple(r) for r in moved.collect()} == {("v00990", "new"), ("v02000", "new"), ("v00000", "new")}
    assert [tuple(r) for r in fresh.collect()] == [("new", "new")]
    assert all(n <= 6 for _, n in written)
    after = apply_merge(labels, moved, fresh)
    assert after.where("component = 'new'").count() == 31 and after.count() == 3_001
