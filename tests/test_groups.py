"""Algorithms on contact groups against the same algorithms on the listed pairs."""

import random
from collections import Counter
from itertools import combinations

import pytest
from graphs import triangles_brute
from pyspark.sql import functions as F

from ringwise.operators.dominance import ascending_pairs
from ringwise.operators.graph import shared_contact_pairs
from ringwise.operators.groups import first_pairs, pairs_inside, pairs_touching, shared_only, signed_contacts, sorted_members, sums_before
from ringwise.operators.labels import label_propagation
from ringwise.operators.pagerank import pagerank
from ringwise.operators.paths import bfs_levels, shortest_paths
from ringwise.operators.triangles import triangle_count

HOLDERS = "policyholder_id string, address string, phone string"


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small tables keep their partitions, so that groups lie across them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def holders(spark, n=60, seed=1, hot=20):
    """Random contacts with nulls; the first ``hot`` share one address, some of them the phone too."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        address = "hot" if i < hot else r.choice([None, *[f"a{k}" for k in range(n // 4)]])
        rows.append((f"p{i:03d}", address, r.choice([None, *[f"t{k}" for k in range(n // 4)]])))
    return spark.createDataFrame(rows, HOLDERS).repartition(3), rows


def others(rows, seed=2, n=8):
    """Edges between holders and vertices outside, and among these."""
    r = random.Random(seed)
    outside = [f"x{i}" for i in range(n)] + [f"c{i:02d}" for i in range(40)]
    edges = {(r.choice(outside[:n]), rows[r.randrange(len(rows))][0]) for _ in range(120)} | {(c, rows[r.randrange(len(rows))][0]) for c in outside[n:]}
    edges |= {(rows[r.randrange(len(rows))][0], r.choice(outside[:n])) for _ in range(30)} | set(combinations(outside[:4], 2))
    return outside, sorted(edges)


@pytest.fixture()
def case(spark):
    df, rows = holders(spark)
    outside, plain = others(rows)
    ids = [x[0] for x in rows] + outside
    pairs = [tuple(r) for r in shared_contact_pairs(df).collect()]
    verts = spark.createDataFrame([(x,) for x in ids], "id string")
    return df, rows, verts, ids, plain, pairs


def frame(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string").repartition(2)


@pytest.mark.parametrize("later", [False, True])
def test_sums_over_split_groups(spark, later):
    rows = [("hot", i, 1) for i in range(500)] + [("cold", i, -1) for i in range(0, 30, 3)] + [("one", 7, 1)]
    members = sorted_members(shared_only(spark.createDataFrame(rows, "value string, vid long, sign int").repartition(8)))
    assert members.rows.select("_part").distinct().count() > 1 and members.split.where("value = 'hot'").count() == 500
    weights = spark.createDataFrame([(i, float(i % 7)) for i in range(400)], "vid long, x double")
    got = {(r["value"], r["vid"]): r["s"] for r in sums_before(members, weights, later, by_member=True).collect()}
    beyond = (lambda a, b: a > b) if later else (lambda a, b: a < b)
    want = {(v, i): sum(float(j % 7) for w, j, _ in rows if w == v and beyond(j, i) and j < 400) for v, i, _ in rows if v != "one"}
    assert got == want
    ones = {r["vid"]: r["n"] for r in sums_before(members, None, later).groupBy("vid").agg(F.sum("s").alias("n")).collect()}
    assert ones[9] == (490 - 6 if later else 9 - 3)


def test_pagerank_equals_that_of_listed_pairs(spark, case):
    df, _, verts, _, plain, pairs = case
    listed = {r["id"]: r["pagerank"] for r in pagerank(verts, frame(spark, plain + pairs)).collect()}
    grouped = {r["id"]: r["pagerank"] for r in pagerank(verts, frame(spark, plain), groups=signed_contacts(df)).collect()}
    assert grouped.keys() == listed.keys() and all(grouped[k] == pytest.approx(listed[k], rel=1e-9) for k in listed)


@pytest.mark.parametrize("seed", [1, 5])
@pytest.mark.parametrize("rounds", [1, 2, 5])
def test_labels_equal_those_of_listed_pairs(spark, seed, rounds):
    df, rows = holders(spark, n=70, seed=seed, hot=25)
    outside, plain = others(rows, seed)
    plain += plain[:7]  # parallel edges count twice
    verts = spark.createDataFrame([(x[0],) for x in rows] + [(x,) for x in outside], "id string")
    pairs = [tuple(r) for r in shared_contact_pairs(df).collect()]
    listed = {r["id"]: r["label"] for r in label_propagation(verts, frame(spark, plain + pairs), rounds).collect()}
    assert {r["id"]: r["label"] for r in label_propagation(verts, frame(spark, plain), rounds, signed_contacts(df)).collect()} == listed
    only = {r["id"]: r["label"] for r in label_propagation(verts, frame(spark, pairs), rounds).collect()}
    none = spark.createDataFrame([], "src string, dst string")
    assert {r["id"]: r["label"] for r in label_propagation(verts, none, rounds, signed_contacts(df)).collect()} == only


def test_triangles_equal_brute_force(spark, case):
    df, rows, verts, ids, plain, pairs = case
    got = {r["id"]: r["count"] for r in triangle_count(verts, frame(spark, plain), signed_contacts(df)).collect()}
    assert got == triangles_brute(ids, plain + pairs)
    with pytest.raises(ValueError):
        triangle_count(verts, frame(spark, [*plain, (rows[0][0], rows[1][0])]), signed_contacts(df))


@pytest.mark.parametrize("direction", ["out", "in", "both"])
def test_distances_equal_those_of_listed_pairs(spark, case, direction):
    df, rows, verts, _, plain, pairs = case
    members = signed_contacts(df).where("sign > 0").select("id", "value")
    marks = spark.createDataFrame([(rows[i][0],) for i in (0, 9, 30)] + [("x1",), ("c03",)], "id string")
    listed = {tuple(r) for r in shortest_paths(frame(spark, plain + pairs), marks, direction, vertices=verts).collect()}
    grouped = {tuple(r) for r in shortest_paths(frame(spark, plain), marks, direction, vertices=verts, groups=members).collect()}
    assert grouped == listed and len({r[2] for r in listed}) > 2
    nearest = {}
    for v, _, d in listed:
        nearest[v] = min(d, nearest.get(v, d))
    levels = bfs_levels(frame(spark, plain), marks, direction, vertices=verts, groups=members)
    assert {r["id"]: r["depth"] for r in levels.collect()} == nearest


def test_more_landmarks_than_bits(spark, monkeypatch):
    from ringwise.operators import paths

    monkeypatch.setattr(paths, "BITS", 3)
    edges = frame(spark, [(f"v{i}", f"v{i + 1}") for i in range(9)])
    marks = spark.createDataFrame([(f"v{i}",) for i in range(8)], "id string")
    got = {tuple(r) for r in shortest_paths(edges, marks, "out").collect()}
    assert got == {(f"v{i}", f"v{j}", j - i) for j in range(8) for i in range(j + 1)}
    maps = {r["id"]: r["distances"] for r in paths.as_maps(shortest_paths(edges, marks, "out")).collect()}
    assert maps == {f"v{i}": {f"v{j}": j - i for j in range(i, 8)} for i in range(8)}


def test_ascending_pairs_equal_brute_force(spark):
    r = random.Random(4)
    rows = [("hot", i, r.randrange(12)) for i in range(300)] + [(f"g{i % 40}", 1_000 + i, r.randrange(5)) for i in range(100)] + [("same", i, 3) for i in range(9)]
    r.shuffle(rows)
    got = {r["g"]: r["pairs"] for r in ascending_pairs(spark.createDataFrame(rows, "g string, c long, h long").repartition(5), ["g"], "c", "h").collect()}
    want = Counter()
    for (g, c, h), (k, d, i) in combinations(rows, 2):
        want[g] += g == k and (c < d) == (h < i) and h != i
    assert got == {g: n for g, n in want.items() if n}


def test_no_query_of_these_lists_pairs(spark, monkeypatch):
    from ringwise.operators import graph
    from ringwise.plans.registry import load_all

    def listed(policyholders):
        raise AssertionError("the pair list is built")

    monkeypatch.setattr(graph, "shared_contact_pairs", listed)
    queries = load_all()
    names = ("sample_high_fraud_network", "sample_by_relationship", "sample_components", "sample_pagerank", "sample_communities", "sample_triangles", "pagerank_top", "communities", "community_stats_ring", "triangle_top", "triangles_by_type", "shortest_paths", "close_to_fraud", "close_to_fraud_directed", "bfs_from_claim", "bfs_paths", "run_summary")
    for name in names:
        queries[name].build(spark, "/root/testdata/sf0.001").count()


def test_samples_of_pairs_equal_those_of_the_list(spark):
    df, _ = holders(spark, n=80, seed=3, hot=30)
    pairs = sorted(tuple(r) for r in shared_contact_pairs(df).collect())
    members = signed_contacts(df).where("sign > 0").select("id", "value")
    for k in (1, 7, 60):
        assert [tuple(r) for r in first_pairs(members, k).collect()] == pairs[:k]
        some = ["p003", "p017", "p055", "p079", "nobody"]
        ids = spark.createDataFrame([(i,) for i in some], "id string")
        touched = [p for p in pairs if set(p) & set(some)]
        assert sorted(tuple(r) for r in pairs_touching(members, ids, k).collect())[:k] == touched[:k]
    many = spark.createDataFrame([(f"p{i:03d}",) for i in range(10, 60)], "id string")
    assert sorted(tuple(r) for r in pairs_inside(members, many).collect()) == [p for p in pairs if all("p010" <= x < "p060" for x in p)]


def test_listed_pairs_are_dealt_by_blocks_and_not_shuffled(spark, monkeypatch):
    from ringwise.operators import groups

    monkeypatch.setattr(groups, "BLOCK", 7)
    df, rows = holders(spark, n=90, seed=7, hot=40)
    # ids whose rows repeat, with other contacts or the same, and one without an id
    more = [("p001", "a1", "t1"), ("p001", "hot", "t2"), ("p050", "hot", "t1"), ("p051", "a1", None), *rows[3:9], (None, "hot", "t1")]
    df = df.unionByName(spark.createDataFrame(more, HOLDERS))
    listed = shared_contact_pairs(df)
    want = {(a[0], b[0]) for a in rows + more[:-1] for b in rows + more[:-1] if a[0] < b[0] and any(a[k] is not None and a[k] == b[k] for k in (1, 2))}
    assert sorted(tuple(r) for r in listed.collect()) == sorted(want)
    above = listed._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0]
    assert "Exchange" not in above and "Aggregate" not in above
    marks = spark.createDataFrame([(f"p{i:03d}", i) for i in range(0, 90, 3)], "id string, mark int")
    got = sorted((r["src"], r["dst"], r["src_at"]["mark"], r["dst_at"]["mark"]) for r in groups.listed_pairs(df, marks).collect())
    assert got == sorted((a, b, int(a[1:]), int(b[1:])) for a, b in want if int(a[1:]) % 3 == 0 == int(b[1:]) % 3)


def test_connected_pairs_by_lists_and_by_ranks_equal_brute_force(spark, monkeypatch):
    from types import SimpleNamespace

    from ringwise.plans import structure

    monkeypatch.setattr(structure, "LISTED_CLAIMS", 12)
    df, rows = holders(spark, n=24, seed=5, hot=10)
    r = random.Random(6)
    of = {row[0]: n for row, n in zip(rows, [0, 1, 3, 8, 9, 12, 13, 40] * 3, strict=True)}
    claims = [(r.choice([f"c{r.randrange(150):03d}", "c077"]), p, r.choice([650, 700, 900])) for p, n in of.items() for _ in range(n)] + [("c999", None, 900)]
    stored = SimpleNamespace(policyholders=df, claims=spark.createDataFrame(claims, "claim_id string, policyholder_id string, score_milli int"))
    got = structure.connected_pairs_df(SimpleNamespace(stored=stored, cfg=SimpleNamespace(threshold_milli=700)))
    want = Counter()
    for p, q in [tuple(x) for x in shared_contact_pairs(df).collect()]:
        want[p, q] = sum(c < d for c, a, s in claims for d, b, t in claims if a == p and b == q and s >= 700 <= t)
    assert {(x[0], x[1]): x[2] for x in got.collect()} == {k: n for k, n in want.items() if n}


def test_landmarks_get_their_names_without_a_join_on_few_keys(spark):
    verts = spark.createDataFrame([(x,) for x in "abcdef"], "id string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "src string, dst string")
    marks = spark.createDataFrame([("a",), ("e",), ("f",)], "id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = shortest_paths(edges, marks, "both", vertices=verts)
        assert "SortMergeJoin [landmark" not in found._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in found.collect()} == {("a", "a", 0), ("b", "a", 1), ("c", "a", 2), ("e", "e", 0), ("d", "e", 1), ("f", "f", 0)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sample_of_connected_claims_equals_the_first_of_all_and_lists_no_pairs(spark, monkeypatch):
    from ringwise.operators import graph
    from ringwise.plans.context import Context
    from ringwise.plans.structure import connected_claimants_df
    from ringwise.sources.fixtures import ClaimTables

    def ctx():
        c = Context(spark, "/root/testdata/sf0.001")
        t = c.tables
        mod = "pmod(xxhash64(policyholder_id), {})".format
        people = t.policyholders.withColumn("address", F.expr(f"IF({mod(3)} = 0, NULL, concat('a', {mod(20)}))"))
        c.__dict__["stored"] = ClaimTables(people.unionByName(people.limit(5)), t.adjusters, t.service_providers, t.claims.unionByName(t.claims.limit(9)))
        return c

    order = ["claim1", "claim2", "policyholder1", "policyholder2"]
    want = [tuple(r) for r in connected_claimants_df(ctx()).orderBy(*order).limit(7).collect()]

    def listed(policyholders):
        raise AssertionError("the pair list is built")

    monkeypatch.setattr(graph, "shared_contact_pairs", listed)
    got = connected_claimants_df(ctx(), first=7).orderBy(*order).limit(7)
    assert len(want) == 7 and [tuple(r) for r in got.collect()] == want


def test_labels_write_votes_of_members_only(spark, case, monkeypatch):
    from ringwise.operators import labels

    df, rows, verts, ids, plain, pairs = case
    written = []
    keep = labels.Rounds.write

    def counted(self, frame, rnd, metrics=None):
        if "lp-rest" in self.label:
            written.append(frame.select("id").distinct().count())
        return keep(self, frame, rnd, metrics)

    monkeypatch.setattr(labels.Rounds, "write", counted)
    label_propagation(verts, frame(spark, plain), 2, signed_contacts(df)).count()
    members = {p for pair in pairs for p in pair}
    assert len(written) == 2 and all(n <= len(members) for n in written)


def test_edges_are_derived_without_writing_the_tables(spark, scratch_dir, monkeypatch):
    """``edges`` reads what it needs of the claims twice; writing all their columns first took longer than that."""
    from ringwise.plans import context as plans
    from ringwise.plans.registry import load_all

    given = {
        "customer": spark.range(60).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "'AUTO' AS c_mktsegment", "cast(id % 3 AS int) AS c_nationkey"),
        "nation": spark.range(3).selectExpr("cast(id AS int) AS n_nationkey", "concat('N', id) AS n_name", "0 AS n_regionkey"),
        "region": spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name"),
        "supplier": spark.range(5).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name"),
        "orders": spark.range(400).selectExpr(
            "id AS o_orderkey", "id % 60 AS o_custkey", "'O' AS o_orderstatus", "id * 10.0D AS o_totalprice", "timestamp'1996-01-01 00:00:00' AS o_orderdate", "'5-LOW' AS o_orderpriority"
        ),
    }
    for name, df in given.items():
        df.write.parquet(f"{scratch_dir}/{name}.parquet")
    stored = plans.context(spark, scratch_dir).graph.edges.drop("claim_count").collect()
    written, write = [], plans.materialize
    monkeypatch.setattr(plans, "materialize", lambda df, label, *more: written.append(label) or write(df, label, *more))
    got = load_all()["edges"].build(spark, scratch_dir).collect()
    assert {r["relationship"] for r in got} > {"shared_contact", "filed_by"} and Counter(got) == Counter(stored)
    assert not written
