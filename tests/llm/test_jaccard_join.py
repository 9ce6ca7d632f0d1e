import random

import numpy as np
import pytest

from ringwise.llm import jaccard_join as J
from ringwise.llm.common import Scratch
from ringwise.llm.graph import components
from tests.llm import brute
from tests.llm.conftest import SCHEMA, odd_rows


def rows_of(df):
    return sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in df.collect())


def expected(rows):
    return sorted(str((r[0], *f)) for r, f in zip(rows, brute.components([r[0] for r in rows], [r[1] for r in rows]), strict=True))


def test_odd_rows(odd):
    assert rows_of(J.join(odd)) == expected(odd_rows())


def test_documents(small):
    df, rows = small
    assert rows_of(J.join(df)) == expected(rows)


def near_copies(n, seed, edits=(0, 1, 2, 3, 4), length=90):
    """Groups of copies with some words changed: many pairs lie near the threshold, and chains form."""
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 5_000)}"
    bases = [[word() for _ in range(length + r.randint(0, 20))] for _ in range(4)]
    common = [word() for _ in range(30)]
    rows = []
    for i in range(n):
        w = list(r.choice(bases))
        if r.random() < 0.3:
            w = [word() for _ in range(60)] + common
        for _ in range(r.choice(edits)):
            w[r.randrange(len(w))] = word()
        if r.random() < 0.3:
            w = w[: len(w) - r.randint(0, 25)]
        rows.append((i, " ".join(w), None, None, None))
    return rows


@pytest.mark.parametrize("block", [4_000, 12, 5])
def test_near_copies_in_blocks_of_any_size(spark, block):
    rows = near_copies(150, 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(J.join(df, block=block)) == expected(rows)


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_all_components(seed):
    rows = near_copies(120, seed, edits=(0, 2, 4, 6, 8))
    texts = [r[1] for r in rows]
    sets = []
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        sets.append(J.shingle_sets(raw, np.array([0, len(raw)]))[0])
    nodes, n = np.arange(len(sets)), np.array([len(s) for s in sets])
    links = J.join_sets(nodes, n, sets, np.zeros(len(sets), int), nodes)
    want = brute.components(nodes.tolist(), texts)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert [find(i) for i in range(len(sets))] == [w[1] for w in want]


def test_shingles_match_a_plain_version():
    texts = ["", "A b\tc", "a B c", "one two three four five six\nseven", "one two three four five one two three four five", "é　x ü", " "]
    bodies = [t.encode() for t in texts]
    sets, counts = J.shingle_sets(np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0, *map(len, bodies)]))
    assert counts.tolist() == [len(brute.shingle_set(t)) for t in texts]
    ends = np.cumsum(counts)
    own = [set(sets[e - c : e].tolist()) for e, c in zip(ends, counts, strict=True)]
    assert own[1] == own[2] and len(own[3] | own[4]) == len(own[3]) + len(own[4]) - 1


def test_prefix_length():
    for n in range(1, 300):
        assert J.prefix_length(np.int64(n)) == n - -(-8 * n // 10) + 1


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(1_000 + i, 1_001 + i) for i in range(70)] + [(5, 5)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(pairs, "u long, v long"), Scratch(spark, "t"), "c").collect()}
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for p in pairs for x in p if any(x in q and q[0] != q[1] for q in pairs)}


def test_representatives(odd, none):
    left = sorted(str(r["doc_id"]) for r in J.representatives(odd).collect())
    # 1 and 2 are equal, 3 is near them, 11 and 12 have the same words; empty ones stay
    assert left == sorted(map(str, [1, 4, 5, 6, 7, 8, 9, None, 10, 11]))
    assert J.join(none).collect() == [] and J.representatives(none).collect() == []


def test_lines_that_many_texts_share_tie_no_cluster_where_counters_are_full(spark, monkeypatch):
    # counters that say the same of all shingles, as those of a large input nearly do
    monkeypatch.setattr(J, "frequencies", lambda texts, scratch: np.full(J.CELLS, 2_000))
    largest, links = [], J._links

    def watched(sets, scratch, block):
        largest.append(max((r["count"] for r in sets.groupBy("cluster").count().collect()), default=0))
        return links(sets, scratch, block)

    monkeypatch.setattr(J, "_links", watched)
    r = random.Random(7)
    word = lambda: f"w{r.randint(0, 1_000_000)}"
    lines = [[word() for _ in range(12)] for _ in range(8)]
    rows = []
    for i in range(100):
        w = [word() for _ in range(80)] + lines[i % 8] + lines[(i * 3 + 1) % 8]
        rows.append((i, " ".join(w), None, None, None))
    rows += [(100 + i, rows[i][1] + " and more", None, None, None) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(J.join(df)) == expected(rows)
    # the pipeline's second stage
    assert sorted(r["doc_id"] for r in J.representatives(df).collect()) == list(range(100))
    assert max(largest) <= 4, "texts that share a line alone are in one cluster"


def test_bitmap_has_the_shingles_of_many_texts(spark):
    line = "one two three four five six"
    texts = [f"{line} " + " ".join(f"w{i}x{j}" for j in range(6)) for i in range(J.FEW + 1)]
    context = spark.sparkContext
    often = context.broadcast(np.zeros(J.CELLS, np.int64))
    bits = J.shared_often(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), often, Scratch(spark, "t"))
    raw = np.frombuffer(line.encode(), np.uint8)
    shared, _ = J.shingle_sets(raw, np.array([0, len(raw)]))
    found = int(np.unpackbits(bits).sum())
    # all texts have 8 shingles, of which the first 7 in order are counted
    assert 1 <= found <= 2 and J._last(shared, bits).sum() == found
    fewer = J.shared_often(spark.createDataFrame([(t,) for t in texts[1:]], "text string"), often, Scratch(spark, "t"))
    assert not fewer.any()
