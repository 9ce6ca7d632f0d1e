import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ringwise.llm import ball_tree as B
from tests.llm.conftest import SCHEMA, odd_rows

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, best=20):
    tf = [(k, Counter(TERM.findall((t or "").translate(LOWER)))) for k, t in docs]
    tf = [(k, c) for k, c in tf if c]
    n_docs, length = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for k, c in tf:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // length
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t])
            if s > 0:
                scored.append((-s, k is None, k or 0, k))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:best], 1)]
    return sorted(map(str, out))


def ranked(docs, items, **more):
    return sorted(str(tuple(r)) for r in B.search(docs, items, **more).select("item_id", "rank", "doc_id", "score").collect())


def test_given_documents(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    df, rows = small
    assert ranked(df, items) == brute([(r[0], r[1]) for r in rows], [(r["item_id"], r["text"]) for r in items.collect()])


@pytest.mark.parametrize("block", [4_096, 50])
def test_many_trees_batches_and_copies(spark, monkeypatch, block):
    monkeypatch.setattr(B, "BLOCK", block)
    monkeypatch.setattr(B, "BATCH_CHARS", 150)
    monkeypatch.setattr(B, "TOGETHER", 2)
    r = random.Random(9)
    word = lambda: r.choice("abcdefgh") + str(int(r.paretovariate(0.7)) % 60)
    docs = [(i, " ".join(word() for _ in range(r.randint(0, 60)))) for i in range(200)]
    docs += [(1_000 + i, docs[0][1] + " tail " + word()) for i in range(100)] + [(None, docs[1][1]), (7, docs[2][1])]
    items = [(i, " ".join(word() for _ in range(r.randint(1, 12)))) for i in range(12)] + [(50, docs[0][1]), (50, docs[0][1]), (51, "nowhere"), (None, "a1 b1 a1")]
    df = spark.createDataFrame([(k, t, None, None, None) for k, t in docs], SCHEMA).repartition(3)
    assert ranked(df, spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items)


def test_odd_rows(spark, odd, none):
    items = [(1, "One two DOG"), (2, None), (3, ""), (4, "..."), (5, "日本語 één"), (6, "word7919 the the The")]
    asked = spark.createDataFrame(items, "item_id int, text string")
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert ranked(odd.withColumn("item_id", odd.doc_id).withColumn("n", odd.text), asked) == brute(rows, items)
    assert ranked(odd, asked, best=1) == brute(rows, items, 1)
    assert ranked(none, asked) == ranked(odd, asked.limit(0)) == []
    assert [f.dataType.simpleString() for f in B.search(none, asked).schema] == ["int", "int", "bigint", "bigint"]


def test_terms():
    text = "Aa_b9éÀ{ſ}\x00ß\U0001f600z\x7f-Q r\u0085s"
    assert [t.decode() for t in B.terms(text.encode())] == TERM.findall(text.translate(LOWER))


def tree_of(r, n, n_terms, copies=0):
    counts = r.integers(0, 30, n)
    term = np.concatenate([np.sort(r.choice(n_terms, c, replace=False)) for c in counts] or [np.zeros(0, int)]).astype(np.int64)
    rows = B.Rows(term, r.integers(1, 1_000_000, len(term)), counts)
    df = np.bincount(term, minlength=n_terms)
    return B.Tree(rows, B.term_bands(df)), rows


def test_bounds_hold_at_every_node_and_prune():
    r = np.random.default_rng(2)
    for n in (1, 5, 17, 300):
        tree, rows = tree_of(r, n, 80)
        some = [np.sort(r.choice(80, c, replace=False)) for c in (1, 4, 20)]
        weights = [r.integers(0, 12_000, len(t)) for t in some]
        bounds = tree.bounds(some, weights)
        for i, (t, w) in enumerate(zip(some, weights, strict=True)):
            q = np.zeros(80, np.int64)
            q[t] = w
            score = tree.rows.sums(tree.rows.x * q[tree.rows.term])
            for node, (a, b) in enumerate(tree.nodes):
                assert score[a:b].max() <= bounds[node, i]
            found, s, opened = tree.search(q, bounds[:, i], 1, 3)
            want = np.sort(rows.sums(rows.x * q[rows.term]))[::-1]
            got = np.sort(s)[::-1][:3]
            assert (got == want[want > 0][:3]).all()
    # documents of two kinds: the subtrees of the other kind stay closed
    term = np.concatenate([np.arange(10) + (0 if i < 256 else 40) for i in range(512)])
    rows = B.Rows(term, np.full(len(term), 500_000) + np.arange(len(term)) % 97, np.full(512, 10))
    tree = B.Tree(rows, B.term_bands(np.bincount(term, minlength=80)))
    q = np.zeros(80, np.int64)
    q[40:45] = 9_000
    assert tree.search(q, tree.bounds([np.arange(40, 45)], [q[40:45]])[:, 0], 1, 20)[2] <= 256 // B.LEAF * 2
