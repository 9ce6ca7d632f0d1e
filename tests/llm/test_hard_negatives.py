import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringwise.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, low=80):
    """All anchors with all rows, in plain integers."""
    def whole(x):
        return x is not None and math.isfinite(x)

    good = [(i, v, [math.floor(256 * float(x)) for x in q], c) for i, (v, q, c) in enumerate(rows) if c is not None and q is not None and all(map(whole, q))]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    out = []
    for i, v, q, c in good:
        if v is None or v % 100:
            continue
        score = sorted(((sum(a * b for a, b in zip(q, w, strict=False)), u, j, d) for j, u, w, d in good if j != i), key=order)
        for nth, (s, u, _, _) in enumerate([x for x in score if x[3] == c][:k], 1):
            fits = [x for x in score if x[3] != c and low * s <= 100 * x[0] <= 100 * s][:k]
            out += [(v, u, nth, r, x[1], s, x[0]) for r, x in enumerate(fits, 1)]
    return sorted(map(str, out))


def mined(df, **more):
    out = H.mine(df, F.col("vec_id") % 100 == 0, **more)
    assert out.columns == ["anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(str(tuple(r)) for r in out.collect())


def as_floats(rows):
    return [(v, None if q is None else [None if x is None else float(np.float32(x)) for x in q], c) for v, q, c in rows]


@pytest.mark.parametrize("tile", [1 << 16, 70])
def test_random_rows_with_ties(spark, monkeypatch, tile):
    monkeypatch.setattr(H, "BLOCK_ROWS", 32)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", 3)
    r = random.Random(3)
    pool = [[r.uniform(-1, 1) for _ in range(8)] for _ in range(40)]
    rows = as_floats([(i * 10 % 2_000, r.choice(pool), r.randint(0, 2)) for i in range(300)])
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(3), tile=tile) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25], 1), (0, [0.5, 0.25], 1), (100, [-0.5, -0.25], 1), (1, [0.5], 1), (2, [0.5, 0.24], 2), (2, [0.5, 0.24], 2), (None, [0.5, 0.24], 2),
            (3, [0.49, 0.25], None), (4, None, 2), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (8, [None, 1.0], 2), (200, [], 3), (9, [], 3), (10, [0.45, 0.3], 3)]
    rows = as_floats(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("row", F.lit("x")).repartition(2)
    assert mined(df) == brute(rows)
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame(rows[3:5], SCHEMA)) == []  # no anchors
    with pytest.raises(ValueError):
        H.mine(spark.createDataFrame([(0, [3e9], 1)], SCHEMA), F.lit(True))


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label")
    assert mined(df) == brute([tuple(r) for r in df.collect()])


def test_residues_give_exact_products():
    r = np.random.default_rng(1)
    for top, width in ((3, 5), (256, 64), (30_000, 3_000), (1 << 21, 700)):
        a, b = r.integers(-top, top + 1, (7, width)), r.integers(-top, top + 1, (9, width))
        a[0], b[0], b[1] = top, top, -top
        primes = H.primes_for(width * top * top)
        assert all(p < 256 and all(p % d for d in range(2, p)) for p in primes)
        got = H.scores([H.residues(a, p) for p in primes], [H.residues(b, p) for p in primes], primes)
        assert (got == (a.astype(object) @ b.T.astype(object))).all()
