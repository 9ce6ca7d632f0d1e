import hashlib

import pytest
from pyspark.sql import functions as F

from ringwise.llm import fingerprints
from tests.llm.brute import words
from tests.llm.conftest import odd_rows


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def edits(rows):
    """(doc_id, text, edited, next) in descending order; ties by key must hold equal texts."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]), reverse=True)
    texts = [r[1] or "" for r in rows]
    out = []
    for i, t in enumerate(texts):
        following, n = texts[(i + 1) % len(texts)], len(t) // 3
        out.append((rows[i][0], t, t[: len(t) - n] + following[:n], following))
    return out


@pytest.mark.parametrize("bucket_bytes", [8 << 20, 3_000])
def test_odd_rows(odd, bucket_bytes):
    got = fingerprints.compare(odd, bucket_bytes=bucket_bytes).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    want = sorted(((k, len(t), hashlib.sha256(e.encode()).hexdigest()) for k, t, e, _ in edits(odd_rows())), key=key)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key) == want
    prints = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints.setdefault(r["doc_id"], r["fingerprint"])
    assert prints[1] == prints[2] != "" and prints[4] == prints[5] == prints[6] == "" and prints[10] != ""


def test_likeness_is_near_the_truth(small):
    df, rows = small
    got = {r["doc_id"]: r for r in fingerprints.compare(df, bucket_bytes=100_000).collect()}
    off = []
    for k, t, e, following in edits(rows):
        a, b, c = shingle_set(t), shingle_set(e), shingle_set(following)
        assert got[k]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert abs(got[k]["near_next"] - len(a & c) / max(1, len(a | c))) < 0.25
        if len(a) > 200:
            off.append(abs(got[k]["near_edited"] - len(a & b) / len(a | b)))
            assert abs(got[k]["contained_in_edited"] - len(a & b) / len(a)) < 0.25
    assert sum(off) / len(off) < 0.05


def test_sketch_keeps_every_low_hash_and_merges(spark):
    texts = ["a b c d e f g h " * 3 + " ".join(map(str, range(300))), " ".join(map(str, range(200, 500)))]
    df = spark.createDataFrame([(t,) for t in [*texts, " ".join(texts)]], "text string")
    a, b, both = (set(r["s"]) for r in fingerprints.with_sketch(df, "text", "s", 4).collect())
    assert a | b <= both and len(both - a - b) <= 4
    lowest = -(1 << 63) + (1 << 62)
    assert all(h < lowest for h in both) and abs(len(both) / 520 - 0.25) < 0.08


def test_single_and_empty(spark, none):
    assert fingerprints.compare(none).collect() == []
    one = spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string").withColumn("fingerprint", F.lit(1))
    r = fingerprints.compare(one).first()
    assert r["n_chars"] == 11 and r["near_next"] == 1.0
    assert "fingerprint" in fingerprints.fingerprint(one.drop("fingerprint")).columns
