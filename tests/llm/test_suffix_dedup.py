import random
from collections import Counter

import numpy as np
import pytest

from ringwise.llm import common
from ringwise.llm import suffix_dedup as S
from tests.llm import brute
from tests.llm.conftest import SCHEMA, odd_rows


def rows_of(df):
    return sorted((r["doc_id"] is None, r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def expected(rows):
    found = brute.suffix_dedup([r[1] for r in rows])
    return sorted((r[0] is None, r[0], *f) for r, f in zip(rows, found, strict=True))


def test_odd_rows(odd):
    assert rows_of(S.dedup(odd)) == expected(odd_rows())


def test_documents(small):
    df, rows = small
    assert rows_of(S.dedup(df)) == expected(rows)


def test_planted_passages_of_all_lengths(spark):
    r = random.Random(5)
    alphabet = "abcdé \n"
    passages = ["".join(r.choice(alphabet) for _ in range(n)) for n in (270, 330, 380, 395, 400, 401, 410, 450, 700, 1500)]
    rows = []
    for i in range(60):
        parts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 300)))]
        for _ in range(r.randint(1, 3)):
            p = r.choice(passages)
            a = r.randint(0, 20)
            parts += [p[a:], "".join(r.choice(alphabet) for _ in range(r.randint(0, 90)))]
        rows.append((i, "".join(parts), None, None, None))
    rows += [(100, "ab" * 600, None, None, None), (101, "z" * 399, None, None, None), (102, "z" * 401, None, None, None), (103, "y" * 400, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert rows_of(S.dedup(df)) == expected(rows)


def test_segments_do_not_show(monkeypatch):
    r = np.random.default_rng(3)
    raw = r.integers(97, 101, 9_000).astype(np.uint8)
    raw[4_000:5_200] = raw[100:1_300]
    offsets = np.array([0, 3_000, 3_000, 3_100, 9_000])
    whole = S.sampled(raw, offsets)
    names = S.window_names(raw, np.arange(0, 2_000, 7))
    monkeypatch.setattr(S, "SEGMENT", 512)
    for a, b in zip(whole, S.sampled(raw, offsets), strict=True):
        assert (a == b).all()
    for a, b in zip(names, S.window_names(raw, np.arange(0, 2_000, 7)), strict=True):
        assert (a == b).all()


def test_kept_text_and_other_columns(spark):
    p = "".join(chr(97 + (i * i) % 23) for i in range(450))
    df = spark.createDataFrame([(1, "head " + p + " é", 7), (2, p + " tail", 8)], "doc_id long, text string, n_bytes long")
    out = {r["doc_id"]: r for r in S.dedup(df, keep_text=True).collect()}
    # the space after it repeats with it
    assert out[1]["kept_text"] == "head é" and out[2]["kept_text"] == "tail"
    assert out[1]["n_bytes"] == 5 + 450 + 3 and out[1]["n_removed"] == 451


def test_empty_and_bad_width(none):
    assert S.dedup(none).collect() == []
    with pytest.raises(ValueError):
        S.dedup(none, width=100)


@pytest.mark.parametrize("together", [20_000, 3])
def test_names_dealt_over_several_tasks(spark, monkeypatch, together):
    """Copies of two texts with edits: one name has many positions, and most have an edit near them."""
    monkeypatch.setattr(S, "TOGETHER", together)
    r = random.Random(8)
    bases = ["".join(r.choice("abcdefgh ") for _ in range(2_500)) for _ in range(2)]
    rows = []
    for i in range(60):
        t = list(r.choice(bases))
        for _ in range(r.randint(0, 5)):
            p = r.randrange(len(t))
            t[p : p + 1] = r.choice(["", "XY", "é"])
        rows.append((i, "".join(t), None, None, None))
    assert rows_of(S.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3))) == expected(rows)


def test_runs_and_passages_of_words(spark, odd, small):
    r = random.Random(6)
    words = [f"w{i}" for i in range(900)]
    passage = [r.choice(words) for _ in range(120)]
    rows = [(i, " ".join([r.choice(words) for _ in range(r.randint(0, 80))] + passage[a : a + n] + [r.choice(words) for _ in range(30)]), None, None, None)
            for i in range(40) for a, n in [(r.randint(0, 40), r.choice((30, 49, 50, 51, 52, 80)))]]
    rows += [(100, "\n\t" + "\r\n ".join(passage) + " \n", None, None, None), (101, " ".join(passage[:50]), None, None, None), (102, None, "en", None, 3), (103, "", None, None, 0)]
    rows += [(104, " ".join(passage), None, None, None), (104, " ".join(passage), None, None, None)]
    got = S.without_passages(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want = brute.without_passages([x[1] for x in rows])
    assert sorted(str((x["doc_id"], x["text"], x["lang"])) for x in got.collect()) == sorted(str((x[0], t, x[2])) for x, t in zip(rows, want, strict=True))
    assert [x["text"] for x in S.without_passages(odd.where("doc_id is null")).collect()] == ["a row without an id but with words in it"]
    df, given = small
    got = {x["doc_id"]: x for x in S.dedup(df, keep_spans=True).collect()}
    for k, t, _, _ in given:
        gone = set()
        for run in got[k]["removed"]:
            gone.update(range(run["start"], run["end"]))
        assert len(gone) == got[k]["n_removed"] and len(got[k]["removed"]) == got[k]["n_spans"]


def test_words_of_passages_shorter_than_the_width(spark, odd):
    """A passage of over 50 short words may have less than 400 bytes: the digest leaves it, ``n_passage_words`` tells of it."""
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"first {passage} end", None, None, None), (2, f"second\n{passage.replace(' ', '  ')}", None, None, None)]
    rows += [(3, " ".join(f"v{i}" for i in range(80)), None, None, None), (4, "the same " * 30, None, None, None), (5, "the same " * 30, None, None, None)]
    rows += [(6, None, None, None, None), (7, " ".join(f"w{i}" for i in range(50)), None, None, None), (3, "another row of that id", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for docs, texts in ((df, [x[1] for x in rows]), (odd, [x[1] for x in odd_rows()])):
        got = S.dedup(docs, keep_text=True, words=S.passage_words(docs))
        left = brute.without_passages(texts)
        want = Counter((len((a or "").encode()), len((a or "").split()) - len((b or "").split())) for a, b in zip(texts, left, strict=True))
        if docs is df:
            assert {r["doc_id"]: (r["n_removed"], r["n_passage_words"]) for r in got.where("doc_id <> 3").collect()} == {1: (0, 60), 2: (0, 60), 4: (0, 60), 5: (0, 60), 6: (0, 0), 7: (0, 0)}
        assert Counter((r["n_bytes"], r["n_passage_words"]) for r in got.collect()) == want


def test_query_tells_of_passages_of_words(spark, scratch_dir):
    from ringwise.llm.queries import QUERIES

    passage = " ".join(f"w{i}" for i in range(55))
    rows = [(1, f"a {passage}", None, None, None), (2, f"b {passage}", None, None, None), (3, "c", None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{scratch_dir}/documents.parquet")
    got = QUERIES["op1_suffix_array_dedup"](spark, scratch_dir).orderBy("doc_id")
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "n_passage_words"]
    assert [(r["n_removed"], r["n_passage_words"]) for r in got.collect()] == [(0, 55), (0, 55), (0, 0)]


def test_passages_are_named_by_words():
    """Only positions where words begin are sampled, so a passage costs a third of what the characters of its codes would."""
    assert S.reach_of(51) == (27, 24) and S.reach_of(400) == (243, 157)
    r = np.random.default_rng(4)
    raw = r.integers(65, 91, 3 * 6_000).astype(np.uint8)
    raw[3 * 3_000 : 3 * 3_100] = raw[3 * 100 : 3 * 200]
    symbols, offsets = S._symbols(raw, np.array([0, 3 * 2_500, 3 * 6_000]), 3)
    assert len(symbols) == 6_000 and len(np.unique(symbols)) > 4_000 and offsets.tolist() == [0, 2_500, 6_000]
    at, lo, hi, name = S.sampled(symbols, offsets, 51)
    assert len(at) < 6_000 / 10 and hi.max() <= 6_000 - 51 and (at - lo).max() < 24
    # every window is stood for once, and equal windows by positions of equal names
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi, strict=True)])
    assert sorted(starts.tolist()) == [*range(2_500 - 50), *range(2_500, 6_000 - 50)]
    named = dict(zip(starts.tolist(), np.repeat(name, hi - lo + 1).tolist(), strict=True))
    assert all(named[100 + i] == named[3_000 + i] for i in range(50)) and named[90] != named[2_990]
    # the least of any number of positions, not of powers of two alone
    nine, _ = S.triple_names(symbols, 27)
    bits = np.uint64(int(6_000).bit_length())
    for p in (0, 777, 2_449, 2_500, 5_949):
        assert at[np.searchsorted(lo, p, side="right") - 1] == p + int(np.argmin((nine >> bits)[p : p + 24]))


def test_texts_with_nothing_found_are_not_shuffled(spark, small, monkeypatch):
    """Where found texts are too many to be sent to all tasks, the join takes them alone; a bitmap that tells little changes nothing."""
    df, rows = small
    want = expected(rows)
    left = Counter(zip([x[0] for x in rows], brute.without_passages([x[1] for x in rows]), strict=True))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for bits in (common.BITS, 8):
            monkeypatch.setattr(common, "BITS", bits)
            parts = []
            monkeypatch.setattr(S, "split", lambda *a, f=common.split: parts.append(f(*a)) or parts[-1])
            assert rows_of(S.dedup(df)) == want
            named, clear = parts[-1]
            assert named.count() + clear.count() == len(rows) and (bits == 8 or 0 < named.count() < len(rows) / 2)
            assert Counter((r["doc_id"], r["text"]) for r in S.without_passages(df).collect()) == left
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
