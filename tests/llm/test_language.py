import zlib

import numpy as np
from pyspark.sql import functions as F

from ringwise.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).collect()
    out = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and r["lang"] is not None]
    assert len(rows) == docs.count() and len(out) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_fold(spark):
    df = spark.range(200).selectExpr("id as doc_id").withColumn("held", language.held_out(F.col("doc_id")))
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in df.collect())


def test_filter_holds_its_grams_and_corrects_false_ones():
    rng = np.random.default_rng(2)
    sets = {k: rng.integers(0, 1 << 40, 5_000, dtype=np.uint64) for k in ("aa", "bb", "cc")}
    f = language.Filters.build(sets, 1 << 14, 3)
    for bit, name in enumerate(sorted(sets)):
        mask = None
        for at in language.cells(sets[name], 1 << 14, 3):
            mask = f.table[at] if mask is None else mask & f.table[at]
        assert ((mask >> np.uint8(bit)) & np.uint8(1)).all()
    noise = rng.integers(97, 123, 200_000).astype(np.uint8)
    hits, counts = f.hits(noise, np.array([0, 100_000, 200_000]))
    raw = counts[0] * f.false_rate
    assert (raw > 1_000).all() and (hits[0] < 0.1 * raw).all()


def test_grams_match_a_plain_version():
    texts = ["", "a", "Ab, é 12", "x" * 9]
    bodies = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, bodies)])
    codes, counts = language.grams(np.frombuffer(b"".join(bodies), np.uint8), offsets)
    want = []
    for b in bodies:
        padded = b"  " + bytes(language.FOLD[list(b)]) + b"  "
        want.append([int.from_bytes(padded[i : i + 5], "big") for i in range(len(padded) - 4)])
    assert counts.tolist() == [len(w) for w in want] and codes.tolist() == [c for w in want for c in w]


def test_odd_rows(odd, none):
    got = {r["doc_id"]: r for r in language.identify(odd.withColumn("score", F.lit("clash"))).collect()}
    assert [got[k]["lang_pred"] for k in (4, 5, 6, 10)] == ["und"] * 4 and got[4]["score"] == 0
    assert {r["lang_pred"] for r in got.values()} <= {"en", "nl", "und"} and got[8]["lang_pred"] == "en"
    assert language.identify(none).collect() == []
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}


def test_more_than_64_languages(spark):
    rng = np.random.default_rng(5)
    own = {f"l{k:03}": ["".join(chr(97 + c) for c in rng.integers(0, 26, 8)) for _ in range(30)] for k in range(130)}
    rows = [(k * 10 + i, " ".join(rng.choice(words, 20)), name) for k, (name, words) in enumerate(own.items()) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.predict(df, language.learn(df)).collect()
    assert len(out) == len(rows) and all(r["lang_pred"] == r["lang"] and 0 < r["score"] <= 1 for r in out)
