import pytest

from ringwise.llm import mixing
from tests.llm import brute
from tests.llm.conftest import odd_rows


def sizes_of(rows):
    out = {}
    for r in rows:
        out[r[3]] = out.get(r[3], 0) + len(brute.words(r[1]))
    return out


def test_targets_and_taken(small):
    df, rows = small
    rows = [(k, t, lang, s) for k, t, lang, s in rows]
    got = mixing.mix(df).collect()
    sizes = sizes_of(rows)
    want = brute.mix_targets(sizes)
    largest = {}
    taken = {}
    for r in got:
        assert r["size"] == len(brute.words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    for s, t in taken.items():
        assert abs(t - want[s]) <= largest[s] / 2 + 1
    again = {r["doc_id"]: r["copies"] for r in mixing.mix(df.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in got}


def test_odd_rows(odd):
    got = mixing.mix(odd).collect()
    want = brute.mix_targets(sizes_of(odd_rows()))
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in odd_rows())
    assert all(abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]) and 0 <= r["copies"] <= 2 for r in got)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1_000, "c": 3, None: 50}, {"a": 0, "b": 7}, {"x": 5}])
def test_water_filling(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df, [3, 1, 2], 1.5, 2.0).collect()}
    want = brute.mix_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 * max(1, want[k]) for k in want)


def test_inclusion_grows_with_size(spark):
    rows = [(i, "w " * (1 if i % 2 else 16), "s" if i < 2_000 else "t") for i in range(2_600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for tilt, low, high in ((0.0, 0.8, 1.25), (0.5, 2.5, 5.5)):
        out = mixing.mix(df, weights=(1, 9), tilt=tilt).where("source = 's'").groupBy("size").avg("copies").collect()
        rate = {r["size"]: r["avg(copies)"] for r in out}
        assert low < (rate[16] - 1) / (rate[1] - 1) < high  # all have one whole copy


def test_empty_and_copies(none, odd):
    assert mixing.mix(none).collect() == []
    mixed = mixing.mix(odd.withColumnRenamed("n_chars", "copies"))
    rows = mixing.materialised(mixed, ["doc_id", "text"]).count()
    assert rows == mixed.agg({"copies": "sum"}).first()[0]
