import re
from collections import Counter

import corpus_pipeline as P
from ringwise.llm import common, language, mixing, packing
from ringwise.llm.common import Scratch
from tests.llm import brute
from tests.llm.test_packing import check


def test_stages_against_brute_force(spark, small):
    df, rows = small
    df = df.select(*P.COLUMNS)
    scratch = Scratch(spark, "test")
    steps = {}
    docs = df
    for name, stage in P.STAGES:
        docs = scratch.save(stage(spark, docs, "/root/testdata/sf0.001"), name)
        steps[name] = [r.asDict() for r in docs.collect()]
    # language ID: only texts without letters go, and the language found is carried on
    left = {r["doc_id"] for r in steps["language_id"]}
    assert left == {k for k, t, _, _ in rows if re.search(r"[^\W\d_]", t or "")}
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(df).collect()}
    assert all(r["lang"] == found[r["doc_id"]][0] and found[r["doc_id"]][1] > 0.25 for r in steps["language_id"])
    # near copies: the least id of each component stays
    first = [(r["doc_id"], r["text"]) for r in steps["language_id"]]
    component = brute.components(*zip(*first, strict=True))
    assert {r["doc_id"] for r in steps["ngram_jaccard_join"]} == {k for (k, _), (_, c) in zip(first, component, strict=True) if k == c}
    # passages of over 50 words: what is left is what brute force leaves
    second = {r["doc_id"]: r["text"] for r in steps["ngram_jaccard_join"]}
    left = dict(zip(second, brute.without_passages(list(second.values())), strict=True))
    assert {r["doc_id"]: r["text"] for r in steps["suffix_array_dedup"]} == left
    assert all(r["n_chars"] == len(r["text"]) for r in steps["suffix_array_dedup"]) and left != second
    # the mix: each document as often as the operator says, each source near its target
    third = spark.read.parquet(f"{scratch.base}/suffix_array_dedup")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(third).collect()}
    assert Counter(r["doc_id"] for r in steps["mixing_sources"]) == Counter({k: c for k, c in copies.items() if c})
    # packing: every id of every copy once
    last = [(r["doc_id"], r["text"]) for r in steps["mixing_sources"]]
    check(steps["packing"], *zip(*last, strict=True))


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is P.run and [n for n, _ in P.STAGES][-1] == "packing"
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    rows = P.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_language_decides(spark):
    """A corpus of two languages: labels that are wrong or missing are put right, texts in neither go."""
    english = "the quick brown fox jumps over the lazy dog while they were waiting for the weather of tomorrow "
    german = "der schnelle braune fuchs springt ueber den faulen hund und sie warteten auf das wetter von morgen "
    rows = [(i, (german if i % 2 else english) * (1 + i % 5), "de" if i % 2 else "en", "s", 9) for i in range(120)]
    rows += [(1_000, english, "de", "s", 9), (1_001, german, None, "s", 9), (1_002, "0123 4567 ...", "en", "s", 9), (1_003, "\u65e5\u672c\u8a9e " * 20, "en", "s", 9)]
    out = P.language_id(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "")
    got = {r["doc_id"]: r["lang"] for r in out.collect()}
    assert got[1_000] == "en" and got[1_001] == "de" and 1_002 not in got and 1_003 not in got
    assert all(got[i] == ("de" if i % 2 else "en") for i in range(120))


def test_workers_let_go_of_the_tokenizer_and_batches_are_bounded(spark, small):
    """Executors keep their Python workers from stage to stage; what packing holds must not stay beside the next stage's memory."""
    import public_tokenizers

    path, run = public_tokenizers.path("byte_bpe_50k.json"), lambda batches: batches
    packing.encoder(path)
    assert list(common.lean(run, holds=True)(iter([1]))) == [1] and packing.encoder(path) is packing.encoder(path)
    assert path in common.held and list(common.lean(run)(iter([1, 2]))) == [1, 2] and not common.held

    def seen(batches):
        """Rows of the batches, and whether the task that ran before in this worker left something."""
        for batch in batches:
            yield batch.from_pydict({"rows": [batch.num_rows], "held": [len(common.held)]})

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        P.language_id(spark, small[0].select(*P.COLUMNS), "")
        texts = spark.range(0, 4_000, 1, 1).selectExpr("repeat('x', 4000) AS text")
        got = texts.mapInArrow(common.lean(seen), "rows long, held long").collect()
        assert sum(r["rows"] for r in got) == 4_000 and max(r["rows"] for r in got) < 2_000 and not any(r["held"] for r in got)
    finally:
        spark.conf.unset(key)
