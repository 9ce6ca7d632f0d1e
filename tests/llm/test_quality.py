import numpy as np
from pyspark.sql import functions as F

from ringwise.llm import quality
from tests.llm import brute
from tests.llm.conftest import odd_rows


def test_base_counts(odd, small):
    df, rows = small
    got = {r["doc_id"]: tuple(r[c] for c in quality.BASE) for r in quality.judge(df).collect()}
    assert got == {k: brute.quality_counts(t) for k, t, _, _ in rows}
    out = quality.judge(odd.withColumn("kept", F.lit("clash")))
    got = sorted(str((r["doc_id"], *(r[c] for c in quality.BASE))) for r in out.collect())
    assert got == sorted(str((r[0], *brute.quality_counts(r[1]))) for r in odd_rows())


def test_verdict_equals_a_plain_version(spark):
    """The whole estimate in numpy, on the features that Spark made."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality.with_features(quality.with_base(df)).select("doc_id", "lang", "source", "base_failed", *quality.FEATURES).toPandas()
    verdict = quality.judge(df).toPandas().set_index("doc_id")
    good = rows[~rows.base_failed]
    own = good.groupby(["lang", "source"]).doc_id.transform("count") >= 50
    small = good[~own]
    pooled = small.groupby("lang").doc_id.transform("count") >= 50
    group = (good.lang + "/" + good.source).where(own, good.lang.where(pooled.reindex(good.index, fill_value=False), "*"))
    floors = np.diag(np.square(quality.FLOORS))
    wrong = 0
    for name, part in good.groupby(group):
        x = part[list(quality.FEATURES)].to_numpy()
        if len(x) < 50:
            assert verdict.kept[part.doc_id].all()
            continue
        centre = np.array([np.sort(c)[(len(c) + 1) // 2 - 1] for c in x.T])
        mad = np.array([np.sort(c)[(len(c) + 1) // 2 - 1] for c in np.abs(x - centre).T])
        d2 = (((x - centre) ** 2) / ((1.4826 * mad) ** 2 + np.square(quality.FLOORS))).sum(axis=1)
        for _ in range(8):
            near = x[d2 <= np.sort(d2)[int(np.ceil(0.75 * len(d2))) - 1]]
            mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) + floors
            d2 = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)
        wide = np.cov(near.T, bias=True) * quality.consistency(0.75) + floors
        d2 = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(wide), x - mean)
        inner = x[d2 <= quality.chi_square_quantile(0.975, 4)]
        mean, cov = inner.mean(axis=0), np.cov(inner.T, bias=True) * quality.consistency(0.975) + floors
        d2 = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)
        wrong += int((verdict.kept[part.doc_id].to_numpy() != (d2 <= quality.chi_square_quantile(0.9999, 4))).sum())
    assert wrong <= 2  # the loops may stop a step apart
    assert not verdict.kept[rows[rows.base_failed].doc_id].any()


def test_clean_stay_and_junk_goes(spark):
    r = np.random.default_rng(4)
    word = lambda: "".join(chr(97 + c) for c in r.integers(0, 26, r.integers(2, 9)))
    rows = [(i, " ".join(word() for _ in range(int(r.integers(40, 400)))), "en", "web") for i in range(300)]
    rows += [(1_000 + i, " ".join(word() + "###$$" for _ in range(200)), "en", "web") for i in range(30)]
    rows += [(2_000 + i, "\n".join(["a line that comes again and again"] * 3 + [" ".join(word() for _ in range(60))] * 1), "en", "rare") for i in range(5)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(300)) and not any(got[1_000 + i] for i in range(30))


def test_quantiles_and_empty(none):
    assert abs(quality.chi_square_quantile(0.95, 4) - 9.4877) < 1e-3 and abs(quality.chi_square_quantile(0.975, 6) - 14.4494) < 1e-3
    assert quality.judge(none).collect() == []
