"""Quality rules: robust multivariate outliers.

Per document, counts of words, symbols, repeated lines and repeated eight-word windows become
four transformed statistics (``FEATURES``). For each language and source, the location and scatter
of minimum covariance determinant are estimated: from medians and median absolute deviations as
the start, the ``core`` share of documents nearest by Mahalanobis distance gives mean and
covariance, which give new distances, until the determinants stop falling (``steps`` at most). The
covariance is made consistent for normal data, a reweighted estimate over all documents within the
``inner`` quantile follows, and documents beyond the ``outer`` quantile of the chi-square law are
rejected. ``FLOORS`` are added to the variances, as most documents have no symbols or repeats.

A group with fewer than ``least`` documents is pooled with the other small ones of its language,
then of all languages; what is still smaller rejects nothing. Documents that fail the base rule
take no part in the estimates.

Only DataFrame functions run; groups are only ever aggregated (sums and mergeable quantile
sketches), never gathered, so a hot one costs no more than its rows. Defined cases: a null text has
no words and fails the base rule; null languages and sources form groups of their own; repeated
rows count each; equal distances get equal verdicts; an empty table gives no rows; other input
columns with clashing names are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwise.llm.common import Scratch, others, words

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
FEATURES = ("x0", "x1", "x2", "x3")
#: Least standard deviations: mean word length (log), symbols (log), repeated lines, repeated words.
FLOORS = (0.05, 0.5, 0.05, 0.05)
SYMBOLS = "#*$%&|<>"
#: Groups whose estimates (some 200 bytes each) are broadcast.
FEW_GROUPS = 50_000
WINDOW = 8
D = len(FEATURES)


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts and the base rule. Steps are columns of their own so that none is evaluated twice."""
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("__text", body).withColumn("__words", F.transform(words(F.col("__text")), lambda w: F.xxhash64(w)))
    n = F.size("__words")
    blanks = F.length("__text") - F.length(F.translate("__text", " \t\n\x0b\x0c\r", ""))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("__lines", lines)
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(WINDOW)]))
    df = df.withColumn("__windows", F.when(n >= WINDOW, windows))
    # only texts that repeat a window have their windows sorted
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    sorted_windows = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("__sorted", F.when(repeats, sorted_windows))
    again = F.filter(
        "__sorted",
        lambda x, j: F.coalesce((j > 0) & (F.get("__sorted", j - 1)["h"] == x["h"]), F.lit(False))
        | F.coalesce(F.get("__sorted", j + 1)["h"] == x["h"], F.lit(False)),
    )
    df = df.withColumn("__at", F.sort_array(F.transform(again, lambda x: x["i"])))
    # a repeated window covers its words up to the next repeated one
    covered = F.transform("__at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("__at", j + 1) - p, F.lit(WINDOW))))
    df = df.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, c: a + c), F.lit(0)).cast("long"))
    df = df.withColumn("n_words", n.cast("long")).withColumn("word_chars", (F.length("__text") - blanks).cast("long"))
    df = df.withColumn("n_symbols", (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long"))
    df = df.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    df = df.withColumn("__n_lines", F.size("__lines"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("__text", "__words", "__lines", "__windows", "__sorted", "__at")


def with_features(df: DataFrame) -> DataFrame:
    """The transformed statistics; short texts are drawn to usual values, as their means vary more."""
    n = F.col("n_words")
    return df.withColumns(
        {
            "x0": F.log((F.col("word_chars") + 500.0) / (n + 100.0)),
            "x1": F.log1p(100.0 * F.col("n_symbols") / (n + 100.0)),
            "x2": F.col("n_dup_lines") / (F.col("__n_lines") + 5.0),
            "x3": F.col("n_repeat_words") / (n + 100.0),
        }
    ).drop("__n_lines")


def chi_square(x: float, d: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(d // 2))


def chi_square_quantile(p: float, d: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, d) < p else (lo, mid)
    return hi


def consistency(p: float) -> float:
    """Factor for the covariance of the share p of normal data that lies nearest."""
    return p / chi_square(chi_square_quantile(p, D), D + 2)


def pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(D) for j in range(i + 1)]


def estimates(rows: DataFrame, factor: float) -> DataFrame:
    """Mean m_i and Cholesky factor l_ij of the covariance of each group, with the log determinant."""
    sums = rows.groupBy("group").agg(
        F.count("*").alias("n"),
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(D)],
        *[F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in pairs()],
    )
    floor = lambda i, j: FLOORS[i] ** 2 if i == j else 0.0
    cov = sums.withColumns(
        {f"c{i}{j}": F.greatest((F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")), F.lit(0.0)) * factor + floor(i, j) if i == j else (F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * factor for i, j in pairs()}
    )
    for i, j in pairs():
        rest = F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        cov = cov.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    det = sum((F.log(F.col(f"l{i}{i}")) for i in range(D)), F.lit(0.0))
    return cov.select("group", "n", *[f"m{i}" for i in range(D)], *[f"l{i}{j}" for i, j in pairs()], det.alias("log_det"))


def of_groups(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Rows joined with a written table of one row a group.

    Up to ``FEW_GROUPS`` groups it is sent to all tasks, so that rows need not be dealt by group; beyond that, both
    sides are shuffled, and adaptive execution splits a hot group.
    """
    return rows.join(F.broadcast(table) if table.count() <= FEW_GROUPS else table, "group", how)


def with_distance(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` by forward substitution; null without an estimate."""
    df = of_groups(rows, fit, "left")
    for i in range(D):
        rest = F.col(f"x{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        df = df.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(D)), F.lit(0.0))
    return df.withColumn("d2", d2).select(*rows.columns, "d2")


def fit_groups(rows: DataFrame, scratch: Scratch, core: float, inner: float, steps: int) -> DataFrame:
    """MCD estimates of each group of rows (group, x0..)."""
    # written: beside an aggregate on its own key, a hot group's rows could not be split in the join
    centre = scratch.save(rows.groupBy("group").agg(*[F.percentile_approx(f"x{i}", 0.5, 10_000).alias(f"m{i}") for i in range(D)]), "centre")
    apart = of_groups(rows, centre)
    spread = apart.groupBy("group").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(D)],
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 10_000).alias(f"mad{i}") for i in range(D)],
    )
    zero = {f"l{i}{j}": F.lit(0.0) for i, j in pairs() if i != j}
    scale = {f"l{i}{i}": F.sqrt((1.4826 * F.col(f"mad{i}")) ** 2 + FLOORS[i] ** 2) for i in range(D)}
    fit = scratch.save(spread.withColumns(zero | scale).select("group", *[f"m{i}" for i in range(D)], *[f"l{i}{j}" for i, j in pairs()]), "start")
    before = None
    for step in range(steps):
        far = with_distance(rows, fit)
        limit = scratch.save(far.groupBy("group").agg(F.percentile_approx("d2", core, 10_000).alias("limit")), f"limit{step}")
        near = of_groups(far, limit).where(F.col("d2") <= F.col("limit"))
        fit = scratch.save(estimates(near, 1.0), f"fit{step}")
        volume = fit.agg(F.sum("log_det")).first()[0]
        if before is not None and volume is not None and before - volume < 1e-3:
            break
        before = volume
    wide = scratch.save(estimates(near, consistency(core)), "wide")
    weighted = with_distance(rows, wide).where(F.col("d2") <= chi_square_quantile(inner, D))
    return scratch.save(estimates(weighted, consistency(inner)), "final")


def _groups(lang: Column, source: Column) -> Column:
    return F.concat_ws("|", F.coalesce(F.concat(F.lit("="), lang), F.lit("-")), F.coalesce(F.concat(F.lit("="), source), F.lit("-")))


def judge(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    core: float = 0.75,
    inner: float = 0.975,
    outer: float = 0.9999,
    least: int = 50,
    steps: int = 8,
) -> DataFrame:
    """Input columns but the text, the base counts, ``base_failed``, ``distance`` (squared) and ``kept``."""
    scratch = Scratch(docs.sparkSession, "quality")
    kept = others(docs, *BASE, "distance", "kept", text, "group", "n_in_group")
    rows = docs.select(
        F.struct(F.lit(0).alias("__"), *kept).alias("__row"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source")
    )
    rows = with_features(with_base(rows)).drop("text")
    rows = scratch.save(rows.select("__row", "lang", "source", *BASE, *FEATURES), "rows")
    counts = rows.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("n"))
    counts = counts.withColumn("own", F.when(F.col("n") >= least, _groups(F.col("lang"), F.col("source"))))
    pooled = counts.where("own is null").groupBy("lang").agg(F.sum("n").alias("pool")).withColumnRenamed("lang", "pool_lang")
    counts = counts.join(pooled, F.col("lang").eqNullSafe(F.col("pool_lang")), "left")
    of_lang = F.when(F.col("pool") >= least, _groups(F.col("lang"), F.lit("*pool")))
    counts = counts.select("lang", "source", F.coalesce("own", of_lang, F.lit("*")).alias("group"))
    counts = scratch.save(counts.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "group"), "groups")
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    grouped = scratch.save(rows.join(counts, same, "left").drop("g_lang", "g_source"), "grouped")
    used = grouped.where(~F.col("base_failed")).select("group", *FEATURES)
    fit = fit_groups(used, scratch, core, inner, steps).where(F.col("n") >= min(least, 2 * D))
    small = used.groupBy("group").agg(F.count("*").alias("size")).where(F.col("size") < least).select("group")
    fit = scratch.save(fit.join(small, "group", "left_anti"), "fit")
    verdict = with_distance(grouped, fit)
    inside = F.coalesce(F.col("d2") <= chi_square_quantile(outer, D), F.lit(True))
    return verdict.select(
        *[F.col("__row")[c].alias(c) for c in kept], *BASE, F.col("d2").alias("distance"), (~F.col("base_failed") & inside).alias("kept")
    )
