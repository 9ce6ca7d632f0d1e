"""Mixing sources to target weights by Pareto order sampling (Rosén 1997).

A source's target in words is its weight's share of ``share`` times all words, at most ``most``
times its own words; what is cut off goes to the others by weight until none is above. With
r = target / words, every document is allocated floor(r) certain whole copies. The rest of the
target is filled by one fixed-size sample without replacement a source: document i has the
inclusion probability p_i, which grows with its size to the power ``tilt``, and the rank
[u_i / (1 - u_i)] / [p_i / (1 - p_i)] with u_i a seeded hash of the document in (0, 1). The
documents of lowest rank are taken until their words reach the rest of the target, to half a
document.

No source is ever sorted as a whole: words are summed per source and per interval of the rank,
the interval that holds the end of the sample is found from these sums (at most ``INTERVALS``
rows a source), and only its documents are ordered.

Defined cases: a null text has no words, and nothing is taken of it; a null source is a source,
the last in order; rows that are equal in key and text have equal ranks, and their order among
them is arbitrary; an empty table gives no rows; input columns named like those that the operator
adds are replaced by them, all others are kept. Equal input gives an equal mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwise.llm.common import Scratch, others, words

ADDED = ("size", "source_size", "target", "copies", "taken")
INTERVALS = 1 << 16


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, source_size) -> with target: one row a source throughout."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    by_cap = Window.orderBy("cap_level", F.col("source").asc_nulls_last())
    sized = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    sized = sized.withColumn("cap_level", F.col("cap") / F.col("weight"))
    # the sources with the lowest cap / weight are capped first; the level of the others is what is left over their weights
    upto = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum(
        "weight"
    ).over(rest)
    leveled = sized.withColumn("level", level)
    # the first source in order whose level is within its cap sets the level of all from there on
    first = F.min(F.when(F.col("level") <= F.col("cap_level"), F.struct("cap_level", "level"))).over(everything)
    fits = first["level"]
    return leveled.select(
        "source", "source_size", F.least("cap", F.col("weight") * F.coalesce(fits, F.col("cap_level"))).alias("target")
    )


def _rank(key: Column, text: Column, inclusion: Column, seed: int) -> Column:
    """Pareto rank q mapped to q / (1 + q), which keeps the order and lies in (0, 1)."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, text), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    p = F.least(F.greatest(inclusion, F.lit(1e-12)), F.lit(1 - 1e-12))
    left, right = u * (1 - p), p * (1 - u)
    return left / (left + right)


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    tilt: float = 0.5,
    seed: int = 77,
) -> DataFrame:
    """Input columns, ``size``, ``source_size``, ``target``, ``copies`` (int) and ``taken`` words a document.

    ``weights`` go to the sources in order of their names, over and over; ``tilt`` 0 gives all
    documents of a source the same probability. ``most`` must be a whole number.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    kept = others(docs, *ADDED)
    n_words = F.size(words(F.col(text))).cast("long")
    light = docs.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("text"), F.col(source).alias("source"), n_words.alias("size")
    )
    light = scratch.save(light, "light")
    tilted = F.pow(F.col("size").cast("double"), F.lit(float(tilt)))
    sums = light.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * tilted).alias("tilted"))
    sums = scratch.save(sums, "sums")
    plan = targets(sums.select("source", "source_size"), list(weights), share, most).withColumnRenamed("source", "plan_source")
    plan = (
        plan.join(sums.select("source", "tilted"), F.col("plan_source").eqNullSafe(F.col("source")))
        .withColumn("whole", F.least(F.coalesce(F.floor(F.col("target") / F.col("source_size")), F.lit(0)), F.lit(int(most))).cast("int"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("per", F.coalesce(F.col("rest") / F.col("tilted"), F.lit(0.0)))
        .select("plan_source", "source_size", "target", "whole", "rest", "per")
    )
    plan = scratch.save(plan, "plan")

    def ranked(df: DataFrame, key_col: Column, hashed: Column) -> DataFrame:
        q = _rank(key_col, hashed, F.col("per") * tilted, seed)
        return df.withColumn("__q", q).withColumn("__interval", F.floor(F.col("__q") * INTERVALS))

    same = F.col("source").eqNullSafe(F.col("plan_source"))
    # sources whose whole copies meet the target take no sample
    sampled = light.join(plan.where("rest > 0.5"), same)
    by_interval = ranked(sampled, F.col("key"), F.col("text")).groupBy("plan_source", "rest", "__interval").agg(
        F.sum("size").alias("words")
    )
    upto = Window.partitionBy("plan_source").orderBy("__interval")
    cut = (
        by_interval.withColumn("__upto", F.sum("words").over(upto))
        .where(F.col("__upto") >= F.col("rest"))
        .groupBy("plan_source")
        .agg(F.min_by(F.struct(F.col("__interval").alias("cut"), (F.col("__upto") - F.col("words")).alias("before")), "__interval").alias("at"))
        .select(F.col("plan_source").alias("cut_source"), "at.*")
    )
    plan = plan.join(cut, F.col("plan_source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    plan = scratch.save(plan, "plan_with_cut")

    # columns by number, so that those that the caller leaves out are not carried along
    full = docs.select(*[F.col(c).alias(f"__in{i}") for i, c in enumerate(kept)], F.col(source).alias("source"), n_words.alias("size"), F.col(key).alias("key"), F.xxhash64(text).alias("hashed"))
    joined = ranked(full.join(plan, same), F.col("key"), F.col("hashed"))
    at_cut = F.col("cut").isNotNull() & (F.col("__interval") == F.col("cut"))
    ordered = Window.partitionBy("plan_source").orderBy("__q", "key", "hashed")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a document is in while its middle lies before the end; intervals past the cut are out, those before it are in
    clear = joined.where(~at_cut).withColumn("__extra", F.coalesce(F.col("__interval") < F.col("cut"), F.col("rest") > 0.5))
    edge = joined.where(at_cut).withColumn(
        "__extra", F.col("before") + F.sum("size").over(running) - F.col("size") / 2.0 <= F.col("rest")
    )
    copies = (F.col("whole") + F.col("__extra").cast("int")).cast("int")
    both = clear.unionByName(edge).withColumn("copies", F.least(copies, F.lit(int(most))))
    return both.select(
        *[F.col(f"__in{i}").alias(c) for i, c in enumerate(kept)],
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def materialised(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: a row for each copy taken."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)
