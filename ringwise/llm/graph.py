"""Connected components of links between long ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise.llm.common import Scratch


#: Edges that one task writes: small graphs need few tasks a round.
EDGES_A_TASK = 100_000


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, scratch: Scratch, label: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the least node that is reachable.

    Minima are written before they are joined to the edges, so that a hub's join is one of two
    written tables, which adaptive execution splits.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    tasks = -(-max(1, edges.count()) // EDGES_A_TASK)

    def save(df: DataFrame, step: str) -> DataFrame:
        return scratch.save(df.coalesce(tasks), f"{label}-{step}")

    now = save(pairs, "0")
    mark = _mark(now)
    for n in range(1, most_rounds + 1):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{n}-large")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = save(large, f"{n}-a")
        least = save(large.groupBy("u").agg(F.min("v").alias("m")), f"{n}-small")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = save(small, f"{n}")
        before, mark = mark, _mark(now)
        if mark == before:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
