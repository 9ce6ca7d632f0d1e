"""Skew-safe "how many rows of my group come after me" (a rank without a group window).

A window partitioned by the group key puts a whole group in one task; a group
holding a third of all rows would then be sorted by a single core. Here the
rows are sorted globally (range partitioning splits a hot group over many
partitions) and numbered inside each partition; windows then only span one
group *within one partition*. Only a group at a border of two partitions has rows in
more than one, so the counts that are carried to its earlier partitions are at most
twice as many as the partitions, which bounds their broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwise.operators.iterate import materialize


def later_in_group(df: DataFrame, group: list[str], order: str | list[str], weight: str | None = None, largest: bool = False) -> DataFrame:
    """``df`` plus ``later``: rows of the same group with a larger ``order`` value
    (or, with ``weight``, the sum of that column over those rows, or the ``largest`` of them; 0 without any).

    ``order`` must be unique within a group. No window exceeds one partition.
    """
    order = [order] if isinstance(order, str) else order
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    fold = F.max if largest else F.sum
    numbered = df.dropna(subset=group).orderBy(*group, *order)
    tagged, _ = materialize(numbered.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_pos")), "rank-sorted")
    # rows after me inside my (group, partition) slice: bounded by the partition size
    inside = Window.partitionBy(*group, "_part").orderBy(F.desc("_pos")).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumn("_after_here", F.coalesce(fold(w).over(inside), F.lit(0)))
    per_part = tagged.join(F.broadcast(border_groups(tagged, group)), group).groupBy(*group, "_part").agg(fold(w).alias("_n"))
    suffix = Window.partitionBy(*group).orderBy("_part").rowsBetween(1, Window.unboundedFollowing)
    later_parts = per_part.select(*group, "_part", F.coalesce(fold("_n").over(suffix), F.lit(0)).alias("_after_parts"))
    here, beyond = F.col("_after_here"), F.coalesce(F.col("_after_parts"), F.lit(0))
    return (
        local.join(F.broadcast(later_parts), [*group, "_part"], "left")
        .withColumn("later", (F.greatest(here, beyond) if largest else here + beyond).cast("long"))
        .drop("_part", "_pos", "_after_here", "_after_parts")
    )


def border_groups(sorted_rows: DataFrame, group: list[str]) -> DataFrame:
    """The groups of the first and the last row of each partition of sorted rows (with ``_part`` and ``_pos``).

    No other group can have rows in two partitions, so there are at most two a partition that matter.
    """
    ends = sorted_rows.groupBy("_part").agg(F.min("_pos").alias("a"), F.max("_pos").alias("b"))
    places = ends.select(F.explode(F.array("a", "b")).alias("_pos")).distinct()
    return sorted_rows.join(F.broadcast(places), "_pos").select(*group).distinct()
