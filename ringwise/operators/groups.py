"""Edges that groups imply, without listing a pair, or listed evenly where they are the result (``listed_pairs``).

Who shares an address or a phone is an edge apart, the smaller id first. A table of *signed groups*
(id, value, sign) stands for these edges: one row for a member's address (+1), phone (+1) and for both
together (-1), so that a sum over the pairs of address and phone, less those that share both, counts each pair
once. What an algorithm needs of the pairs is then a prefix sum over a group's members in order of ids:

* ``sorted_members`` sorts all members by (value, id) once, by ranges, and writes them with their partition. A
  group of a third of all rows lies in several partitions.
* ``sums_before`` adds up a weight over the members of smaller (or larger) id: a window over a group's members of one
  partition, plus the totals of its other partitions. Only a group at a border of partitions has
  members in more than one, so there are at most twice as many such totals as partitions, which bounds their broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwise.operators.iterate import materialize
from ringwise.operators.ranking import border_groups

#: The kinds of contact that policyholders share.
CONTACTS = ("address", "phone")
#: Members of a block, when the pairs of a group are listed block by block.
BLOCK = 1000
#: Pairs that one task lists.
TASK_PAIRS = 2_000_000


def signed_contacts(policyholders: DataFrame) -> DataFrame:
    """(id, value, sign) of all holders with a contact: see the module."""
    one, other = CONTACTS
    both = F.when(
        F.col(one).isNotNull() & F.col(other).isNotNull(),
        # the length keeps apart what joins to equal strings
        F.struct(F.concat(F.lit("both:"), F.length(one).cast("string"), F.lit(":"), F.col(one), F.col(other)).alias("value"), F.lit(-1).alias("sign")),
    )
    single = [F.when(F.col(c).isNotNull(), F.struct(F.concat(F.lit(f"{c}:"), F.col(c)).alias("value"), F.lit(1).alias("sign"))) for c in CONTACTS]
    rows = policyholders.select(F.col("policyholder_id").alias("id"), F.explode(F.array(*single, both)).alias("g"))
    return rows.where(F.col("g").isNotNull()).select("id", "g.value", "g.sign")


def encode_groups(groups: DataFrame, index: DataFrame) -> DataFrame:
    """(vid, value, sign) of members that are vertices."""
    return groups.join(index, "id").select("vid", "value", "sign")


def shared_only(members: DataFrame) -> DataFrame:
    """Members (vid, value, sign, size) of the groups that have two or more; sizes are written, so a hot group's join is split."""
    sizes, _ = materialize(members.groupBy("value").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "group-sizes")
    return members.join(sizes, "value").select("vid", "value", "sign", "size")


@dataclass(frozen=True)
class SortedMembers:
    """Members (vid, value, sign, size, _part), written in order of value and vid; and those of groups in several partitions."""

    rows: DataFrame
    split: DataFrame


def sorted_members(members: DataFrame) -> SortedMembers:
    """``members`` (vid, value, sign, size) in order."""
    ordered = members.orderBy("value", "vid").select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_pos"))
    rows, _ = materialize(ordered, "group-members")
    split, _ = materialize(rows.join(F.broadcast(border_groups(rows, ["value"])), "value"), "group-split")
    return SortedMembers(rows, split)


def sums_before(members: SortedMembers, weights: DataFrame | None, later: bool = False, by_member: bool = False) -> DataFrame:
    """(vid, s): the signed sums, over a vertex's groups, of the weights of the members of smaller id (larger ones if ``later``).

    ``weights`` (vid, x) has a row for whoever counts; without it everyone counts one. ``by_member`` leaves a row for
    each group of a vertex, (vid, value, sign, size, s), unsigned.
    """

    def weighed(rows: DataFrame) -> DataFrame:
        if weights is None:
            return rows.withColumn("x", F.lit(1).cast("long"))
        return rows.join(weights, "vid", "left")

    order = F.desc("vid") if later else F.col("vid")
    here = Window.partitionBy("value", "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = weighed(members.rows).withColumn("local", F.coalesce(F.sum("x").over(here), F.lit(0)))
    across = Window.partitionBy("value").orderBy(F.desc("_part") if later else F.col("_part")).rowsBetween(Window.unboundedPreceding, -1)
    totals = weighed(members.split).groupBy("value", "_part").agg(F.sum("x").alias("t"))
    carried = totals.select("value", "_part", F.coalesce(F.sum("t").over(across), F.lit(0)).alias("carried"))
    s = F.col("local") + F.coalesce(F.col("carried"), F.lit(0))
    out = local.join(F.broadcast(carried), ["value", "_part"], "left")
    if by_member:
        return out.select("vid", "value", "sign", "size", s.alias("s"))
    return out.select("vid", (F.col("sign") * s).alias("s"))


def listed_pairs(policyholders: DataFrame, attributes: DataFrame | None = None, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(src, dst), src < dst, once for every two ids that share an address or phone; the list is the result here.

    With ``attributes`` (id unique, more columns), only ids that have a row take part, and ``src_at`` and ``dst_at`` hold
    the rest of their rows. A group's members are dealt into blocks, and each two blocks meet under a key of their own, either way, so a
    task has few cells of at most about ``BLOCK`` squared pairs, whatever a group's size. Of the values that two ids
    share, the first one alone gives the pair (addresses before phones): no pair is shuffled.
    """
    rows = policyholders.select(F.col("policyholder_id").alias("id"), *CONTACTS).where("id IS NOT NULL")
    if attributes is not None:
        rows = rows.join(attributes.select("id"), "id", "left_semi")
    kinds = [F.struct(F.lit(n).alias("kind"), F.col(c).alias("value")) for n, c in enumerate(CONTACTS)]
    contacts = rows.select("id", F.inline(F.array(*kinds))).where("value IS NOT NULL").distinct()
    sizes = contacts.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("kind", "value")
    groups, m = materialize(sizes.withColumn("gid", F.monotonically_increasing_id()), "pair-groups", {"pairs": F.sum(F.expr("n * (n - 1) div 2"))})
    members = contacts.join(groups, ["kind", "value"])
    held = members.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("gid", "kind", "n"))).alias("held"))
    at = F.lit(None).cast("boolean").alias("at")
    if attributes is not None:
        held, at = held.join(attributes, "id"), F.struct(*[c for c in attributes.columns if c != "id"]).alias("at")
    # an id has one address and one phone, unless its row repeats with others: ``more`` lists the groups then
    several = F.expr("size(filter(held, x -> x.kind = 0)) > 1 OR size(filter(held, x -> x.kind = 1)) > 1")
    each = held.select(
        "id", at, F.expr("IF(held[0].kind = 0, held[0].gid, NULL)").alias("one"), F.when(several, F.col("held.gid")).alias("more"), F.inline("held")
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    each, _ = materialize(each.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int")).drop("n"), "pair-members")
    tasks = max(1, min(-(-(m["pairs"] or 0) // task_pairs), 10_000))
    cell = ["gid", "i", "j"]
    others = F.explode(F.expr("sequence(0, blocks - 1)"))
    a = each.select("*", others.alias("j")).withColumnRenamed("block", "i").drop("blocks")
    b = each.select("id", "at", "one", "more", "gid", F.col("block").alias("j"), others.alias("i"))
    b = b.select(*cell, *[F.col(c).alias(f"{c}2") for c in ("id", "at", "one", "more")])
    # blocks of equal size meet: memory is that of a block of each side
    met = a.repartition(tasks, *cell).join(b.repartition(tasks, *cell).hint("merge"), cell)
    first = F.expr(
        "IF(more IS NULL AND more2 IS NULL, kind = 0 OR coalesce(one <> one2, true), "
        "array_min(array_intersect(coalesce(more, array(one, gid)), coalesce(more2, array(one2, gid)))) = gid)"
    )
    met = met.where(F.expr("id < id2") & first)
    pair = [F.col("id").alias("src"), F.col("id2").alias("dst")]
    return met.select(*pair) if attributes is None else met.select(*pair, F.col("at").alias("src_at"), F.col("at2").alias("dst_at"))


def _beside(members: DataFrame, ids: DataFrame, k: int, larger: bool) -> DataFrame:
    """(src, dst): the first ``k`` pairs of each of a few ids with members of larger, or of smaller, id."""
    mine = members.join(ids.select("id").distinct(), "id").select(F.col("id").alias("me"), "value")
    met = mine.join(members.select(F.col("id").alias("other"), "value"), "value")
    met = met.where(F.col("other") > F.col("me") if larger else F.col("other") < F.col("me"))
    # a pair that shares two values has one rank; ranks beyond k go before the shuffle
    first = met.withColumn("_nth", F.dense_rank().over(Window.partitionBy("me").orderBy("other"))).where(F.col("_nth") <= k)
    src, dst = ("me", "other") if larger else ("other", "me")
    return first.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()


def pairs_touching(members: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """The first ``k`` pairs at least, in order of (src, dst), that one of a few ids is part of; members are (id, value)."""
    return _beside(members, ids, k, True).unionByName(_beside(members, ids, k, False)).distinct()


def pairs_after(members: DataFrame, ids: DataFrame) -> DataFrame:
    """All pairs of a few ids with members of larger id."""
    mine = members.join(ids.select("id").distinct(), "id").select(F.col("id").alias("src"), "value")
    return mine.join(members.select(F.col("id").alias("dst"), "value"), "value").where("src < dst").select("src", "dst").distinct()


def pairs_inside(members: DataFrame, ids: DataFrame) -> DataFrame:
    """All pairs among a few ids."""
    ours = members.join(ids.select("id").distinct(), "id", "left_semi")
    a, b = ours.select(F.col("id").alias("src"), "value"), ours.select(F.col("id").alias("dst"), "value")
    return a.join(b, "value").where("src < dst").select("src", "dst").distinct()


def first_pairs(members: DataFrame, k: int) -> DataFrame:
    """The first ``k`` pairs of all in order of (src, dst): those of the ``k`` smallest ids that have a larger member beside them."""
    last, _ = materialize(members.groupBy("value").agg(F.max("id").alias("last")), "group-last")
    starts = members.join(last, "value").where("id < last").select("id").distinct().orderBy("id").limit(k)
    return _beside(members, starts, k, True).orderBy("src", "dst").limit(k)
