"""Synchronous label propagation (community detection).

Every vertex starts with its own id as label. Each round every edge sends the
label of each endpoint to the other one (edge direction ignored, parallel edges
count twice); a vertex adopts the label it received most often, ties going to
the smallest label, and a vertex that receives nothing keeps its label.

The mode is found with two aggregates instead of a window, so a hub receiving a
third of all messages is pre-aggregated on the map side: count per (vertex,
label), then one max per vertex over (votes, inverted label) packed into a
decimal -- more votes win, ties go to the smallest label.

``groups`` (``groups.signed_contacts``) stand for edges between all members of a group, of which each other member
sends one vote. A round then counts a histogram of labels per group, and a member of an address, a phone and both
together gets address(label) + phone(label) - both(label) votes, less what it adds to these itself. Its best label is one of few:

* the first two of its address and of its phone: a label of one list alone has its count there, and the first but the
  member's own bounds all others of that list;
* a label of both lists: these are found once for each pair of address and phone that some member has, by looking up the
  labels of the group with fewer different ones in the other's histogram;
* a label that an edge sends it, looked up in its groups' histograms.

So a round's work grows with members, edges and the smaller lists, and no pair of members is listed. What edges send to
vertices outside all groups is counted apart and neither written nor met with the lists.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwise.operators.groups import encode_groups, shared_only
from ringwise.operators.ids import decode, encode_edges, index_ids
from ringwise.operators.iterate import Rounds, materialize


# Packing of (votes, label) into one hash-aggregatable decimal (labels are non-negative longs).
_PACK = "decimal(38,0)"
_SHIFT = 2**63
_LAST = 2**63 - 1


def _packed(votes: Column, label: Column) -> Column:
    """votes * 2^63 + (2^63 - 1 - label): the largest has most votes, then the smallest label."""
    return votes.cast(_PACK) * F.lit(str(_SHIFT)).cast(_PACK) + (F.lit(_LAST) - label).cast(_PACK)


def _label_of(packed: Column) -> Column:
    return F.lit(_LAST) - (packed % F.lit(str(_SHIFT)).cast(_PACK)).cast("long")


def label_propagation(vertices: DataFrame, edges: DataFrame, rounds: int = 5, groups: DataFrame | None = None) -> DataFrame:
    """(id, label) for every vertex.

    Runs on order-preserving bigint ids, so "smallest label" ties resolve
    exactly as they would on the string ids, with hash aggregates throughout.
    Groups must be of two kinds at most for a member, and of both together.
    """
    index = index_ids(vertices)
    held = None if groups is None else _held(groups, index)
    labels = _propagate(index.select(F.col("vid").alias("id")), encode_edges(edges.select("src", "dst"), index), rounds, held)
    return decode(decode(labels, index, "id", "_id"), index, "label", "_label").select(
        F.col("_id").alias("id"), F.col("_label").alias("label")
    )


@dataclass(frozen=True)
class _Held:
    """Groups by number: ``rows`` (id, gid, sign); ``wide`` (id, one, other, both), a row a member, null where it has none; ``combos``, the pairs that occur."""

    rows: DataFrame
    wide: DataFrame
    combos: DataFrame


def _held(groups: DataFrame, index: DataFrame) -> _Held:
    members = shared_only(encode_groups(groups, index))
    numbers = index_ids(members.select("value"), "value").select(F.col("id").alias("value"), F.col("vid").alias("gid"))
    rows, _ = materialize(members.join(numbers, "value").select(F.col("vid").alias("id"), "gid", "sign"), "lp-members")
    plain = F.when(F.col("sign") > 0, F.col("gid"))
    wide = rows.groupBy("id").agg(F.min(plain).alias("one"), F.max(plain).alias("other"), F.max(F.when(F.col("sign") < 0, F.col("gid"))).alias("both"))
    wide, _ = materialize(wide.withColumn("other", F.when(F.col("other") != F.col("one"), F.col("other"))), "lp-wide")
    combos, _ = materialize(wide.where("other IS NOT NULL").select("one", "other", "both").distinct(), "lp-combos")
    return _Held(rows, wide, combos)


def _best_two(counts: DataFrame, keys: list[str], votes: str) -> DataFrame:
    """The rows of most votes, two for each key; what can't be among them goes before the shuffle."""
    first = Window.partitionBy(*keys).orderBy(F.desc(votes), "label")
    return counts.withColumn("_nth", F.row_number().over(first)).where("_nth <= 2").drop("_nth")


def _in_both_lists(combos: DataFrame, hist: DataFrame) -> DataFrame:
    """(one, other, label, votes) of the labels that a pair of groups has in common."""
    sizes = hist.groupBy("gid").agg(F.count(F.lit(1)).alias("d"))
    sized = combos.join(sizes.select(F.col("gid").alias("one"), F.col("d").alias("d1")), "one").join(sizes.select(F.col("gid").alias("other"), F.col("d").alias("d2")), "other")
    fewer = sized.select(
        "one", "other", "both", F.when(F.col("d1") <= F.col("d2"), F.col("one")).otherwise(F.col("other")).alias("few"),
        F.when(F.col("d1") <= F.col("d2"), F.col("other")).otherwise(F.col("one")).alias("many"),
    )
    few, many, both = (hist.select(F.col("gid").alias(g), "label", F.col("cnt").alias(f"n_{g}")) for g in ("few", "many", "both"))
    found = fewer.join(few, "few").join(many, ["many", "label"]).join(both, ["both", "label"], "left")
    votes = F.col("n_few") + F.col("n_many") - F.coalesce(F.col("n_both"), F.lit(0))
    return found.select("one", "other", "label", votes.alias("votes"))


def _from_groups(held: _Held, labels: DataFrame, rest: DataFrame, hist: DataFrame) -> DataFrame:
    """(id, label, votes): the candidates of members, by their groups and by what edges send them (``rest``)."""
    lists = _best_two(hist, ["gid"], "cnt").withColumnRenamed("cnt", "votes")
    of_pair = _in_both_lists(held.combos, hist)
    for side in ("one", "other"):
        top = lists.withColumnRenamed("gid", side)
        of_pair = of_pair.unionByName(held.combos.join(top, side).select("one", "other", "label", "votes"))
    of_pair = _best_two(of_pair.groupBy("one", "other", "label").agg(F.max("votes").alias("votes")), ["one", "other"], "votes")
    # a member counts in each of its groups itself; a group of both that it has alone isn't listed
    times = F.expr("int(one IS NOT NULL) + int(other IS NOT NULL) - int(both IS NOT NULL)")
    mine = held.wide.join(labels.withColumnRenamed("label", "own"), "id").withColumn("times", times)
    less_own = F.col("votes") - F.when(F.col("label") == F.col("own"), F.col("times")).otherwise(0)
    with_two = mine.where("other IS NOT NULL").select("id", "one", "other", "own", "times").join(of_pair, ["one", "other"])
    with_one = mine.where("other IS NULL").select("id", F.col("one").alias("gid"), "own", "times").join(lists, "gid")
    candidates = with_two.select("id", "label", less_own.alias("votes")).unionByName(with_one.select("id", "label", less_own.alias("votes")))
    # what edges send to members counts in their groups too
    asked = rest.join(held.rows, "id").join(hist, ["gid", "label"]).select("id", "label", (F.col("sign") * F.col("cnt")).alias("votes"))
    own = mine.select("id", F.col("own").alias("label"), (-F.col("times")).cast("long").alias("votes"))
    own = own.join(rest.select("id", "label"), ["id", "label"], "left_semi")
    exact = rest.unionByName(asked).unionByName(own).groupBy("id", "label").agg(F.sum("votes").alias("votes"))
    return candidates.unionByName(exact)


def _sent(wires: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, label, votes): what the wires bring."""
    brought = wires.join(labels.withColumnRenamed("id", "u"), "u")
    return brought.groupBy(F.col("v").alias("id"), "label").agg(F.count(F.lit(1)).alias("votes"))


def _propagate(vertices: DataFrame, edges: DataFrame, rounds: int, held: _Held | None) -> DataFrame:
    e = edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    wires = e.select(F.expr("inline(array(struct(src AS u, dst AS v), struct(dst AS u, src AS v)))"))
    if held is not None:
        # what is sent to members of groups counts beside their groups' lists; to all others it is all that counts
        wires = wires.join(held.wide.select(F.col("id").alias("v"), F.lit(True).alias("member")), "v", "left")
    wires, _ = materialize(wires, "lp-wires")
    plain = wires
    if held is not None:
        plain = wires.where("member IS NULL").select("u", "v")
        wires, _ = materialize(wires.where("member").select("u", "v"), "lp-inner")
    store, lists, sent = (Rounds(vertices.sparkSession, name) for name in ("lp", "lp-hist", "lp-rest"))
    labels, _ = store.write(vertices.select("id", F.col("id").alias("label")), 0)
    for rnd in range(1, rounds + 1):
        votes = _sent(plain, labels)
        if held is not None:
            # both are read several times
            rest, _ = sent.write(_sent(wires, labels), rnd)
            hist, _ = lists.write(held.rows.join(labels, "id").groupBy("gid", "label").agg(F.count(F.lit(1)).alias("cnt")), rnd)
            # a label that only the vertex itself has is no vote
            votes = votes.unionByName(_from_groups(held, labels, rest, hist).where("votes > 0"))
        winner = votes.groupBy("id").agg(F.max(_packed(F.col("votes"), F.col("label"))).alias("best"))
        winner = winner.select("id", _label_of(F.col("best")).alias("new_label"))
        nxt = labels.join(winner, "id", "left").select("id", F.coalesce("new_label", "label").alias("label"))
        labels, _ = store.write(nxt, rnd)
    return labels
