"""Property graph as two DataFrames, and the claims-graph builders.

Vertex schema: id, type, name, fraud_score, score_milli, amount, category,
status, address, phone, event_date (unused columns NULL per type).
Edge schema: src, dst, relationship, edge_date, fraud_score, claim_count.
Edges are directed; algorithms that need an undirected view symmetrise.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise import config as C
from ringwise.operators.groups import listed_pairs
from ringwise.operators.iterate import materialize
from ringwise.operators.ranking import later_in_group
from ringwise.sources.fixtures import ClaimTables

VERTEX_COLUMNS = (
    ("id", "string"),
    ("type", "string"),
    ("name", "string"),
    ("fraud_score", "double"),
    ("score_milli", "int"),
    ("amount", "double"),
    ("category", "string"),
    ("status", "string"),
    ("address", "string"),
    ("phone", "string"),
    ("event_date", "date"),
)
EDGE_COLUMNS = (
    ("src", "string"),
    ("dst", "string"),
    ("relationship", "string"),
    ("edge_date", "date"),
    ("fraud_score", "double"),
    ("claim_count", "long"),
)


@dataclass(frozen=True)
class PropertyGraph:
    vertices: DataFrame
    edges: DataFrame

    def view(self, relationships: Iterable[str] | str | None) -> "PropertyGraph":
        """Same vertices, edges restricted to some relationships (or a named view)."""
        if relationships is None:
            return self
        if isinstance(relationships, str):
            relationships = C.VIEWS[relationships]
        rels = list(relationships)
        return PropertyGraph(self.vertices, self.edges.where(F.col("relationship").isin(rels)))


def _conform(df: DataFrame, columns) -> DataFrame:
    """Project to the fixed schema: one ``selectExpr`` (typed NULL for missing columns)."""
    present = set(df.columns)
    return df.selectExpr(
        *[f"cast({n if n in present else 'NULL'} as {t}) AS {n}" for n, t in columns]
    )


def claim_vertices(t: ClaimTables) -> DataFrame:
    return _conform(
        t.claims.selectExpr(
            "claim_id AS id",
            "'claim' AS type",
            "fraud_score",
            "score_milli",
            "claim_amount AS amount",
            "claim_type AS category",
            "status",
            "incident_date AS event_date",
        ),
        VERTEX_COLUMNS,
    )


def policyholder_vertices(t: ClaimTables) -> DataFrame:
    return _conform(
        t.policyholders.selectExpr(
            "policyholder_id AS id",
            "'policyholder' AS type",
            "name",
            "customer_tier AS category",
            "address",
            "phone",
            "policy_start_date AS event_date",
        ),
        VERTEX_COLUMNS,
    )


def adjuster_vertices(t: ClaimTables) -> DataFrame:
    return _conform(
        t.adjusters.selectExpr("adjuster_id AS id", "'adjuster' AS type", "name", "department AS category"),
        VERTEX_COLUMNS,
    )


def provider_vertices(t: ClaimTables) -> DataFrame:
    return _conform(
        t.service_providers.selectExpr(
            "service_provider_id AS id", "'provider' AS type", "provider_name AS name", "service_type AS category"
        ),
        VERTEX_COLUMNS,
    )


def build_vertices(t: ClaimTables) -> DataFrame:
    return (
        claim_vertices(t)
        .unionByName(policyholder_vertices(t))
        .unionByName(adjuster_vertices(t))
        .unionByName(provider_vertices(t))
    )


def shared_contact_pairs(policyholders: DataFrame) -> DataFrame:
    """(src, dst) with src < dst for every two policyholders sharing an address or phone.

    Equi-joins of blocks of each group's members (``groups.listed_pairs``), instead of one OR-theta join that would plan as
    a nested loop; no pair is shuffled. The output is the pair set itself, so its size is sum(group_size^2)/2;
    connectivity-only operators use ``shared_contact_star`` instead.
    """
    return listed_pairs(policyholders)


def shared_contact_star(policyholders: DataFrame) -> DataFrame:
    """Linear-size edges with the same connectivity as ``shared_contact_pairs``.

    Each policyholder is linked to the smallest id sharing its address (and its
    phone). A contact value held by a third of all rows costs one partial
    aggregate, written so that its members' join can be split.
    """
    out = None
    for attr in ("address", "phone"):
        side = policyholders.select(F.col("policyholder_id").alias("pid"), F.col(attr).alias("v")).where(
            F.col("v").isNotNull()
        )
        root, _ = materialize(side.groupBy("v").agg(F.min("pid").alias("root")), f"contact-{attr}")
        star = side.join(root, "v").where(F.col("pid") != F.col("root")).select(
            F.col("root").alias("src"), F.col("pid").alias("dst")
        )
        out = star if out is None else out.unionByName(star)
    return out.distinct()


def contact_edges(pairs: DataFrame, as_of: str) -> DataFrame:
    """Shared-contact edges of listed pairs (src, dst)."""
    return _conform(pairs.selectExpr("src", "dst", f"'{C.SHARED_CONTACT}' AS relationship", f"DATE'{as_of}' AS edge_date"), EDGE_COLUMNS)


def shared_contact_edges(t: ClaimTables, as_of: str) -> DataFrame:
    return contact_edges(shared_contact_pairs(t.policyholders), as_of)


def collaboration_pairs(claims: DataFrame, left: str, right: str, min_claims: int) -> DataFrame:
    """Entity pairs that appear together on at least ``min_claims`` claims.

    Partial aggregation runs before the shuffle, so a hot pair costs one row
    per map task. ``fraud_score`` is the exact mean of the claim scores.
    """
    return (
        claims.groupBy(F.col(left).alias("src"), F.col(right).alias("dst"))
        .agg(F.count(F.lit(1)).alias("claim_count"), F.sum("score_milli").alias("sum_milli"))
        .where(F.col("claim_count") >= min_claims)
        .select(
            "src",
            "dst",
            "claim_count",
            (F.col("sum_milli").cast("double") / (F.col("claim_count") * F.lit(1000)).cast("double")).alias(
                "fraud_score"
            ),
        )
    )


def build_edges(t: ClaimTables, as_of: str = C.DEFAULT_AS_OF, relationships: Iterable[str] | None = None) -> DataFrame:
    """Edges of the wanted relationships (all by default); what isn't wanted is not built."""
    wanted = set(C.ALL_RELATIONSHIPS if relationships is None else relationships)
    rest = sorted(wanted - {C.SHARED_CONTACT})
    parts = [build_edges_without_contacts(t, as_of, rest)] if rest else []
    if C.SHARED_CONTACT in wanted:
        parts.append(shared_contact_edges(t, as_of))
    return reduce(DataFrame.unionByName, parts)


def build_graph(t: ClaimTables, as_of: str = C.DEFAULT_AS_OF, relationships: Iterable[str] | None = None) -> PropertyGraph:
    return PropertyGraph(build_vertices(t), build_edges(t, as_of, relationships))


def connectivity_edges(t: ClaimTables, relationships: Iterable[str], as_of: str = C.DEFAULT_AS_OF) -> DataFrame:
    """Edges of a view for connectivity-only operators (components).

    Like ``build_edges`` of the view, except that shared contacts use the linear
    star form (same components, no pair explosion).
    """
    rest = sorted(set(relationships) - {C.SHARED_CONTACT})
    parts = [build_edges_without_contacts(t, as_of, rest).select("src", "dst")] if rest else []
    if C.SHARED_CONTACT in relationships:
        parts.append(shared_contact_star(t.policyholders).select("src", "dst"))
    return reduce(DataFrame.unionByName, parts)


def contact_members(policyholders: DataFrame) -> DataFrame:
    """(id, value): the contact values of each holder; who shares one is an edge apart."""
    parts = [
        policyholders.select(F.col("policyholder_id").alias("id"), F.concat(F.lit(f"{kind}:"), F.col(kind)).alias("value"))
        for kind in ("address", "phone")
    ]
    return parts[0].unionByName(parts[1]).where(F.col("value").isNotNull())


def contact_degrees(policyholders: DataFrame) -> DataFrame:
    """(id, out_degree, in_degree) in the shared-contact edges (smaller to larger id), from group sizes.

    Who shares the address or the phone is who shares the one, plus the other,
    less both. No pair is listed.
    """
    out = policyholders.select(F.col("policyholder_id").alias("id"), "address", "phone")
    parts = []
    for group, sign in ((["address"], 1), (["phone"], 1), (["address", "phone"], -1)):
        members = out.dropna(subset=group).select("id", *group)
        size, _ = materialize(members.groupBy(*group).agg(F.count(F.lit(1)).alias("size")), "contact-sizes")
        ranked = later_in_group(members, group, "id").join(size, group)
        parts.append(ranked.select("id", (sign * F.col("later")).alias("o"), (sign * (F.col("size") - 1 - F.col("later"))).alias("i")))
    return reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def contact_pair_count(policyholders: DataFrame) -> DataFrame:
    """One row: how many shared-contact edges there are (column ``count``), from group sizes."""
    parts = []
    for group, sign in ((["address"], 1), (["phone"], 1), (["address", "phone"], -1)):
        sizes = policyholders.dropna(subset=group).groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
        parts.append(sizes.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("pairs")).select((sign * F.col("pairs")).alias("pairs")))
    return reduce(DataFrame.unionByName, parts).agg(F.sum("pairs").alias("count"))


# how each relationship comes from a claim: struct fields for claim edges, and grouped pairs with their least claims
_CLAIM_EDGES = {
    C.FILED_BY: ("policyholder_id", "filing_date"),
    C.PROCESSED_BY: ("adjuster_id", "filing_date"),
    C.SERVICED_BY: ("service_provider_id", "incident_date"),
}
_PAIR_EDGES = {
    C.REPEAT_ADJUSTER: ("policyholder_id", "adjuster_id", 2),
    C.REPEAT_PROVIDER: ("policyholder_id", "service_provider_id", 2),
    C.FREQUENT_COLLABORATION: ("adjuster_id", "service_provider_id", 3),
}


def _fanned(claims: DataFrame, keep: list[str], structs: list[str]) -> DataFrame:
    """Each claim once for each struct; a single struct needs no generator."""
    if len(structs) == 1:
        return claims.selectExpr(*keep, f"{structs[0]} AS s").selectExpr(*[k.split(" AS ")[-1] for k in keep], "s.*")
    return claims.selectExpr(*keep, f"inline(array({', '.join(structs)}))")


def build_edges_without_contacts(
    t: ClaimTables, as_of: str = C.DEFAULT_AS_OF, relationships: Iterable[str] | None = None
) -> DataFrame:
    """The wanted relationships except shared contacts, from at most two passes over the claims.

    Claim edges come from one scan (a claim fans out to the wanted ones); the
    collaboration pair sets share one scan and one shuffle, grouped by
    (relationship, src, dst).
    """
    wanted = [r for r in C.ALL_RELATIONSHIPS if r != C.SHARED_CONTACT and (relationships is None or r in relationships)]
    parts = []
    direct = [r for r in wanted if r in _CLAIM_EDGES]
    if direct:
        structs = [f"struct({_CLAIM_EDGES[r][0]} AS dst, '{r}' AS relationship, {_CLAIM_EDGES[r][1]} AS edge_date)" for r in direct]
        fanned = _fanned(t.claims, ["claim_id AS src", "fraud_score"], structs)
        parts.append(_conform(fanned.selectExpr("src", "dst", "relationship", "edge_date", "fraud_score", "1L AS claim_count"), EDGE_COLUMNS))
    pairs = [r for r in wanted if r in _PAIR_EDGES]
    if pairs:
        structs = ["struct('{}' AS relationship, {} AS src, {} AS dst, {} AS min_claims)".format(r, *_PAIR_EDGES[r]) for r in pairs]
        collab = (
            _fanned(t.claims, ["score_milli"], structs)
            .groupBy("relationship", "src", "dst", "min_claims")
            .agg(F.count(F.lit(1)).alias("claim_count"), F.sum("score_milli").alias("sum_milli"))
            .where(F.col("claim_count") >= F.col("min_claims"))
            .selectExpr(
                "src",
                "dst",
                "relationship",
                f"DATE'{as_of}' AS edge_date",
                "cast(sum_milli as double) / cast(claim_count * 1000 as double) AS fraud_score",
                "claim_count",
            )
        )
        parts.append(_conform(collab, EDGE_COLUMNS))
    return reduce(DataFrame.unionByName, parts)
