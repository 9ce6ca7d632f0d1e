"""Secret scans: candidate secrets of all texts, judged by how many owners and repositories hold them.

Candidates. Patterns of six ``KINDS`` are matched from left to right in the whole text. The first three
make the base and are always reported. The others look for what the base has no pattern for: long strings of
capitals, small letters and digits outside assignments, passwords in addresses, and private key blocks.

Ownership. Every candidate's value is hashed, and the hash counted over the corpus: by the distinct
repositories (places that hold it; several copies in one place are one) and by the distinct owners of those.
A value that ``copied_owners`` owners or ``copied_places`` repositories hold is a widely copied example;
one that at most ``live_owners`` owner holds, and that looks random (``LEAST_DISTINCT`` characters, no word of
an example), is an owner's live-looking credential. A candidate beyond the base is reported if it is live.

Only DataFrame functions run. Positions are sums of the lengths of matches and of the pieces between
them, in code points; a text's running sums cost n to the power of 1.5 for n matches, so very long texts with
many matches stay cheap. Counting goes by three aggregates, each summed before it is shuffled, so a value in a third
of all rows costs a row a task. Verdicts of values that hold a thousandth of all candidates, at most a thousand
of them, are broadcast; those of the others are joined by value. Rows are told apart by a number written with
them, so repeated rows and keys stay apart.

Defined cases: a null text is empty and has no spans; a null owner or repository counts as one of its own;
overlapping spans of several kinds all stay; rows of equal texts have equal results; an empty table gives no
rows; input columns other than the key, text, owner and repository are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwise.llm.common import Scratch

#: Kind, pattern, group of its value, least characters of the value. Of ``access`` and ``hex`` a match runs to the end
#: of its characters, so that asking for the least number in the pattern drops the same matches.
_ASSIGNED = (
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = (
    ("assign", _ASSIGNED, 1, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("opaque", r"[A-Za-z0-9+/_-]{24,}", 0, 24),
    ("userinfo", r"[A-Za-z]://[A-Za-z0-9._~%-]+:([A-Za-z0-9._~%!*+=-]+)@", 1, 6),
    ("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]+", 0, 40),
)
N_BASE = 3
OPAQUE = 3
#: A value of fewer distinct characters does not look random.
LEAST_DISTINCT = 8
#: Words that mark an example.
EXAMPLE = r"example|sample|changeme|change_me|placeholder|dummy|your[_-]|xxxx|1234567|abcdefg"
#: Values with this share of all candidates have their verdicts broadcast.
HEAVY = 1_000

_SPAN = "array<struct<start: bigint, kind: int, end: bigint, value: bigint, random: boolean>>"
_JUDGED = "array<struct<start: bigint, kind: int, end: bigint, verdict: string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(numbers: Column) -> Column:
    """Sums of an array's numbers up to each one, itself included, by blocks of the root of its size."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def by_blocks(x: Column) -> Column:
        g, k = x["g"], x["k"]
        places = F.sequence(F.lit(0), F.floor((F.size(g) - 1) / k).cast("int"))
        blocks = F.transform(places, lambda c: total(F.slice(g, c * k + 1, k)))
        before = _let(blocks, lambda b: F.transform(places, lambda c: total(F.slice(b, F.lit(1), c))))
        return _let(
            before,
            lambda b: F.transform(g, lambda _, i: F.get(b, F.floor(i / k).cast("int")) + total(F.slice(g, i - i % k + 1, i % k + 1))),
        )

    root = F.ceil(F.sqrt(F.size(numbers).cast("double"))).cast("int")
    blocked = _let(F.struct(numbers.alias("g"), root.alias("k")), by_blocks)
    return F.when(F.size(numbers) > 0, blocked).otherwise(F.array().cast("array<bigint>"))


def _long(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.char_length(t).cast("bigint"))


def located(text: Column, kind: int) -> Column:
    """Spans of one kind in a text, from left to right."""
    _, pattern, group, least = KINDS[kind]
    rx = F.lit(pattern)

    def wanted(value: Column) -> Column:
        mixed = F.rlike(value, F.lit("[A-Z]")) & F.rlike(value, F.lit("[a-z]")) & F.rlike(value, F.lit("[0-9]"))
        return (F.char_length(value) >= least) & (mixed if kind == OPAQUE else F.lit(True))

    def spans(x: Column) -> Column:
        # a piece, then a match, and so on; what follows the last match doesn't matter
        steps = F.zip_with(F.slice(_long(x["between"]), F.lit(1), F.size(x["whole"])), _long(x["whole"]), lambda a, b: a + b)
        ends = _let(steps, running_sums)
        pairs = F.arrays_zip(ends.alias("end"), x["whole"].alias("whole"), x["value"].alias("value"))
        return F.transform(
            F.filter(pairs, lambda m: wanted(m["value"])),
            lambda m: F.struct(
                (m["end"] - F.char_length(m["whole"])).alias("start"),
                F.lit(kind).alias("kind"),
                m["end"].alias("end"),
                F.xxhash64(m["value"]).alias("value"),
                looks_random(m["value"]).alias("random"),
            ),
        )

    found = F.struct(
        F.regexp_extract_all(text, rx, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, rx, F.lit(group)).alias("value"),
        F.split(text, pattern, -1).alias("between"),
    )
    return F.when(F.rlike(text, rx), _let(found, spans)).otherwise(F.array()).cast(_SPAN)


def looks_random(value: Column) -> Column:
    several = F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT
    return several & ~F.rlike(F.lower(value), F.lit(EXAMPLE))


def without_assignments(text: Column) -> Column:
    """The text with its assignments blanked, every other character at its place."""
    rx = F.lit(KINDS[0][1])
    found = F.struct(F.split(text, KINDS[0][1], -1).alias("between"), F.regexp_extract_all(text, rx, F.lit(0)).alias("whole"))

    def blanked(x: Column) -> Column:
        # one piece more than matches: the last piece is followed by none
        parts = F.zip_with(x["between"], x["whole"], lambda p, m: F.concat(p, F.repeat(F.lit(" "), F.coalesce(F.char_length(m), F.lit(0)))))
        return F.array_join(parts, "")

    return F.when(F.rlike(text, rx), _let(found, blanked)).otherwise(text)


def candidates(text: Column) -> Column:
    """All candidate spans of a text: by start, then by kind."""

    def opaque(masked: Column) -> Column:
        return located(masked, OPAQUE)

    parts = [_let(without_assignments(text), opaque) if k == OPAQUE else located(text, k) for k in range(len(KINDS))]
    return F.sort_array(F.concat(*parts))


def _is(kind: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def scan_columns(spans: Column) -> list[Column]:
    """The result's columns from a row's judged spans."""

    def printed(some: Column) -> Column:
        names = F.array(*[F.lit(k[0]) for k in KINDS])
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def number(test: Callable[[Column], Column]) -> Column:
        return F.size(F.filter(spans, test)).cast("bigint")

    return [
        *[number(_is(k)).alias(f"n_{KINDS[k][0]}") for k in range(N_BASE)],
        F.sha2(printed(F.filter(spans, lambda s: s["kind"] < N_BASE)), 256).alias("base_sha256"),
        printed(spans).alias("spans"),
        number(lambda s: s["kind"] >= N_BASE).alias("n_added"),
        printed(F.filter(spans, lambda s: s["verdict"] == "live")).alias("live_spans"),
        printed(F.filter(spans, lambda s: s["verdict"] == "copied")).alias("copied_spans"),
    ]


def ownership(found: DataFrame, live_owners: int = 1, copied_owners: int = 3, copied_places: int = 10) -> DataFrame:
    """(value, owners, places, n, owned, copied) of candidate rows (value, owner, place)."""
    per_place = found.groupBy("value", "owner", "place").agg(F.count(F.lit(1)).alias("n"))
    per_owner = per_place.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("places"), F.sum("n").alias("n"))
    per_value = per_owner.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("places").alias("places"), F.sum("n").alias("n"))
    copied = (F.col("owners") >= copied_owners) | (F.col("places") >= copied_places)
    return per_value.withColumns({"owned": (F.col("owners") <= live_owners) & ~copied, "copied": copied})


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    place: str | None = None,
    live_owners: int = 1,
    copied_owners: int = 3,
    copied_places: int = 10,
) -> DataFrame:
    """One row a document: see the module. ``place`` names the repository; without it, each different text is one.

    ``spans`` has all spans as kind:start:end, ``live_spans`` and ``copied_spans`` those of live and of widely copied values.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    body = F.coalesce(F.col(text), F.lit(""))
    where = F.xxhash64(body) if place is None else F.xxhash64(F.col(place))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(owner).alias("owner"), where.alias("place"), candidates(body).alias("found"))
    rows = scratch.save(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    spans = rows.where(F.size("found") > 0).select("row", "doc_id", "owner", "place", F.inline("found"))
    known = scratch.save(ownership(spans.select("value", "owner", "place"), live_owners, copied_owners, copied_places), "known")
    total = known.agg(F.sum("n")).first()[0] or 0
    verdicts = known.select(F.col("value").alias("__value"), "owned", "copied", (F.col("n") * HEAVY >= total).alias("heavy"))
    # at most HEAVY values have such a share of all candidates
    often = F.broadcast(verdicts.where("heavy").drop("heavy"))
    near = spans.join(often, F.col("value") == F.col("__value"), "left")
    judged = near.where(F.col("__value").isNotNull())
    rest = near.where(F.col("__value").isNull()).drop("__value", "owned", "copied")
    judged = judged.unionByName(rest.join(verdicts.where("not heavy").drop("heavy"), F.col("value") == F.col("__value")))
    verdict = F.when(F.col("copied"), "copied").when(F.col("owned") & F.col("random"), "live").otherwise("unclear")
    one = F.struct("start", "kind", "end", verdict.alias("verdict"))
    grouped = judged.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.collect_list(one).alias("spans"))
    wanted = F.filter(F.sort_array("spans"), lambda s: (s["kind"] < N_BASE) | (s["verdict"] == "live"))
    bare = rows.where(F.size("found") == 0).select("doc_id", F.array().cast(_JUDGED).alias("spans"))
    return grouped.select("doc_id", wanted.alias("spans")).unionByName(bare).select("doc_id", *scan_columns(F.col("spans")))
